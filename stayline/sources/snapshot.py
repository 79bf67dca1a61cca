"""Customer snapshot derived from the order tables: one row per customer, 21 columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.columns import ADDONS, PUBLIC_NAME
from stayline.session import once
from stayline.sources.store import Store, file_status

# Part type behind each add-on service, in the order of ADDONS.
ADDON_PART_TYPES = ["ECONOMY", "SMALL", "MEDIUM", "PROMO", "LARGE", "STANDARD"]


NO_PHONE = "c_nationkey % 10 = 0"
NO_INTERNET = "c_mktsegment = 'HOUSEHOLD'"


def _yes_no(condition: str) -> str:
    return f"if({condition}, 'Yes', 'No')"


# Every snapshot column over the joined row; null comparisons fall through to the last branch.
DEFINITIONS = {
    "customer_id": "c_name",
    "gender": "if(c_custkey % 2 = 0, 'Male', 'Female')",
    "senior_citizen": "if(c_acctbal < 0, 1, 0)",
    "partner": _yes_no("c_nationkey % 2 = 0"),
    "dependents": _yes_no("c_custkey % 3 = 0"),
    "phone_service": f"if({NO_PHONE}, 'No', 'Yes')",
    "multiple_lines": f"case when {NO_PHONE} then 'No phone service' when n >= 10 then 'Yes' else 'No' end",
    "internet_service": f"case when {NO_INTERNET} then 'No' "
                        "when c_mktsegment in ('MACHINERY', 'BUILDING') then 'Fiber optic' else 'DSL' end",
    **{a: f"case when {NO_INTERNET} then 'No internet service' when {a} >= 7 then 'Yes' else 'No' end"
       for a in ADDONS},
    "contract": "case last.o_orderstatus when 'F' then 'Two year' when 'P' then 'One year' "
                "else 'Month-to-month' end",
    "paperless_billing": _yes_no("c_acctbal >= 4500"),
    "payment_method": "case last.o_orderpriority when '1-URGENT' then 'Electronic check' "
                      "when '2-HIGH' then 'Mailed check' when '3-MEDIUM' then 'Bank transfer (automatic)' "
                      "else 'Credit card (automatic)' end",
    "monthly_charges": "if(n is null, 0.0D, cast(tot as double) / n)",
    "total_charges_raw": "if(tenure = 0, ' ', cast(tot as string))",
    "churn": _yes_no("l is null or datediff(snap_at, l) > 270"),
}


def build_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plan of the snapshot.

    Line items are narrowed to two keys, matched with the parts of the six types only, and counted
    per order before they meet the orders; orders are then folded to one row per customer. Both
    aggregations combine before their shuffle, so an order, part or customer holding a large share
    of the rows costs partial sums, not a long group. Join strategies are left to the optimizer,
    which broadcasts by measured size and splits skewed partitions.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    parts = table("part").select("p_partkey", "p_type").where(F.col("p_type").isin(ADDON_PART_TYPES))
    per_order = (
        table("lineitem").select("l_orderkey", "l_partkey")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey")
        .agg(*[F.expr(f"count_if(p_type = '{t}') as {a}") for t, a in zip(ADDON_PART_TYPES, ADDONS)])
    )
    orders = table("orders")
    per_customer = (
        orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .groupBy("o_custkey")
        .agg(
            F.expr("min(o_orderdate) as f"),
            F.expr("max(o_orderdate) as l"),
            F.expr("count(1) as n"),
            F.expr("sum(cast(o_totalprice as decimal(18,2))) as tot"),
            F.expr("max_by(struct(o_orderstatus, o_orderpriority), struct(o_orderdate, o_orderkey)) as last"),
            *[F.expr(f"sum({a}) as {a}") for a in ADDONS],
        )
    )
    snap_at = orders.agg(F.max("o_orderdate")).scalar()
    joined = table("customer").join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left")
    dated = joined.withColumns({
        "tenure": F.expr("cast(least(72, floor(coalesce(datediff(l, f), 0) / 30)) as int)"), "snap_at": snap_at,
    })
    return dated.selectExpr(*[f"{DEFINITIONS.get(n, n)} as {n}" for n in PUBLIC_NAME])


def snapshot_files(sf_dir: str) -> list[str]:
    """The tables that the snapshot is made of."""
    return [f"{sf_dir}/{t}.parquet" for t in ("customer", "lineitem", "orders", "part")]


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot as a stored table, scanned with column pruning; made anew if a file of its tables has changed."""
    inputs = snapshot_files(sf_dir)
    return once(spark, ("snapshot", tuple(file_status(spark, inputs))), lambda: Store(spark, inputs, {}).table(
        "snapshot", lambda: build_snapshot(spark, sf_dir)))
