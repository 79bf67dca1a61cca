"""Key figures, revenue at risk and retention campaign economics.

All tables start from two single-row aggregates: ``kpis`` over the customers and ``tier_counts``
over the scored rows. Everything after that is arithmetic on one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.columns import (
    COST_SHARE, HIGH_RISK, KEY, MEDIUM_RISK, MEDIUM_WEIGHT, MONTHS, RETENTION,
)
from stayline.functions.exprs import one_row
from stayline.operators.risk import scored_summary, tier, tier_counts


def kpis(df: DataFrame) -> DataFrame:
    """Churn rate, customers, churned customers, mean charge, annual revenue at risk."""
    base = df.agg(
        F.expr("avg(label) * 100 as churn_rate"), F.expr("count(1) as n_customers"),
        F.expr("sum(label) as n_churned"), F.expr("avg(monthly_charges) as mean_charge"),
    )
    return base.selectExpr("*", f"n_churned * mean_charge * {MONTHS} as revenue_at_risk")


def scored_kpis(customers: DataFrame, scored: DataFrame) -> DataFrame:
    """Key figures with the risk tiers and the predicted churn rate of the scored rows."""
    return kpis(customers).withColumn("t", one_row(scored_summary(scored))).select("*", "t.*").drop("t")


def monthly_risk(df: DataFrame) -> DataFrame:
    """Revenue at risk per month: a twelfth of the year, rising by two points a month from 0.9."""
    return kpis(df).selectExpr("revenue_at_risk", f"explode(sequence(0, {MONTHS - 1})) as month").selectExpr(
        "month", f"revenue_at_risk / {MONTHS} * (0.9D + 0.02D * month) as risk"
    )


def campaign_roi(customers: DataFrame, scored: DataFrame) -> DataFrame:
    """Cost, savings and return of a campaign on the high and medium tiers; no cost gives null ROI."""
    base = kpis(customers).select("mean_charge", "revenue_at_risk").withColumn("t", one_row(tier_counts(scored)))
    saved = base.selectExpr(
        "mean_charge", "revenue_at_risk", "t.n_high", "t.n_medium",
        f"(mean_charge * {COST_SHARE}D) as unit_cost",
        f"t.n_high * {RETENTION}D * mean_charge * {MONTHS} as high_saved",
        f"t.n_medium * {RETENTION}D * {MEDIUM_WEIGHT}D * mean_charge * {MONTHS} as medium_saved",
    )
    totals = saved.selectExpr(
        "*", "high_saved + medium_saved as total_saved", "(n_high + n_medium) * unit_cost as total_cost"
    )
    return totals.selectExpr("*", "try_divide(total_saved - total_cost, total_cost) * 100 as roi_pct")


def roi_waterfall(roi: DataFrame) -> DataFrame:
    """Steps from revenue at risk to net benefit, in thousands."""
    steps = {
        "Revenue at Risk": "revenue_at_risk", "Campaign Cost": "-total_cost", "High Risk Saved": "high_saved",
        "Medium Risk Saved": "medium_saved", "Net Benefit": "total_saved - total_cost",
    }
    rows = ", ".join(f"{i + 1}, '{name}', ({sql}) / 1000" for i, (name, sql) in enumerate(steps.items()))
    return roi.selectExpr(f"stack({len(steps)}, {rows}) as (step, item, value_k)")


def segment_savings(roi: DataFrame) -> DataFrame:
    """Savings and cost per targeted segment, in thousands."""
    return roi.selectExpr(
        "stack(2, 'High Risk (≥70%)', n_high, high_saved / 1000, n_high * unit_cost / 1000, "
        "'Medium Risk (40-70%)', n_medium, medium_saved / 1000, n_medium * unit_cost / 1000) "
        "as (segment, n, saved_k, cost_k)"
    )


def savings_projection(roi: DataFrame, months: int = MONTHS) -> DataFrame:
    """Savings, cost and cumulative net per month. The running sum covers ``months`` rows."""
    monthly = roi.selectExpr("total_saved", "total_cost", f"explode(sequence(1, {months})) as month").selectExpr(
        "month",
        f"total_saved / {months} * (1 - exp(-0.4D * month)) * (1 + 0.01D * (month - 1)) as savings",
        f"total_cost / {months} * least(1D, 0.5D + 0.04D * month) as cost",
    )
    return monthly.selectExpr(
        "*", "sum(savings - cost) over (order by month rows unbounded preceding) as cumulative_net"
    )


# Fixed texts shown to an agent, each with the condition that raises it.
REASONS = {
    "month-to-month contract": "contract = 'Month-to-month'",
    "pays by electronic check": "payment_method = 'Electronic check'",
    "fiber optic without security or support":
        "internet_service = 'Fiber optic' and (online_security = 'No' or tech_support = 'No')",
    "new customer (months 1-6)": "tenure between 1 and 6",
}


def action_list(df: DataFrame, score: str = "score", key: str = KEY) -> DataFrame:
    """Customers to contact: tier, weeks to act within and reasons."""
    reasons = ", ".join(f"if({condition}, '{text}', null)" for text, condition in REASONS.items())
    return df.where(F.col(score) >= MEDIUM_RISK).selectExpr(
        key, score, f"{tier(score)} as tier",
        f"if({score} >= {HIGH_RISK}D, 2, 4) as horizon_weeks",
        f"concat_ws('; ', {reasons}) as reasons",
    )
