"""SQL of every checkable query, for DuckDB over the same Parquet tables.

Written independently of the Spark code: windows, joins and quadratic comparisons where those are
the plainest statement of the result.
"""

from __future__ import annotations

from stayline.columns import (
    ADDONS, BINARY, CATEGORICAL, CORRELATED, ENGINEERED, KEPT_FEATURES, MULTI_LEVEL, NUMERIC, PUBLIC_NAME, SCALED,
    public,
)

# Fixed levels of the multi-level columns, sorted.
_ADDON_LEVELS = ["No", "No internet service", "Yes"]
LEVELS = {
    "multiple_lines": ["No", "No phone service", "Yes"],
    "internet_service": ["DSL", "Fiber optic", "No"],
    **{a: _ADDON_LEVELS for a in ADDONS},
    "contract": ["Month-to-month", "One year", "Two year"],
    "payment_method": [
        "Bank transfer (automatic)", "Credit card (automatic)", "Electronic check", "Mailed check",
    ],
}
FEATURES = (
    [public(c) for c in KEPT_FEATURES]
    + [f"{public(c)}_{v}" for c in MULTI_LEVEL for v in LEVELS[c]]
    + list(ENGINEERED.values())
)


def r(expr: str, digits: int = 6) -> str:
    """Round half to even, without negative zero."""
    return f"(round_even(({expr}) * 1e{digits}, 0) / 1e{digits} + 0.0)"


_PART_TYPES = ["ECONOMY", "SMALL", "MEDIUM", "PROMO", "LARGE", "STANDARD"]
_ADDON_SQL = ",\n".join(
    f"case when c_mktsegment = 'HOUSEHOLD' then 'No internet service' when coalesce(cnt_{a}, 0) >= 7 then 'Yes' "
    f"else 'No' end as {a}"
    for a in ADDONS
)
SNAP = f"""
asat as (select max(o_orderdate) as t from orders),
per_cust as (
  select o_custkey, min(o_orderdate) as f, max(o_orderdate) as l, count(*) as n,
         sum(cast(o_totalprice as decimal(18,2))) as tot
  from orders group by o_custkey),
last_order as (
  select * from (select o_custkey, o_orderstatus, o_orderpriority,
         row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders)
  where rn = 1),
cnt as (
  select o_custkey, {", ".join(f"count(*) filter (where p_type = '{t}') as cnt_{a}" for t, a in zip(_PART_TYPES, ADDONS))}
  from orders join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey group by o_custkey),
base as (
  select c.*, p.f, p.l, p.n, p.tot, lo.o_orderstatus, lo.o_orderpriority, cnt.* exclude (o_custkey),
         cast(least(72, floor(coalesce(date_diff('day', p.f, p.l), 0) / 30)) as int) as tenure
  from customer c left join per_cust p on p.o_custkey = c.c_custkey
  left join last_order lo on lo.o_custkey = c.c_custkey left join cnt on cnt.o_custkey = c.c_custkey),
snap as (
  select c_name as customer_id,
    case when c_custkey % 2 = 0 then 'Male' else 'Female' end as gender,
    case when c_acctbal < 0 then 1 else 0 end as senior_citizen,
    case when c_nationkey % 2 = 0 then 'Yes' else 'No' end as partner,
    case when c_custkey % 3 = 0 then 'Yes' else 'No' end as dependents,
    tenure,
    case when c_nationkey % 10 = 0 then 'No' else 'Yes' end as phone_service,
    case when c_nationkey % 10 = 0 then 'No phone service' when n >= 10 then 'Yes' else 'No' end as multiple_lines,
    case when c_mktsegment = 'HOUSEHOLD' then 'No' when c_mktsegment in ('MACHINERY', 'BUILDING') then 'Fiber optic'
         else 'DSL' end as internet_service,
    {_ADDON_SQL},
    case when o_orderstatus = 'F' then 'Two year' when o_orderstatus = 'P' then 'One year'
         else 'Month-to-month' end as contract,
    case when c_acctbal >= 4500 then 'Yes' else 'No' end as paperless_billing,
    case when o_orderpriority = '1-URGENT' then 'Electronic check' when o_orderpriority = '2-HIGH' then 'Mailed check'
         when o_orderpriority = '3-MEDIUM' then 'Bank transfer (automatic)'
         else 'Credit card (automatic)' end as payment_method,
    case when n is null then 0.0::double else cast(tot as double) / n end as monthly_charges,
    case when tenure = 0 then ' ' else cast(tot as varchar) end as total_charges_raw,
    case when l is null or date_diff('day', l, (select t from asat)) > 270 then 'Yes' else 'No' end as churn
  from base)"""

NUM = SNAP + """,
num as (select * exclude (total_charges_raw), try_cast(trim(total_charges_raw) as double) as total_charges from snap)"""
CLEAN = NUM + """,
clean as (
  select * replace (coalesce(total_charges, (select quantile_cont(total_charges, 0.5) from num)) as total_charges),
         case when churn = 'Yes' then 1 else 0 end as label
  from num)"""


def _coded(c: str) -> str:
    return f"case {c} when 'Yes' then 1 when 'No' then 0 when 'Male' then 1 when 'Female' then 0 end"


_FLAGS = [f"""case when {c} = '{v}' then 1 else 0 end as "{public(c)}_{v}" """ for c in MULTI_LEVEL for v in LEVELS[c]]
_SUBSCRIBED = " + ".join(f"case when {a} = 'Yes' then 1 else 0 end" for a in ADDONS)
_DERIVED = {
    "avg_monthly_charges": "total_charges / (tenure + 1)",
    "charge_per_tenure": "monthly_charges / (tenure + 1)",
    "has_streaming": "case when streaming_tv = 'Yes' or streaming_movies = 'Yes' then 1 else 0 end",
    "has_security": "case when online_security = 'Yes' or tech_support = 'Yes' then 1 else 0 end",
    "num_addon_services": _SUBSCRIBED,
}
FEAT = CLEAN + f""",
feat as (select customer_id, churn, label,
  {", ".join(f'{_coded(c) if c in BINARY else c} as "{public(c)}"' for c in KEPT_FEATURES)},
  {", ".join(_FLAGS)},
  {", ".join(f'{sql} as "{ENGINEERED[c]}"' for c, sql in _DERIVED.items())}
  from clean),
split as (
  select *, row_number() over (partition by label order by md5(customer_id || '|42'), customer_id)
            <= round(0.2 * count(*) over (partition by label)) as is_test
  from feat)"""
_FIT = ", ".join(f'avg("{c}") as "m_{c}", stddev_pop("{c}") as "s_{c}"' for c in SCALED)
_SCALE = ", ".join(
    f'("{c}" - "m_{c}") / case when "s_{c}" = 0 then 1.0 else "s_{c}" end as "{c}"' for c in SCALED
)
SCALEDF = FEAT + f""",
fitted as (select {_FIT} from split where not is_test),
scaled as (select split.* replace ({_SCALE}) from split cross join fitted)"""

SCORE = "cast(least(100, greatest(0, {points})) as double) / 100"
STAND_INS = {
    "tenure and segment": "90 - tenure + case when contract = 'Month-to-month' then 10 else 0 end "
                          "+ case when internet_service = 'Fiber optic' then 10 else 0 end",
    "tenure": "100 - tenure",
    "segment": "30 + case when contract = 'Month-to-month' then 15 else 0 end "
               "+ case when multiple_lines = 'No' then 20 else 0 end "
               "+ case when internet_service = 'Fiber optic' then 10 else 0 end",
}
SCORED = CLEAN + f""",
raw_score as (select *, {SCORE.format(points=STAND_INS["tenure and segment"])} as score from clean),
scored as (select *, case when score >= 0.5 then 1 else 0 end as pred from raw_score)"""
MODELS = CLEAN + ",\nmodels as (" + " union all ".join(
    f"select '{m}' as model, customer_id, label, {SCORE.format(points=p)} as score, "
    f"case when {SCORE.format(points=p)} >= 0.5 then 1 else 0 end as pred from clean"
    for m, p in STAND_INS.items()
) + ")"
_CM = ("count(*) filter (where label = 0 and pred = 0) as tn, count(*) filter (where label = 0 and pred = 1) as fp, "
       "count(*) filter (where label = 1 and pred = 0) as fn, count(*) filter (where label = 1 and pred = 1) as tp")
_METRICS = """(tp + tn)::double / (tp + tn + fp + fn) as accuracy,
  case when tp + fp = 0 then 0.0 else tp::double / (tp + fp) end as precision,
  case when tp + fn = 0 then 0.0 else tp::double / (tp + fn) end as recall,
  case when 2 * tp + fp + fn = 0 then 0.0 else (2 * tp)::double / (2 * tp + fp + fn) end as f1"""
_AUC = """select {by} sum(pos * (cum - neg / 2.0::double)) / (sum(pos)::double * sum(neg)) as roc_auc from (
  select {by} pos, neg, sum(neg) over ({part} order by score) as cum from (
    select {by} score, count(*) filter (where label = 1) as pos, count(*) filter (where label = 0) as neg
    from {src} group by {by} score)) {group}"""
METRIC_WIDE = MODELS + f""",
cm as (select model, {_CM} from models group by model),
auc as ({_AUC.format(by="model,", part="partition by model", src="models", group="group by model")}),
wide as (select cm.model, {_METRICS}, roc_auc from cm join auc on auc.model = cm.model)"""

RATES = CLEAN + ",\nrates as (" + " union all ".join(
    f"select '{c}' as feature, cast({c} as varchar) as level, count(*) as n, avg(label * 100.0::double) as rate "
    f"from clean group by {c}" for c in CATEGORICAL
) + ")"
NUMF = CLEAN + ",\nnumf as (select " + ", ".join(
    f"({_coded(c) if c in BINARY else c})::double as {c}" for c in CORRELATED
) + " from clean)"


def _corr(a: str, b: str) -> str:
    return f"case when stddev_pop({a}) > 0 then 1.0::double end" if a == b else f"corr({a}, {b})"


KPI = """kpi as (select avg(label) * 100 as churn_rate, count(*) as n_customers, sum(label)::bigint as n_churned,
  avg(monthly_charges) as mean_charge, sum(label) * avg(monthly_charges) * 12 as revenue_at_risk from clean)"""
TIERS = """tiers as (select count(*) filter (where score >= 0.7) as n_high,
  count(*) filter (where score >= 0.4 and score < 0.7) as n_medium,
  count(*) filter (where score < 0.4) as n_low from scored)"""
ROI = SCORED + f""", {KPI}, {TIERS},
roi0 as (select mean_charge, revenue_at_risk, n_high, n_medium, mean_charge * 0.15::double as unit_cost,
  n_high * 0.35::double * mean_charge * 12 as high_saved,
  n_medium * 0.35::double * 0.2::double * mean_charge * 12 as medium_saved from kpi, tiers),
roi1 as (select *, high_saved + medium_saved as total_saved, (n_high + n_medium) * unit_cost as total_cost from roi0),
roi as (select *, case when total_cost = 0 then null else (total_saved - total_cost) / total_cost * 100 end as roi_pct
  from roi1)"""


def _band(labels: list[str]) -> str:
    edges = [0.0, 0.3, 0.5, 0.7, 1.0]
    return "case " + " ".join(
        f"when score > {a} and score <= {b} then '{v}'" for a, b, v in zip(edges, edges[1:], labels)
    ) + " end"


RISK = ["Very Low (<30%)", "Low (30-50%)", "Medium (50-70%)", "High (≥70%)"]
PRIORITY = ["Low Risk", "Watch", "At-Risk", "Critical"]


def _smote() -> str:
    d2 = " + ".join(f'(a."{c}" - b."{c}") * (a."{c}" - b."{c}")' for c in FEATURES)
    own = ", ".join(f"""{r(f'"{c}"::double')} as "{c}" """ for c in FEATURES)
    made = ", ".join(f"""{r(f'b."{c}" + u * (n."{c}" - b."{c}")')} as "{c}" """ for c in FEATURES)
    return f"""with {SCALEDF},
train as (select * from scaled where not is_test),
minority as (select *, row_number() over (order by md5(customer_id || '|42'), customer_id) as rn from train where label = 1),
sizes as (select count(*) filter (where label = 1) as n_min,
  count(*) filter (where label = 0) - count(*) filter (where label = 1) as n_new from train),
near as (select a.customer_id as base, b.customer_id as other,
    row_number() over (partition by a.customer_id order by {d2}, b.customer_id) - 1 as place
  from minority a join minority b on a.customer_id <> b.customer_id qualify place < 5),
draws as (select customer_id as base,
    unnest(range(1, n_new // n_min + case when rn <= n_new % n_min then 1 else 0 end + 1)) as draw
  from minority, sizes),
hashed as (select *, md5(base || '|42|' || draw) as h from draws),
picked as (select *, ('0x' || substr(h, 1, 8))::bigint % 5 as pick, ('0x' || substr(h, 9, 8))::bigint / 4294967296.0::double as u
  from hashed)
select customer_id, label, null::varchar as base_key, {own} from train
union all
select 'synthetic|' || p.base || '|' || draw as customer_id, 1 as label, p.base as base_key, {made}
from picked p join near on near.base = p.base and near.place = p.pick
join minority b on b.customer_id = p.base join minority n on n.customer_id = near.other"""


def _trend() -> str:
    return f"""with {SCORED},
rng as (select min(tenure)::double as lo, max(tenure)::double as hi from scored),
t0 as (select (2 * tenure - (lo + hi)) / (hi - lo) as z, score as s from scored, rng),
m as (select avg(z) as m1, avg(z * z) as m2, avg(z * z * z) as m3, avg(s) as ms from t0),
t1 as (select z, s, z - m1 as p1 from t0, m),
b1 as (select sum((z * z - m2) * p1) / sum(p1 * p1) as b21, sum((z * z * z - m3) * p1) / sum(p1 * p1) as b31 from t1, m),
t2 as (select z, s, p1, z * z - m2 - b21 * p1 as p2 from t1, m, b1),
b2 as (select sum((z * z * z - m3) * p2) / sum(p2 * p2) as b32 from t2, m),
t3 as (select s, p1, p2, z * z * z - m3 - b31 * p1 - b32 * p2 as p3 from t2, m, b1, b2),
c as (select sum(s * p1) / sum(p1 * p1) as c1, sum(s * p2) / sum(p2 * p2) as c2, sum(s * p3) / sum(p3 * p3) as c3 from t3),
g0 as (select i::int as point, lo + i * ((hi - lo) / 99) as x, lo, hi from rng, range(100) as g(i)),
g1 as (select point, x, (2 * x - (lo + hi)) / (hi - lo) as z from g0),
g2 as (select point, x, z - m1 as p1, z, m2, m3, ms from g1, m),
g3 as (select *, z * z - m2 - b21 * p1 as p2 from g2, b1),
g4 as (select g3.*, z * z * z - m3 - g3.b31 * p1 - b32 * p2 as p3 from g3, b2)
select point, {r("x")} as x, {r("ms + c1 * p1 + c2 * p2 + c3 * p3")} as trend from g4, c"""


def _reasons() -> str:
    conditions = {
        "month-to-month contract": "contract = 'Month-to-month'",
        "pays by electronic check": "payment_method = 'Electronic check'",
        "fiber optic without security or support":
            "internet_service = 'Fiber optic' and (online_security = 'No' or tech_support = 'No')",
        "new customer (months 1-6)": "tenure between 1 and 6",
    }
    return "concat_ws('; ', " + ", ".join(f"case when {c} then '{t}' end" for t, c in conditions.items()) + ")"


def _clean_label() -> str:
    names = " ".join(f"when '{c}' then '{public(c)}'" for c in CATEGORICAL)
    name = "raw"
    for old, new in [("_", " "), (" Yes", ""), (" No", ""), ("Contract ", "Contract: "),
                     ("PaymentMethod ", "Payment: "), ("InternetService ", "Internet: ")]:
        name = f"replace({name}, '{old}', '{new}')"
    return f"""with {RATES},
named as (select case feature {names} end || '_' || level as raw from rates),
swapped as (select raw, {name} as s from named)
select raw as feature, array_to_string(list_transform(regexp_extract_all(s, '[A-Za-z]+|[^A-Za-z]+'),
  lambda x: upper(x[1]) || lower(x[2:])), '') as display, replace(lower(raw), ' ', '_') as slug from swapped"""


def _report() -> str:
    corr = " union all ".join(f"select 'correlation', '{c}', {_corr(c, 'label')} from numf" for c in CORRELATED)
    means = " union all ".join(f"select 'mean {c}', churn, avg({c}) from clean group by churn" for c in NUMERIC)
    kinds = {"senior_citizen": "int", "tenure": "int", "monthly_charges": "double", "total_charges": "double", "label": "int"}
    names = [*[c for c in PUBLIC_NAME if c != "total_charges_raw"], "total_charges", "label"]
    types = " union all ".join(
        f"select 'type', '{c} {kinds.get(c, 'string')}', count({c})::double from clean" for c in dict.fromkeys(names))
    missing = " union all ".join(
        f"select 'missing', '{c}', count(*) - count({c}) from num having count(*) > count({c})"
        for c in dict.fromkeys(names) if c != "label")
    stats = {"n": "count({})", "mean": "avg({})", "std": "stddev_samp({})", "min": "min({})", "max": "max({})",
             "q25": "quantile_cont({}, 0.25)", "q50": "quantile_cont({}, 0.5)", "q75": "quantile_cont({}, 0.75)"}
    described = " union all ".join(
        f"select 'describe {c}', '{name}', ({sql.format(c)})::double from num" for c in NUMERIC for name, sql in stats.items())
    return f"""with {RATES}, numf as (select {", ".join(f"({_coded(c) if c in BINARY else c})::double as {c}" for c in CORRELATED)} from clean),
rows_ (section, item, value) as (
select 'overview', 'rows', count(*)::double from clean union all
select 'overview', 'columns', 22.0 union all
select 'overview', 'duplicate rows', ((select count(*) from clean) - (select count(*) from (select distinct * from clean)))::double union all
select 'target', churn, count(*)::double from clean group by churn union all
select 'target share', churn, 100.0::double * count(*) / (select count(*) from clean) from clean group by churn union all
select 'rates', feature || '=' || level, rate from rates union all
select 'highest rate', feature || '=' || level, rate from (select *, row_number() over (partition by feature
  order by rate desc, level desc) as rn from rates) where rn = 1 union all
select 'lowest rate', feature || '=' || level, rate from (select *, row_number() over (partition by feature
  order by rate, level) as rn from rates) where rn = 1 union all
{types} union all {missing} union all {described} union all
{corr} union all {means})
select section, item, {r("value")} as value from rows_"""


def _linear_frame() -> str:
    return ", ".join(f'{r(chr(34) + c + chr(34))} as "{c}"' for c in SCALED)


def _types() -> str:
    kinds = {"senior_citizen": "int", "tenure": "int", "monthly_charges": "double"}
    return " union all ".join(
        f"select '{c}' as column_name, '{kinds.get(c, 'string')}' as data_type, count({c}) as n_values from snap"
        for c in PUBLIC_NAME
    )


def _stacked() -> str:
    """Numeric columns of ``clean`` below each other."""
    return " union all ".join(f"select '{c}' as feature, churn, {c}::double as x from clean" for c in NUMERIC)


def oracle_sql() -> dict[str, str]:
    rate = "avg(label * 100.0::double)"
    q: dict[str, str] = {
        # sources and cleaning
        "scan_snapshot": f"with {SNAP} select * replace ({r('monthly_charges')} as monthly_charges) from snap",
        "csv_roundtrip": f"with {SNAP} select * replace ({r('monthly_charges')} as monthly_charges) from snap",
        "splits_roundtrip": f"with {SCALEDF} select customer_id, label, is_test::int as is_test, {_linear_frame()} from scaled",
        "model_invariants": f"""with {FEAT}, t as (select count(*) as n, sum(label) as p from split where is_test)
            select 4 as n_models, n as least_rows, n as most_rows, n as least_keys, p as least_churners, p as most_churners,
              0 as odd_scores, p as least_actual, p as most_actual, 1 as n_best, n as explained_rows, 0 as unexplained,
              45 as n_features, 100.0::double as whole_share, 4 as cv_models, 0 as odd_cv, n as test_set_size,
              45 as meta_features, 1 as meta_cv, 20 as fold_scores, n as tier_rows,
              45 as equal_importances, 20 * n as cloud_points from t""",
        "clean_numeric": f"with {NUM} select customer_id, total_charges from num",
        "missing_total_charges": f"with {NUM} select count(*) - count(total_charges) as n_missing from num",
        "fill_median": f"with {CLEAN} select customer_id, {r('total_charges')} as total_charges from clean",
        "fill_median_train": f"""with {FEAT} select customer_id, {r('''coalesce(total_charges,
            (select quantile_cont(n.total_charges, 0.5) from num n join split s using (customer_id) where not s.is_test))''')}
            as total_charges from num""",
        "label": f"with {CLEAN} select customer_id, label from clean",
        "report_rows": _report(),
        # profiling
        "profile_shape": f"with {SNAP} select count(*) as n_rows, 21 as n_columns from snap",
        "duplicate_rows": f"""with {SNAP} select (select count(*) from snap) -
            (select count(*) from (select distinct * from snap)) as n_duplicates""",
        "missing_values": f"with {NUM} select * from (" + " union all ".join(
            f"select '{c}' as column_name, count(*) - count({c}) as n_missing from num"
            for c in [*[c for c in PUBLIC_NAME if c != 'total_charges_raw'], 'total_charges']
        ) + ") where n_missing > 0",
        "column_types": f"with {SNAP} {_types()}",
        "class_balance": f"""with {SNAP}, c as (select churn, count(*) as n from snap group by churn)
            select churn, n, {r("100.0::double * n / (select sum(n) from c)")} as pct,
                   {r("(select max(n) from c)::double / n")} as imbalance from c""",
        "describe_numeric": f"with {NUM} " + " union all ".join(
            f"select '{c}' as feature, count({c}) as n, {r(f'avg({c})')} as mean, {r(f'stddev_samp({c})')} as std, "
            f"{r(f'min({c})::double')} as min, {r(f'quantile_cont({c}, 0.25)')} as q25, "
            f"{r(f'quantile_cont({c}, 0.5)')} as q50, {r(f'quantile_cont({c}, 0.75)')} as q75, "
            f"{r(f'max({c})::double')} as max from num" for c in NUMERIC),
        "mean_by_class": f"with {NUM} select churn, " + ", ".join(
            f"{r(f'avg({c})')} as mean_{c}" for c in NUMERIC) + " from num group by churn",
        "churn_rates_all": f"with {RATES} select feature, level, n, {r('rate')} as rate from rates",
        "rate_contract": f"with {CLEAN} select contract, {r(rate)} as rate from clean group by contract",
        "rate_internet": f"with {CLEAN} select internet_service, {r(rate)} as rate from clean group by internet_service",
        "rate_payment": f"with {CLEAN} select payment_method, {r(rate)} as rate from clean group by payment_method order by 2",
        **{f"crosstab_{k}": f"""with {SNAP} select {c}, count(*) filter (where churn = 'No') as n_no,
            count(*) filter (where churn = 'Yes') as n_yes from snap group by {c}"""
           for k, c in {"contract": "contract", "internet": "internet_service"}.items()},
        "crosstab_contract_pct": f"""with {SNAP} select contract,
            {r("100.0::double * (count(*) filter (where churn = 'No') / count(*)::double)")} as pct_no,
            {r("100.0::double * (count(*) filter (where churn = 'Yes') / count(*)::double)")} as pct_yes
            from snap group by contract""",
        "corr_matrix": f"with {NUMF} " + " union all ".join(
            f"select '{a}' as x, '{b}' as y, {r(_corr(a, b))} as corr from numf" for a in CORRELATED for b in CORRELATED),
        "corr_target": f"with {NUMF} " + " union all ".join(
            f"select '{a}' as feature, {r(_corr(a, 'label'))} as corr from numf" for a in CORRELATED),
        "tenure_bands": f"""with {CLEAN}, b as (select label, case when tenure > 0 and tenure <= 12 then 1
              when tenure > 12 and tenure <= 24 then 2 when tenure > 24 and tenure <= 48 then 3
              when tenure > 48 and tenure <= 72 then 4 end as band_ord from clean)
            select band_ord, ['0-12m', '13-24m', '25-48m', '49-72m'][band_ord] as band, count(*) as n, {r(rate)} as rate
            from b where band_ord is not null group by band_ord""",
        "association_rank": f"with {RATES}, numf as (select tenure::double as tenure, monthly_charges, total_charges, label from clean) "
            f"select feature, {r('max(rate) - min(rate)')} as strength, 'rate spread' as kind from rates group by feature "
            + " ".join(f"union all select '{c}', {r(f'100 * abs(corr({c}, label))')}, 'correlation' from numf" for c in NUMERIC),
        "hist_density": f"""with {CLEAN}, v as ({_stacked()}), s as (select feature, churn, min(x) as lo, max(x) as hi,
              count(*) as total from v group by all),
            b as (select feature, churn, least(floor((x - lo) / ((hi - lo) / 30)), 29)::int as bin, count(*) as n
              from v join s using (feature, churn) group by all),
            g as (select feature, churn, lo, (hi - lo) / 30 as w, total, i::int as bin from s, range(30) as t(i))
            select g.feature, g.churn, g.bin, {r("lo + g.bin * w")} as left_edge, coalesce(n, 0) as n,
              {r("coalesce(n, 0)::double / (total * w)", 12)} as height
            from g left join b on b.feature = g.feature and b.churn = g.churn and b.bin = g.bin""",
        "box_stats": f"""with {CLEAN}, v as ({_stacked()}), s as (select feature, churn, quantile_cont(x, 0.25) as q25,
              quantile_cont(x, 0.5) as q50, quantile_cont(x, 0.75) as q75 from v group by all),
            i as (select feature, churn, x, q25, q50, q75,
              x between q25 - 1.5 * (q75 - q25) and q75 + 1.5 * (q75 - q25) as inside from v join s using (feature, churn))
            select feature, churn, count(*) as n, {r("any_value(q25)")} as q25, {r("any_value(q50)")} as q50,
              {r("any_value(q75)")} as q75, {r("min(x) filter (where inside)")} as whisker_low,
              {r("max(x) filter (where inside)")} as whisker_high, count(*) filter (where not inside) as n_outliers
            from i group by feature, churn""",
        "kde_tenure": f"""with {CLEAN}, s as (select churn, count(*) as n, min(tenure)::double as lo, max(tenure)::double as hi,
              stddev_samp(tenure) * pow(count(*), -0.2) as h from clean group by churn),
            v as (select churn, tenure::double as x, count(*) as c from clean group by churn, tenure),
            g as (select churn, i::int as point, n, h, lo - 0.5 * (hi - lo) + i * (2.0 * (hi - lo) / 999) as grid_x
              from s, range(1000) as t(i)),
            d as (select g.churn, point, grid_x, sum(c * exp(-0.5 * ((grid_x - x) / h) * ((grid_x - x) / h)) / (n * h * sqrt(2.0 * pi()))) as density
              from g join v on v.churn = g.churn group by g.churn, point, grid_x)
            select churn, point, {r("grid_x")} as grid_x, {r("density", 9)} as density from d""",
        "scatter_tenure_charges": f"""with {CLEAN} select customer_id, tenure, {r("monthly_charges")} as monthly_charges, churn
            from clean""",
        "contract_profile": f"""with {CLEAN} select contract, {r("avg(label)")} as churn_rate, count(*) as n,
            {r("avg(monthly_charges)")} as avg_monthly, {r(rate)} as churn_pct from clean group by contract""",
        "key_insights": f"""with {RATES} select feature, arg_max(level, (rate, level)) as highest_level, {r("max(rate)")} as highest_rate,
            arg_min(level, (rate, level)) as lowest_level, {r("min(rate)")} as lowest_rate from rates group by feature""",
        # features
        "encode_binary": f"with {SNAP} select customer_id, " + ", ".join(f"{_coded(c)} as {c}" for c in BINARY) + " from snap",
        "one_hot": f"with {SNAP} select customer_id, {', '.join(_FLAGS)} from snap",
        "engineered": f"with {CLEAN} select customer_id, " + ", ".join(
            f"{r(sql) if 'charges' in c or 'charge_' in c else sql} as {c}" for c, sql in _DERIVED.items()
        ) + f", case when {_SUBSCRIBED} > 0 then 1 else 0 end as has_any_addon from clean",
        "split_counts": f"with {FEAT} select label, is_test::int as is_test, count(*) as n from split group by all",
        "split_members": f"with {FEAT} select customer_id, label, is_test::int as is_test from split",
        "scaled_train": f"with {SCALEDF} select customer_id, is_test::int as is_test, {_linear_frame()} from scaled",
        "smote_balance": f"""with {FEAT}, b as (select label, count(*) as n from split where not is_test group by label)
            select label, n, 'before' as stage from b union all
            select label, (select max(n) from b) as n, 'after' as stage from b""",
        "smote_rows": _smote(),
        "align_features": f"with {FEAT} select customer_id, " + ", ".join(
            (f'0 as "{c}"' if c == "gender" else f'{r(chr(34) + c + chr(34))} as "{c}"' if c in SCALED and c != "tenure"
             else f'"{c}"') for c in reversed(FEATURES)) + " from feat",
        "sample_n": f"""with {SNAP} select customer_id, tenure from snap order by md5(customer_id || '|42'), customer_id limit 200""",
        "cv_folds": f"""with {FEAT}, t as (select *, row_number() over (partition by label order by md5(customer_id || '|42'),
              customer_id) as rn, count(*) over (partition by label) as n from split where not is_test)
            select label, ((rn - 1) * 5 // n)::int as fold, count(*) as n_rows from t group by all""",
        # evaluation
        "confusion": f"""with {SCORED}, c as (select {_CM} from scored) select *,
            {r("tn::double / (tn + fp)")} as tn_share, {r("fp::double / (tn + fp)")} as fp_share,
            {r("fn::double / (fn + tp)")} as fn_share, {r("tp::double / (fn + tp)")} as tp_share from c""",
        "class_metrics": f"""with {SCORED}, c as (select {_CM} from scored), m as (select {_METRICS} from c)
            select {', '.join(f"{r(x)} as {x}" for x in ('accuracy', 'precision', 'recall', 'f1'))} from m""",
        "roc_auc": f"with {SCORED}, a as ({_AUC.format(by='', part='', src='scored', group='')}) select {r('roc_auc', 9)} as roc_auc from a",
        "roc_curve": f"""with {MODELS}, s as (select model, score, count(*) filter (where label = 1) as pos,
              count(*) filter (where label = 0) as neg from models group by model, score),
            c as (select model, score as threshold,
              sum(neg) over (partition by model order by score desc) / (sum(neg) over (partition by model))::double as fpr,
              sum(pos) over (partition by model order by score desc) / (sum(pos) over (partition by model))::double as tpr from s)
            select model, threshold, {r("fpr", 9)} as fpr, {r("tpr", 9)} as tpr from c
            union all select distinct model, 'Infinity'::double, 0.0, 0.0 from s""",
        "metric_table": f"with {METRIC_WIDE} select model, metric, {r('value', 9)} as value from "
            "(unpivot wide on accuracy, precision, recall, f1, roc_auc into name metric value value)",
        "select_best": f"""with {METRIC_WIDE},
            s as (select model, 0.4::double * f1 + 0.4::double * roc_auc + 0.2::double * recall as composite,
              case model when 'tenure and segment' then 1 when 'tenure' then 2 else 3 end as place from wide),
            k as (select model, composite, row_number() over (order by composite desc, place)::int as rank from s)
            select model, {r("composite", 9)} as composite, rank, case when rank = 1 then 1 else 0 end as is_best from k""",
        # risk
        "risk_tiers": f"""with {SCORED}, {TIERS} select 'high' as tier, n_high as n from tiers
            union all select 'medium', n_medium from tiers union all select 'low', n_low from tiers""",
        "risk_bands": f"""with {SCORED}, b as (select {_band(RISK)} as band from scored)
            select t.band_ord::int as band_ord, t.band, count(b.band) as n from (values {", ".join(f"({i + 1}, '{v}')" for i, v in enumerate(RISK))}) t(band_ord, band)
            left join b on b.band = t.band group by t.band_ord, t.band""",
        "priority_tiers": f"with {SCORED} select customer_id, score, {_band(PRIORITY)} as priority from scored",
        "proba_hist": f"""with {SCORED}, b as (select label, least(floor(score * 40)::int + 1, 40) as bin from scored)
            select label, bin, {r("(bin - 0.5) / 40")} as centre, count(*) as n from b group by label, bin""",
        "tenure_score_bins": f"""with {SCORED}, g as (select min(tenure)::double as lo, max(tenure)::double as hi from scored),
            b as (select greatest(1, least(10, ceil((tenure - lo) / ((hi - lo) / 10))))::int as bin, score, lo, hi from scored, g)
            select bin, count(*) as n, {r("avg(score)")} as mean_score,
              {r("(case when bin = 1 then any_value(lo) - 0.001 * (any_value(hi) - any_value(lo)) else any_value(lo) + (bin - 1) * ((any_value(hi) - any_value(lo)) / 10) end + (any_value(lo) + bin * ((any_value(hi) - any_value(lo)) / 10))) / 2")} as mid
            from b group by bin""",
        "tenure_trend": _trend(),
        "value_vs_score": f"""with {SCORED} select customer_id, score, {r("total_charges")} as total_charges,
            {_band(PRIORITY)} as priority from scored""",
        # business
        "kpis": f"""with {SCORED}, {KPI}, {TIERS} select {r("churn_rate")} as churn_rate, n_customers, n_churned,
            {r("mean_charge")} as mean_charge, {r("revenue_at_risk", 3)} as revenue_at_risk, n_high, n_medium, n_low,
            {r("(select avg(pred) * 100 from scored)")} as predicted_rate from kpi, tiers""",
        "monthly_risk": f"""with {CLEAN}, {KPI} select i::int as month,
            {r("revenue_at_risk / 12 * (0.9::double + 0.02::double * i)", 3)} as risk from kpi, range(12) as t(i)""",
        "campaign_roi": f"with {ROI} select n_high, n_medium, " + ", ".join(
            f"{r(c, 3)} as {c}" for c in ("mean_charge", "revenue_at_risk", "unit_cost", "high_saved", "medium_saved",
                                          "total_saved", "total_cost", "roi_pct")) + " from roi",
        "roi_waterfall": f"with {ROI} " + " union all ".join(
            f"select {i + 1}::int as step, '{n}' as item, {r(f'({e}) / 1000')} as value_k from roi"
            for i, (n, e) in enumerate({"Revenue at Risk": "revenue_at_risk", "Campaign Cost": "-total_cost",
                                        "High Risk Saved": "high_saved", "Medium Risk Saved": "medium_saved",
                                        "Net Benefit": "total_saved - total_cost"}.items())),
        "segment_savings": f"""with {ROI} select 'High Risk (≥70%)' as segment, n_high as n, {r("high_saved / 1000")} as saved_k,
            {r("n_high * unit_cost / 1000")} as cost_k from roi union all
            select 'Medium Risk (40-70%)', n_medium, {r("medium_saved / 1000")}, {r("n_medium * unit_cost / 1000")} from roi""",
        "savings_projection": f"""with {ROI}, m as (select i::int as month,
              total_saved / 12 * (1 - exp(-0.4::double * i)) * (1 + 0.01::double * (i - 1)) as savings,
              total_cost / 12 * least(1::double, 0.5::double + 0.04::double * i) as cost from roi, range(1, 13) as t(i))
            select month, {r("savings", 3)} as savings, {r("cost", 3)} as cost,
              {r("sum(savings - cost) over (order by month)", 3)} as cumulative_net from m""",
        "action_list": f"""with {SCORED} select customer_id, score, case when score >= 0.7 then 'high' else 'medium' end as tier,
            case when score >= 0.7 then 2 else 4 end as horizon_weeks,
            {_reasons()} as reasons from scored where score >= 0.4""",
        # labels
        "clean_label": _clean_label(),
    }
    return q
