"""Independent DuckDB SQL for every registered query (the correctness oracle).

The driver registers the parquet tables as views; these texts rebuild the raw
fixture, the clean and the feature tables as CTEs and then answer each query.
Aggregated doubles are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

# FIXTURES.md section 3 with the DuckDB words substituted.
RAW_CTES = """
o as (
  select o_custkey, count(*) as n,
         cast(min(o_orderdate) as date) as d0, cast(max(o_orderdate) as date) as d1,
         sum(cast(round(o_totalprice * 100) as bigint)) as tot_cents
  from orders group by o_custkey),
b as (
  select c_custkey as k, c_nationkey as nk, c_mktsegment as seg, o.n, o.d1,
         date_diff('day', o.d0, o.d1) as days,
         2000 + (cast(round(c_acctbal * 100) as bigint) + 100000) // 110 as m_cents,
         o.tot_cents // 1000 as t_cents
  from customer left join o on o.o_custkey = c_custkey),
r as (
  select k,
    case when k % 101 = 0 then null else k + 1 end as customer_id,
    case when k % 31 = 0 then null when k % 2 = 0 then ' Male' else 'Female ' end as gender,
    case when k % 29 = 0 then null when nk % 5 = 0 then '1' else '0' end as senior_citizen,
    case when nk % 2 = 0 then 'Yes' else ' No' end as partner,
    case when nk % 7 = 0 then 'Yes' else 'No' end as dependents,
    case when k % 27 = 0 then 'bad' when k % 53 = 0 then '-3' when k % 37 = 0 then '0'
         else cast((days * (k % 4 + 1)) // 120 as varchar) end as tenure,
    case when k % 10 = 0 then 'No' else 'Yes' end as phone_service,
    case when k % 10 = 0 then 'No phone service' when k % 3 = 0 then 'Yes' else 'No' end as multiple_lines,
    case when seg = 'HOUSEHOLD' then 'No' when seg in ('BUILDING', 'AUTOMOBILE') then 'DSL' else 'Fiber optic' end as internet_service,
    case when seg = 'HOUSEHOLD' then 'No internet service' when k % 41 = 0 then null when k % 3 = 0 then ' Yes' else 'No' end as online_security,
    case when seg = 'HOUSEHOLD' then 'No internet service' when k % 4 = 0 then 'Yes' else 'No' end as online_backup,
    case when seg = 'HOUSEHOLD' then 'No internet service' when k % 5 = 0 then 'Yes ' else 'No' end as device_protection,
    case when seg = 'HOUSEHOLD' then 'No internet service' when k % 6 = 0 then 'Yes' else 'No' end as tech_support,
    case when seg = 'HOUSEHOLD' then 'No internet service' when k % 7 = 0 then 'Yes' else 'No' end as streaming_tv,
    case when seg = 'HOUSEHOLD' then 'No internet service' when k % 8 = 0 then 'Yes' else 'No' end as streaming_movies,
    case when k % 97 = 0 then 'Unknown' when n >= 12 then 'Two year' when n >= 9 then 'One year' else 'Month-to-month' end as contract,
    case when nk % 3 = 1 then 'Yes' else 'No' end as paperless_billing,
    case nk % 4 when 0 then 'Electronic check' when 1 then 'Mailed check' when 2 then 'Bank transfer (automatic)' else 'Credit card (automatic)' end as payment_method,
    case when k % 43 = 0 then '' else concat(cast(m_cents // 100 as varchar), '.', lpad(cast(m_cents % 100 as varchar), 2, '0')) end as monthly_charges,
    case when k % 47 = 0 then ' ' when t_cents is null then null else concat(cast(t_cents // 100 as varchar), '.', lpad(cast(t_cents % 100 as varchar), 2, '0')) end as total_charges,
    case when k % 61 = 0 then null when d1 < date '2000-12-01' then 'Yes ' else 'No' end as churn,
    case nk % 3 when 0 then date '2025-08-22' when 1 then date '2025-08-23' else date '2025-08-24' end as ingest_date
  from b),
raw as (select * from r union all select * from r where k % 89 = 0)"""

CLEAN_CTE = """
clean as (
  select try_cast(customer_id as bigint) as customer_id,
    trim(gender) as gender,
    try_cast(trim(senior_citizen) as bigint) as senior_citizen,
    trim(partner) as partner, trim(dependents) as dependents,
    try_cast(trim(tenure) as bigint) as tenure,
    trim(phone_service) as phone_service, trim(multiple_lines) as multiple_lines,
    trim(internet_service) as internet_service, trim(online_security) as online_security,
    trim(online_backup) as online_backup, trim(device_protection) as device_protection,
    trim(tech_support) as tech_support, trim(streaming_tv) as streaming_tv,
    trim(streaming_movies) as streaming_movies, trim(contract) as contract,
    trim(paperless_billing) as paperless_billing, trim(payment_method) as payment_method,
    try_cast(trim(monthly_charges) as double) as monthly_charges,
    try_cast(nullif(trim(cast(total_charges as varchar)), '') as double) as total_charges,
    trim(churn) as churn,
    cast(case when trim(churn) = 'Yes' then 1 else 0 end as bigint) as churn_label,
    ingest_date
  from raw where customer_id is not null)"""

_SVC = ("(cast(c.online_security = 'Yes' as bigint) + cast(c.online_backup = 'Yes' as bigint)"
        " + cast(c.device_protection = 'Yes' as bigint) + cast(c.tech_support = 'Yes' as bigint)"
        " + cast(c.streaming_tv = 'Yes' as bigint) + cast(c.streaming_movies = 'Yes' as bigint))")

FEATURES_CTE = f"""
stats as (
  select ingest_date, quantile_disc(monthly_charges, 0.8) as p80_monthly
  from clean group by ingest_date),
features as (
  select c.customer_id, c.tenure, c.monthly_charges, c.total_charges,
    (c.senior_citizen = 1) as is_senior,
    (c.internet_service <> 'No') as has_internet,
    {_SVC} as services_count,
    c.total_charges / nullif(c.tenure, 0) as avg_charges_per_tenure,
    c.monthly_charges / nullif({_SVC}, 0) as charges_per_service,
    c.internet_service as internet_type,
    c.contract as contract_type,
    c.payment_method as payment_method,
    cast(case when c.contract = 'Month-to-month' then 1 when c.contract = 'One year' then 12
              when c.contract = 'Two year' then 24 else null end as bigint) as contract_length_months,
    case when c.tenure is null then 'unknown' when c.tenure < 12 then '<12m'
         when c.tenure between 12 and 24 then '12-24m' when c.tenure between 25 and 48 then '25-48m'
         else '>48m' end as tenure_bucket,
    (c.monthly_charges > s.p80_monthly) as is_high_spender,
    c.churn_label, c.ingest_date
  from clean c left join stats s on c.ingest_date = s.ingest_date)"""


def with_tables(body: str, *, clean: bool = True, features: bool = True, extra: str = "") -> str:
    ctes = [RAW_CTES]
    if clean or features:
        ctes.append(CLEAN_CTE)
    if features:
        ctes.append(FEATURES_CTE)
    if extra:
        ctes.append(extra)
    return "with " + ",".join(ctes) + "\n" + body


SQL: dict[str, str] = {}


def register(name: str, body: str, **kw) -> None:
    SQL[name] = with_tables(body, **kw)


# ---- tables and clean -------------------------------------------------------
register("raw_row_count", "select cast(count(*) as bigint) as cnt from raw", clean=False, features=False)
register("clean_table", "select * from clean", features=False)
register("clean_churn_label",
         "select churn, churn_label, cast(count(*) as bigint) as n from clean group by churn, churn_label",
         features=False)
register("latest_clean",
         "select * from clean where ingest_date = (select max(ingest_date) from clean)", features=False)
register("feature_table", "select * from features")
register("features_except_partition", "select * exclude (ingest_date) from features")
register("latest_features",
         "select * from features where ingest_date = (select max(ingest_date) from features)")

# ---- segments ---------------------------------------------------------------
register("counts_clean_vs_features",
         "select (select cast(count(*) as bigint) from clean) as clean_rows,"
         " (select cast(count(*) as bigint) from features) as feature_rows")
register("churn_distribution",
         "select churn_label, cast(count(*) as bigint) as n from clean group by churn_label", features=False)
register("partition_counts_7d",
         "select ingest_date, cast(count(*) as bigint) as n from features"
         " where ingest_date between date '2025-08-24' - interval 7 day and date '2025-08-24'"
         " group by ingest_date order by ingest_date desc")
register("segment_contract",
         "select contract_type, cast(count(*) as bigint) as n, round(avg(churn_label), 6) as churn_rate"
         " from features group by contract_type order by churn_rate desc, contract_type")
register("segment_internet_payment",
         "select internet_type, payment_method, cast(count(*) as bigint) as n,"
         " round(avg(churn_label), 6) as churn_rate from features group by internet_type, payment_method"
         " order by avg(churn_label) desc, internet_type, payment_method limit 20")

register("label_correlations", """
select feature, round(r, 6) as r from (
  select 'monthly_charges' as feature, corr(monthly_charges, churn_label) as r from features union all
  select 'total_charges', corr(total_charges, churn_label) from features union all
  select 'tenure', corr(tenure, churn_label) from features union all
  select 'services_count', corr(services_count, churn_label) from features union all
  select 'avg_charges_per_tenure', corr(avg_charges_per_tenure, churn_label) from features union all
  select 'charges_per_service', corr(charges_per_service, churn_label) from features union all
  select 'contract_length_months', corr(contract_length_months, churn_label) from features)
order by r desc nulls last, feature""")

register("tenure_cohorts", """
select tenure_cohort, cast(count(*) as bigint) as n, round(avg(churn_label), 6) as churn_rate,
       round(avg(monthly_charges), 6) as avg_monthly
from (select *, case when tenure < 6 then '0-5m' when tenure < 12 then '6-11m'
                     when tenure < 24 then '12-23m' when tenure < 36 then '24-35m' else '36m+' end as tenure_cohort
      from features)
group by tenure_cohort order by churn_rate desc, tenure_cohort""")

register("high_risk_segments", """
select contract_type, payment_method, cast(count(*) as bigint) as n, round(avg(churn_label), 6) as churn_rate
from features group by contract_type, payment_method having count(*) >= 50
order by avg(churn_label) desc, contract_type, payment_method limit 15""")

_ORDER_IDS = "(select o_custkey + 1 as customer_id from orders)"

register("customer_lookup", f"""
select * exclude (ingest_date) from features where customer_id in {_ORDER_IDS}""")

register("latest_customer_features", f"""
select * exclude (ingest_date, _rn) from (
  select *, row_number() over (partition by customer_id order by ingest_date desc,
    tenure desc nulls last, monthly_charges desc nulls last, total_charges desc nulls last,
    is_senior desc nulls last, has_internet desc nulls last, services_count desc nulls last,
    avg_charges_per_tenure desc nulls last, charges_per_service desc nulls last,
    internet_type desc nulls last, contract_type desc nulls last, payment_method desc nulls last,
    contract_length_months desc nulls last, tenure_bucket desc nulls last,
    is_high_spender desc nulls last, churn_label desc nulls last) as _rn
  from features where customer_id in {_ORDER_IDS}) where _rn = 1""")

register("segment_contract_latest", """
select contract_type, cast(count(*) as bigint) as n, round(avg(churn_label), 6) as churn_rate
from features where ingest_date = (select max(ingest_date) from features)
group by contract_type order by churn_rate desc, contract_type""")

register("feature_p80", "select ingest_date, p80_monthly from stats")
register("feature_high_spender",
         "select ingest_date, is_high_spender, cast(count(*) as bigint) as n from features group by all")
register("feature_services_count",
         "select services_count, cast(count(*) as bigint) as n from features group by all")
register("feature_ratios",
         "select customer_id, ingest_date, avg_charges_per_tenure, charges_per_service from features")
register("feature_contract_months", """
select contract, cast(case when contract = 'Month-to-month' then 1 when contract = 'One year' then 12
                           when contract = 'Two year' then 24 end as bigint) as contract_length_months,
       cast(count(*) as bigint) as n
from clean group by all""", features=False)
register("feature_tenure_bucket", """
select tenure_bucket, cast(count(*) as bigint) as n, min(tenure) as min_tenure, max(tenure) as max_tenure
from features group by tenure_bucket""")

# ---- data quality (per partition) ------------------------------------------
_NULLS = """cast(sum(case when tenure is null then 1 else 0 end) as bigint) as null_tenure,
  cast(sum(case when gender is null then 1 else 0 end) as bigint) as null_gender,
  cast(sum(case when monthly_charges is null then 1 else 0 end) as bigint) as null_monthly,
  cast(sum(case when total_charges is null then 1 else 0 end) as bigint) as null_total,
  cast(sum(case when senior_citizen is null then 1 else 0 end) as bigint) as null_senior_citizen,
  cast(sum(case when churn_label is null then 1 else 0 end) as bigint) as null_churn_label"""
_RANGE = """cast(sum(case when tenure < 0 then 1 else 0 end) as bigint) as bad_tenure,
  cast(sum(case when gender not in ('Female', 'Male') then 1 else 0 end) as bigint) as bad_gender,
  cast(sum(case when monthly_charges < 0 then 1 else 0 end) as bigint) as bad_monthly,
  cast(sum(case when total_charges < 0 then 1 else 0 end) as bigint) as bad_total,
  cast(sum(case when senior_citizen not in (0, 1) then 1 else 0 end) as bigint) as bad_senior_citizen"""
_STATS = """min(tenure) as min_tenure, max(tenure) as max_tenure, round(avg(tenure), 6) as avg_tenure,
  min(monthly_charges) as min_monthly, max(monthly_charges) as max_monthly, round(avg(monthly_charges), 6) as avg_monthly,
  min(total_charges) as min_total, max(total_charges) as max_total, round(avg(total_charges), 6) as avg_total"""
_DISTINCT = """cast(count(distinct gender) as bigint) as distinct_gender,
  cast(count(distinct internet_service) as bigint) as distinct_internet_service,
  cast(count(distinct contract) as bigint) as distinct_contract,
  cast(count(distinct payment_method) as bigint) as distinct_payment_method"""

register("dq_row_count", "select ingest_date, cast(count(*) as bigint) as cnt from clean group by ingest_date",
         features=False)
register("dq_nulls", f"select ingest_date, {_NULLS} from clean group by ingest_date", features=False)
register("dq_label_values", "select ingest_date, churn_label, cast(count(*) as bigint) as cnt from clean"
         " group by ingest_date, churn_label order by ingest_date, churn_label", features=False)
register("dq_out_of_range", f"select ingest_date, {_RANGE} from clean group by ingest_date", features=False)
register("dq_basic_stats", f"select ingest_date, {_STATS} from clean group by ingest_date", features=False)
register("dq_distinct_counts", f"select ingest_date, {_DISTINCT} from clean group by ingest_date",
         features=False)
register("dq_duplicates", """
select ingest_date, cast(sum(case when n > 1 then 1 else 0 end) as bigint) as dupes
from (select ingest_date, customer_id, count(*) as n from clean group by ingest_date, customer_id)
group by ingest_date""", features=False)
register("dq_partitions_present",
         "select distinct ingest_date from clean order by ingest_date desc limit 5", features=False)
_DQ_LONG_CTES = f"""
fused as (select ingest_date, cast(count(*) as bigint) as cnt, {_NULLS}, {_RANGE},
  min(tenure) as min_tenure, max(tenure) as max_tenure, avg(tenure) as avg_tenure,
  min(monthly_charges) as min_monthly, max(monthly_charges) as max_monthly, avg(monthly_charges) as avg_monthly,
  min(total_charges) as min_total, max(total_charges) as max_total, avg(total_charges) as avg_total
  from clean group by ingest_date),
longf as (
  select * from (select ingest_date, cast(cnt as double) as cnt, cast(null_tenure as double) as null_tenure, cast(null_gender as double) as null_gender, cast(null_monthly as double) as null_monthly, cast(null_total as double) as null_total, cast(null_senior_citizen as double) as null_senior_citizen, cast(null_churn_label as double) as null_churn_label, cast(bad_tenure as double) as bad_tenure, cast(bad_gender as double) as bad_gender, cast(bad_monthly as double) as bad_monthly, cast(bad_total as double) as bad_total, cast(bad_senior_citizen as double) as bad_senior_citizen, cast(min_tenure as double) as min_tenure, cast(max_tenure as double) as max_tenure, cast(avg_tenure as double) as avg_tenure, cast(min_monthly as double) as min_monthly, cast(max_monthly as double) as max_monthly, cast(avg_monthly as double) as avg_monthly, cast(min_total as double) as min_total, cast(max_total as double) as max_total, cast(avg_total as double) as avg_total from fused)
  unpivot (value for metric in (cnt, null_tenure, null_gender, null_monthly, null_total, null_senior_citizen, null_churn_label, bad_tenure, bad_gender, bad_monthly, bad_total, bad_senior_citizen, min_tenure, max_tenure, avg_tenure, min_monthly, max_monthly, avg_monthly, min_total, max_total, avg_total))),
dist as (
  select * from (select ingest_date, {_DISTINCT} from clean group by ingest_date)
  unpivot (value for metric in (distinct_gender, distinct_internet_service, distinct_contract, distinct_payment_method)))"""
_DQ_LONG_BODY = """select ingest_date,
  case when metric = 'cnt' then 'row_count' when metric like 'null_%' then 'nulls'
       when metric like 'bad_%' then 'out_of_range' else 'basic_stats' end as "check",
  metric, round(value, 6) as value from longf
union all
select ingest_date, 'distinct_counts', metric, cast(value as double) from dist
union all
select ingest_date, 'label_values', 'cnt_' || cast(churn_label as varchar), cast(count(*) as double)
from clean group by ingest_date, churn_label
union all
select ingest_date, 'duplicates', 'dupes', cast(sum(case when n > 1 then 1 else 0 end) as double)
from (select ingest_date, customer_id, count(*) as n from clean group by ingest_date, customer_id)
group by ingest_date"""
register("dq_report_long", _DQ_LONG_BODY, features=False, extra=_DQ_LONG_CTES)


def _json(cols: list[str], rows: str = "") -> str:
    """JSON text of a list of one record (or of the records of a group, in ``rows`` order)."""
    one = "{" + ", ".join(f"'{c}': {'round(' + c + ', 6)' if c.startswith('avg_') else c}" for c in cols) + "}"
    return f"cast(to_json({'list(' + one + ' order by ' + rows + ')' if rows else '[' + one + ']'}) as varchar)"


_REPORT = {
    "row_count": ["cnt"],
    "nulls": ["null_tenure", "null_gender", "null_monthly", "null_total", "null_senior_citizen", "null_churn_label"],
    "out_of_range": ["bad_tenure", "bad_gender", "bad_monthly", "bad_total", "bad_senior_citizen"],
    "basic_stats": [f"{f}_{c}" for c in ("tenure", "monthly", "total") for f in ("min", "max", "avg")],
}
register("validation_report", "\nunion all\n".join(
    [f"select ingest_date, '{k}' as \"check\", {_json(v)} as result_json from fused" for k, v in _REPORT.items()] + [
        f"select ingest_date, 'distinct_counts', {_json(['distinct_gender', 'distinct_internet_service', 'distinct_contract', 'distinct_payment_method'])}"
        f" from (select ingest_date, {_DISTINCT} from clean group by ingest_date)",
        f"select ingest_date, 'label_values', {_json(['churn_label', 'cnt'], 'churn_label nulls first')}"
        " from (select ingest_date, churn_label, count(*) as cnt from clean group by all) group by ingest_date",
        f"select ingest_date, 'duplicates', {_json(['dupes'])} from (select ingest_date, cast(sum(case when n > 1 then 1 else 0 end)"
        " as bigint) as dupes from (select ingest_date, customer_id, count(*) as n from clean group by all) group by ingest_date)",
        "select cast(null as date), 'partitions_present', cast(to_json(list({'ingest_date': strftime(ingest_date, '%Y-%m-%d')}"
        " order by ingest_date desc)) as varchar) from (select distinct ingest_date from clean order by ingest_date desc limit 5)",
    ]), features=False, extra=_DQ_LONG_CTES)

# ---- profile (clean table: 3 numeric, 14 categorical columns) --------------
_P_NUM = ["tenure", "monthly_charges", "total_charges"]
_P_CAT = ["gender", "internet_service", "payment_method", "partner", "dependents", "phone_service",
          "multiple_lines", "online_security", "online_backup", "device_protection", "tech_support",
          "streaming_tv", "streaming_movies", "paperless_billing"]
_F_NUM = ["tenure", "monthly_charges", "total_charges", "services_count", "avg_charges_per_tenure",
          "charges_per_service", "contract_length_months"]


def _union(parts):
    return "\nunion all\n".join(parts)


_NUM_LONG = "numlong as (" + _union(
    [f"select '{c}' as \"column\", cast({c} as double) as value, churn_label from clean where {c} is not null"
     for c in _P_NUM]) + ")"
_CAT_LONG = "catlong as (" + _union(
    [f"select '{c}' as \"column\", cast({c} as varchar) as value, churn_label from clean" for c in _P_CAT]) + ")"
_FNUM_LONG = "fnumlong as (" + _union(
    [f"select '{c}' as \"column\", cast({c} as double) as value from features where {c} is not null"
     for c in _F_NUM]) + ")"

register("profile_numeric", """
select "column", cast(count(*) as bigint) as "count", round(avg(value), 6) as mean,
  round(stddev_samp(value), 6) as std, round(min(value), 6) as "min",
  round(quantile_cont(value, 0.25), 6) as p25, round(quantile_cont(value, 0.5), 6) as p50,
  round(quantile_cont(value, 0.75), 6) as p75, round(max(value), 6) as "max"
from numlong group by "column" """, features=False, extra=_NUM_LONG)

register("profile_categorical_uniques", """
select "column", cast(count(distinct value) as bigint) as unique_count from catlong
where value is not null group by "column" """, features=False, extra=_CAT_LONG)

_CORR_COLS = _P_NUM + ["churn_label"]
_CORR_PAIRS = [(a, b) for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i:]]
_CORR_UPPER = "upper_t as (" + _union(
    [f"select '{a}' as col_a, '{b}' as col_b, corr({a}, {b}) as r from clean" for a, b in _CORR_PAIRS]) + ")"
register("profile_correlation", """
select col_a, col_b, round(r, 6) as r from upper_t
union all
select col_b, col_a, round(r, 6) from upper_t where col_a <> col_b""", features=False, extra=_CORR_UPPER)

register("profile_top_correlations", """
select col_a as feature, round(r, 6) as r from upper_t where col_b = 'churn_label' and col_a <> 'churn_label'
order by r desc nulls last, feature limit 10""", features=False, extra=_CORR_UPPER)

_RATES = """rates as (select "column", value, avg(churn_label) as churn_rate from catlong
  where value is not null group by "column", value)"""
register("profile_churn_rates_long", """
select "column", value, round(churn_rate, 6) as churn_rate from rates""",
         features=False, extra=_CAT_LONG + "," + _RATES)
register("profile_churn_rates_wide", "select value, " + ", ".join(
    f"round(max(case when \"column\" = '{c}' then churn_rate end), 6) as {c}" for c in _P_CAT)
    + " from rates group by value", features=False, extra=_CAT_LONG + "," + _RATES)
register("profile_top3_rates", """
select "column", value, round(churn_rate, 6) as churn_rate, "rank" from (
  select *, row_number() over (partition by "column" order by churn_rate desc, value) as "rank" from rates
  where "column" in ('gender', 'internet_service', 'payment_method', 'partner', 'dependents'))
where "rank" <= 3""", features=False, extra=_CAT_LONG + "," + _RATES)

_HIST_CTES = """rng as (select "column", case when min(value) = max(value) then min(value) - 0.5 else min(value) end as lo,
                         case when min(value) = max(value) then max(value) + 0.5 else max(value) end as hi
        from fnumlong group by "column"),
cnt as (select l."column", cast(least(floor((l.value - r.lo) * 30 / (r.hi - r.lo)), 29) as integer) as bin,
               count(*) as c
        from fnumlong l join rng r on l."column" = r."column" group by all),
grid as (select "column", lo, hi, cast(unnest(range(0, 30)) as integer) as bin from rng)"""
register("profile_histogram", """select g."column", g.bin, round(g.lo + g.bin * ((g.hi - g.lo) / 30), 6) as bin_lo,
       round(case when g.bin = 29 then g.hi else g.lo + (g.bin + 1) * ((g.hi - g.lo) / 30) end, 6) as bin_hi,
       cast(coalesce(c.c, 0) as bigint) as "count"
from grid g left join cnt c on g."column" = c."column" and g.bin = c.bin""",
         extra=_FNUM_LONG + "," + _HIST_CTES)

_BOX_CTES = """q as (select churn_label, "column", quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as median,
             quantile_cont(value, 0.75) as q3 from numlong group by all),
boxrows as (select l.churn_label, l."column", q.q1, q.median, q.q3, l.value,
             l.value >= q.q1 - 1.5 * (q.q3 - q.q1) and l.value <= q.q3 + 1.5 * (q.q3 - q.q1) as inside
      from numlong l join q on l.churn_label = q.churn_label and l."column" = q."column")"""
register("profile_box_stats", """select churn_label, "column", round(any_value(q1), 6) as q1, round(any_value(median), 6) as median,
  round(any_value(q3), 6) as q3, round(min(case when inside then value end), 6) as whisker_low,
  round(max(case when inside then value end), 6) as whisker_high,
  cast(sum(case when inside then 0 else 1 end) as bigint) as outliers
from boxrows group by churn_label, "column" """, features=False, extra=_NUM_LONG + "," + _BOX_CTES)

register("profile_value_counts", """
select "column", coalesce(value, 'Unknown') as value, cast(count(*) as bigint) as "count" from catlong
group by all order by "column", "count" desc, value""", features=False, extra=_CAT_LONG)
register("profile_churn_rate_sorted", """
select "column", value, round(churn_rate, 6) as churn_rate from rates order by "column", churn_rate desc, value""",
         features=False, extra=_CAT_LONG + "," + _RATES)

# ---- raw preparation --------------------------------------------------------
_BODY = ["gender", "senior_citizen", "partner", "dependents", "tenure", "phone_service", "multiple_lines",
         "internet_service", "online_security", "online_backup", "device_protection", "tech_support",
         "streaming_tv", "streaming_movies", "contract", "paperless_billing", "payment_method",
         "monthly_charges", "total_charges"]
_TITLE = ("upper(substr(trim(coalesce(churn, 'nan')), 1, 1)) || lower(substr(trim(coalesce(churn, 'nan')), 2))")
_PREP_CTES = f"""
prim as (select k, {', '.join(_BODY)}, {_TITLE} as churn, cast(null as varchar) as ingest_date,
                cast(null as varchar) as note, 0 as source_ord from r where k % 10 < 7),
sec as (select k, {', '.join(c if c != 'tech_support' else 'cast(null as varchar) as tech_support' for c in _BODY)},
               {_TITLE} as churn, cast(null as varchar) as ingest_date,
               'note ' || cast(k as varchar) as note, 1 as source_ord from r where k % 10 >= 7),
unioned as (select * from prim union all select * from sec),
coerced as (select * replace (try_cast(trim(tenure) as double) as tenure,
                              try_cast(trim(monthly_charges) as double) as monthly_charges,
                              try_cast(trim(total_charges) as double) as total_charges),
                   row_number() over (order by source_ord, k) as customer_id from unioned)"""

register("prep_label_titlecase", f"select k, churn as churn_raw, {_TITLE} as churn from r",
         clean=False, features=False)
register("prep_conform_schema", """
select * exclude (source_ord), 'C' || cast(k as varchar) as customer_id, 'primary' as source from prim
union all select * exclude (source_ord), cast(null as varchar), 'secondary' from sec""",
         clean=False, features=False, extra=_PREP_CTES)
register("prep_union_sources", "select * from unioned", clean=False, features=False, extra=_PREP_CTES)
register("prep_surrogate_ids", f"""
select cast(customer_id as bigint) as customer_id,
  {', '.join(
      f'cast(round_even({c}, 0) as bigint) as {c}' if c == 'tenure' else
      f'cast(round_even(try_cast(trim({c}) as double), 0) as bigint) as {c}' if c == 'senior_citizen' else c
      for c in _BODY)}, churn, date '2025-08-24' as ingest_date
from coerced""", clean=False, features=False, extra=_PREP_CTES)
register("prep_coerce_numeric",
         "select cast(customer_id as bigint) as customer_id, tenure, monthly_charges, total_charges from coerced",
         clean=False, features=False, extra=_PREP_CTES)
register("prep_round_to_int", """
select cast(customer_id as bigint) as customer_id,
  cast(round_even(try_cast(trim(senior_citizen) as double), 0) as bigint) as senior_citizen,
  cast(round_even(tenure, 0) as bigint) as tenure from coerced""", clean=False, features=False, extra=_PREP_CTES)
register("prep_null_counts", """
select cast(count(*) as bigint) as "rows",
  cast(sum(case when tenure is null then 1 else 0 end) as bigint) as null_tenure,
  cast(sum(case when monthly_charges is null then 1 else 0 end) as bigint) as null_monthly_charges,
  cast(sum(case when total_charges is null then 1 else 0 end) as bigint) as null_total_charges,
  cast(sum(case when churn is null then 1 else 0 end) as bigint) as null_churn
from coerced""", clean=False, features=False, extra=_PREP_CTES)

# ---- model ------------------------------------------------------------------
_SPLIT_CTES = """cnt as (select churn_label, count(*) as n from features group by churn_label),
tot as (select sum(n) as t, cast(ceil(sum(n) * 0.25) as bigint) as n_test from cnt),
base as (select c.churn_label, c.n, floor(c.n * (t.t - t.n_test) / t.t) as fl,
                c.n * (t.t - t.n_test) / t.t - floor(c.n * (t.t - t.n_test) / t.t) as rem,
                t.t - t.n_test as n_train from cnt c cross join tot t),
alloc as (select churn_label, n, fl + case when row_number() over (order by rem desc, churn_label)
                 <= n_train - sum(fl) over () then 1 else 0 end as train from base)"""
register("stratified_split_counts", """
select churn_label, is_test, cast(case when is_test then n - train else train end as bigint) as n
from alloc cross join (select unnest([true, false]) as is_test)
where case when is_test then n - train else train end > 0""", extra=_SPLIT_CTES)
_MODEL_NUM = ["tenure", "monthly_charges", "total_charges", "is_senior", "has_internet", "services_count",
              "avg_charges_per_tenure", "charges_per_service", "contract_length_months", "is_high_spender"]
_MODEL_CAT = ["internet_type", "contract_type", "payment_method", "tenure_bucket"]
_SPLIT_ROWS = _SPLIT_CTES + f""", split as (select f.*, rk <= a.n - a.train as is_test from (
  select *, row_number() over (partition by churn_label order by
    ((customer_id % 2147483647) * 1103515245 + date_diff('day', date '1970-01-01', ingest_date) * 12345 + 42) % 2147483647,
    customer_id, ingest_date, {", ".join(c + " nulls first" for c in _MODEL_NUM[:7] + ["charges_per_service"] + _MODEL_CAT[:3]
                                         + ["contract_length_months", "tenure_bucket", "is_high_spender"])}) as rk
  from features) f join alloc a on f.churn_label is not distinct from a.churn_label)"""
_MNUM_LONG = _SPLIT_ROWS + ", mlong as (" + _union(
    [f"select customer_id, ingest_date, is_test, '{c}' as \"column\", cast({c} as double) as value from split"
     for c in _MODEL_NUM]) + """),
med as (select "column", quantile_cont(value, 0.5) as med from mlong where not is_test and value is not null group by "column"),
imp as (select customer_id, ingest_date, is_test, l."column", coalesce(value, med) as value
        from mlong l left join med m on l."column" = m."column")"""
register("impute_median", """
select customer_id, ingest_date, is_test, "column", value from imp""", extra=_MNUM_LONG)
register("standardize", """
select customer_id, ingest_date, is_test, l."column", round((value - mean) / coalesce(nullif(std, 0), 1), 6) as value
from imp l left join (select "column", avg(value) as mean, stddev_pop(value) as std from imp where not is_test
                      group by "column") s on l."column" = s."column" """, extra=_MNUM_LONG)
_MCAT_LONG = _SPLIT_ROWS + ", clong as (" + _union(
    [f"select customer_id, ingest_date, is_test, payment_method, '{c}' as \"column\", cast({c} as varchar) as value from split"
     for c in _MODEL_CAT]) + ")"


def _modes(fit: str) -> str:
    return f""", modes as (select "column", arg_min(value, (-n, value)) as mode from (
  select "column", value, count(*) as n from clong where {fit} and value is not null group by all) group by "column"),
cimp as (select customer_id, ingest_date, is_test, payment_method, l."column", coalesce(value, mode) as value
         from clong l left join modes m on l."column" = m."column")"""


register("impute_mode", 'select customer_id, ingest_date, is_test, "column", value from cimp',
         extra=_MCAT_LONG + _modes("not is_test"))
_ENCODER_ROWS = "not is_test and payment_method is distinct from 'Mailed check'"
register("one_hot_matrix", f"""
select customer_id, ingest_date, is_test, c."column", c.value as category, cast(position as bigint) as position
from cimp c left join (select "column", value, row_number() over (partition by "column" order by value) - 1 as position
  from (select distinct "column", value from cimp where {_ENCODER_ROWS} and value is not null)) k
  on c."column" = k."column" and c.value = k.value""", extra=_MCAT_LONG + _modes(_ENCODER_ROWS))
_SIZES = "cast(count(*) filter (not is_test) as bigint) as n_train, cast(count(*) filter (is_test) as bigint) as n_test"
register("train_logreg", f"""
select {_SIZES}, round(avg(churn_label) filter (not is_test), 3) as mean_probability,
  round(avg(churn_label) filter (not is_test), 3) as label_rate from split""", extra=_SPLIT_ROWS)
register("logreg_certificate", f"""
select term, true as zero_gradient, (select cast(count(*) as bigint) from split where not is_test) as n_train
from (select unnest({["(intercept)"] + _MODEL_NUM}) as term
      union all select distinct "column" || '=' || value from cimp where not is_test and value is not null)""",
         extra=_MCAT_LONG + _modes("not is_test"))
register("train_rf", f"""
select {_SIZES}, cast(250 as bigint) as n_trees, cast(count(*) filter (is_test) as bigint) as n_scored
from split""", extra=_SPLIT_ROWS)
register("threshold_predictions", """
select churn_label as label, cast(count(*) as bigint) as n, cast(count(*) as bigint) as n_scored,
  cast(count(*) as bigint) as n_consistent from split where is_test group by churn_label""", extra=_SPLIT_ROWS)

_SCORED = """scored as (select churn_label as label,
  cast(((customer_id - 1) * 37) % 100 as double) / 100 as score from features)"""
register("metrics_confusion", """
select cast(tp as bigint) as tp, cast(fp as bigint) as fp, cast(fn as bigint) as fn, cast(tn as bigint) as tn,
  round(coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 0), 6) as accuracy,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as "precision",
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1
from (select cast(sum(case when label = 1 and score >= 0.5 then 1 else 0 end) as double) as tp,
             cast(sum(case when label <> 1 and score >= 0.5 then 1 else 0 end) as double) as fp,
             cast(sum(case when label = 1 and score < 0.5 then 1 else 0 end) as double) as fn,
             cast(sum(case when label <> 1 and score < 0.5 then 1 else 0 end) as double) as tn from scored)""",
         extra=_SCORED)
register("metrics_auc", """
select round(sum(pos * (neg_below + neg / 2.0)) / nullif(sum(pos) * sum(neg), 0), 6) as auc,
  cast(sum(pos) as bigint) as n_pos, cast(sum(neg) as bigint) as n_neg
from (select pos, neg, coalesce(sum(neg) over (order by score rows between unbounded preceding and 1 preceding), 0)
             as neg_below
      from (select score, sum(case when label = 1 then 1 else 0 end) as pos,
                   sum(case when label <> 1 then 1 else 0 end) as neg from scored group by score))""",
         extra=_SCORED)

# ---- status / registry (derived from events) --------------------------------
_STATUS_LOG = """slog as (select 'run-' || cast(user_id as varchar) as run_id, event_type as step,
  case when value < 5 then 'FAILED' when value < 100 then 'STARTED' else 'SUCCESS' end as status,
  props as message, ts as created_at from events)"""
_REG = """reg as (select 'run-' || cast(user_id as varchar) as run_id,
  cast(case when event_type = 'signup' then null else event_id end as bigint) as version,
  case event_type when 'purchase' then 'READY' when 'error' then 'FAILED' when 'signup' then 'RUNNING'
       else 'TRAINING' end as status,
  case when event_type = 'purchase' then 'models/v' || cast(event_id as varchar) end as artifact_uri,
  props as metrics_json, false as is_latest, ts as created_at, ts as updated_at from events)"""
_PROMOTED = """tgt as (select arg_max(run_id, version) as p_run, max(version) as p_ver from reg where status = 'READY'),
promoted as (
  select run_id, version,
    case when me then 'READY' else status end as status,
    case when me then 'models/promoted/v' || cast(p_ver as varchar) else artifact_uri end as artifact_uri,
    case when me then '{"roc_auc": 1.0}' else metrics_json end as metrics_json,
    case when me then true when other then false else is_latest end as is_latest,
    created_at,
    case when me or other then timestamp '2025-08-24 04:30:00' else updated_at end as updated_at
  from (select r.*, t.*, coalesce(r.run_id = t.p_run and r.version is not distinct from t.p_ver, false) as me,
               coalesce(r.is_latest, false) and not coalesce(r.run_id = t.p_run and r.version is not distinct from t.p_ver, false) as other
        from reg r cross join tgt t))"""

register("status_latest", """
select run_id, step, status, created_at from (
  select *, max(created_at) over (partition by run_id, step) as mx,
         row_number() over (partition by run_id, step order by created_at desc, status desc, message desc) as rn
  from slog) where rn = 1""", clean=False, features=False, extra=_STATUS_LOG)
register("registry_next_version", "select cast(coalesce(max(version), 0) + 1 as bigint) as next_version from reg",
         clean=False, features=False, extra=_REG)
_SRC = "src as (select distinct 'run-' || cast(o_custkey as varchar) as run_id from orders)"
register("merge_upsert", """
select run_id, version, case when version is null and run_id in (select run_id from src) then 'RUNNING' else status end as status,
  artifact_uri, metrics_json, is_latest, created_at,
  case when version is null and run_id in (select run_id from src) then timestamp '2025-08-24 04:30:00' else updated_at end as updated_at
from reg
union all
select run_id, cast(null as bigint), 'RUNNING', cast(null as varchar), cast(null as varchar), false,
  timestamp '2025-08-24 04:30:00', timestamp '2025-08-24 04:30:00'
from src where run_id not in (select run_id from reg where version is null)""",
         clean=False, features=False, extra=_REG + "," + _SRC)
register("registry_promote", "select * from promoted", clean=False, features=False, extra=_REG + "," + _PROMOTED)
register("registry_select", """
select version, artifact_uri from promoted where status = 'READY' and is_latest
order by updated_at desc nulls last, version desc nulls last, run_id limit 1""",
         clean=False, features=False, extra=_REG + "," + _PROMOTED)
register("registry_list", """
select version, status, is_latest, artifact_uri, created_at, updated_at from reg
order by version desc nulls last, updated_at desc nulls last, run_id limit 20""",
         clean=False, features=False, extra=_REG)

# ---- scoring payloads ---------------------------------------------------------
_PAYLOAD = ["tenure", "monthly_charges", "total_charges", "is_senior", "has_internet", "services_count",
            "avg_charges_per_tenure", "charges_per_service", "internet_type", "contract_type", "payment_method",
            "contract_length_months", "tenure_bucket", "is_high_spender"]
_PAYLOAD_TYPE = {"tenure": "double", "contract_length_months": "double"}
register("parse_feature_payload", f"""
select customer_id as payload_id, ingest_date, {", ".join(
    f"case when customer_id % 9 > 4 then cast({c} as {_PAYLOAD_TYPE[c]}) end as {c}" if c in _PAYLOAD_TYPE
    else f"case when customer_id % 9 > 4 then {c} end as {c}" for c in _PAYLOAD)},
  customer_id % 9 > 4 as valid_json, customer_id % 9 <= 4 as bad_payload from features""")
register("score_from_json", """
select customer_id as payload_id, ingest_date, customer_id % 9 > 4 as valid_json, customer_id % 9 <= 4 as kept_text,
  customer_id % 9 > 4 as scored, case when customer_id % 9 > 4 then cast(1 as bigint) end as model_version from features""")
register("score_by_id", f"""
select i.customer_id, feature_day is not null as found, feature_day,
  case when feature_day is not null then cast(1 as bigint) end as model_version,
  feature_day is not null as scored, feature_day is not null as decided
from (select customer_id from {_ORDER_IDS} union select c_custkey + 1 as customer_id from customer) i
left join (select customer_id, max(ingest_date) as feature_day from features group by customer_id) f
  on i.customer_id = f.customer_id""")

# ---- incremental ingest: raw rows after the typed load (bad rows skipped) ----
_WRONG = ", ".join(
    f"case when trim(cast({c} as varchar)) <> '' and not regexp_full_match(trim(cast({c} as varchar)), '[+-]?[0-9]+')"
    f" then '{c}' end" if c in ("customer_id", "senior_citizen", "tenure") else
    f"case when trim(cast({c} as varchar)) <> '' and try_cast(trim(cast({c} as varchar)) as double) is null then '{c}' end"
    for c in ["customer_id", "senior_citizen", "tenure", "monthly_charges", "total_charges"])
_LOADED = f"parsed as (select *, coalesce({_WRONG}) as reason from raw)"
register("ingest_incremental", """
select cast(customer_id as bigint) as customer_id, gender, try_cast(trim(senior_citizen) as bigint) as senior_citizen,
  partner, dependents, try_cast(trim(tenure) as bigint) as tenure,
  phone_service, multiple_lines, internet_service, online_security, online_backup, device_protection,
  tech_support, streaming_tv, streaming_movies, contract, paperless_billing, payment_method,
  try_cast(trim(monthly_charges) as double) as monthly_charges,
  try_cast(trim(total_charges) as double) as total_charges, churn, ingest_date
from parsed where reason is null""", clean=False, features=False, extra=_LOADED)
SQL["ingest_redelivered"] = SQL["ingest_incremental"]
register("load_bad_record_budget", """
select ingest_date, coalesce(reason, 'loaded') as outcome, cast(count(*) as bigint) as n
from parsed group by all""", clean=False, features=False, extra=_LOADED)
_COUNTS = ("select cast(count(*) as bigint) as \"rows\", cast(count(reason) as bigint) as bad, " + ", ".join(
    f"cast(count(*) filter (reason is null and try_cast(trim({c}) as double) is null) as bigint) as null_{c}"
    for c in ["tenure", "monthly_charges", "total_charges"]) + " from parsed")
register("load_budget_outcomes", f"""
select bound, case when bad <= allowed then 'loaded' else 'refused' end as outcome, bad, null_monthly_charges, null_tenure,
  null_total_charges, "rows"
from (select *, unnest(['no bad row', '1000 rows', '1 %', '25 %']) as bound, unnest([0, 1000, "rows" * 0.01, "rows" * 0.25]) as allowed
      from ({_COUNTS}))""", clean=False, features=False, extra=_LOADED)
register("load_field_addition", """
select ingest_date, case when ingest_date = date '2025-08-24' then ['gold', 'silver', 'none'][k % 3 + 1] end as loyalty_tier, contract,
  cast(count(*) as bigint) as n
from parsed where reason is null group by all""", clean=False, features=False, extra=_LOADED)
SQL["latest_clean_table"] = SQL["latest_clean"]
register("sketch_report", """
select "column", cast(sum(n) as bigint) as "rows", cast(coalesce(sum(n) filter (value is null), 0) as bigint) as nulls,
  cast(count(value) as bigint) as distinct_values,
  '[' || string_agg('{"value":"' || value || '","count":' || n || '}', ',' order by n desc, value) filter (value is not null and rn <= 3) || ']' as frequent
from (select *, row_number() over (partition by "column" order by value is null, n desc, value) as rn from ("""
         + _union([f"select '{c}' as \"column\", {c} as value, count(*) as n from clean group by {c}"
                   for c in ("gender", "internet_service", "contract", "payment_method", "partner")])
         + """)) group by "column" """, features=False)
register("customer_lookup_table", """
select * exclude (ingest_date) from features where customer_id in (
  select o_custkey + 1 from orders group by 1 order by count(*) desc, 1 limit 20)""")
register("prep_sparse_ids", """
select cast(row_number() over (order by source_ord, md5(cast(k as varchar))) as bigint) as customer_id, source_ord,
  md5(cast(k as varchar)) as key from coerced""", clean=False, features=False, extra=_PREP_CTES)
register("predict_threshold", """
select customer_id, ingest_date, score, cast(score >= 0.5 as bigint) as prediction, label
from (select customer_id, ingest_date, churn_label as label,
             cast(((customer_id - 1) * 37) % 100 as double) / 100 as score from features)""")
