"""Feature engineering: 17-column feature rows from clean rows.

The only non-row-local input is the day's 80th percentile of monthly charges,
an exact distributed quantile with one row for each day. That table ends in an
aggregate by day, so the optimizer knows its join key to be unique and drops the
join where ``is_high_spender`` is not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from retention.functions import safe_divide
from retention.operators.clean import day_lit
from retention.operators.quantiles import sketched_quantiles
from retention.schemas import ADDON_COLUMNS, CONTRACT_MONTHS, FEATURE_COLUMNS

HIGH_SPENDER_PERCENTILE = 0.8
APPROX_ACCURACY = 100_000


def daily_p80(clean_df: DataFrame, exact: bool = True) -> DataFrame:
    """(ingest_date, p80_monthly) of every day with a charge: the nearest-rank value
    (``quantiles.sketched_quantiles``, no buffer per day), or a percentile_approx sketch."""
    if not exact:
        return clean_df.groupBy("ingest_date").agg(
            F.percentile_approx("monthly_charges", HIGH_SPENDER_PERCENTILE, APPROX_ACCURACY).alias("p80_monthly"))
    q = sketched_quantiles(clean_df.select("ingest_date", "monthly_charges"), ["monthly_charges"],
                           [HIGH_SPENDER_PERCENTILE], by=["ingest_date"], kind="disc")
    return q.groupBy("ingest_date").agg(F.max("value").alias("p80_monthly"))


def services_count() -> Column:
    """Sum of six yes-flags; any NULL flag makes the sum NULL."""
    return reduce(lambda a, b: a + b,
                  [(F.col(c) == "Yes").cast("bigint") for c in ADDON_COLUMNS])


def contract_months(c: Column) -> Column:
    e = None
    for k, v in CONTRACT_MONTHS.items():
        e = (F.when(c == k, F.lit(v)) if e is None else e.when(c == k, F.lit(v)))
    return e.cast("bigint")


def tenure_bucket(t: Column) -> Column:
    return (F.when(t.isNull(), F.lit("unknown"))
            .when(t < 12, F.lit("<12m"))
            .when(t.between(12, 24), F.lit("12-24m"))
            .when(t.between(25, 48), F.lit("25-48m"))
            .otherwise(F.lit(">48m")))


def feature_columns(stats_col: Column) -> list[Column]:
    sc = services_count()
    return [
        F.col("customer_id"), F.col("tenure"), F.col("monthly_charges"), F.col("total_charges"),
        (F.col("senior_citizen") == 1).alias("is_senior"),
        (F.col("internet_service") != "No").alias("has_internet"),
        sc.alias("services_count"),
        safe_divide("total_charges", "tenure").alias("avg_charges_per_tenure"),
        safe_divide(F.col("monthly_charges"), sc).alias("charges_per_service"),
        F.col("internet_service").alias("internet_type"),
        F.col("contract").alias("contract_type"),
        F.col("payment_method"),
        contract_months(F.col("contract")).alias("contract_length_months"),
        tenure_bucket(F.col("tenure")).alias("tenure_bucket"),
        (F.col("monthly_charges") > stats_col).alias("is_high_spender"),
        F.col("churn_label"),
        F.col("ingest_date"),
    ]


def build_features(clean_df: DataFrame, day=None, exact: bool = True) -> DataFrame:
    """Clean -> features for one day, or for every day at once (per-day p80).

    Building it runs no job. The statistics are broadcast: one row of two values
    for each day, so a century of days is 36,525 rows (under 2 MB); a shuffle by
    day instead would put each day's rows into one task."""
    src = clean_df if day is None else clean_df.where(F.col("ingest_date") == day_lit(day))
    joined = src.join(F.broadcast(daily_p80(src, exact=exact)), "ingest_date", "left")
    return joined.select(*feature_columns(F.col("p80_monthly"))).select(*FEATURE_COLUMNS)
