"""Segment, cohort and history analytics over clean / feature tables.

All are single aggregates (partial + final, map-side combined, so a hot
segment costs one row per task before the shuffle) or top-k
(TakeOrderedAndProject). Every ordered LIMIT carries unique tie-break keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from retention.functions import guarded_corr
from retention.operators.clean import day_lit
from retention.schemas import LABEL_CORRELATION_FEATURES


def _rate(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                 F.avg("churn_label").alias("churn_rate"))


def counts_side_by_side(clean_df: DataFrame, features_df: DataFrame) -> DataFrame:
    """A1: two table counts in one row; the second is a scalar subquery."""
    b = features_df.agg(F.count(F.lit(1)))
    return clean_df.agg(F.count(F.lit(1)).alias("clean_rows")).select(
        "clean_rows", b.scalar().alias("feature_rows"))


def churn_distribution(df: DataFrame) -> DataFrame:
    """A2: label distribution."""
    return df.groupBy("churn_label").agg(F.count(F.lit(1)).alias("n"))


def partition_counts(df: DataFrame, asof, days: int = 7) -> DataFrame:
    """A3: rows per partition with asof-days <= d <= asof, newest first."""
    d = day_lit(asof)
    return (df.where(F.col("ingest_date").between(F.date_sub(d, days), d))
              .groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.col("ingest_date").desc()))


def segment_contract(features_df: DataFrame) -> DataFrame:
    """A4: churn rate by contract type, highest first."""
    return _rate(features_df, ["contract_type"]).orderBy(
        F.col("churn_rate").desc(), F.col("contract_type").asc_nulls_last())


def segment_internet_payment(features_df: DataFrame, limit: int = 20) -> DataFrame:
    """A5: churn rate by internet type x payment method, top ``limit``."""
    return (_rate(features_df, ["internet_type", "payment_method"])
            .orderBy(F.col("churn_rate").desc(), F.col("internet_type").asc_nulls_last(),
                     F.col("payment_method").asc_nulls_last())
            .limit(limit))


def label_correlations(features_df: DataFrame, label: str = "churn_label",
                       features: list[str] | None = None) -> DataFrame:
    """Pearson r of each numeric feature with the label, one pass + unpivot."""
    feats = [c for c in (features or LABEL_CORRELATION_FEATURES) if c in features_df.columns]
    wide = features_df.agg(*[guarded_corr(c, label).alias(c) for c in feats])
    long = wide.unpivot([], feats, "feature", "r")
    return long.orderBy(F.col("r").desc_nulls_last(), F.col("feature"))


def tenure_cohort(t) -> F.Column:
    t = F.col(t) if isinstance(t, str) else t
    return (F.when(t < 6, F.lit("0-5m")).when(t < 12, F.lit("6-11m"))
            .when(t < 24, F.lit("12-23m")).when(t < 36, F.lit("24-35m"))
            .otherwise(F.lit("36m+")))


def tenure_cohorts(features_df: DataFrame) -> DataFrame:
    """Churn by tenure cohort; NULL tenure falls in the last cohort."""
    return (features_df.withColumn("tenure_cohort", tenure_cohort("tenure"))
            .groupBy("tenure_cohort")
            .agg(F.count(F.lit(1)).alias("n"), F.avg("churn_label").alias("churn_rate"),
                 F.avg("monthly_charges").alias("avg_monthly"))
            .orderBy(F.col("churn_rate").desc(), F.col("tenure_cohort")))


def high_risk_segments(features_df: DataFrame, min_rows: int = 50, limit: int = 15) -> DataFrame:
    """Contract x payment segments with at least ``min_rows`` rows, top ``limit``."""
    return (_rate(features_df, ["contract_type", "payment_method"])
            .where(F.col("n") >= min_rows)
            .orderBy(F.col("churn_rate").desc(), F.col("contract_type").asc_nulls_last(),
                     F.col("payment_method").asc_nulls_last())
            .limit(limit))


def customer_lookup(features_df: DataFrame, ids: DataFrame) -> DataFrame:
    """A9 (batch form): feature rows (without the partition column) of the
    customers in ``ids``. The id list is joined, not collected."""
    return (features_df.join(ids.select("customer_id").distinct(), "customer_id", "left_semi")
            .drop("ingest_date"))


def latest_customer_features(features_df: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """A10 (batch form): newest feature row per customer.

    ``max_by`` over a struct aggregates partially per task, so a customer with
    many rows costs one buffer per task, never a collected group.
    Ties on the date are broken by the full row (deterministic).
    """
    src = features_df
    if ids is not None:
        src = src.join(ids.select("customer_id").distinct(), "customer_id", "left_semi")
    rest = [c for c in src.columns if c != "customer_id"]
    key = F.struct(F.col("ingest_date"), *[F.col(c) for c in rest if c != "ingest_date"])
    best = src.groupBy("customer_id").agg(F.max_by(F.struct(*rest), key).alias("_r"))
    return best.select("customer_id", *[F.col(f"_r.{c}").alias(c) for c in rest if c != "ingest_date"])


def segment_contract_latest(features_df: DataFrame) -> DataFrame:
    """Churn rate by contract on the newest partition. The rows are read once: the rates of
    every (day, contract) are an aggregate, and the newest day is picked among its few rows. On a
    stored table ``sources.tables.read_newest`` finds the day without reading any row."""
    rates = _rate(features_df, ["ingest_date", "contract_type"])
    days = rates.groupBy("ingest_date").agg(F.collect_list(F.struct("contract_type", "n", "churn_rate")).alias("_r"))
    newest = days.agg(F.max_by("_r", "ingest_date").alias("_r")).select(F.inline("_r"))
    return newest.orderBy(F.col("churn_rate").desc(), F.col("contract_type").asc_nulls_last())
