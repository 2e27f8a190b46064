"""Data-quality suite over the clean table.

Batch form: every check is grouped by the partition column, so one pass
validates every day; ``day`` restricts to one partition (the daily job).
Row count, NULL counts, out-of-range counts and basic stats are fused into a
single aggregate (one scan, partial + final). Distinct counts plan as
Expand + two aggregates. Duplicates are counted with two aggregates whose
first is map-side combined, so a hot id never gathers its rows in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from retention.functions import count_when, null_count
from retention.operators.clean import day_lit
from retention.schemas import GENDER_VALUES, SENIOR_VALUES

PART = "ingest_date"

CHECK_NAMES = ["row_count", "nulls", "label_values", "out_of_range", "basic_stats",
               "distinct_counts", "duplicates", "partitions_present"]


def _scope(df: DataFrame, day) -> DataFrame:
    return df if day is None else df.where(F.col(PART) == day_lit(day))


def row_count_aggs() -> list[Column]:
    return [F.count(F.lit(1)).alias("cnt")]


def null_aggs() -> list[Column]:
    return [null_count("tenure").alias("null_tenure"),
            null_count("gender").alias("null_gender"),
            null_count("monthly_charges").alias("null_monthly"),
            null_count("total_charges").alias("null_total"),
            null_count("senior_citizen").alias("null_senior_citizen"),
            null_count("churn_label").alias("null_churn_label")]


def out_of_range_aggs() -> list[Column]:
    # SQL three-valued logic: NULL is neither in nor out of range.
    return [count_when(F.col("tenure") < 0).alias("bad_tenure"),
            count_when(~F.col("gender").isin(*GENDER_VALUES)).alias("bad_gender"),
            count_when(F.col("monthly_charges") < 0).alias("bad_monthly"),
            count_when(F.col("total_charges") < 0).alias("bad_total"),
            count_when(~F.col("senior_citizen").isin(*SENIOR_VALUES)).alias("bad_senior_citizen")]


def basic_stats_aggs() -> list[Column]:
    out = []
    for col, short in [("tenure", "tenure"), ("monthly_charges", "monthly"), ("total_charges", "total")]:
        out += [F.min(col).alias(f"min_{short}"), F.max(col).alias(f"max_{short}"),
                F.avg(col).alias(f"avg_{short}")]
    return out


def distinct_aggs(approx: bool = False) -> list[Column]:
    cd = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    return [cd("gender").alias("distinct_gender"),
            cd("internet_service").alias("distinct_internet_service"),
            cd("contract").alias("distinct_contract"),
            cd("payment_method").alias("distinct_payment_method")]


def row_count(df, day=None):
    return _scope(df, day).groupBy(PART).agg(*row_count_aggs())


def nulls(df, day=None):
    return _scope(df, day).groupBy(PART).agg(*null_aggs())


def label_values(df, day=None):
    return (_scope(df, day).groupBy(PART, "churn_label").agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(PART, "churn_label"))


def out_of_range(df, day=None):
    return _scope(df, day).groupBy(PART).agg(*out_of_range_aggs())


def basic_stats(df, day=None):
    return _scope(df, day).groupBy(PART).agg(*basic_stats_aggs())


def distinct_counts(df, day=None, approx: bool = False):
    return _scope(df, day).groupBy(PART).agg(*distinct_aggs(approx))


def duplicates(df, day=None, key: str = "customer_id"):
    """Number of ids seen more than once, per day (0 when none)."""
    per_id = _scope(df, day).groupBy(PART, key).agg(F.count(F.lit(1)).alias("_n"))
    return per_id.groupBy(PART).agg(count_when(F.col("_n") > 1).alias("dupes"))


def partitions_present(df, n: int = 5):
    """Newest ``n`` partitions; ignores the day scope by design."""
    return df.select(PART).distinct().orderBy(F.col(PART).desc()).limit(n)


def fused_scalar_checks(df, day=None):
    """row_count + nulls + out_of_range + basic_stats in one scan."""
    return _scope(df, day).groupBy(PART).agg(
        *row_count_aggs(), *null_aggs(), *out_of_range_aggs(), *basic_stats_aggs())


def _check_of(metric: Column) -> Column:
    return (F.when(metric == "cnt", F.lit("row_count"))
            .when(metric.startswith("null_"), F.lit("nulls"))
            .when(metric.startswith("bad_"), F.lit("out_of_range"))
            .when(metric.startswith("distinct_"), F.lit("distinct_counts"))
            .otherwise(F.lit("basic_stats")))


def report_long(df, day=None) -> DataFrame:
    """Numeric checks in long form (ingest_date, check, metric, value double).

    Three scans of the day(s): one fused aggregate (scalar checks and distinct
    counts together, one Expand), one label aggregate, one duplicate count.
    """
    scoped = _scope(df, day)
    fused = scoped.groupBy(PART).agg(*row_count_aggs(), *null_aggs(), *out_of_range_aggs(),
                                     *basic_stats_aggs(), *distinct_aggs())
    metrics = [c for c in fused.columns if c != PART]
    long = (fused.select(PART, *[F.col(c).cast("double").alias(c) for c in metrics])
            .unpivot([PART], metrics, "metric", "value")
            .withColumn("check", _check_of(F.col("metric"))))
    lv = (label_values(df, day)
          .select(PART, F.lit("label_values").alias("check"),
                  F.concat(F.lit("cnt_"), F.col("churn_label").cast("string")).alias("metric"),
                  F.col("cnt").cast("double").alias("value")))
    du = duplicates(df, day).select(PART, F.lit("duplicates").alias("check"),
                                    F.lit("dupes").alias("metric"),
                                    F.col("dupes").cast("double").alias("value"))
    return (long.select(PART, "check", "metric", "value")
            .unionByName(lv).unionByName(du))


def validation_report(df, day=None, digits: int | None = None) -> DataFrame:
    """(ingest_date, check, result_json) rows, the shape of the saved report.

    The scalar checks come from one fused row for each day, exploded to one row
    per check, so the day is read as often as in ``report_long`` and once more
    for the partition list (ingest_date NULL: table-wide). Label and partition
    lists hold a handful of rows. ``digits`` rounds the averages in the JSON."""
    fused = _scope(df, day).groupBy(PART).agg(*row_count_aggs(), *null_aggs(), *out_of_range_aggs(),
                                              *basic_stats_aggs(), *distinct_aggs())
    if digits is not None:
        fused = fused.withColumns({c: F.round(c, digits) for c in fused.columns if c.startswith("avg_")})
    checks = {
        "row_count": ["cnt"],
        "nulls": [c for c in fused.columns if c.startswith("null_")],
        "out_of_range": [c for c in fused.columns if c.startswith("bad_")],
        "basic_stats": [c for c in fused.columns if c[:4] in ("min_", "max_", "avg_")],
        "distinct_counts": [c for c in fused.columns if c.startswith("distinct_")],
    }
    rows = F.explode(F.array(*[F.struct(F.lit(check).alias("check"), F.to_json(F.array(F.struct(*names)), _NULLS).alias("result_json"))
                               for check, names in checks.items()]))
    scalar = fused.select(PART, rows.alias("_r")).select(PART, "_r.check", "_r.result_json")

    def listed(rows_: DataFrame, check: str) -> DataFrame:
        vals = [c for c in rows_.columns if c != PART]
        return rows_.groupBy(PART).agg(F.to_json(F.array_sort(F.collect_list(F.struct(*vals))), _NULLS).alias("result_json")) \
            .select(PART, F.lit(check).alias("check"), "result_json")
    days = partitions_present(df).agg(F.to_json(F.sort_array(F.collect_list(
        F.struct(F.date_format(PART, "yyyy-MM-dd").alias(PART))), asc=False)).alias("result_json"))
    return (scalar.unionByName(listed(label_values(df, day), "label_values"))
            .unionByName(listed(duplicates(df, day), "duplicates"))
            .unionByName(days.select(F.lit(None).cast("date").alias(PART), F.lit("partitions_present").alias("check"), "result_json")))


_NULLS = {"ignoreNullFields": "false"}
