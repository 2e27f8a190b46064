"""Column profile of a clean or feature table (the tables behind the EDA report).

Columns are picked from candidate lists when present, so both table kinds
work. Every statistic is an aggregate over an unpivoted (column, value) form;
quantiles use the distributed exact method in ``quantiles``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from retention.functions import guarded_corr
from retention.operators.quantiles import long_values, quantile_wide, sketched_quantiles
from retention.schemas import PROFILE_CATEGORICAL_CANDIDATES, PROFILE_NUMERIC_CANDIDATES

LABEL = "churn_label"
HIST_BINS = 30
WHISKER = 1.5
TOP_RATES_COLUMNS = 5
TOP_RATES_K = 3


class ProfileInputError(RuntimeError):
    pass


def pick_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    if LABEL not in df.columns:
        raise ProfileInputError(f"a profile needs the label column {LABEL}; the input has {', '.join(df.columns)}")
    num = [c for c in PROFILE_NUMERIC_CANDIDATES if c in df.columns]
    cat = [c for c in PROFILE_CATEGORICAL_CANDIDATES if c in df.columns]
    return num, cat


def require_rows(df: DataFrame) -> None:
    """Empty input is an error (one cheap action: reads at most one row)."""
    if df.isEmpty():
        raise ProfileInputError("a profile needs at least one row; this day has none")


def _cat_long(df: DataFrame, cats: list[str], extra: list[str] = ()) -> DataFrame:
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                             for c in cats])).alias("_kv")
    return df.select(*extra, kv).select(*extra, "_kv.column", "_kv.value")


APPROX_ACCURACY = 100_000


def _quartiles(df: DataFrame, num: list[str], by: list[str], exact: bool) -> DataFrame:
    """(by..., column, p, value) for p = 0.25, 0.5, 0.75: exact (distributed)
    or a single-pass percentile_approx sketch per group (bounded buffers)."""
    probs = [0.25, 0.5, 0.75]
    if exact:
        return sketched_quantiles(df, num, probs, by=by)
    q = (long_values(df, num, by).groupBy(*by, "column")
         .agg(F.percentile_approx("value", probs, APPROX_ACCURACY).alias("_q")))
    return q.select(*by, "column", F.posexplode("_q").alias("_i", "value")) \
        .select(*by, "column", F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("_i") + 1).alias("p"),
                "value")


def numeric_summary(df: DataFrame, cols: list[str] | None = None, exact: bool = True) -> DataFrame:
    """Count, mean, sample std, min, 25/50/75 % (linear), max per column.
    ``exact=False`` takes the quartiles from a percentile_approx sketch."""
    num = cols or pick_columns(df)[0]
    lv = long_values(df, num)
    basic = lv.groupBy("column").agg(
        F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    q = quantile_wide(_quartiles(df, num, [], exact), ["column"],
                      {0.25: "p25", 0.5: "p50", 0.75: "p75"})
    return (basic.join(q, "column", "left")
            .select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"))


def categorical_uniques(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Distinct non-NULL values per categorical column."""
    cats = cols or pick_columns(df)[1]
    return (_cat_long(df, cats).where(F.col("value").isNotNull())
            .groupBy("column").agg(F.count_distinct("value").alias("unique_count")))


def correlation_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pearson matrix of the numeric columns and the label, pairwise
    complete, long form (col_a, col_b, r). One aggregate over the upper
    triangle; the lower triangle is mirrored."""
    num = (cols or pick_columns(df)[0]) + [LABEL]
    pairs = [(a, b) for i, a in enumerate(num) for b in num[i:]]
    wide = df.agg(*[guarded_corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    spark = df.sparkSession
    names = spark.createDataFrame([(str(i), a, b) for i, (a, b) in enumerate(pairs)],
                                  "k string, col_a string, col_b string")
    long = wide.unpivot([], [str(i) for i in range(len(pairs))], "k", "r")
    upper = long.join(F.broadcast(names), "k").select("col_a", "col_b", "r")
    lower = upper.where(F.col("col_a") != F.col("col_b")).select(
        F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "r")
    return upper.unionByName(lower)


def top_label_correlations(df: DataFrame, n: int = 10) -> DataFrame:
    """Correlations with the label, highest first, top ``n``."""
    m = correlation_matrix(df)
    return (m.where((F.col("col_b") == LABEL) & (F.col("col_a") != LABEL))
            .select(F.col("col_a").alias("feature"), "r")
            .orderBy(F.col("r").desc_nulls_last(), "feature").limit(n))


def churn_rates_long(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """E5: mean label per value of each categorical (NULL value excluded)."""
    cats = cols or pick_columns(df)[1]
    return (_cat_long(df, cats, [LABEL]).where(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.avg(LABEL).alias("churn_rate")))


def churn_rates_wide(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """rows = union of values, one column per categorical."""
    cats = cols or pick_columns(df)[1]
    return (churn_rates_long(df, cats).groupBy("value").pivot("column", cats)
            .agg(F.first("churn_rate")))


def top_rates(df: DataFrame, n_columns: int = TOP_RATES_COLUMNS, k: int = TOP_RATES_K) -> DataFrame:
    """Top-k values by label rate for the first ``n_columns`` categoricals.
    The window holds one row per distinct value of one categorical column."""
    cats = pick_columns(df)[1][:n_columns]
    w = Window.partitionBy("column").orderBy(F.col("churn_rate").desc(), F.col("value"))
    return (churn_rates_long(df, cats).withColumn("rank", F.row_number().over(w).cast("bigint"))
            .where(F.col("rank") <= k))


def histogram(df: DataFrame, cols: list[str] | None = None, bins: int = HIST_BINS) -> DataFrame:
    """Equal-width histogram per numeric column, NULLs dropped, last bin
    closed, empty bins kept. min == max widens the range by 0.5 each side.
    Two passes: the ranges, then the counts, whose table also carries the grid."""
    num = cols or pick_columns(df)[0]
    lv = long_values(df, num)
    rng = lv.groupBy("column").agg(F.min("value").alias("_mn"), F.max("value").alias("_mx"))
    rng = rng.select("column",
                     F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("lo"),
                     F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("hi"))
    b = F.least(F.floor((F.col("value") - F.col("lo")) * F.lit(bins) / (F.col("hi") - F.col("lo"))),
                F.lit(bins - 1)).cast("int")
    counts = (lv.join(rng, "column").groupBy("column", "lo", "hi", b.alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
              .groupBy("column", "lo", "hi").agg(F.map_from_entries(F.collect_list(F.struct("bin", "_n"))).alias("_m")))
    w = (F.col("hi") - F.col("lo")) / F.lit(bins)
    return (counts.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
            .select("column", "bin", (F.col("lo") + F.col("bin") * w).alias("bin_lo"),
                    F.when(F.col("bin") == bins - 1, F.col("hi"))
                     .otherwise(F.col("lo") + (F.col("bin") + 1) * w).alias("bin_hi"),
                    F.coalesce(F.col("_m")[F.col("bin")], F.lit(0)).cast("bigint").alias("count")))


def box_stats(df: DataFrame, cols: list[str] | None = None, exact: bool = True) -> DataFrame:
    """Per (column, label): quartiles, whiskers at the last point within
    1.5 IQR, number of outliers. Rows with a NULL in either are dropped.
    ``exact=False`` takes the quartiles from a percentile_approx sketch."""
    num = cols or pick_columns(df)[0]
    lv = long_values(df.where(F.col(LABEL).isNotNull()), num, [LABEL])
    q = quantile_wide(_quartiles(df.where(F.col(LABEL).isNotNull()), num, [LABEL], exact),
                      [LABEL, "column"], {0.25: "q1", 0.5: "median", 0.75: "q3"})
    q = q.withColumn("_lo", F.col("q1") - WHISKER * (F.col("q3") - F.col("q1"))) \
         .withColumn("_hi", F.col("q3") + WHISKER * (F.col("q3") - F.col("q1")))
    v = F.col("value")
    inside = (v >= F.col("_lo")) & (v <= F.col("_hi"))
    j = lv.join(q, [LABEL, "column"])
    return j.groupBy(LABEL, "column").agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(1)).cast("bigint").alias("outliers"))


def value_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Counts per value with NULL shown as 'Unknown', most frequent first."""
    cats = cols or pick_columns(df)[1]
    return (_cat_long(df, cats).select("column", F.coalesce("value", F.lit("Unknown")).alias("value"))
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("column", F.col("count").desc(), "value"))


def churn_rate_sorted(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Label rate by category, highest first within each column."""
    return churn_rates_long(df, cols).orderBy("column", F.col("churn_rate").desc(), "value")
