"""Distinct counts and frequent values from sketches kept for each day.

Each day's sketches are written once, when the day is loaded: per column a
HyperLogLog of its distinct values and a frequent-items sketch. A report over any
days unions them: it reads a few rows per day and no data row.

Error: a distinct count has a relative standard error of 1.04 / sqrt(2 ** LG_K)
(1.6 %), and is exact for a few values. The frequent-items sketch tracks
``TRACKED`` items of a column; as long as no day or union has met more different
values than 0.75 * TRACKED, its counts are exact; beyond it a count is off by at most
3.5 * rows / TRACKED. Null values are counted apart and are no value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from retention.sources import tables as TB

LG_K, TRACKED = 12, 4096


def day_sketches(df: DataFrame, cols: list[str], part: str = TB.PART) -> DataFrame:
    """(ingest_date, column, rows, nulls, distinct_sketch, frequent_sketch): one row for each day and column.

    One pass: every column's sketches are aggregates of the same scan, merged from the tasks' own."""
    each = []
    for c in cols:
        v = F.col(c).cast("string")
        each.append(F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("rows"), F.count_if(v.isNull()).alias("nulls"),
                             F.hll_sketch_agg(v, LG_K).alias("distinct_sketch"),
                             F.call_function("approx_top_k_accumulate", v, F.lit(TRACKED)).alias("frequent_sketch")))
    return df.groupBy(part).agg(F.array(*each).alias("_e")).select(part, F.inline("_e"))


def write_sketches(df: DataFrame, cols: list[str], path: str) -> None:
    """Adds the days of ``df`` to the sketch table, in place of what it held for them."""
    TB.write_partitions(day_sketches(df, cols), path)


def report(spark: SparkSession, path: str, first=None, last=None, top: int = 10) -> DataFrame:
    """(column, rows, nulls, distinct_values, frequent array<struct<value, count>>) over the days from
    ``first`` to ``last`` (inclusive, either may be left out): a union of the days' sketches."""
    s = spark.read.parquet(path)
    if first is not None:
        s = s.where(F.col(TB.PART) >= F.lit(first).cast("date"))
    if last is not None:
        s = s.where(F.col(TB.PART) <= F.lit(last).cast("date"))
    frequent = F.call_function("approx_top_k_estimate", F.call_function("approx_top_k_combine", "frequent_sketch", F.lit(TRACKED)),
                               F.lit(top + 1))
    known = F.filter(frequent, lambda x: x["item"].isNotNull())
    order = F.array_sort(known, lambda a, b: F.when(a["count"] != b["count"], F.when(a["count"] > b["count"], -1).otherwise(1))
                         .otherwise(F.when(a["item"] < b["item"], -1).when(a["item"] > b["item"], 1).otherwise(0)))
    return s.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_values"),
        F.transform(F.slice(order, 1, top), lambda x: F.struct(x["item"].alias("value"), x["count"].alias("count"))).alias("frequent"))
