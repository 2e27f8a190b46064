"""Exact running sums in a global order without a single-task window.

A window with an ORDER BY but no PARTITION BY moves every row into one task.
Here the caller names a ``bucket``: a function of the first order column that
never decreases with it, so bucket order is row order and equal keys share a
bucket. It is a plain expression: a row's bucket is the same in every branch
of the plan and after any recomputation, nothing is sampled, and building the
plan runs no job. The running sum is a window inside each bucket; bucket totals
(partial sums, one row for each bucket and group) give the offsets.

Used for contiguous ids (count of 1 per row), per-label ranks and ROC AUC
(negatives per distinct score), exact quantiles (counts per distinct value).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Keys in one bucket of a dense integer key, and buckets in each doubling of a real value.
KEYS_PER_BUCKET, BUCKETS_PER_DOUBLING = 1 << 16, 256


def by_key(c: Column) -> Column:
    """Bucket of a dense integer key: 65,536 neighbouring keys."""
    return F.floor(c / F.lit(KEYS_PER_BUCKET)).cast("bigint")


def by_value(c: Column) -> Column:
    """Bucket of any real value: 256 for each doubling of 1 + |value|, mirrored below zero."""
    x = c.cast("double")
    step = F.log2(F.lit(1.0) + F.abs(x)) * F.lit(float(BUCKETS_PER_DOUBLING))
    return F.when(F.isnan(x), F.lit((1 << 63) - 1)).otherwise(
        F.when(x < 0, -F.ceil(step)).otherwise(F.floor(step))).cast("bigint")


def by_share(c: Column) -> Column:
    """Bucket of a value in [0, 1]: 65,536 equal ranges."""
    return F.floor(c.cast("double") * F.lit(KEYS_PER_BUCKET)).cast("bigint")


def same(left: list[str], right: list[str]) -> Column:
    """Null-safe equality of columns, pairwise by name."""
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)])


def running_sum(df: DataFrame, order_cols: list[str], value_col: str | None = None,
                partition_cols: list[str] | tuple = (), out: str = "running",
                bucket: Callable[[Column], Column] = by_key, prefix: list[str] | tuple = ()) -> DataFrame:
    """Inclusive running sum of ``value_col`` (1 per row when None) ordered by
    ``prefix`` and then ``order_cols``, restarting for every combination of
    ``partition_cols``.

    ``bucket`` is applied to the first of ``order_cols``; ``prefix`` columns come
    before it and are part of the bucket (e.g. a source number). Rows that tie on
    all order columns get distinct, arbitrary positions. Nulls come first.
    """
    keys, pre = list(partition_cols), list(prefix)
    v = F.lit(1).cast("bigint") if value_col is None else F.col(value_col)
    src = df.withColumn("_rs_v", v).withColumn("_rs_b", bucket(F.col(order_cols[0])))
    slot = keys + pre + ["_rs_b"]
    run = Window.partitionBy(*slot).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    local = src.withColumn("_rs_local", F.sum("_rs_v").over(run))
    totals = src.groupBy(*slot).agg(F.sum("_rs_v").alias("_rs_t"))
    before = Window.partitionBy(*keys).orderBy(
        *[F.col(c).asc_nulls_first() for c in pre + ["_rs_b"]]).rowsBetween(Window.unboundedPreceding, -1)
    names = [f"_o{i}" for i in range(len(slot))]
    offsets = totals.select(*[F.col(c).alias(n) for c, n in zip(slot, names)],
                            F.coalesce(F.sum("_rs_t").over(before), F.lit(0)).alias("_rs_off"))
    return local.join(offsets, same(slot, names)).select(
        *df.columns, (F.col("_rs_local") + F.col("_rs_off")).alias(out))


def contiguous_ids(df: DataFrame, order_cols: list[str], out: str = "id", start: int = 1,
                   bucket: Callable[[Column], Column] = by_key, prefix: list[str] | tuple = ()) -> DataFrame:
    """Ids start, start+1, ... in the order of ``prefix`` and ``order_cols`` (no gaps), like
    a row number over the whole table but computed in parallel."""
    r = running_sum(df, order_cols, None, (), "_cid", bucket, prefix)
    return r.withColumn(out, (F.col("_cid") + F.lit(start - 1)).cast("bigint")).drop("_cid")


def ranged_ids(df: DataFrame, order_cols: list[str], out: str = "id", start: int = 1) -> DataFrame:
    """Contiguous ids in the order of any sortable columns: sparse integers, text, several keys.

    Two levels: sampled range boundaries deal the rows to tasks, which sort them and write them
    with their place in the range; the ranges' sizes, added up, are the offsets. A hash of the row's
    place follows the order columns in the boundaries, so a value that a third of the rows share is
    cut into ranges, too; rows that tie on ``order_cols`` get distinct ids in an arbitrary order. Nulls
    come first. The one window is over a row for each range. The ranges are written to the shared
    folder: sampled boundaries may differ if a stage runs again, what is written does not.
    """
    from retention.session import checkpoint_dir
    spark = df.sparkSession
    keyed = df.withColumn("_ri_t", F.xxhash64(F.monotonically_increasing_id(), *order_cols))
    order = [F.col(c).asc_nulls_first() for c in [*order_cols, "_ri_t"]]
    rows = (keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_ri_t")
            .withColumn("_ri_id", F.monotonically_increasing_id()))
    path = f"{checkpoint_dir(spark).rstrip('/')}/ranges-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    part, place = F.shiftright("_ri_id", 33), F.col("_ri_id").bitwiseAND(F.lit((1 << 33) - 1))
    rows = rows.select(*df.columns, part.alias("_ri_p"), place.alias("_ri_at"))
    earlier = Window.orderBy("_ri_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("_ri_p").agg(F.count(F.lit(1)).alias("_ri_n"))
               .select(F.col("_ri_p").alias("_ri_q"), F.coalesce(F.sum("_ri_n").over(earlier), F.lit(0)).alias("_ri_off")))
    return (rows.join(offsets, F.col("_ri_p") == F.col("_ri_q"))
            .select(*df.columns, (F.col("_ri_off") + F.col("_ri_at") + F.lit(start)).cast("bigint").alias(out)))


def scan_order_ids(df: DataFrame, group_cols: list[str], pos_col: str, out: str = "id",
                   start: int = 1) -> DataFrame:
    """Contiguous ids in file-scan order.

    ``group_cols`` name a file split (e.g. source, file path, split start) and
    ``pos_col`` is ``monotonically_increasing_id()`` taken right after the scan:
    rows of one split are read in sequence inside one task. The rows are
    checkpointed first, so positions and split offsets come from one execution
    of the scan. The offsets' window runs over one row for each file split.
    """
    from retention.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    rows = df.checkpoint(eager=True)
    splits = rows.groupBy(*group_cols).agg(F.min(pos_col).alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy(*group_cols).rowsBetween(Window.unboundedPreceding, -1)
    names = [f"_g{i}" for i in range(len(group_cols))]
    offs = splits.select(*[F.col(c).alias(n) for c, n in zip(group_cols, names)], "_first",
                         F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    ident = F.col("_off") + (F.col(pos_col) - F.col("_first")) + F.lit(start)
    return rows.join(offs, same(list(group_cols), names)).select(*df.columns, ident.cast("bigint").alias(out))
