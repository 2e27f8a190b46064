"""MERGE for tables without MERGE support (plain Parquet snapshots).

``merge_upsert`` = target rows left-joined to the source (matched ones updated,
others kept) + source rows without a match (an anti join) inserted. The match
condition may include target-only predicates (``T.version IS NULL``). Keys
compare null-safely unless they are declared not nullable. No broadcast is forced;
the optimizer may pick one by size and, unlike in a full outer join, split a skewed
key on the left side. A source that has a key twice is refused, as a MERGE requires.

A target that is kept bucketed and sorted by its keys (``write_bucketed``) stays where it
is: only the source is shuffled, into the target's buckets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def write_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> None:
    """``df`` as the table ``name`` at ``path``, in ``buckets`` files sorted by ``keys``. The rows are
    dealt to the buckets first, so that there is one file for each and not one for each task."""
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
     .mode("overwrite").saveAsTable(name))


def unique_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """``source``, which fails when a key occurs twice: no row is merged by chance. The count shares
    the shuffle by key that the join needs in any case."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    text = F.concat(F.lit("the source has a key twice: "), F.to_json(F.struct(*keys)))
    return source.withColumn("_n", n).where(F.when(F.col("_n") > 1, F.raise_error(text).cast("boolean")).otherwise(F.lit(True))).drop("_n")


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str],
                 target_cond: Column | None = None,
                 when_matched: dict[str, Column] | None = None,
                 when_not_matched: dict[str, Column] | None = None, nullable_keys: bool = True) -> DataFrame:
    """MERGE target T USING source S ON T.k <=> S.k [AND target_cond]
    WHEN MATCHED THEN UPDATE SET when_matched
    WHEN NOT MATCHED THEN INSERT when_not_matched (columns missing -> NULL).

    The target-only predicate is part of both join conditions. ``when_matched`` expressions
    see the target columns (and source columns as ``_s_<name>``); inserted
    target columns not named in ``when_not_matched`` take the source column of
    the same name (else NULL), and its expressions refer to source columns as
    ``_s_<name>``. A repeated source key fails the query. ``nullable_keys=False``: no key
    is NULL, so equality is plain and a bucketed target needs no shuffle.
    """
    upd = when_matched or {}
    ins = when_not_matched or {}
    s = unique_keys(source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns]), [f"_s_{k}" for k in keys])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_s_{k}")) if nullable_keys else F.col(k) == F.col(f"_s_{k}")
                                     for k in keys])
    if target_cond is not None:
        on = on & target_cond
    types = dict(target.dtypes)
    matched = F.col("_s_row").isNotNull()
    kept = target.join(s.withColumn("_s_row", F.lit(True)), on, "left").select(
        *[(F.when(matched, upd[c].cast(types[c])).otherwise(F.col(c)) if c in upd else F.col(c)).alias(c)
          for c in target.columns])
    new = s.join(target, on, "left_anti").select(
        *[(ins[c] if c in ins else F.col(f"_s_{c}") if c in source.columns else F.lit(None)).cast(types[c]).alias(c)
          for c in target.columns])
    return kept.unionByName(new)
