"""Aggregate helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from retention.functions.strings import _c


def count_when(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END) as bigint; NULL cond counts 0."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def null_count(c) -> Column:
    return count_when(_c(c).isNull())


def guarded_corr(a, b) -> Column:
    """Pearson correlation over pairwise-complete rows that never throws.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI mode for a constant column.
    covar_pop / (stddev_pop(a) * stddev_pop(b)), each restricted to rows where
    both sides are present, gives NULL for constant, one-row and empty input.
    Partial aggregation applies, so this is one map-side-combined pass.
    """
    ca, cb = _c(a).cast("double"), _c(b).cast("double")
    both = ca.isNotNull() & cb.isNotNull()
    sa = F.stddev_pop(F.when(both, ca))
    sb = F.stddev_pop(F.when(both, cb))
    return F.try_divide(F.covar_pop(ca, cb), F.nullif(sa * sb, F.lit(0.0)))
