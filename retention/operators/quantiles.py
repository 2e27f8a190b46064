"""Exact quantiles per group without holding a group in one task.

``sketched_quantiles`` (the default of the feature, profile and model steps): one KLL
sketch per group, merged from the tasks' sketches, brackets every wanted rank; a
second pass counts what lies under each bracket and orders the bracketed values only.

``exact_quantiles`` takes no sketch and reads its input once:

1. unpivot the columns to (group..., column, value), drop NULLs;
2. count rows per distinct value (map-side combined: a value held by a third of
   all rows is one row per task before the shuffle);
3. add those counts up in ranges of values (``ordering.by_value``) and find, for
   each target rank, the range that holds it;
4. only the distinct values of those ranges are put in order.

Both are one lazy plan, the same at every size, and give the same values.

``kind='linear'``: position (n-1)p with linear interpolation (percentile_cont).
``kind='disc'``: the first value whose cumulative share reaches p (percentile_disc).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from retention.operators.ordering import by_value, same

#: Size of the sketches, their rank error at 99 % confidence (2.296 / k ** 0.9021, from the
#: sketch's documentation), and how many of these errors a bracket spans on either side.
KLL_K, KLL_ERRORS = 4096, 4
KLL_RANK_ERROR = 2.296 / KLL_K ** 0.9021
#: Groups of fewer values are ordered whole.
KLL_WHOLE = 2000


def long_values(df: DataFrame, cols: list[str], by: list[str] | tuple = ()) -> DataFrame:
    """(by..., column, value double) for the non-NULL values of ``cols``."""
    if len(cols) == 1:  # a constant name drops out of grouping and partitioning keys
        return df.select(*by, F.lit(cols[0]).alias("column"), F.col(cols[0]).cast("double").alias("value")).where("value is not null")
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                             for c in cols])).alias("_kv")
    return (df.select(*by, kv).select(*by, "_kv.column", "_kv.value")
            .where(F.col("value").isNotNull()))


def value_histogram(df: DataFrame, cols: list[str], by: list[str] | tuple = ()) -> DataFrame:
    return (long_values(df, cols, by).groupBy(*by, "column", "value")
            .agg(F.count(F.lit(1)).alias("cnt")))


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                    by: list[str] | tuple = (), kind: str = "linear") -> DataFrame:
    """Rows (by..., column, p, value, n); no rows for a group without values."""
    keys = list(by) + ["column"]
    hist = value_histogram(df, cols, by).withColumn("_b", by_value(F.col("value")))
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    ranges = (hist.groupBy(*keys, "_b").agg(F.sum("cnt").alias("_c"))
              .select(*keys, "_b", (F.sum("_c").over(upto) - F.col("_c")).alias("_before"), "_c",
                      F.sum("_c").over(whole).alias("n")))
    t = ranges.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    lo, hi, frac = _ranks(F.col("n"), F.col("p"), kind)
    in_range = [(i >= F.col("_before")) & (i < F.col("_before") + F.col("_c")) for i in (lo, hi)]
    t = t.where(in_range[0] | in_range[1])
    names = [f"_k{i}" for i in range(len(keys) + 1)]
    wanted = t.select(*[F.col(k).alias(a) for k, a in zip(keys + ["_b"], names)], "_before", "n", "p",
                      lo.cast("bigint").alias("_lo"), hi.cast("bigint").alias("_hi"), frac.alias("_f"))
    near = hist.join(wanted, same(keys + ["_b"], names))
    order = Window.partitionBy(*keys, "_b", "p").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    cum = near.withColumn("_cum", F.sum("cnt").over(order) + F.col("_before"))

    def at(i: str):
        return F.max(F.when((F.col("_cum") - F.col("cnt") <= F.col(i)) & (F.col(i) < F.col("_cum")), F.col("value")))
    out = cum.groupBy(*keys, "p").agg(at("_lo").alias("_vl"), at("_hi").alias("_vh"),
                                      F.first("_f").alias("_f"), F.first("n").alias("n"))
    value = F.when(F.col("_f") == 0, F.col("_vl")).otherwise(
        F.col("_vl") + F.col("_f") * (F.col("_vh") - F.col("_vl")))
    return out.select(*keys, "p", value.alias("value"), "n")


def value_sketches(df: DataFrame, cols: list[str], by: list[str] | tuple = (), k: int = KLL_K) -> DataFrame:
    """(by..., column, n, sketch) of the non-NULL values: a mergeable KLL sketch for each group and column."""
    v = F.col("value")
    return (long_values(df, cols, by).groupBy(*by, "column")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.kll_sketch_agg_double(F.when(F.isnan(v), F.lit(float("inf"))).otherwise(v), k).alias("sketch")))


def _ranks(n: Column, p: Column, kind: str) -> tuple[Column, Column, Column]:
    """Zero-based ranks below and above a quantile, and the share of the way between them."""
    if kind == "linear":
        h = (n - 1) * p
        return F.floor(h).cast("bigint"), F.ceil(h).cast("bigint"), h - F.floor(h)
    if kind == "disc":
        at = F.greatest(F.ceil(n * p).cast("bigint") - 1, F.lit(0).cast("bigint"))
        return at, at, F.lit(0.0)
    raise ValueError(f"unknown quantile kind {kind!r}")


def brackets(sketches: DataFrame, probs: list[float], kind: str = "linear", keys: list[str] | tuple = ("column",)) -> DataFrame:
    """(keys..., p, n, _lo, _hi, _f, _a, _b): the ranks of each quantile and values that enclose them.

    Under ``KLL_WHOLE`` values one rank is more than a sketch's error: the bracket is the whole range."""
    slack = KLL_ERRORS * KLL_RANK_ERROR + 1.0 / KLL_WHOLE
    few = F.col("n") < KLL_WHOLE

    def value_at(share: float, end: float) -> Column:
        at = lambda x: F.kll_sketch_get_quantile_double("sketch", F.lit(float(min(max(x, 0.0), 1.0))))
        return F.when(few, at(end)).otherwise(at(share))
    each = [(F.lit(float(p)).alias("p"), value_at(p - slack, 0.0).alias("_a"), value_at(p + slack, 1.0).alias("_b")) for p in probs]
    t = sketches.select(*keys, "n", *each[0]) if len(each) == 1 else \
        sketches.select(*keys, "n", F.explode(F.array(*[F.struct(*e) for e in each])).alias("_q")).select(*keys, "n", "_q.*")
    lo, hi, f = _ranks(F.col("n"), F.col("p"), kind)
    last = F.when(F.col("_b") == float("inf"), F.lit(float("nan"))).otherwise(F.col("_b"))
    return t.select(*keys, "p", "n", lo.alias("_lo"), hi.alias("_hi"), f.alias("_f"), "_a", last.alias("_b"))


def values_at(df: DataFrame, cols: list[str], near: DataFrame, by: list[str] | tuple = (), few: bool = True) -> DataFrame:
    """(by..., column, p, n, _f, _vl, _vh, rank, below): the values at the ranks ``_lo`` and ``_hi`` of ``near``
    (see ``brackets``), exactly, the first rank, and how many values are smaller than the first.

    ``few``: the groups are known to be few (a century of days is 36,525 rows of some
    hundred bytes for each column; labels are three), so the brackets are broadcast and
    this pass shuffles counts only. With ``few=False`` the planner chooses.
    """
    keys = [*by, "column"]
    names = [f"_k{i}" for i in range(len(keys))]
    near = near.withColumnsRenamed(dict(zip(keys, names)))
    v = F.col("value")
    counted = (long_values(df, cols, by).join(F.broadcast(near) if few else near, same(keys, names))
               .where(v <= F.col("_b"))
               .groupBy(*keys, "p", "n", "_lo", "_hi", "_f", F.when(v >= F.col("_a"), v).alias("value"))
               .agg(F.count(F.lit(1)).alias("cnt")))  # NULL: all that lies under the bracket
    order = Window.partitionBy(*keys, "p").orderBy(F.col("value").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    cum = counted.withColumn("_cum", F.sum("cnt").over(order))

    def at(i: str, x: Column) -> Column:
        return F.max(F.when((F.col("_cum") - F.col("cnt") <= F.col(i)) & (F.col(i) < F.col("_cum")), x))

    def found(x: Column) -> Column:
        return F.coalesce(x, F.raise_error(F.lit("a rank lies outside its sketch's bracket; use exact_quantiles")).cast("double"))
    return cum.groupBy(*keys, "p").agg(
        F.first("n").alias("n"), F.first("_f").alias("_f"), F.first("_lo").alias("rank"),
        found(at("_lo", v)).alias("_vl"), found(at("_hi", v)).alias("_vh"),
        at("_lo", F.col("_cum") - F.col("cnt")).alias("below"))


def sketched_quantiles(df: DataFrame, cols: list[str], probs: list[float], by: list[str] | tuple = (),
                       kind: str = "linear", sketches: DataFrame | None = None, few: bool = True) -> DataFrame:
    """Rows (by..., column, p, value, n) like ``exact_quantiles``.

    ``sketches``: those of ``value_sketches`` for the same rows, where they are stored
    already. A bracket spans four times the sketch's error of 99 % confidence on either
    side; should a rank lie outside even so, the query fails rather than answer wrongly.
    """
    own = value_sketches(df, cols, by) if sketches is None else sketches
    out = values_at(df, cols, brackets(own, probs, kind, [*by, "column"]), by, few)
    value = F.when(F.col("_f") == 0, F.col("_vl")).otherwise(F.col("_vl") + F.col("_f") * (F.col("_vh") - F.col("_vl")))
    return out.select(*by, "column", "p", value.alias("value"), "n")


def quantile_wide(q: DataFrame, keys: list[str], names: dict[float, str]) -> DataFrame:
    """(keys..., <name per p>) from the long quantile table (small)."""
    aggs = [F.max(F.when(F.col("p") == F.lit(p), F.col("value"))).alias(n) for p, n in names.items()]
    return q.groupBy(*keys).agg(*aggs)
