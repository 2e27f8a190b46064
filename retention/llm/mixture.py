"""Mixing sources to target weights by entropy balancing.

Sources in code-point order share all tokens by weights that repeat; a target stops
at ``MOST`` times its source's tokens and the excess is shared again by weight.

Rates: of all rates r that meet the targets, those with the least relative entropy
to one copy a document, sum(r ln r - r), under r <= ``MOST``. Their dual has one
multiplier for each token constraint, and r = min(MOST, exp(multiplier * size)): the
document is tilted by what it adds to its constraint. The dual is convex; its
gradient (tokens taken less target) and second derivative are sums over documents,
added up by Spark in each Newton round. A step that leaves the interval which the
gradient's signs have left is replaced by its middle. The multipliers stay in a
table; the driver sees the largest violation of a constraint only. Documents of one
source and size have one rate, so rounds run over counts of (source, size).

Copies: floor(rate), and one more for some documents of each (source, size), so many
that the source's tokens follow the rates from the largest size down: each class
makes up for what the larger ones left over, so a source ends within about a small
document of its target. Which documents: those with the smallest hashes of doc_id.

Size: a source has at most sqrt(2 * tokens) distinct sizes, the rows that meet in
its task when copies are dealt out. Ranks in a class are taken in hash slots of about
``SLOT`` rows, so a class with a third of all rows is spread over many tasks.

Null text has size 0, a null source is a source of its own (the last), a null doc_id
is a document like any other. Repeated rows and ties each get a rate and copies of
their own; which of equal rows has the extra copy does not show. A document without
tokens keeps rate 1. Texts of any length are counted whole. An empty table gives no rows.
Other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retention.llm.common import stored, table, texts

#: Fixed values of the contract: weights and the largest number of copies.
WEIGHTS, MOST = (5, 2, 1), 3
SLOT, TOLERANCE, ROUNDS = 100_000, 1e-9, 200


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): words between ASCII white space, of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([len(t.split()) for t in texts(b)], pa.int64())],
                                             ["doc_id", "source", "size"])
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, source string, size long"))


def targets(classes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, docs, target) from (source, size, docs): docs are those with tokens."""
    sums = classes.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"),
                                         F.sum(F.when(F.col("size") > 0, F.col("docs")).otherwise(0)).alias("docs"))
    order = F.col("source").asc_nulls_last()
    rows = stored(sums.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources")
    # One row for each range: the only step that is not split.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("part").agg(F.count("*").alias("n"))
               .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    place = F.col("offset") + F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    rows = stored(rows.join(offsets, "part").select("source", "source_size", "docs", weight.alias("weight")), "weights")
    total, share = rows.agg(F.sum("source_size"), F.sum("weight")).first()
    unit, limit = (total or 0) / (share or 1), F.col("source_size") * most
    while True:  # each round at least one more source is full
        full = limit < F.col("weight") * F.lit(unit)
        used, share = rows.agg(F.coalesce(F.sum(F.when(full, limit)), F.lit(0)),
                               F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0))).first()
        more = ((total or 0) - used) / share if share else unit
        if more <= unit:
            break
        unit = more
    return rows.select("source", "source_size", "docs",
                       F.least(F.col("weight") * F.lit(unit), limit.cast("double")).alias("target"))


def multipliers(classes: DataFrame, goals: DataFrame, most: int = MOST, tolerance: float = TOLERANCE) -> DataFrame:
    """(source, source_size, target, scale, multiplier): the dual's solution; null where every rate is ``most``."""
    open_ = (F.col("source_size") > 0) & (F.col("target") < F.col("source_size") * most)
    state = goals.select("source", "source_size", "target", (F.col("source_size") / F.greatest("docs", F.lit(1))).alias("scale"),
                         F.when(open_, F.lit(0.0)).alias("multiplier"), F.lit(None).cast("double").alias("lo"),
                         F.lit(None).cast("double").alias("hi"))
    for _ in range(ROUNDS):
        tilt = rate(most)
        at = F.col("multiplier")
        sums = (classes.where("size > 0").join(state.where(at.isNotNull()).select(F.col("source").alias("of"), "scale", "multiplier"),
                                               F.col("source").eqNullSafe(F.col("of")))
                .groupBy("of").agg(_sum(F.col("docs") * F.col("size") * tilt).alias("taken"),
                                   _sum(F.when(tilt < most, F.col("docs") * F.col("size") * tilt * F.col("size") / F.col("scale"))
                                        .otherwise(0.0)).alias("slope")))
        now = state.join(sums, F.col("source").eqNullSafe(F.col("of")), "left")
        gap = F.col("taken") - F.col("target")
        lo, hi = F.when(gap < 0, at).otherwise(F.col("lo")), F.when(gap > 0, at).otherwise(F.col("hi"))
        newton = F.when(F.col("slope") > 0, at - gap / F.col("slope"))
        middle = F.when(lo.isNull(), hi * 2 - 1).when(hi.isNull(), lo * 2 + 1).otherwise((lo + hi) / 2)
        inside = newton.isNotNull() & (lo.isNull() | (newton > lo)) & (hi.isNull() | (newton < hi))
        met = at.isNull() | (F.abs(gap) <= F.col("target") * tolerance) | (lo.isNotNull() & hi.isNotNull() & ((middle == lo) | (middle == hi)))
        step = F.when(met, at).when(inside, newton).otherwise(middle)
        state = stored(now.select("source", "source_size", "target", "scale", step.alias("multiplier"), lo.alias("lo"), hi.alias("hi"),
                                  met.alias("met")), "multipliers")
        if not state.where("not met").limit(1).count():
            break
        state = state.drop("met")
    return state.select("source", "source_size", "target", "scale", "multiplier")


def _sum(x):
    """A sum that does not depend on the order of its rows, so that reruns agree to the last bit."""
    return F.sum(x.cast("decimal(38,12)")).cast("double")


def rate(most: int):
    """The tilted rate of a row with size, scale and multiplier."""
    x = F.col("multiplier") * F.col("size") / F.col("scale")
    return F.when(x >= math.log(most), F.lit(float(most))).otherwise(F.exp(x))


def _extras(source: tuple, rows: pa.Table) -> pa.Table:
    """How many documents of each size get one copy more, largest sizes first."""
    rows = rows.sort_by([("size", "descending")])
    out, left = [], 0.0
    for size, docs, r in zip(rows["size"].to_pylist(), rows["docs"].to_pylist(), rows["rate"].to_pylist()):
        want = docs * (r - math.floor(r))
        n = min(max(math.floor(want + (left / size if size else 0.0) + 0.5), 0), docs)
        left += (want - n) * size
        out.append(n)
    return rows.append_column("extra", pa.array(out, pa.int64()))


def copies(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, slot: int = SLOT) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies) of every row of ``docs`` (doc_id, source, text)."""
    rows = stored(sizes(docs), "sizes")
    classes = stored(rows.groupBy("source", "size").agg(F.count("*").alias("docs")), "classes")
    solved = multipliers(classes, targets(classes, weights, most), most)
    per_doc = F.when(F.col("multiplier").isNull(), F.when(F.col("size") > 0, F.lit(float(most))).otherwise(1.0)).otherwise(rate(most))
    rated = (classes.join(solved.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
             .select("source", "size", "docs", "source_size", "target", per_doc.alias("rate")))
    dealt = rated.groupBy("source").applyInArrow(
        _extras, "source string, size long, docs long, source_size long, target double, rate double, extra long")
    dealt = stored(dealt, "dealt").withColumnsRenamed({"source": "of", "size": "of_size"})
    slots = max(1, rows.count() // slot)
    placed = rows.withColumn("hash", F.xxhash64("doc_id")).withColumn("slot", F.pmod("hash", F.lit(slots)))
    same_class = F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("of_size"))
    counts = placed.groupBy("source", "size", "slot").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source", "size").orderBy("slot")) - F.col("n")
    quota = (counts.withColumn("before", before).join(dealt, same_class)
             .select("of", "of_size", F.col("slot").alias("of_slot"), "source_size", "target", "rate",
                     (F.col("extra") - F.col("before")).alias("quota")))
    rank = F.row_number().over(Window.partitionBy("source", "size", "slot").orderBy("hash", "doc_id"))
    return (placed.withColumn("rank", rank).join(quota, same_class & (F.col("slot") == F.col("of_slot")))
            .select("doc_id", "source", "size", "source_size", "target", "rate",
                    (F.floor("rate") + (F.col("rank") <= F.col("quota")).cast("long")).alias("copies")))


def query(spark, sf_dir: str) -> DataFrame:
    return copies(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "rate")
