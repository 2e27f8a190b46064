"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.llm.common import stored


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m"))
    return (both.join(low, "a").where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    rest = e.join(low, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(low.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is its component's smallest node.

    Each round rewrites the edge table in the shared folder; rounds end when it
    no longer changes, which takes about the logarithm of the longest chain.
    Loops and repeated edges are allowed; an empty table gives an empty result.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .distinct(), "edges")
    before = None
    while True:
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before or not state["n"]:
            break
        before = state
        e = stored(_small_star(_large_star(e)), "edges")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
