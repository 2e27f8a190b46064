"""The corpus pipeline: five stages over ``documents``, each written and read again.

quality rules -> line dedup -> SimHash near-dedup -> benchmark decontamination
-> best-fit packing. Every stage works on all that its predecessor kept; all but
the last return the columns of ``documents``. The last returns the pieces of the
remaining documents with their sequence and place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retention.llm import decontaminate, line_templates, packing, quality_rules, simhash
from retention.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor a certified rule rejects."""
    return quality_rules.accept(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines whose template recurs elsewhere (the first stays)."""
    return line_templates.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, with sequence_id and offset."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("quality_rules", quality),
    ("line_templates", lines),
    ("simhash", near_duplicates),
    ("decontamination", benchmark),
    ("packing", pack),
]

#: Tokens, XXH64 and learned cutoffs are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
