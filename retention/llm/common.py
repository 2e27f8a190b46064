"""Small helpers shared by the operators: tables, stored intermediates, bytes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retention.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Cuts the lineage at a copy that every executor can read, so a lost executor
    never makes the steps before it run again, and a step that is read several
    times runs once. Each call has a folder of its own.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    col = batch.column(batch.schema.get_field_index(name))
    return [b"" if v is None else v for v in col.cast(pa.large_binary()).to_pylist()]


def groups_of(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to about ``limit`` (one item at least)."""
    lo = total = 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > limit:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def columns_of(df: DataFrame) -> list[Column]:
    """All columns of ``df`` by their exact names, dots and all."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def ids_and_text(docs: DataFrame) -> DataFrame:
    """The two columns most operators read; other columns never reach them."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def shielded(docs: DataFrame, *used: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with every column but ``used`` under a name that no operator uses, and the columns that
    give the result its own names back: whatever a user's columns are called, none can clash."""
    names = {c: f"__in_{i}" for i, c in enumerate(docs.columns)}
    safe = docs.toDF(*[c if c in used else names[c] for c in docs.columns])
    return safe, [F.col(c if c in used else names[c]).alias(c) for c in docs.columns]
