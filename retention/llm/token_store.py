"""Token ids as Parquet list columns, for selective reads.

Format, one folder:

* ``tokens/``: one row for each document in ascending doc_id order: ``doc_id``,
  ``part`` (number of the file's range), ``part_start`` (ids before it in that
  part), ``n_tokens``, ``ids`` (list of int). Parquet's dictionary encoding holds
  an id in as many bits as the row group needs; where the dictionary would grow
  past its page, the v2 writer falls back to delta encoding. Row groups and pages
  have set sizes and Parquet writes its column and offset indexes, so a reader
  that asks for some doc_ids skips row groups and pages by their bounds, and one
  that asks for metadata reads no ids.
* ``parts/``: ``part``, ``part_base`` (ids in all parts before it), ``n_tokens``.

The order comes from a range partitioning of the texts; ids are made after it,
so the shuffle carries text once and the sorted rows go straight into the files.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retention.llm.common import groups_of, ids_and_text, table, texts
from retention.llm.tokens import default_path, encoder
from retention.session import checkpoint_dir

END_ID = 2
BLOCK = 1_000_000
ROW_GROUP_BYTES, PAGE_BYTES, DICTIONARY_BYTES = 32 << 20, 256 << 10, 1 << 20

SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end, part, before = encoder(path), np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId(), 0
        for b in batches:
            lengths = pc.fill_null(pc.binary_length(b.column(1)), 0).to_pylist()
            for lo, hi in groups_of(lengths, BLOCK):  # only a block's texts are copied out of the batch
                ids = [x + end for x in enc.encode(texts(b.slice(lo, hi - lo)))]
                sizes = np.array([len(x) // 4 for x in ids], np.int64)
                ends = np.concatenate(([0], np.cumsum(sizes)))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                                 pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[lo:hi], pa.array(np.full(hi - lo, part, np.int32)), pa.array(before + ends[:-1]),
                     pa.array(sizes), lists], ["doc_id", "part", "part_start", "n_tokens", "ids"])
                before += int(ends[-1])
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Writes the format above for ``docs`` (doc_id, text, any others).

    Null text is empty: the end id alone. Null doc_ids come first. Repeated rows
    each get their own; an empty table gives empty folders that can be read.
    """
    ordered = ids_and_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    (ordered.mapInArrow(_encode(tokenizer or default_path(), end_id), SCHEMA)
     .write.option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
     .option("parquet.dictionary.page.size", DICTIONARY_BYTES).option("parquet.enable.dictionary", "true")
     .option("parquet.writer.version", "PARQUET_2_0").parquet(f"{path}/tokens"))
    spark = docs.sparkSession
    sizes = read_part(spark, f"{path}/tokens").groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    # One row for each written file: the only step that is not split.
    base = F.coalesce(F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes.select("part", base.cast("long").alias("part_base"), "n_tokens").write.parquet(f"{path}/parts")


def read_part(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def read_tokens(spark: SparkSession, path: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of documents with lo <= doc_id <= hi; the bounds are
    pushed into the scan, and only columns that are asked for are read."""
    rows = read_part(spark, f"{path}/tokens")
    if lo is not None:
        rows = rows.where(F.col("doc_id") >= lo)
    if hi is not None:
        rows = rows.where(F.col("doc_id") <= hi)
    parts = spark.read.schema("part int, part_base long, n_tokens long").parquet(f"{path}/parts").drop("n_tokens")
    return rows.join(parts, "part").select("doc_id", (F.col("part_base") + F.col("part_start")).alias("start"),
                                           "n_tokens", "ids")


def checksums(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows from ``read_tokens``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(3)
            ends, flat = ids.offsets.to_numpy(), memoryview(ids.values.to_numpy().astype("<i4", copy=False)).cast("B")
            crc = [zlib.crc32(flat[4 * s:4 * e]) for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(crc, pa.int64())],
                                             ["doc_id", "start", "n_tokens", "ids_crc32"])
    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    write_tokens(table(spark, sf_dir, "documents"), path)
    return checksums(read_tokens(spark, path))
