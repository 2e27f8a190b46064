"""Best-fit-decreasing packing of documents into sequences, in bulk.

Documents of one length are interchangeable, and so are sequences with one gap:
both are ranked inside their class by Spark (a count for each class and slot,
offsets, then a row number inside each slot). A superstep takes a whole length
class, longest first: its successor sweep walks the gap classes from the
smallest that fits upwards, rank i of the documents takes rank i of the gaps (so
no two want the same gap), the gaps move to their new classes, and documents
left over open new sequences. That is best-fit decreasing, decision for
decision; only runs of equal gaps are moved, and there are at most ``capacity``
classes of either kind, so the sweep's state is bounded by the capacity and not
by the corpus. The rows themselves are then matched to the sweep's intervals by
class and rank.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retention.llm.common import groups_of, ids_and_text, stored, table, texts
from retention.llm.tokens import default_path, encoder

CAPACITY, END_ID = 4096, 1
BLOCK = 4_000_000

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every row's ids and the end id, cut only where longer than a sequence."""
    path, end = tokenizer or default_path(), np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            docs_, all_texts = b.column(0).to_pylist(), texts(b)
            for lo, hi in groups_of([len(t) for t in all_texts], BLOCK):
                rows = []
                for doc, ids in zip(docs_[lo:hi], enc.encode(all_texts[lo:hi])):
                    ids += end
                    for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at:at + 4 * capacity]
                        rows.append((doc, i, at // 4, len(part) // 4, zlib.crc32(part)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), *[pa.int64()] * 3))],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])
    return ids_and_text(docs).mapInArrow(run, PIECE)


@dataclass
class Sweep:
    """Where each rank of each length goes, and the gaps that are open."""

    capacity: int
    sequences: int = 0
    gaps: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    placed: dict[int, list[tuple[int, int, int, int]]] = field(default_factory=dict)

    def _fill(self, length: int, rank: int, left: int, gap: int, first: int, count: int) -> tuple[int, int]:
        """Puts up to ``left`` documents into ``count`` sequences with ``gap`` free; returns how many, and sequences used."""
        each = gap // length
        full = min(count, left // each)
        some = left - full * each if full < count else 0
        for seqs, per in ((full, each), (1 if some else 0, some)):
            if seqs:
                self.placed.setdefault(length, []).append((rank, first, per, self.capacity - gap))
                if gap - per * length:
                    self.gaps.setdefault(gap - per * length, []).append((first, seqs))
                rank, first = rank + seqs * per, first + seqs
        return full * each + some, full + bool(some)

    def superstep(self, length: int, n: int) -> None:
        """Places the ``n`` documents of one length; lengths come longest first."""
        rank = 0
        for gap in sorted(g for g in self.gaps if g >= length):
            runs = self.gaps.pop(gap)
            while runs and rank < n:
                first, count = runs.pop(0)
                took, used = self._fill(length, rank, n - rank, gap, first, count)
                rank += took
                if used < count:
                    runs.insert(0, (first + used, count - used))
            if runs:
                self.gaps.setdefault(gap, [])[:0] = runs
            if rank == n:
                return
        opened = -(-(n - rank) // (self.capacity // length))
        self._fill(length, rank, n - rank, self.capacity, self.sequences, opened)
        self.sequences += opened


def sweep(histogram: dict[int, int], capacity: int = CAPACITY) -> Sweep:
    out = Sweep(capacity)
    for length in sorted(histogram, reverse=True):
        out.superstep(length, histogram[length])
    return out


def _assign(plan: dict[int, list[tuple[int, int, int, int]]]):
    by_length = {k: [np.array(c, np.int64) for c in zip(*v)] for k, v in plan.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column("length").to_numpy()
            rank = b.column("rank").to_numpy()
            seq, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length).tolist():
                at = np.flatnonzero(length == n)
                ranks, first, per, begin = by_length[n]
                i = np.searchsorted(ranks, rank[at], "right") - 1
                step = rank[at] - ranks[i]
                seq[at] = first[i] + step // per[i]
                offset[at] = begin[i] + step % per[i] * n
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq), pa.array(offset)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (see ``pieces``) with sequence_id and offset: best-fit decreasing, gapless from 0.

    An empty table stays empty. Equal pieces and repeated rows are packed one by one.
    """
    spark = parts.sparkSession
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(parts.withColumn("row", F.monotonically_increasing_id())
                  .withColumn("slot", F.pmod(F.xxhash64("row"), F.lit(slots)).cast("int")), "pieces")
    counts = stored(rows.groupBy("length", "slot").agg(F.count("*").alias("n")), "counts")
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = F.sum("n").over(Window.partitionBy("length").orderBy("slot")) - F.col("n")
    bases = counts.select("length", "slot", before.alias("base"))
    in_slot = F.row_number().over(Window.partitionBy("length", "slot").orderBy("row")) - 1
    ranked = (rows.withColumn("in_slot", in_slot).join(bases, ["length", "slot"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("in_slot")).alias("rank")))
    return ranked.mapInArrow(_assign(sweep(total, capacity).placed), PIECE + ", sequence_id long, offset long")


def query(spark, sf_dir: str) -> DataFrame:
    return pack(pieces(table(spark, sf_dir, "documents")))
