"""Substring deduplication by content-defined chunks.

A gear hash rolls over each whole text: every byte shifts the hash left by one
and adds that byte's number, so its 16 bits depend on the last 16 bytes only. A
chunk ends where the hash's leading bits are zero, at least ``MIN_CHUNK`` and at
most ``MAX_CHUNK`` bytes after it began; text that is inserted or removed moves
the cuts near it and no others. Chunks are compared by 128-bit digest over the
whole corpus. The first document (smallest doc_id) that has a chunk keeps it;
later ones lose it where such chunks in a row reach ``MIN_RUN`` bytes or make up
the whole document, so a phrase that recurs by chance stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.llm.common import groups_of, ids_and_text, stored, table, texts

CUT_BITS, MIN_CHUNK, MAX_CHUNK, MIN_RUN = 4, 24, 512, 120
BLOCK = 4_000_000


def gear_numbers() -> np.ndarray:
    """One 16-bit number for each byte value, from a multiplicative hash of it."""
    x = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(40)).astype(np.uint16)


def gear_hash(text: bytes) -> np.ndarray:
    """The rolling hash after each byte: h = 2h + gear[byte], 16 bits, by doubling the window."""
    h = gear_numbers()[np.frombuffer(text, np.uint8)]
    for step in (1, 2, 4, 8):
        older = h[:-step] << np.uint16(step) if step < len(h) else h[:0]
        h = np.concatenate([h[:step], h[step:] + older])
    return h


def cuts(candidates: list[int], size: int) -> list[int]:
    """Chunk starts and the end, from the positions after which the hash allows a cut."""
    out, start = [0], 0
    for at in [*candidates, size]:
        while at - start > MAX_CHUNK:
            start += MAX_CHUNK
            out.append(start)
        if at - start >= MIN_CHUNK and at < size:
            out.append(at)
            start = at
    if out[-1] != size:
        out.append(size)
    return out


def chunks_of(text: bytes) -> list[int]:
    at = np.flatnonzero(gear_hash(text) >> np.uint16(16 - CUT_BITS) == 0) + 1
    return cuts(at.tolist(), len(text))


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its size and the first chunk of each digest in it, plus the later ones as repeats."""
    digest = xxhash.xxh3_128_digest
    kind = [("start", pa.int32()), ("stop", pa.int32()), ("d1", pa.int64()), ("d2", pa.int64())]
    for b in batches:
        all_texts = texts(b)
        for lo, hi in groups_of([len(t) for t in all_texts], BLOCK):
            starts, stops, digests, sizes, repeats = [], [], [], [], []
            for t in all_texts[lo:hi]:
                c = chunks_of(t) if t else [0]
                seen: dict[bytes, int] = {}
                again = []
                for s, e in zip(c, c[1:]):
                    d = digest(t[s:e])
                    if d in seen:
                        again.append({"start": s, "stop": e})
                    else:
                        seen[d] = s
                        starts.append(s)
                        stops.append(e)
                        digests.append(d)
                sizes.append(len(seen))
                repeats.append(again)
            d = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            flat = pa.StructArray.from_arrays([pa.array(starts, pa.int32()), pa.array(stops, pa.int32()),
                                               pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy())],
                                              fields=[pa.field(n, t) for n, t in kind])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays(
                [b.column(0)[lo:hi], pa.array([len(t) for t in all_texts[lo:hi]], pa.int64()), lists,
                 pa.array(repeats, pa.list_(pa.struct(kind[:2])))], ["doc_id", "n_bytes", "chunks", "repeats"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins neighbouring chunks to spans and keeps the spans that are long enough."""
    for b in batches:
        out = []
        for size, found in zip(b.column("n_bytes").to_pylist(), b.column("found").to_pylist()):
            spans: list[list[int]] = []
            for s, e in sorted((x["start"], x["stop"]) for x in found):
                if spans and spans[-1][1] == s:
                    spans[-1][1] = e
                else:
                    spans.append([s, e])
            out.append([{"start": s, "stop": e} for s, e in spans if e - s >= MIN_RUN or e - s == size])
        yield pa.RecordBatch.from_arrays(
            [b.column("row"), pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))],
            ["row", "spans"])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_chunks, spans array<start, stop>) per row of ``docs``: bytes to remove.

    Null and empty text: no chunk. Rows that share a doc_id count as one
    document, as do rows without one (they come last). A chunk that recurs inside
    its document is kept once there, too.
    """
    schema = ("doc_id long, n_bytes long, chunks array<struct<start:int,stop:int,d1:bigint,d2:bigint>>, "
              "repeats array<struct<start:int,stop:int>>")
    rows = stored(ids_and_text(docs).mapInArrow(_chunked, schema).withColumn("row", F.monotonically_increasing_id()), "chunks")
    last = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    each = rows.select("row", last.alias("doc"), "n_bytes", F.inline("chunks"))
    first = (each.groupBy("d1", "d2").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
             .where("first < last").select("d1", "d2", "first"))
    later = each.join(first, ["d1", "d2"]).where("doc > first").select("row", "n_bytes", "start", "stop")
    inside = rows.where(F.size("repeats") > 0).select("row", "n_bytes", F.inline("repeats"))
    found = later.unionByName(inside).groupBy("row").agg(
        F.first("n_bytes").alias("n_bytes"), F.collect_list(F.struct("start", "stop")).alias("found"))
    spans = found.mapInArrow(_runs, "row long, spans array<struct<start:int,stop:int>>")
    return (rows.select("row", "doc_id", "n_bytes", (F.size("chunks") + F.size("repeats")).cast("long").alias("n_chunks"))
            .join(spans, "row", "left").select("doc_id", "n_bytes", "n_chunks", F.coalesce(
                "spans", F.array().cast("array<struct<start:int,stop:int>>")).alias("spans")))


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without ``spans`` (sorted, disjoint byte ranges)."""
    edges = [0, *[x for s in spans for x in s], len(text)]
    return b"".join(text[s:e] for s, e in zip(edges[0::2], edges[1::2]))


def query(spark, sf_dir: str) -> DataFrame:
    found = repeated_spans(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"])
    return found.select("doc_id", "n_bytes", "n_chunks", F.size("spans").cast("long").alias("n_spans"),
                        removed.alias("n_removed"), "spans")
