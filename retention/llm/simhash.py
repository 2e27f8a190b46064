"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints differ in at most 2r bits exactly when some value lies within
r bits of both. So every distinct fingerprint emits all values within r bits,
equal values meet in a shuffle, and fingerprints that meet are linked after a
check of their distance. The ball is emitted in two factors: a shuffle row for
each way to flip up to r of the leading ``ROUTE_BITS`` (the route), and, where
the route meets, the flips that are left for the other bits. That sends 137
routes instead of 2081 variants for each fingerprint, 8 bytes each.

Fingerprints that share a variant are linked to the smallest of them, not pair
by pair: they are all within 2r bits of each other, so no component changes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.llm.common import groups_of, ids_and_text, shielded, stored, texts
from retention.llm.components import connected_components

SHINGLE, MAX_BITS, SEED = 4, 4, 42
ROUTE_BITS = 16
#: Variants expanded at a time in one task, and shingles hashed at a time.
BLOCK, SHINGLES_AT_A_TIME = 2_000_000, 200_000


def fingerprint_words(words: list[bytes], shingle: int = SHINGLE) -> bytes:
    """Concatenated big-endian XXH64 digests of the word shingles."""
    digest = xxhash.xxh64_digest
    if len(words) <= shingle:
        return digest(b" ".join(words), SEED) if words else b""
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1].tolist()
    stops = (ends[shingle - 1:] - 1).tolist()
    return b"".join([digest(line[s:t], SEED) for s, t in zip(starts, stops)])


def majority(digests: bytes) -> int:
    """The 64 majority bits of big-endian 8-byte hashes; 0 for none."""
    n = len(digests) // 8
    if not n:
        return 0
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, SHINGLES_AT_A_TIME):
        part = np.frombuffer(digests[lo * 8:(lo + SHINGLES_AT_A_TIME) * 8], np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp long) of every row. Null or wordless text: 0. Fewer
    words than a shingle: the whole sequence is the one shingle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [majority(fingerprint_words(t.lower().split(), shingle)) for t in texts(b)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fp, pa.int64())],
                                             ["doc_id", "text_hash", "fp"])
    return (ids_and_text(docs).withColumn("text_hash", F.xxhash64("text"))
            .mapInArrow(run, "doc_id long, text_hash long, fp long"))


def _flips(bits: int, most: int) -> list[np.ndarray]:
    """For each k up to ``most``: all masks of ``bits`` bits with k ones."""
    return [np.array([sum(1 << i for i in c) for c in combinations(range(bits), k)], np.uint64)
            for k in range(most + 1)]


def _routes(radius: int):
    """Packs fingerprints by each way to flip up to ``radius`` route bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = np.concatenate(_flips(ROUTE_BITS, radius))
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for lo, hi in groups_of([len(masks)] * len(fps), BLOCK):
                part = fps[lo:hi]
                key = ((part >> np.uint64(64 - ROUTE_BITS))[:, None] ^ masks).ravel().astype(np.int32)
                order = np.argsort(key, kind="stable")
                key, packed = key[order], np.repeat(part, len(masks))[order]
                first = np.flatnonzero(np.diff(key, prepend=-1))
                cuts = np.append(first, len(key)).astype(np.int32) * 8
                pack = pa.Array.from_buffers(pa.binary(), len(first),
                                             [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(packed.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(key[first], pa.int32()), pack], ["route", "pack"])
    return run


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(root, node) of each node but the roots: the same components with fewer edges."""
    nodes, idx = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = idx[: len(a)], idx[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[label[moved]], nodes[moved]


def _ball(bits: int, radius: int) -> np.ndarray:
    """How many variants a fingerprint has left after 0, 1, ... flips in its first ``bits`` bits."""
    return np.array([sum(comb(64 - bits, j) for j in range(radius + 1 - k)) for k in range(radius + 1)])


def _expand(prefix: np.ndarray, fps: np.ndarray, bits: int, radius: int, max_bits: int):
    """Links (smaller, larger) of fingerprints that share a variant whose first ``bits`` bits are ``prefix``.

    More variants than a block holds: the next four bits are routed the same way first.
    """
    used = np.bitwise_count((fps >> np.uint64(64 - bits)) ^ prefix)
    if _ball(bits, radius)[used].sum() > 4 * BLOCK and bits <= 56 and len(np.unique(fps)) > 1:
        parts = []
        for x in range(16):
            longer = (prefix << np.uint64(4)) | np.uint64(x)
            near = np.bitwise_count((fps >> np.uint64(60 - bits)) ^ longer) <= radius
            if near.any():
                parts.append(_expand(longer[near], fps[near], bits + 4, radius, max_bits))
        return np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts])
    rest = _flips(64 - bits, radius)
    low = fps & np.uint64((1 << (64 - bits)) - 1)
    variants, owner = [], []
    for k in range(radius + 1):
        at = np.flatnonzero(used == k)
        masks = np.concatenate(rest[: radius + 1 - k])
        variants.append((((prefix[at] << np.uint64(64 - bits)) | low[at])[:, None] ^ masks).ravel())
        owner.append(np.repeat(at, len(masks)))
    v, own = np.concatenate(variants), np.concatenate(owner)
    order = np.argsort(v)
    v, f = v[order], fps[own[order]]
    first = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
    size = np.diff(np.append(first, len(v)))
    many = np.repeat(size > 1, size)
    f, size = f[many], size[size > 1]
    if not len(size):
        return f, f
    head = np.repeat(np.minimum.reduceat(f, np.append(0, np.cumsum(size)[:-1])), size)
    ok = (head != f) & (np.bitwise_count(head ^ f) <= max_bits)
    pairs = np.unique(np.stack([head[ok], f[ok]], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _meet(radius: int, max_bits: int):
    """Expands the rest of the ball route by route and links what meets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ball = _ball(ROUTE_BITS, radius)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        routes: list[np.ndarray] = []
        packs: list[np.ndarray] = []
        pending, last = 0, None

        def flush():
            nonlocal pending
            if routes:
                r, f = np.concatenate(routes), np.concatenate(packs)
                routes.clear()
                packs.clear()
                pending = 0
                found.append(_expand(r, f, ROUTE_BITS, radius, max_bits))
                if sum(len(x) for x, _ in found) > BLOCK:
                    merged = local_forest(np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]))
                    found[:] = [merged]

        for batch in batches:
            for route, pack in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if route != last and pending > BLOCK:
                    flush()
                last = route
                f = np.frombuffer(pack, np.uint64)
                r = np.full(len(f), route, np.uint64)
                pending += int(ball[np.bitwise_count((f >> np.uint64(64 - ROUTE_BITS)) ^ r)].sum())
                routes.append(r)
                packs.append(f)
        flush()
        if found:
            a, b = local_forest(np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]))
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])
    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) that connect the distinct values of ``fp`` at ``max_bits`` or fewer differing bits."""
    radius = (max_bits + 1) // 2
    routes = fps.select("fp").distinct().mapInArrow(_routes(radius), "route int, pack binary")
    return (routes.repartition("route").sortWithinPartitions("route")
            .mapInArrow(_meet(radius, max_bits), "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) for every row of ``docs`` (doc_id, text, any others).

    root is the component's smallest fingerprint, component_id the smallest
    doc_id reachable over links. A null doc_id takes part but names no component
    that has another; a component of nulls alone has a null id. Repeated rows repeat.
    """
    fps = stored(fingerprints(docs, shingle), "fingerprints")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("first_doc"))
    roots = connected_components(links(fps, max_bits)).select(F.col("node").alias("fp"), "root")
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    of_fp = rooted.join(named, "root").select("fp", "root", "component_id")
    return fps.join(of_fp, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` for each component: that of its smallest doc_id (null last), then text hash.

    Columns keep their names, whatever these are; an empty table stays empty; texts of any
    length are fingerprinted whole.
    """
    docs, back = shielded(docs, "doc_id", "text")
    found = near_duplicates(docs, shingle, max_bits)
    heads = (found.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("h"))
        .select("h.doc_id", "h.text_hash"))
    rows = (found.groupBy("doc_id", "text_hash").agg(F.count("*").alias("__rows"))
            .withColumnsRenamed({"doc_id": "d", "text_hash": "t"}))
    same = heads["doc_id"].eqNullSafe(rows["d"]) & heads["text_hash"].eqNullSafe(rows["t"])
    heads = stored(heads.join(rows, same).select(F.col("d").alias("__id"), F.col("t").alias("__hash"), "__rows"), "heads")
    kept = docs.join(heads, F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))
                     & F.xxhash64(F.col("text").cast("string")).eqNullSafe(F.col("__hash")))
    once = kept.where("__rows = 1").select(*back)
    # Rows that repeat the chosen one in full are the only ones left to thin out.
    return once.unionByName(kept.where("__rows > 1").dropDuplicates(["__id", "__hash"]).select(*back))


def query(spark, sf_dir: str) -> DataFrame:
    from retention.llm.common import table
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
