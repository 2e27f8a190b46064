"""Removal of repeated byte strings with run-length indexes.

Every byte goes that lies in a string of ``LENGTH`` bytes which also starts
somewhere else. One index of the whole corpus cannot be built in one place, so
texts are routed by content first, exactly:

1. Of every ``LENGTH`` bytes the run of ``KGRAM`` bytes with the smallest hash is
   an anchor (the last of equals), so equal strings have equal anchors at equal
   places. An anchor's context is what any such string around it can cover.
   Contexts are counted by anchor and digest; equal contexts are kept once.
2. A context that occurs twice is repeated as a whole. An anchor with different
   contexts goes to an index: contexts of anchors that share documents are
   routed together, as disjoint pieces of their documents.
3. The contexts of an anchor that has more than ``CROWD`` different ones become
   documents of their own, cut to the strings whose anchor it is (so that no
   string is in two of them), and go through the same steps with longer anchors:
   what they share inside a common passage becomes equal contexts, kept once. The
   last anchors are the strings themselves, of which no group can be left.
4. A route holds about ``INDEX_BYTES`` of pieces at most (or one group of 3). A task
   builds run-length indexes (``run_index``) over one or more routes, streams
   matching statistics, and reports for each context the strings inside it that
   have a match.
5. What was found for a context holds wherever it occurs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.llm.common import groups_of, ids_and_text, stored, table, texts
from retention.llm.run_index import RunIndex

LENGTH, KGRAM = 200, 64
CROWD, INDEX_BYTES = 1_000, 1_500_000
#: Lengths of anchors for crowds, one after the other; then the whole string.
LONGER = (160, 192)
#: Bytes hashed, indexed and handed over at a time: the first two fit a core's cache.
BLOCK, BATCH_BYTES, SCAN_BYTES = 1 << 16, 200_000, 8_000_000
_POSITION_BITS = np.uint64(22)
_MASK = np.uint64((1 << 22) - 1)


def _byte_numbers() -> np.ndarray:
    x = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def run_hashes(buf: bytes, k: int) -> np.ndarray:
    """64-bit hash of the ``k`` bytes from each position on, from runs of 1, 2, 4 ... bytes."""
    h, m, out, done = _byte_numbers()[np.frombuffer(buf, np.uint8)], 1, None, 0
    n = len(h) - k + 1
    if n < 1:
        return h[:0]
    while True:
        if k & m:
            part = h[done:done + n]
            out = part if out is None else out * np.uint64(0x9E3779B97F4A7C15) + part
            done += m
        if 2 * m > k:
            return out
        h = h[:-m] * np.uint64(2 * m * 0x632BE59BD9B4E019 % (1 << 64) | 1) + h[m:]
        m *= 2


def _rightmost_minima(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest hash among the ``width`` from each position on; the last of equals."""
    mixed = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x, m = (mixed & ~_MASK) | (_MASK - np.arange(len(h), dtype=np.uint64)), 1
    while 2 * m <= width:
        x = np.minimum(x[:-m], x[m:])
        m *= 2
    if width > m:
        x = np.minimum(x[:len(x) - (width - m)], x[width - m:])
    return (_MASK - (x & _MASK)).astype(np.int64)


def anchors(docs: list[bytes], length: int = LENGTH, k: int = KGRAM, block: int = BLOCK) -> list[tuple[list[int], list[int]]]:
    """(positions, hashes) of each document's anchors, ascending. Long documents go in overlapping segments."""
    segments = [(d, s, min(s + block + length - 1, len(t))) for d, t in enumerate(docs)
                for s in range(0, max(len(t) - length + 1, 0), block)]
    out: list[tuple[list[int], list[int]]] = [([], []) for _ in docs]
    for lo, hi in groups_of([e - s for _, s, e in segments], block):
        some = segments[lo:hi]
        ends = np.cumsum([e - s for _, s, e in some])
        h = run_hashes(b"".join([docs[d][s:e] for d, s, e in some]), k)
        at = _rightmost_minima(h, length - k + 1)
        owner = np.searchsorted(ends, np.arange(len(at)), "right")
        at, owner = at[(fits := np.arange(len(at)) + length <= ends[owner])], owner[fits]
        new = np.append(True, (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])) if len(at) else np.zeros(0, bool)
        at, owner = at[new], owner[new]
        begin = ends - [e - s for _, s, e in some]
        cuts = np.searchsorted(owner, np.arange(len(some) + 1)).tolist()
        hashes = h[at].view(np.int64).tolist()
        for i, (d, s, _) in enumerate(some):
            pos = (at[cuts[i]:cuts[i + 1]] - begin[i] + s).tolist()
            mine = hashes[cuts[i]:cuts[i + 1]]
            skip = 1 if out[d][0] and pos and out[d][0][-1] == pos[0] else 0
            out[d][0].extend(pos[skip:])
            out[d][1].extend(mine[skip:])
    return out


def _scan(length: int, k: int, block: int):
    """Per document its size, digest and anchors with their contexts' digests."""
    left, kind = length - k, [("pos", pa.int32()), ("a", pa.int64()), ("c", pa.int64())]
    digest = xxhash.xxh3_64_intdigest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            all_texts = texts(b)
            for lo, hi in groups_of([len(t) for t in all_texts], SCAN_BYTES):
                docs = all_texts[lo:hi]
                pos, a, c, n = [], [], [], [0]
                for t, (p, h) in zip(docs, anchors(docs, length, k, block)):
                    pos += p
                    a += h
                    c += [digest(t[max(0, x - left):x + length], min(x, left)) for x in p]
                    n.append(len(pos))
                flat = pa.StructArray.from_arrays(
                    [pa.array(pos, pa.int32()), pa.array(a, pa.int64()), pa.array(np.array(c, np.uint64).view(np.int64))],
                    fields=[pa.field(*x) for x in kind])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[lo:hi], b.column(2)[lo:hi], pa.array([len(t) for t in docs], pa.int32()),
                     pa.array([hashlib.sha256(t).hexdigest() for t in docs]), pa.ListArray.from_arrays(pa.array(n, pa.int32()), flat)],
                    ["doc_id", "text_hash", "n_bytes", "sha256", "anchors"])
    return run


ROWS = "doc_id long, text_hash long, n_bytes int, sha256 string, anchors array<struct<pos:int,a:bigint,c:bigint>>"


def _same_row(docs: DataFrame, keys: DataFrame):
    return docs["doc_id"].eqNullSafe(keys["__id"]) & docs["text_hash"].eqNullSafe(keys["__hash"])


def _owned(length: int, k: int):
    """From (a, c, pos, text): the part of the text whose strings have their anchor at ``pos``, and where
    that part begins, as an offset from the anchor."""
    left = length - k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for a, c, pos, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), texts(b)):
                s = max(0, pos - left)
                ctx = t[s:pos + length]
                own = np.flatnonzero(_rightmost_minima(run_hashes(ctx, k), left + 1) == pos - s)
                out.append((a, c, int(own[0]) + s - pos, ctx[own[0]:own[-1] + length]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                    ["a", "c", "at", "text"])
    return run


def _union(frames: list[DataFrame]) -> DataFrame | None:
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out


def _pieces(length: int, k: int):
    """From (rep, units, text) of a document: for each route the disjoint pieces that its contexts cover."""
    left = length - k
    unit = pa.struct([("a", pa.int64()), ("c", pa.int64()), ("pos", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for rep, units, t in zip(b.column("rep").to_pylist(), b.column("units").to_pylist(), texts(b)):
                routes: dict[tuple[int, int], dict[int, dict]] = {}
                for u in units:
                    routes.setdefault((u["home"], u["part"]), {})[u["pos"]] = {"a": u["a"], "c": u["c"], "pos": u["pos"]}
                for (home, part), mine in routes.items():
                    at, end, held = None, None, []
                    for p in sorted(mine):
                        s, e = max(0, p - left), min(len(t), p + length)
                        if at is not None and s > end:
                            out.append((home, part, rep, at, t[at:end], held))
                            at, held = None, []
                        at, end = (s if at is None else at), e
                        held.append(mine[p])
                    out.append((home, part, rep, at, t[at:end], held))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(),
                                                                pa.list_(unit)))],
                    ["home", "part", "rep", "at", "piece", "units"])
    return run


def _indexed(length: int, k: int):
    """Step 4: marks (a, c, s, e), offsets from the anchor, of rows sorted by (home, part)."""
    left = length - k

    def marks(rows: list[tuple]) -> list[tuple[int, int, int, int]]:
        merged: list[list] = []  # [rep, at, bytes]; pieces of one document that overlap become one
        units: list[tuple[int, int, int, int]] = []
        for rep, at, piece, mine in sorted(rows, key=lambda r: (r[0], r[1])):
            if merged and merged[-1][0] == rep and at <= merged[-1][1] + len(merged[-1][2]):
                merged[-1][2] += piece[merged[-1][1] + len(merged[-1][2]) - at:]
            else:
                merged.append([rep, at, piece])
            units += [(u["a"], u["c"], u["pos"], len(merged) - 1) for u in mine]
        index = RunIndex([m[2] for m in merged])
        long = np.concatenate(([0], np.cumsum(index.matching_statistics() >= length)))
        out = set()
        for a, c, pos, m in units:
            at, size = merged[m][1], len(merged[m][2])
            s, e = max(at, pos - left), min(at + size, pos + length)
            base = int(index.begin[m]) - at
            first, last = base + s, base + e - length
            if last >= first and long[last + 1] > long[first]:
                hit = np.flatnonzero(long[first + 1:last + 2] > long[first:last + 1])
                for g in np.split(hit, np.flatnonzero(np.diff(hit) > length) + 1):
                    out.add((a, c, int(g[0]) + s - pos, int(g[-1]) + s - pos + length))
        return list(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None

        def flush():
            found = marks(held)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*found) if found else [[]] * 4, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                ["a", "c", "s", "e"])
        for b in batches:
            for home, part, rep, at, piece, units in zip(*[b.column(i).to_pylist() for i in range(6)]):
                if size > BATCH_BYTES and (home, part) != last:
                    yield flush()
                    size = 0
                last = (home, part)
                held.append((rep, at, piece, units))
                size += len(piece)
        if held:
            yield flush()
    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, n_removed, n_spans, sha256, spans) of texts and the spans to remove."""
    for b in batches:
        out = []
        for row, spans, t in zip(b.column("row").to_pylist(), b.column("found").to_pylist(), texts(b)):
            merged: list[list[int]] = []
            for s, e in sorted((x["s"], x["e"]) for x in spans):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            edges = [0, *[x for m in merged for x in m], len(t)]
            kept = b"".join(t[s:e] for s, e in zip(edges[0::2], edges[1::2]))
            out.append((row, len(t) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(),
                        [{"start": s, "stop": e} for s, e in merged]))
        if not out:
            continue
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string(),
                                                        pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))))],
            ["row", "n_removed", "n_spans", "kept_sha256", "spans"])


def _found(rows: DataFrame, with_text, length: int, ladder: list[int], crowd: int, index_bytes: int, block: int) -> DataFrame:
    """(row, s, e): repeated strings of stored ``rows`` (row, n_bytes, anchors). ``ladder``: the length of
    their anchors and those for crowds; ``with_text``: adds ``text`` to rows by their column ``rep``."""
    k = ladder[0]
    each = rows.select("row", "n_bytes", F.inline("anchors"))
    contexts = each.groupBy("a", "c").agg(F.count("*").alias("n"), F.first("row").alias("rep"),
                                          F.first("pos").alias("pos"), F.first("n_bytes").alias("n_bytes"))
    several = contexts.groupBy("a").agg(F.count("*").alias("n_ctx")).where("n_ctx > 1")
    contexts = stored(contexts.join(several, "a", "left").where("n > 1 or n_ctx is not null")
                      .withColumn("n_ctx", F.coalesce("n_ctx", F.lit(1))), "contexts")
    reach_l, reach_r = F.least(F.col("pos"), F.lit(length - k)), F.least(F.col("n_bytes") - F.col("pos"), F.lit(length))
    marks = [contexts.where("n > 1").select("a", "c", (-reach_l).alias("s"), reach_r.alias("e"))]

    units = contexts.where("n_ctx > 1")
    crowded = units.where(F.col("n_ctx") > crowd).select("a", "c", "pos", "rep")
    if len(ladder) > 1 and not crowded.isEmpty():
        units = units.where(F.col("n_ctx") <= crowd)
        part = stored(with_text(crowded).select("a", "c", "pos", "text").mapInArrow(
            _owned(length, k), "a long, c long, at int, text binary").dropDuplicates(["a", "c"])
            .withColumn("row", F.monotonically_increasing_id()), "crowd")
        small = stored(part.select(F.col("row").alias("doc_id"), "text", F.col("row").alias("text_hash"))
                       .mapInArrow(_scan(length, ladder[1], block), ROWS)
                       .select(F.col("doc_id").alias("row"), "n_bytes", "anchors"), "crowd_rows")
        text_of = part.select(F.col("row").alias("rep"), "text")
        inner = _found(small, lambda df: df.join(text_of, "rep"), length, ladder[1:], crowd, index_bytes, block)
        marks.append(inner.join(part.select("row", "a", "c", "at"), "row")
                     .select("a", "c", (F.col("at") + F.col("s")).alias("s"), (F.col("at") + F.col("e")).alias("e")))

    units = units.select(F.col("a").alias("key"), "a", "c", "rep", "pos")
    label = units.groupBy("rep").agg(F.min("key").alias("label"))
    home = units.join(label, "rep").groupBy("key").agg(F.min("label").alias("home"))
    homed = stored(units.join(home, "key"), "units")
    parts = homed.groupBy("home").agg(
        F.greatest(F.lit(1), F.ceil(F.count("*") * F.lit(2.0 * (length - k)) / index_bytes)).cast("int").alias("parts"))
    routed = homed.join(parts, "home").select("rep", F.struct(
        "home", F.pmod(F.xxhash64("key"), "parts").cast("int").alias("part"), "a", "c", "pos").alias("u"))
    by_doc = routed.groupBy("rep").agg(F.collect_set("u").alias("units"))
    placed = with_text(by_doc).select("rep", "units", "text").mapInArrow(
        _pieces(length, k), "home long, part int, rep long, at int, piece binary, units array<struct<a:bigint,c:bigint,pos:int>>")
    marks.append(placed.repartition("home", "part").sortWithinPartitions("home", "part", "rep", "at")
                 .mapInArrow(_indexed(length, k), "a long, c long, s int, e int"))

    of_context = stored(_union(marks).groupBy("a", "c").agg(F.collect_set(F.struct("s", "e")).alias("m")), "marks")
    return (each.select("row", "pos", "a", "c").join(of_context, ["a", "c"])
            .select("row", "pos", F.inline("m")).select("row", (F.col("pos") + F.col("s")).alias("s"), (F.col("pos") + F.col("e")).alias("e")))


def repeated_strings(docs: DataFrame, length: int = LENGTH, k: int = KGRAM, crowd: int = CROWD,
                     index_bytes: int = INDEX_BYTES, block: int = BLOCK, longer: tuple[int, ...] = LONGER) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) for each row of ``docs``.

    Null text is empty; texts under ``length`` bytes lose nothing. Repeated rows
    are each other's match, so all of them lose what is long enough.
    """
    keyed = ids_and_text(docs).withColumn("text_hash", F.xxhash64("text"))
    rows = stored(keyed.mapInArrow(_scan(length, k, block), ROWS).withColumn("row", F.monotonically_increasing_id()), "rows")
    key_of = rows.select("row", F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    once = keyed.dropDuplicates(["doc_id", "text_hash"]) if _has_repeats(rows) else keyed

    def with_text(df: DataFrame, row: str = "rep") -> DataFrame:
        keys = df.join(key_of.withColumnRenamed("row", row), row)
        return once.join(keys, _same_row(once, keys))
    found = _found(rows.select("row", "n_bytes", "anchors"), with_text, length, [k, *longer, length], crowd, index_bytes, block)
    spans = found.groupBy("row").agg(F.collect_list(F.struct("s", "e")).alias("found"))
    done = (with_text(spans, "row").select("row", "found", "text")
            .mapInArrow(_cut, "row long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,stop:int>>"))
    return rows.select("row", "doc_id", "n_bytes", "sha256").join(done, "row", "left").select(
        "doc_id", F.col("n_bytes").cast("long").alias("n_bytes"), F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,stop:int>>")).alias("spans"))


def _has_repeats(rows: DataFrame) -> bool:
    return not rows.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty()


def query(spark, sf_dir: str) -> DataFrame:
    return repeated_strings(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
