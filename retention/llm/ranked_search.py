"""Ranked lexical search over K2-treaps of the grid of terms and documents.

Index, one Parquet row for each block of documents (about ``BLOCK`` bytes of text):
``doc_ids``, the block's ``terms`` in row order (most frequent first) with their
``dfs``, and ``treap``: a compressed quadtree over (term row, document column)
whose every cell has four bits for its children and, as the difference to the
cell above, the largest impact inside it; a cell of one term and one document
holds the impact itself. An impact is a term's share of a score before its weight.

Search: the paths of all of an item's rows go down the quadtree jointly, by ranges
of documents. A range's bound is the sum over the rows of weight times the maximum
of the row's cell there; the ranges with the best bounds are halved first, and one
is given up when its bound is under the k-th best score that the task has seen. A
range of one document has its exact score, so the result is exact: recall is 1.

Words are compared as bytes (``words.Runs``), hashes never decide.

Size: each task holds one block and the best ``k`` of each item; items go through in
sets of at most ``SET_BYTES`` of terms, one pass over the index for each set.

Null, empty and wordless texts are no documents of the collection and no hit; an
item without terms, or whose terms occur nowhere, has no rows. Repeated rows of
either table count, and are ranked, one by one; among equal scores a null doc_id
comes first. Very long texts are a block of their own. Empty tables give no rows.
Other columns are never read.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retention.llm.common import groups_of, ids_and_text, stored, table, texts
from retention.llm.words import Runs
from retention.session import checkpoint_dir

K, BLOCK, SET_BYTES = 50, 16_000_000, 4_000_000
#: Ranges that are halved at a time.
AT_A_TIME = 256

#: A-Z become a-z, other ASCII that is neither a letter nor a digit separates terms.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 0
                    for c in range(256))
#: For a cell's four bits and a quadrant (bits * 4 + quadrant): is the child there, and how many are before it.
_HAS = np.array([b >> q & 1 for b in range(16) for q in range(4)], np.int32)
_BEFORE = np.array([(b & ((1 << q) - 1)).bit_count() for b in range(16) for q in range(4)], np.int32)

INDEX = "block string, doc_ids array<bigint>, terms binary, dfs binary, treap binary"


def terms_of(text: bytes) -> list[bytes]:
    """All terms of a text, repeats included."""
    return [w for w in text.translate(_TERM_BYTES).split(b"\0") if w]


def _edges(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text that begins and ends with byte 0."""
    inside = np.frombuffer(text, np.uint8) != 0
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    return edge[0::2], edge[1::2]


class Words(Runs):
    """The words of a block, grouped, and the text ``doc`` that each is in."""

    def __init__(self, parts: list[bytes], **kw):
        text = b"\0" + b"\0".join(parts) + b"\0" * 9
        super().__init__(text, *_edges(text), **kw)
        self.doc = np.searchsorted(np.cumsum([len(p) + 1 for p in parts]) + 1, self.starts, "right")


def _spread(x: np.ndarray) -> np.ndarray:
    """The lower 32 bits with a zero bit after each."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def write_treap(row: np.ndarray, col: np.ndarray, value: np.ndarray) -> bytes:
    """The quadtree of points (each cell once) with values above 0, top level first."""
    height = max(int(row.max()), int(col.max()), 1).bit_length()
    key = (_spread(row) << np.uint64(1)) | _spread(col)
    order = np.argsort(key)
    key, value = key[order], value[order].astype(np.int64)
    bits, drops = [], []
    for _ in range(height):
        above = key >> np.uint64(2)
        first = np.flatnonzero(np.concatenate(([True], above[1:] != above[:-1])))
        most = np.maximum.reduceat(value, first)
        bits.append(np.bitwise_or.reduceat(np.uint8(1) << (key & np.uint64(3)).astype(np.uint8), first))
        drops.append(np.repeat(most, np.diff(np.append(first, len(key)))) - value)
        key, value = above[first], most
    bits_, drops_ = np.concatenate(bits[::-1]), np.concatenate(drops[::-1]).astype("<u4")
    lower = drops_ != 0  # a cell with one child is as high as that child
    head = np.array([height, int(value[0]), len(bits_), len(drops_)], "<u8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(
        b"".join([head, bits_.tobytes(), np.packbits(lower).tobytes(), drops_[lower].tobytes()]))


class Treap:
    """Cells by number: 0 stands for an empty cell, 1 for the whole grid, then level by level."""

    def __init__(self, data: bytes):
        data = zstandard.ZstdDecompressor().decompress(data)
        self.height, top, n_bits, n_drops = np.frombuffer(data, "<u8", 4).astype(np.int64).tolist()
        bits = np.frombuffer(data, np.uint8, n_bits, 32)
        n_flags = -(-n_drops // 8)
        lower = np.unpackbits(np.frombuffer(data, np.uint8, n_flags, 32 + n_bits), count=n_drops).view(bool)
        drops = np.zeros(n_drops, np.int32)
        drops[lower] = np.frombuffer(data, "<i4", -1, 32 + n_bits + n_flags)
        children = np.bitwise_count(bits)
        upto = np.cumsum(children, dtype=np.int32)
        self.bits = np.concatenate(([np.uint8(0)], bits)) << 2
        self.child = np.concatenate((np.zeros(1, np.int32), 2 + upto - children))
        self.most = np.zeros(n_drops + 2, np.int32)
        self.most[1] = top
        lo, hi = 0, 1
        for _ in range(self.height):  # cells lo..hi of one level have their children after them
            below = slice(1 + (upto[lo - 1] if lo else 0), 1 + upto[hi - 1])
            self.most[1:][below] = np.repeat(self.most[1:][lo:hi], children[lo:hi]) - drops[below.start - 1:below.stop - 1]
            lo, hi = below.start, below.stop

    def search(self, rows: np.ndarray, weights: np.ndarray, k: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Columns and scores (at least ``least``) among which are the k best: sums of weight times value over rows."""
        cells = np.ones((1, len(rows)), np.int32)
        bound, level, col = np.array([np.iinfo(np.int64).max]), np.array([self.height]), np.zeros(1, np.int64)
        cols, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        while len(bound):
            if len(bound) > AT_A_TIME:
                best = np.zeros(len(bound), bool)
                best[np.argpartition(bound, len(bound) - AT_A_TIME)[-AT_A_TIME:]] = True
            else:
                best = np.ones(len(bound), bool)
            c, lev, at = cells[best], level[best] - 1, col[best]
            slot = self.bits[c] + (rows >> lev[:, None] & 1).astype(np.uint8) * np.uint8(2)
            first = self.child[c]
            both = [(first + _BEFORE[slot + side]) * _HAS[slot + side] for side in (np.uint8(0), np.uint8(1))]
            new_cells = np.concatenate(both)
            new_bound = self.most[new_cells] @ weights
            new_level, new_col = np.concatenate((lev, lev)), np.concatenate((2 * at, 2 * at + 1))
            done = (new_level == 0) & (new_bound >= least)
            if done.any():
                cols, scores = np.concatenate((cols, new_col[done])), np.concatenate((scores, new_bound[done]))
                if len(scores) >= k:
                    least = max(least, int(np.partition(scores, len(scores) - k)[-k]))
                    cols, scores = cols[scores >= least], scores[scores >= least]
            old, new = ~best & (bound >= least), (new_level > 0) & (new_bound >= least)
            cells, bound = np.concatenate((cells[old], new_cells[new])), np.concatenate((bound[old], new_bound[new]))
            level, col = np.concatenate((level[old], new_level[new])), np.concatenate((col[old], new_col[new]))
        return cols, scores


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n = np.array([len(_edges(b"\0" + t.translate(_TERM_BYTES) + b"\0")[0]) for t in texts(b)], np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([int((n > 0).sum())], pa.int64()), pa.array([int(n.sum())], pa.int64())],
                                         ["docs", "terms"])


def collection_size(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all their terms."""
    r = (ids_and_text(docs).mapInArrow(_count, "docs long, terms long")
         .agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("terms"), F.lit(0)).alias("terms")).first())
    return r["docs"], r["terms"]


def _block(ids: list, parts: list[bytes], n_docs: int, n_terms: int) -> tuple | None:
    words = Words(parts)
    if not len(words.starts):
        return None
    length = np.bincount(words.doc, minlength=len(parts))
    m = 50 + 50 * length * n_docs // n_terms
    doc = words.doc[words.order]
    point = np.flatnonzero(words.head | np.concatenate(([True], doc[1:] != doc[:-1])))
    tf = np.diff(np.append(point, len(doc)))
    term, doc = (np.cumsum(words.head) - 1)[point], doc[point]
    df = np.bincount(term)
    order = np.argsort(-df, kind="stable")
    row = np.empty(len(df), np.int64)
    row[order] = np.arange(len(df))
    # Documents with the same favourite term and a like length are neighbours: ranges of them have tight bounds.
    favourite = np.zeros(len(parts), np.int64)
    np.maximum.at(favourite, doc, tf * len(df) - row[term])
    favourite = -favourite % len(df)
    used = np.lexsort((length, favourite))
    used = used[length[used] > 0]
    column = np.empty(len(parts), np.int64)
    column[used] = np.arange(len(used))
    models = words.models()[order]
    names = b"\0".join([words.text[s:e] for s, e in zip(words.starts[models].tolist(), words.ends[models].tolist())])
    squeeze = zstandard.ZstdCompressor(level=1).compress
    return (uuid.uuid4().hex, [ids[i] for i in used.tolist()], squeeze(names), squeeze(df[order].astype("<u4").tobytes()),
            write_treap(row[term], column[doc], 10**9 * tf // (1000 * tf + 20 * m[doc])))


def _index(n_docs: int, n_terms: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, size = [], [], 0

        def flush():
            made = _block(ids, parts, n_docs, n_terms)
            if made:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], t) for x, t in zip(made, (pa.string(), pa.list_(pa.int64()), *[pa.binary()] * 3))],
                    ["block", "doc_ids", "terms", "dfs", "treap"])
        for b in batches:
            names, all_texts = b.column(0).to_pylist(), texts(b)
            for lo, hi in groups_of([len(t) for t in all_texts], max(1, limit // 4)):
                ids += names[lo:hi]
                parts += [t.translate(_TERM_BYTES) for t in all_texts[lo:hi]]
                size += sum(map(len, parts[lo - hi:]))
                if size >= limit or len(ids) >= limit // 64:
                    yield from flush()
                    ids, parts, size = [], [], 0
        yield from flush()
    return run


def write_index(docs: DataFrame, path: str, block: int = BLOCK) -> tuple[int, int]:
    """Indexes every row of ``docs`` (doc_id, text) in ``path``; returns the collection's size."""
    n_docs, n_terms = collection_size(docs)
    (ids_and_text(docs).mapInArrow(_index(n_docs, max(n_terms, 1), block), INDEX)
     .write.option("parquet.block.size", block).option("parquet.enable.dictionary", "false").parquet(path))
    return n_docs, n_terms


def _rows_of(names: bytes, wanted: dict[bytes, int]) -> list[tuple[int, int]]:
    """(number in ``wanted``, row) of the terms that a block has."""
    return [(w, row) for row, name in enumerate(zstandard.ZstdDecompressor().decompress(names).split(b"\0"))
            if (w := wanted.get(name)) is not None]


def _frequencies(wanted: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), np.int64)
        for b in batches:
            for names, dfs in zip(b.column(0), b.column(1)):
                df = np.frombuffer(zstandard.ZstdDecompressor().decompress(dfs.as_py()), "<u4")
                for w, row in _rows_of(names.as_py(), wanted):
                    total[w] += df[row]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["term", "df"])
    return run


def _best(items: list[tuple[int, np.ndarray]], wanted: dict[bytes, int], weight: np.ndarray, k: int):
    """Each task's k best documents of each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[list[tuple[int, bool, int]]] = [[] for _ in items]  # best first: -score, has an id, id
        for b in batches:
            for ids, names, data in zip(b.column(0), b.column(1), b.column(2)):
                row = np.full(len(wanted), -1)
                if here := _rows_of(names.as_py(), wanted):
                    row[[w for w, _ in here]] = [r for _, r in here]
                treap, ids = Treap(data.as_py()), ids.values
                for i, (_, terms) in enumerate(items):
                    terms = terms[row[terms] >= 0]
                    if len(terms):
                        least = -found[i][-1][0] if len(found[i]) == k else 1
                        cols, scores = treap.search(row[terms], weight[terms], k, least)
                        mine = [(-s, d is not None, d or 0) for s, d in zip(scores.tolist(), ids.take(pa.array(cols)).to_pylist())]
                        found[i] = sorted(found[i] + mine)[:k]
        out = [(items[i][0], d if known else None, -s) for i, rows in enumerate(found) for s, known, d in rows]
        for lo in range(0, len(out), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out[lo:lo + 100_000])],
                                             ["item", "doc_id", "score"])
    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        terms = [sorted(set(terms_of(t))) for t in texts(b)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(terms, pa.list_(pa.binary()))], ["item", "terms"])


def search(spark: SparkSession, path: str, size: tuple[int, int], items: DataFrame, k: int = K,
           set_bytes: int = SET_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each row of ``items`` (item_id, text)."""
    held = stored(items.select("item_id", F.col("text").cast("string").alias("text"))
                  .withColumn("item", F.monotonically_increasing_id()), "items")
    terms = stored(held.select("item", "text").mapInArrow(_item_terms, "item long, terms array<binary>")
                   .where(F.size("terms") > 0), "item_terms")
    length = F.expr("aggregate(terms, 0L, (n, t) -> n + octet_length(t) + 8)")
    n_items, n_bytes = terms.agg(F.count("*"), F.sum(length)).first()
    sets = min(n_items, -(-(n_bytes or 0) // set_bytes))
    index, (n_docs, _) = spark.read.schema(INDEX).parquet(path), size
    hits = None
    for s in range(sets):
        mine = terms.where(F.pmod(F.xxhash64("item"), F.lit(sets)) == s).orderBy("item").collect()
        wanted = {t: i for i, t in enumerate(dict.fromkeys(bytes(t) for r in mine for t in r["terms"]))}
        df = dict(index.select("terms", "dfs").mapInArrow(_frequencies(wanted), "term long, df long")
                  .groupBy("term").agg(F.sum("df").alias("df")).collect())
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(wanted))], np.int64)
        rows = [(r["item"], np.array([wanted[bytes(t)] for t in r["terms"]])) for r in mine]
        best = index.select("doc_ids", "terms", "treap").mapInArrow(_best(rows, wanted, weight, k), "item long, doc_id long, score long")
        hits = best if hits is None else hits.unionAll(best)
    if hits is None:
        hits = spark.createDataFrame([], "item long, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    few = F.row_number().over(Window.partitionBy("item", F.pmod(F.xxhash64("doc_id"), F.lit(64))).orderBy(*order))
    hits = hits.withColumn("rank", few).where(F.col("rank") <= k)  # a hot item's rows meet in 64 tasks first
    hits = hits.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    return hits.join(held.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/index"
    size = write_index(table(spark, sf_dir, "documents"), path)
    return search(spark, path, size, table(spark, sf_dir, "benchmark"))


#: Fixed values of the contract: term pattern, weights, 50 documents.
SQL = r"""
with d as (select row_number() over () r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) t from documents),
q as (select distinct i, item_id, t from (select row_number() over () i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) t from benchmark)),
n as (select r, any_value(doc_id) doc_id, count(*) n from d group by r),
c as (select count(*) docs, cast(sum(n) as bigint) terms from n),
p as (select r, t, count(*) tf from d where t in (select t from q) group by r, t),
w as (select t, cast(floor(1000 * ln((2 * max(docs) + 2) / (2 * count(*) + 1))) as bigint) w from p, c group by t),
s as (select i, item_id, doc_id, r, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms)))) as bigint) score
      from q join p using (t) join w using (t) join n using (r), c group by i, item_id, doc_id, r),
k as (select i, item_id, doc_id, score, cast(row_number() over (partition by i order by score desc, doc_id nulls first) as integer) as "rank" from s where score > 0)
select item_id, "rank", doc_id, score from k where "rank" <= 50
"""
