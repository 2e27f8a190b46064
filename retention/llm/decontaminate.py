"""Benchmark decontamination by winnowing.

Words are hashed in runs of ``KGRAM``; of every ``WINDOW`` consecutive words the
smallest run hash is kept (robust winnowing: the rightmost of equals). Any span
of ``WINDOW`` words that a document shares with a benchmark item therefore has a
kept hash in common with it. Kept hashes of documents that the benchmark may
hold (a bit filter of fixed size decides; it can only err by keeping too much)
are extended to every window around them, and the windows' words are joined
with the benchmark's windows: an equal join on the words themselves, so hits are
exact whatever the hashes did. An item of fewer than ``WINDOW`` words is one
window; its hash is that of all its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.llm.common import groups_of, shielded, stored, table, texts
from retention.llm.words import WordBlock

WINDOW, KGRAM = 10, 5
#: Bits of the filter sent to every task (2 MB), whatever the benchmark's size.
FILTER_BITS = 24
BLOCK = 2_000_000

#: A-Z become a-z, other ASCII that is neither a letter nor a digit separates words.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
                    for c in range(256))


def _kept(block: WordBlock, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions that winnowing keeps, and the run hashes there."""
    g, _ = block.grams(k)
    n = max(0, len(block.hash) - window + 1)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    best, at = g[:n].copy(), np.arange(n)
    for j in range(1, window - k + 1):
        lower = g[j:n + j] <= best
        best = np.where(lower, g[j:n + j], best)
        at = np.where(lower, np.arange(j, n + j), at)
    at = np.unique(at[block.doc[:n] == block.doc[window - 1:n + window - 1]])
    return at, g[at]


def _benchmark_windows(items: DataFrame, window: int, k: int) -> DataFrame:
    """(item_id string, n_words int, words binary, hash long): the windows and their kept hashes.

    One row for each window; ``hash`` is the kept one inside it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [t.translate(_WORD_BYTES) for t in texts(b)]
            names = b.column(0).to_pylist()
            for lo, hi in groups_of([len(p) for p in parts], BLOCK):
                block = WordBlock(parts[lo:hi])
                out = []
                g, _ = block.grams(k)
                for i, (first, n) in enumerate(zip(block.first.tolist(), block.n_words.tolist())):
                    if 0 < n < window:
                        whole = WordBlock([parts[lo + i]]).grams(n)[0][0]
                        out.append((names[lo + i], n, block.joined(first, n), int(whole.astype(np.int64))))
                    for s in range(first, first + n - window + 1):
                        low = g[s:s + window - k + 1].min()
                        out.append((names[lo + i], window, block.joined(s, window), int(low.astype(np.int64))))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int32(), pa.binary(), pa.int64()))],
                        ["item_id", "n_words", "words", "hash"])
    return (items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "item_id string, n_words int, words binary, hash long"))


def _filters(windows: DataFrame) -> dict[int, np.ndarray]:
    """For each window length in the benchmark, a bit filter of its kept hashes.

    At most 10 lengths of 2**24 bits: built by a distributed ``bit_or``."""
    slot = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    rows = (windows.groupBy("n_words", F.shiftright(slot, 5).cast("int").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(shiftrightunsigned(hash, 40) & 31 as int))")).alias("bits")).collect())
    out: dict[int, np.ndarray] = {}
    for r in rows:
        out.setdefault(r["n_words"], np.zeros(1 << (FILTER_BITS - 5), np.uint32))[r["word"]] = r["bits"]
    return out


def _maybe(filt: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    return (filt[slot >> 5] >> (slot & 31).astype(np.uint32)) & 1 == 1


def _scan(filters: dict[int, np.ndarray], window: int, k: int):
    """Per document its number of words and the windows that the benchmark may hold."""
    def candidates(block: WordBlock) -> dict[int, np.ndarray]:
        found = {}
        for n, filt in filters.items():
            if n < window:
                g, whole = block.grams(n)
                found[n] = np.flatnonzero(whole & _maybe(filt, g)) if len(g) else np.zeros(0, np.int64)
                continue
            at, h = _kept(block, window, k)
            at = at[_maybe(filt, h)]
            s = np.unique((at[:, None] - np.arange(window - k + 1)).ravel())
            s = s[(s >= 0) & (s + window <= len(block.hash))]
            found[n] = s[block.doc[s] == block.doc[s + window - 1]]
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [t.translate(_WORD_BYTES) for t in texts(b)]
            for lo, hi in groups_of([len(p) for p in parts], BLOCK):
                block = WordBlock(parts[lo:hi])
                wins: list[list[dict]] = [[] for _ in range(hi - lo)]
                for n, at in candidates(block).items():
                    for s, d in zip(at.tolist(), block.doc[at].tolist()):
                        wins[d].append({"s": s - int(block.first[d]), "n": n, "words": block.joined(s, n)})
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[lo:hi], b.column(2)[lo:hi], pa.array(block.n_words, pa.int64()),
                     pa.array(wins, pa.list_(pa.struct([("s", pa.int32()), ("n", pa.int32()), ("words", pa.binary())])))],
                    ["doc_id", "text_hash", "n_words", "windows"])
    return run


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = KGRAM) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, text_hash, n_words, n_hit, items (sorted strings).

    A word is hit inside any occurrence of an item's window. Null or empty text
    has no words; repeated rows give a row each; items whose id is null hit
    words but are not listed; an empty benchmark hits nothing.
    """
    windows = stored(_benchmark_windows(benchmark, window, k), "windows")
    filters = _filters(windows)
    held = (windows.groupBy("words", "n_words")
            .agg(F.collect_set("item_id").alias("items")).withColumnRenamed("n_words", "n"))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .withColumn("text_hash", F.xxhash64("text"))
            .mapInArrow(_scan(filters, window, k), "doc_id long, text_hash long, n_words long, "
                                                   "windows array<struct<s:int,n:int,words:binary>>")
            .withColumn("row", F.monotonically_increasing_id()))
    rows = stored(rows, "rows")
    hits = (rows.where(F.size("windows") > 0).select("row", F.inline("windows"))
            .join(held, ["words", "n"])
            .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("s", (F.col("s") + F.col("n")).alias("e")))).alias("spans"),
                                F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))
    covered = F.expr("""aggregate(spans, named_struct('reach', 0, 'n', 0L),
        (a, x) -> named_struct('reach', greatest(a.reach, x.e), 'n', a.n + greatest(0, x.e - greatest(a.reach, x.s))),
        a -> a.n)""")
    return (rows.select("row", "doc_id", "text_hash", "n_words")
            .join(hits.select("row", covered.alias("n_hit"), "items"), "row", "left")
            .select("doc_id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = KGRAM) -> DataFrame:
    """``docs`` without the rows that share a window of words with the benchmark; all its columns, whatever their names."""
    docs, back = shielded(docs, "doc_id", "text")
    bad = contamination(docs, benchmark, window, k).where("n_hit > 0").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    return docs.join(bad, F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))
                     & (F.xxhash64(F.col("text").cast("string")) == F.col("__hash")), "left_anti").select(*back)


def query(spark, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


#: Fixed values of the contract: letters, word pattern, window length.
SQL = r"""
with d as (select doc_id, row_number() over () r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
b as (select cast(item_id as varchar) item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
bw as (select distinct item_id, least(10, len(w)) n, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') k
       from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) s from b where len(w) > 0)),
dw as (select r, n, s, array_to_string(w[s:s + n - 1], ' ') k
       from (select r, n, w, unnest(range(1, len(w) - n + 2)) s from d, (select distinct n from bw) where len(w) >= n)),
h as (select r, s, bw.n, item_id from dw join bw on dw.k = bw.k and dw.n = bw.n),
c as (select r, count(distinct p) n_hit from (select r, unnest(range(s, s + n)) p from (select distinct r, s, n from h)) group by r),
i as (select r, count(*) n_items, string_agg(item_id, ',' order by item_id) items from (select distinct r, item_id from h) group by r)
select doc_id, cast(len(w) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit, cast(coalesce(n_items, 0) as bigint) n_items,
       sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join c using (r) left join i using (r)
"""
