"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``ORDER`` long, with the counts of the
bytes that follow each in the training documents. A byte that a context has not
seen escapes to the context without its first byte: escape method C (as many
escapes as distinct followers), and every symbol the longer context knew is
excluded there. As a context's followers are also followers of its suffix, what
is excluded at an order is just the next longer context's followers, so each
probability takes one lookup for each order. Below order 0 all other bytes are
equally likely. A text is preceded by ``ORDER`` zero bytes and ended by one.

Neither the trie nor the vocabulary is held in one place. Documents are put into
blocks of about ``BLOCK`` bytes; a block sends its distinct words and grams
(context and byte), with their training counts, to shards by hash; a shard adds
up the counts of all blocks and answers each block with what it asked for. Grams
are sharded by the two bytes before the last, which keeps a gram and all its
suffixes of order 2 and more together; orders 1 and 0 are a table of at most
65,536 byte pairs that every shard gets.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.llm.common import ids_and_text, stored, table, texts

ORDER, BLOCK = 4, 16_000_000
#: Bytes whose grams are made at a time.
SPAN = 2_000_000
_U8 = np.uint64(8)


def held_out(doc_id: int | None) -> bool:
    """crc32 of the id as text (null: empty) leaves 1 divided by 5."""
    return zlib.crc32(b"" if doc_id is None else b"%d" % doc_id) % 5 == 1


def grams(text: bytes) -> np.ndarray:
    """Key of each byte and the end: its ORDER predecessors and itself, latest lowest."""
    b = np.frombuffer(bytes(ORDER) + text + b"\0", np.uint8).astype(np.uint64)
    n, key = len(b) - ORDER, np.zeros(len(b) - ORDER, np.uint64)
    for j in range(ORDER + 1):
        key = (key << _U8) | b[j:j + n]
    return key


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return k, np.bincount(inverse, np.concatenate(counts), len(k)).astype(np.int64)


def block_grams(docs: list[bytes], train: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of a block, ascending, with their counts in its training documents."""
    keys: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    for use in (True, False):
        part, size = [], 0
        todo = [d for d, t in zip(docs, train) if t == use]
        for i, d in enumerate(todo):
            part.append(grams(d))
            size += len(d) + 1
            if size > SPAN or i == len(todo) - 1:
                k, c = np.unique(np.concatenate(part), return_counts=True)
                keys.append(k)
                counts.append(c if use else np.zeros(len(k), np.int64))
                part, size = [], 0
    return _merged(keys, counts)


def block_words(docs: list[bytes], train: list[bool]) -> dict[bytes, int]:
    """Distinct lower-case words of a block, in order, with their training counts."""
    out: dict[bytes, int] = {}
    for d, t in zip(docs, train):
        words = d.lower().split()
        if t:
            for w in words:
                out[w] = out.get(w, 0) + 1
        else:
            for w in words:
                out.setdefault(w, 0)
    return out


def word_shards(words: list[bytes], shards: int) -> tuple[np.ndarray, list[int]]:
    """An order of the words that depends on the set alone, by shard and hash, and where each shard begins in it."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    of = (h % np.uint64(shards)).astype(np.int64)
    order = np.lexsort((h, of))
    if (h[order][1:] == h[order][:-1]).any():
        order = np.array(sorted(range(len(words)), key=lambda i: (of[i], h[i], words[i])), np.int64)
    return order, np.searchsorted(of[order], np.arange(shards + 1)).tolist()


def gram_shards(keys: np.ndarray, shards: int) -> np.ndarray:
    pair = (keys >> _U8) & np.uint64(0xFFFF)
    return ((pair * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % shards


TABLE = "kind int, shard int, block long, keys binary, counts binary, doc_id long, text binary"


def _blocks(limit: int, shards: int):
    """Cuts each task's documents into blocks of about ``limit`` bytes. Rows out: kind 2, a document
    of the block; kind 0 and 1, the words and grams that the block asks a shard for, with its counts."""
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary())
    names = [x.split()[0] for x in TABLE.split(", ")]

    def requests(block: int, ids: list, docs: list[bytes]) -> list[tuple]:
        train, out = [not held_out(i) for i in ids], []
        seen = block_words(docs, train)
        words, n = list(seen), np.fromiter(seen.values(), np.int32, len(seen))
        order, cuts = word_shards(words, shards)
        order_list = order.tolist()
        for s, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
            if hi > lo:
                out.append((0, s, block, b"\n".join([words[i] for i in order_list[lo:hi]]), n[order[lo:hi]].tobytes(), None, None))
        keys, n = block_grams(docs, train)
        of = gram_shards(keys, shards)
        for s in np.unique(of).tolist():
            out.append((1, s, block, keys[of == s].tobytes(), n[of == s].astype(np.int32).tobytes(), None, None))
        return out

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        ids: list = []
        docs: list[bytes] = []
        size = 0

        def flush():
            yield batch([(2, 0, block, None, None, i, t) for i, t in zip(ids, docs)])
            yield batch(requests(block, ids, docs))
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), texts(b)):
                if docs and size + len(t) > limit:
                    yield from flush()
                    ids, docs, size, block = [], [], 0, block + 1
                ids.append(i)
                docs.append(t)
                size += len(t) + 1
        if docs:
            yield from flush()
    return run


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training counts of (byte, next byte)."""
    total = np.zeros(1 << 16, np.int64)
    for b in batches:
        for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            low = (np.frombuffer(k, np.uint64) & np.uint64(0xFFFF)).astype(np.int64)
            total += np.bincount(low, np.frombuffer(c, np.int32), 1 << 16).astype(np.int64)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["pair", "n"])


class Trie:
    """Contexts of order 2 to ORDER of some grams, over the counts of all byte pairs."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, pairs: np.ndarray):
        seen = counts > 0
        keys, counts = keys[seen], counts[seen]
        self.one = pairs.reshape(256, 256)
        self.zero = self.one.sum(axis=0)
        d1 = (self.one > 0).sum(axis=1)
        self.level1 = (self.one.sum(axis=1), d1, ((self.one > 0) * self.zero).sum(axis=1))
        self.levels: dict[int, tuple] = {}
        for k in range(2, ORDER + 1):
            key, inverse = np.unique(keys & np.uint64((1 << 8 * (k + 1)) - 1), return_inverse=True)
            n = np.bincount(inverse, counts, len(key)).astype(np.int64)
            lower = self._count(k - 1, key)
            ctx, of = np.unique(key >> _U8, return_inverse=True)
            self.levels[k] = (key, n, ctx, np.bincount(of, n, len(ctx)), np.bincount(of, minlength=len(ctx)),
                              np.bincount(of, lower, len(ctx)))

    @staticmethod
    def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(table):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return at, table[at] == keys

    def _count(self, k: int, keys: np.ndarray) -> np.ndarray:
        """Training count of each key's last k + 1 bytes."""
        if k == 1:
            return self.one.ravel()[(keys & np.uint64(0xFFFF)).astype(np.int64)]
        at, found = self._find(self.levels[k][0], keys & np.uint64((1 << 8 * (k + 1)) - 1))
        return np.where(found, self.levels[k][1][at] if len(self.levels[k][1]) else 0, 0)

    def _context(self, k: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Total, distinct followers, and those followers' total one order lower."""
        if k == 0:
            n = len(keys)
            return np.full(n, self.zero.sum()), np.full(n, (self.zero > 0).sum()), np.zeros(n)
        if k == 1:
            last = ((keys >> _U8) & np.uint64(0xFF)).astype(np.int64)
            return tuple(x[last] for x in self.level1)
        _, _, ctx, total, distinct, below = self.levels[k]
        at, found = self._find(ctx, (keys & np.uint64((1 << 8 * (k + 1)) - 1)) >> _U8)
        return tuple(np.where(found, x[at] if len(x) else 0, 0) for x in (total, distinct, below))

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's last byte after the bytes before it."""
        out, open_ = np.zeros(len(keys)), np.ones(len(keys), bool)
        ex_t, ex_d = np.zeros(len(keys)), np.zeros(len(keys))
        for k in range(ORDER, -1, -1):
            total, distinct, below = self._context(k, keys)
            n = self._count(k, keys) if k else self.zero[(keys & np.uint64(0xFF)).astype(np.int64)]
            left = distinct - ex_d
            free = open_ & (left > 0)
            size = np.where(free, (total - ex_t) + left, 1)
            hit = free & (n > 0)
            out += np.log10(np.where(hit, n / size, np.where(free, left / size, 1)))
            open_ &= ~hit
            known = distinct > 0
            ex_t, ex_d = np.where(known, below, ex_t), np.where(known, distinct, ex_d)
        unseen = 256 - int((self.zero > 0).sum())
        return np.where(open_, out - np.log10(max(unseen, 1)), out)


def _answer(pairs: np.ndarray):
    """One shard: adds up all blocks' counts, then answers each block in its own order."""
    def words(rows: pa.Table) -> Iterator[tuple]:
        keys = [k.split(b"\n") for k in rows.column("keys").to_pylist()]
        total: dict[bytes, int] = {}
        for ks, c in zip(keys, rows.column("counts").to_pylist()):
            for w, n in zip(ks, np.frombuffer(c, np.int32).tolist()):
                if n:
                    total[w] = total.get(w, 0) + n
        size, distinct = sum(total.values()), len(total)
        for block, ks in zip(rows.column("block").to_pylist(), keys):
            yield block, np.array([total.get(w, 0) for w in ks], np.int64).tobytes(), size, distinct

    def trie(rows: pa.Table) -> Iterator[tuple]:
        keys = [np.frombuffer(k, np.uint64) for k in rows.column("keys").to_pylist()]
        k, n = _merged(keys, [np.frombuffer(c, np.int32) for c in rows.column("counts").to_pylist()])
        lp = Trie(k, n, pairs).log10(k)
        for block, ks in zip(rows.column("block").to_pylist(), keys):
            yield block, lp[np.searchsorted(k, ks)].tobytes(), 0, 0

    def run(rows: pa.Table) -> pa.Table:
        kind, shard = rows.column("kind")[0].as_py(), rows.column("shard")[0].as_py()
        out = list(zip(*(trie if kind else words)(rows)))
        n = len(out[0])
        return pa.table({"kind": pa.array([kind] * n, pa.int32()), "shard": pa.array([shard] * n, pa.int32()),
                         "block": pa.array(out[0], pa.int64()), "found": pa.array(out[1], pa.binary()),
                         "tokens": pa.array(out[2], pa.int64()), "distinct": pa.array(out[3], pa.int64())})
    return run


class _Lookup:
    """Position of each key in an ascending array: a hash table, and a search where two keys share a slot."""

    def __init__(self, keys: np.ndarray, bits: int = 21):
        self.keys, self.shift = keys, np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, np.int32)
        self.table[self._slot(keys)] = np.arange(len(keys), dtype=np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self.table[self._slot(keys)]
        wrong = np.flatnonzero(self.keys[at] != keys)
        at[wrong] = np.searchsorted(self.keys, keys[wrong])
        return at


def _scores(shards: int, total: int, distinct: int, train_docs: int):
    n_all, v = total + train_docs, distinct + (train_docs > 0)
    scale = np.log10(n_all + 0.5 * (v + 1))
    kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        ids, docs = block.column("doc_id").to_pylist(), block.column("text").to_pylist()
        words = list(block_words(docs, [False] * len(docs)))
        keys, _ = block_grams(docs, [False] * len(docs))
        by_word, word_cuts = word_shards(words, shards)
        of_gram, lp, count = gram_shards(keys, shards), np.zeros(len(keys)), np.zeros(len(words), np.int64)
        by_gram = np.argsort(of_gram, kind="stable")
        gram_cuts = np.searchsorted(of_gram[by_gram], np.arange(shards + 1)).tolist()
        for kind, s, found in zip(*[answers.column(c).to_pylist() for c in ("kind", "shard", "found")]):
            if kind:
                lp[by_gram[gram_cuts[s]:gram_cuts[s + 1]]] = np.frombuffer(found)
            else:
                count[by_word[word_cuts[s]:word_cuts[s + 1]]] = np.frombuffer(found, np.int64)
        at = dict(zip(words, range(len(words))))
        look = _Lookup(keys)
        log_c, known, end = np.log10(count + 0.5), count > 0, np.log10(train_docs + 0.5)
        out = []
        for i, d in zip(ids, docs):
            w = np.array([at[x] for x in d.lower().split()], np.int64)
            g = grams(d)
            score = sum(float(lp[look(g[lo:lo + SPAN])].sum()) for lo in range(0, len(g), SPAN))
            out.append((i, held_out(i), len(w) + 1, int(known[w].sum()) + (train_docs > 0), n_all,
                        float(log_c[w].sum() + end - (len(w) + 1) * scale), score))
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[x.split()[0] for x in SCORES.split(", ")])
    return run


SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")


def scores(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``.

    Null text is empty: one end. Repeated rows count, and are scored, each. With
    no training document every byte is equally likely and no token is known.
    """
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(ids_and_text(docs).mapInArrow(_blocks(block, shards), TABLE), "blocks")
    asked = rows.where("kind < 2").select("kind", "shard", "block", "keys", "counts")
    pairs = np.zeros(1 << 16, np.int64)
    for r in (asked.where("kind = 1").select("keys", "counts").mapInArrow(_pairs, "pair int, n long")
              .groupBy("pair").agg(F.sum("n").alias("n")).collect()):  # 65,536 rows at most
        pairs[r["pair"]] = r["n"]
    found = stored(asked.groupBy("kind", "shard").applyInArrow(
        _answer(pairs), "kind int, shard int, block long, found binary, tokens long, distinct long"), "answers")
    size = (found.where("kind = 0").groupBy("shard").agg(F.first("tokens").alias("t"), F.first("distinct").alias("d"))
            .agg(F.sum("t").alias("t"), F.sum("d").alias("d")).first())
    remainder = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5
    train_docs = ids_and_text(docs).select("doc_id").where(remainder != 1).count()
    in_block = rows.where("kind = 2").select("block", "doc_id", "text").groupBy("block")
    return in_block.cogroup(found.select("block", "kind", "shard", "found").groupBy("block")).applyInArrow(
        _scores(shards, size["t"] or 0, size["d"] or 0, train_docs), SCORES)


def query(spark, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"))
