"""Token ids, their files, and packing: exact round trips and a plain best fit."""

import bisect
import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_tables import SF_SMALL, awkward, sf_docs, table_of  # noqa: F401 - fixtures
from retention.llm import packing, token_store
from retention.llm.tokens import REMEMBERED, WordEncoder, default_path


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(default_path())
    return lambda text: t.encode(text, add_special_tokens=False).ids


ENCODER = WordEncoder(default_path(), remembered=40)  # forgets all the time


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(
    st.text(max_size=40),
    st.text("aAbZéÉßœŒİıÅŉǅ'’s .,!?-<|>09\t\n  ́\u0085\x1c", max_size=60),
    st.sampled_from(["<|endoftext|>", "a<|startoftext|>b", "don't we'll they'RE I'M 'S", "é ́e ﬁ ΑΣ ΣΑΣ İI", "x" * 200])),
    min_size=1, max_size=6))
def test_words_are_encoded_as_whole_texts_are(texts):
    plain = Tokenizer.from_file(default_path())
    got = [np.frombuffer(x, "<u4").tolist() for x in ENCODER.encode([t.encode("utf-8", "ignore") for t in texts])]
    assert got == [plain.encode(t.encode("utf-8", "ignore").decode(), add_special_tokens=False).ids for t in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_query_round_trip(spark, sf_docs, plain):
    start, want = 0, []
    for i in sorted(sf_docs):
        ids = plain(sf_docs[i]["text"]) + [2]
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(tuple(r) for r in token_store.query(spark, SF_SMALL).collect()) == want


def test_token_worker_holds_one_block(monkeypatch):
    """A worker copies a block's texts out of a batch, not the batch's, and forgets pieces."""
    import tracemalloc
    import types
    rows, text = 8_000, "the quick brown fox jumps over a dog, " * 80
    batch = pa.RecordBatch.from_arrays([pa.array(range(rows)), pa.array([text] * (rows - 2) + [None, ""])], ["doc_id", "text"])
    monkeypatch.setattr(token_store, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    encode = token_store._encode(default_path(), 2)
    list(encode(iter([batch.slice(0, 1)])))  # the encoder is there
    tracemalloc.start()
    sizes = [n for out in encode(iter([batch])) for n in out.column("n_tokens").to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(sizes) == rows and len(set(sizes[:-2])) == 1 and sizes[-2:] == [1, 1]
    assert peak < 60e6 and REMEMBERED * 250 < 100e6


def test_token_files(spark, table_of, awkward, plain, tmp_path):
    path = str(tmp_path / "store")
    token_store.write_tokens(table_of(awkward, extra=True), path)
    rows = token_store.read_tokens(spark, path).orderBy("start").collect()
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0)) and len(rows) == len(awkward)
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    want = collections.Counter((i, tuple(plain(t or "") + [2])) for i, t in awkward)
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in rows) == want
    some = token_store.read_tokens(spark, path, 6, 8)
    assert sorted(r.doc_id for r in some.collect()) == [6, 7, 8, 8]
    plan = some.select("doc_id", "n_tokens")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,6)" in plan and "ids" not in plan.split("ReadSchema")[1].split("\n")[0]
    empty = str(tmp_path / "empty")
    token_store.write_tokens(table_of([]), empty)
    assert token_store.read_tokens(spark, empty).count() == 0


def best_fit(lengths, capacity):
    gaps, n = [], 0
    for x in sorted(lengths, reverse=True):
        i = bisect.bisect_left(gaps, x)
        if i < len(gaps):
            gap = gaps.pop(i)
        else:
            gap, n = capacity, n + 1
        bisect.insort(gaps, gap - x)
    return n


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=80))
def test_sweep_is_best_fit_decreasing(lengths):
    s = packing.sweep(collections.Counter(lengths), 20)
    assert s.sequences == best_fit(lengths, 20)
    places = collections.defaultdict(list)
    for length, n in collections.Counter(lengths).items():
        ranks = [p[0] for p in s.placed[length]]
        assert ranks == sorted(ranks)
        for rank in range(n):
            first_rank, first, per, begin = s.placed[length][bisect.bisect_right(ranks, rank) - 1]
            step = rank - first_rank
            places[first + step // per].append((begin + step % per * length, length))
    assert_packed(places, 20)
    assert len(places) == s.sequences


def assert_packed(places, capacity):
    for found in places.values():
        end = 0
        for at, length in sorted(found):
            assert at == end
            end += length
        assert end <= capacity


def check_pieces(rows, texts, plain, capacity):
    places, lengths = collections.defaultdict(list), []
    by_doc = collections.defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        lengths.append(r.length)
    assert_packed(places, capacity)
    assert len(places) == best_fit(lengths, capacity)
    want = collections.defaultdict(list)
    for i, t in texts:
        ids = plain(t or "") + [1]
        want[i] += [(n, s, len(ids[s:s + capacity]), crc(ids[s:s + capacity])) for n, s in enumerate(range(0, len(ids), capacity))]
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in want.items()}


def test_packing_query(spark, sf_docs, plain):
    check_pieces(packing.query(spark, SF_SMALL).collect(), [(i, r["text"]) for i, r in sf_docs.items()], plain, 4096)


def test_packing_awkward(spark, table_of, awkward, plain):
    docs = table_of(awkward, extra=True)
    check_pieces(packing.pack(packing.pieces(docs, capacity=50), 50).collect(), awkward, plain, 50)
    assert packing.pack(packing.pieces(table_of([]))).count() == 0


def test_packing_of_one_hot_length(spark, table_of, plain):
    rng = random.Random(2)
    docs = [(i, "same words here") for i in range(300)] + [(i, "word " * rng.randint(1, 60)) for i in range(300, 400)]
    check_pieces(packing.pack(packing.pieces(table_of(docs), capacity=64), 64).collect(), docs, plain, 64)
