"""Line templates, content-defined chunks and run-length indexes against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_tables import SF_SMALL, awkward, sf_docs, table_of  # noqa: F401 - fixtures
from retention.llm import chunk_dedup as cd
from retention.llm import line_templates as lt
from retention.llm import repeated_bytes as rb
from retention.llm.run_index import RunIndex


# ---- line templates

def expected_lines(docs):
    """{(doc_id, text)} -> text without recurring lines, straight from the definition."""
    docs = sorted(set(docs), key=lambda d: (d[0] is None, d[0] or 0))
    lines = [(i, n, lt.fields(x)) for i, (_, t) in enumerate(docs) for n, x in enumerate((t or "").encode().split(b"\n"))]

    def leaf(f):
        return len(f), tuple(f[:lt.DEPTH])
    held = collections.defaultdict(set)
    support = collections.Counter()
    for i, _, f in lines:
        held[leaf(f)].add(i)
        support.update((leaf(f), p, x) for p, x in enumerate(f))
    groups = collections.defaultdict(list)
    for i, n, f in lines:
        fixed = [(p, x) for p, x in enumerate(f) if x != lt.FIELD and support[leaf(f), p, x] >= lt.MIN_DOCS]
        if fixed and len(held[leaf(f)]) >= lt.MIN_DOCS and len(fixed) >= lt.SIMILARITY * sum(x != lt.FIELD for x in f):
            groups[leaf(f), tuple(fixed)].append((i, n))
    gone = collections.defaultdict(set)
    for found in groups.values():
        if len({i for i, _ in found}) >= lt.MIN_DOCS:
            for i, n in found[1:]:
                gone[i].add(n)
    return {d: (len(gone[i]), d[1] if d[1] is None else "\n".join(x for n, x in enumerate(d[1].split("\n")) if n not in gone[i]))
            for i, d in enumerate(docs)}


def test_line_query_against_brute_force(spark, sf_docs):
    want = expected_lines([(i, r["text"]) for i, r in sf_docs.items()])
    got = {(r.doc_id, sf_docs[r.doc_id]["text"]): (r.n_dropped, r.text) for r in lt.query(spark, SF_SMALL).collect()}
    assert got == want and any(n for n, _ in got.values())


def test_variable_fields_are_generalised(spark, table_of):
    docs = [(i, f"Page {i} of 90 printed by {name} today\nbody number {name} is its own {name}{name}")
            for i, name in enumerate(["ann", "bob", "cy", "dee", "eve", "fay"])]
    rows = {r.doc_id: r.text for r in lt.dedup_lines(table_of(docs)).collect()}
    assert rows[0] == docs[0][1]  # the first stays
    assert all("Page" not in rows[i] and "body" in rows[i] for i in range(1, 6))


def test_lines_awkward(spark, table_of, awkward):
    docs = table_of(awkward, extra=True)
    out = lt.dedup_lines(docs)
    assert out.columns == docs.columns
    want = expected_lines(awkward)
    rows = collections.Counter((r.doc_id, r.text) for r in out.collect())
    assert rows == collections.Counter((d, want[d, t][1]) for d, t in awkward
                                       if not want[d, t][0] or want[d, t][1].strip())
    assert lt.dedup_lines(table_of([])).count() == 0
    same = [(i, "All rights reserved by us\nmine " + chr(97 + i) * 3) for i in range(7)]
    kept = {r.doc_id: (r.text, r.n_chars) for r in lt.dedup_lines(table_of([(*d, "en", "s", 1) for d in same])).collect()}
    assert kept[0] == (same[0][1], len(same[0][1])) and all(kept[i] == ("mine " + chr(97 + i) * 3, 8) for i in range(1, 7))


@pytest.mark.parametrize("n", [100, 100_000])
def test_word_fields_are_generalised_at_every_size(spark, table_of, n):
    """Two variable words of 1,000 values each: one template, whether a value is in the leaf once or 100 times.
    Lines of another leaf that only recur as they are go, too."""
    rng = random.Random(9)
    name = ["".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(1000)]
    lines = [f"Letter sent to {rng.choice(name)} living in {rng.choice(name)} today" for _ in range(n)]
    per = n // 100
    docs = [(i, "\n".join([*lines[i * per:(i + 1) * per], f"One two three {name[i % 20]} {name[i % 20]} {name[i % 20]}"]))
            for i in range(100)]
    if n > 100:
        docs = [(i, t + "".join(f"\nOne two three {x} {x} {x}" for x in name[:20])) for i, t in docs]
    rows = lt.drop_lines(table_of(docs), lt.line_groups(table_of(docs))).orderBy("doc_id").collect()
    left = [x for r in rows for x in r.text.split("\n")]
    assert [x for x in left if x.startswith("Letter")] == lines[:1]
    assert len([x for x in left if x.startswith("One")]) == 20


# ---- chunks

def plain_chunks(text):
    h, out, gear = 0, [0], cd.gear_numbers().tolist()
    for i, b in enumerate(text):
        h = ((h << 1) + gear[b]) & 0xFFFF
        n = i + 1 - out[-1]
        if i + 1 < len(text) and (n == cd.MAX_CHUNK or n >= cd.MIN_CHUNK and not h >> (16 - cd.CUT_BITS)):
            out.append(i + 1)
    return out + [len(text)]


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=3000), st.integers(1, 40))
def test_chunks_against_a_byte_loop(text, times):
    text = text * times
    assert cd.chunks_of(text) == plain_chunks(text)


def test_chunks_resist_insertions():
    rng = random.Random(5)
    text = bytes(rng.choice(b"abcdefghij klmnop") for _ in range(20000))
    moved = text[:9000] + b"inserted words" + text[9000:]

    def parts(t):
        c = cd.chunks_of(t)
        return {t[s:e] for s, e in zip(c, c[1:])}
    assert len(parts(text) - parts(moved)) <= 8


def expected_spans(docs):
    first, out = {}, {}
    for i in sorted(docs):
        t = docs[i]
        c, spans = plain_chunks(t) if t else [0], []
        for s, e in zip(c, c[1:]):
            if t[s:e] in first:
                if spans and spans[-1][1] == s:
                    spans[-1] = (spans[-1][0], e)
                else:
                    spans.append((s, e))
            else:
                first[t[s:e]] = i
        out[i] = [x for x in spans if x[1] - x[0] >= cd.MIN_RUN or x[1] - x[0] == len(t)]
    return out


def test_chunk_query_against_brute_force(spark, sf_docs):
    want = expected_spans({i: r["text"].encode() for i, r in sf_docs.items()})
    got = {r.doc_id: [tuple(x) for x in r.spans] for r in cd.query(spark, SF_SMALL).collect()}
    assert got == want and any(got.values())


def test_passages_are_found_and_clean_text_is_left(spark, table_of):
    rng = random.Random(11)

    def prose(n):
        return " ".join("".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(n))
    passage = prose(60)
    docs = [(i, prose(80) + " " + passage + " " + prose(80)) for i in range(6)] + [(i, prose(200)) for i in range(6, 10)]
    rows = {r.doc_id: r.spans for r in cd.repeated_spans(table_of(docs)).collect()}
    assert not rows[0] and not any(rows[i] for i in range(6, 10))
    for i in range(1, 6):
        text = docs[i][1].encode()
        begin = text.index(passage.encode())
        covered = sum(min(x.stop, begin + len(passage)) - max(x.start, begin) for x in rows[i])
        assert covered > 0.6 * len(passage)
        assert all(begin <= x.start and x.stop <= begin + len(passage) for x in rows[i])
        assert len(cd.cut_spans(text, [tuple(x) for x in rows[i]])) == len(text) - covered


def test_chunks_awkward(spark, table_of, awkward):
    rows = cd.repeated_spans(table_of(awkward, extra=True)).collect()
    assert len(rows) == len(awkward)
    of = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert of[1].n_bytes == of[2].n_bytes == 0 and not of[4].spans and of[5].spans == [(0, 3)]
    assert not of[6].spans and of[7].spans == of[8].spans == [(0, of[7].n_bytes)]
    assert cd.repeated_spans(table_of([])).count() == 0


# ---- run-length index

@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("ab\0", max_size=25).map(str.encode), min_size=1, max_size=5), st.booleans())
def test_matching_statistics(texts, twice):
    texts = texts + texts[:1] if twice else texts
    at = [(t, i) for t, x in enumerate(texts) for i in range(len(x) + 1)]

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n
    want = [max([common(texts[t][i:], texts[u][j:]) for u, j in at if (u, j) != (t, i)], default=0) for t, i in at]
    assert RunIndex(texts).matching_statistics().tolist() == want


def expected_removal(texts, length=rb.LENGTH):
    seen = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        edge = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                edge[i] += 1
                edge[i + length] -= 1
        gone = np.cumsum(edge)[:-1] > 0
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((len(t), int(gone.sum()), int((np.diff(np.append(0, gone.astype(int))) == 1).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return out


def removal(rows):
    return [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows]


def test_repeat_query_against_brute_force(spark, sf_docs):
    ids = sorted(sf_docs)
    want = dict(zip(ids, expected_removal([sf_docs[i]["text"].encode() for i in ids])))
    rows = rb.query(spark, SF_SMALL).collect()
    assert dict(zip([r.doc_id for r in rows], removal(rows))) == want and any(w[1] for w in want.values())


@pytest.mark.parametrize("crowd, index_bytes, block", [(2, 3000, 700), (rb.CROWD, rb.INDEX_BYTES, rb.BLOCK)])
def test_planted_repeats(spark, table_of, crowd, index_bytes, block):
    """Periods, overlaps, exactly 199 / 200 / 201 shared bytes, crowds; small limits take every other path."""
    rng = random.Random(3)

    def noise(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    line, texts = noise(150), []
    for n in (199, 200, 201, 260, 400):
        shared = noise(n)
        texts += [noise(rng.randint(0, 90)) + shared + noise(rng.randint(0, 90)) for _ in range(3)]
    texts += [noise(60) + line + noise(60) for _ in range(8)] + ["ab" * 400, "a" * 500, noise(90) * 5, "é" * 300, ""]
    whole = noise(3000)
    texts += [whole, whole, whole[:1500] + "!" + whole[1500:], noise(50) + whole[200:1200] + whole[100:900]]
    texts += [line + noise(49) + "!", line + noise(51)]
    rows = rb.repeated_strings(table_of([(i, t) for i, t in enumerate(texts)]), crowd=crowd, index_bytes=index_bytes,
                               block=block).collect()
    rows.sort(key=lambda r: r.doc_id)
    assert removal(rows) == expected_removal([t.encode() for t in texts])


def test_repeats_awkward(spark, table_of, awkward):
    rows = rb.repeated_strings(table_of(awkward, extra=True)).collect()
    want = expected_removal([(t or "").encode() for _, t in awkward])
    key = lambda d, w: (d is None, d or 0, w)
    assert sorted(zip([r.doc_id for r in rows], removal(rows)), key=lambda x: key(*x)) == \
        sorted(zip([d for d, _ in awkward], want), key=lambda x: key(*x))
    assert rb.repeated_strings(table_of([])).count() == 0


@pytest.mark.parametrize("partitions", [4, 64])
def test_the_only_document_that_repeats_itself(spark, table_of, partitions):
    """Its one merged piece is alone in its task, whatever the number of partitions."""
    rng = random.Random(8)

    def noise(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for texts in ([noise(250) * 2], [noise(100) * 3, noise(400)], [noise(250) * 2, noise(300) * 2, noise(700)]):
            rows = rb.repeated_strings(table_of(list(enumerate(texts)))).collect()
            rows.sort(key=lambda r: r.doc_id)
            want = expected_removal([t.encode() for t in texts])
            assert removal(rows) == want and want[0][1] == len(texts[0])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
