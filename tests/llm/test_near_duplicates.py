"""SimHash balls against all pairs; components; the stage that keeps one."""

import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_tables import SF_SMALL, awkward, sf_docs, table_of  # noqa: F401 - fixtures
from retention.llm import simhash
from retention.llm.components import connected_components


def fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(w[i:i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def components(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_query_against_all_pairs(spark, sf_docs):
    f = {i: fingerprint(r["text"]) for i, r in sf_docs.items()}
    near = [(a, b) for a in f for b in f if a < b and (f[a] ^ f[b]).bit_count() <= 4]
    roots = components(near, f)
    got = simhash.query(spark, SF_SMALL).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{f[i]:016x}", roots[i]) for i in f}


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=5)), min_size=1, max_size=12),
       st.sampled_from([50, 2_000_000]))
def test_ball_links_what_all_pairs_link(seeds, block):
    fps = sorted({x for s, flips in seeds for x in (s, s ^ sum(1 << b for b in set(flips)))})
    arr = np.array(fps, np.uint64)
    old, simhash.BLOCK = simhash.BLOCK, block
    try:
        masks = np.concatenate(simhash._flips(simhash.ROUTE_BITS, 2))
        route = (arr >> np.uint64(48))[:, None] ^ masks
        linked = set()
        for r in np.unique(route).tolist():
            here = arr[(route == np.uint64(r)).any(axis=1)]
            a, b = simhash._expand(np.full(len(here), r, np.uint64), here, simhash.ROUTE_BITS, 2, 4)
            linked |= set(zip(a.tolist(), b.tolist()))
    finally:
        simhash.BLOCK = old
    assert all((a ^ b).bit_count() <= 4 for a, b in linked)
    near = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4]
    assert components(linked, fps) == components(near, fps)


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)] * 2,
                                   [(5, 3), (3, 9), (9, 5), (20, 21), (22, 21), (100, 7)]])
def test_components(spark, edges):
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a != b]
    assert got == components(real, {x for e in real for x in e})


def test_awkward_rows(spark, table_of, awkward):
    rows = simhash.near_duplicates(table_of(awkward, extra=True)).collect()
    assert len(rows) == len(awkward)
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, set()).add(r.component_id)
    assert of[1] == of[2] == of[3] == {1}  # no words: fingerprint zero, linked like any other
    assert of[4] == of[5] == {4} and of[6] == of[7] == of[8] == {6}


def test_keep_one(spark, table_of, awkward):
    docs = table_of(awkward, extra=True)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    ids = [i for i, _ in rows if i is not None]
    assert len(ids) == len(set(ids)) and {1, 4, 6, 9, 10} <= set(ids) and not {2, 3, 5, 7, 8} & set(ids)
    assert (None, "no id") in rows and (None, None) not in rows
    twice = simhash.keep_one(table_of([(1, "a b c d e"), (1, "a b c d e"), (1, "a b c d e")]))
    assert twice.count() == 1
    assert simhash.keep_one(table_of([])).count() == 0
