"""Ranked search, fill-in-middle and source mixing against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from llm_tables import SCHEMA, SF_SMALL, awkward, sf_docs, table_of, words  # noqa: F401

from retention.llm import fill_in_middle, mixture, queries, ranked_search

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
A_TO_Z = {c: c + 32 for c in range(65, 91)}


def plain_search(docs, items, k=50):
    """docs: (doc_id, text), items: (item_id, text) -> sorted (item_id, rank, doc_id, score)."""
    bags = [(i, Counter(TERM.findall((t or "").translate(A_TO_Z)))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        terms = set(TERM.findall((text or "").translate(A_TO_Z)))
        found = []
        for i, b, n in bags:
            m = 50 + 50 * n * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 20 * m))
                        for t in terms if t in b)
            if score > 0:
                found.append((-score, i is not None, i or 0))
        out += [(item, r, i if known else None, -s) for r, (s, known, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def searched(spark, docs, items, tmp, k=50, block=ranked_search.BLOCK, set_bytes=ranked_search.SET_BYTES):
    size = ranked_search.write_index(docs, f"{tmp}/index", block)
    got = ranked_search.search(spark, f"{tmp}/index", size, items, k, set_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted([tuple(r) for r in got.collect()], key=repr)


ITEMS = [(1, "one Ünï d"), (2, None), (3, "..."), (4, words(30, 3)), (4, words(30, 3)), (None, "a b no id"), (5, "unseen"),
         (6, " ".join(["x" * 30000, "é" * 5000, "one", "One", "ONE"]))]


@pytest.mark.parametrize("block, set_bytes, k", [(ranked_search.BLOCK, ranked_search.SET_BYTES, 50), (300, 40, 3)])
def test_search_on_awkward_rows(spark, table_of, awkward, tmp_path, block, set_bytes, k):
    docs = table_of(awkward, extra=True).repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert searched(spark, docs, items, tmp_path, k, block, set_bytes) == plain_search(awkward, ITEMS, k)


def test_search_of_empty_tables(spark, table_of, awkward, tmp_path):
    none, items = table_of([]), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert searched(spark, none, items, tmp_path / "a") == []
    assert searched(spark, table_of([(1, None), (2, " .")]), items, tmp_path / "b") == []
    assert searched(spark, table_of(awkward), items.where("false"), tmp_path / "c") == []


def test_search_of_copies_and_ties(spark, table_of, tmp_path):
    rows = [(i, "the same words here") for i in range(200, 0, -1)] + [(i, f"the other w{i}") for i in range(300, 330)]
    items = [(7, "same words other"), (8, "w301 the")]
    got = searched(spark, table_of(rows), spark.createDataFrame(items, "item_id long, text string"), tmp_path, block=2000)
    assert got == plain_search(rows, items)


def test_search_query_is_its_sql(spark):
    got = sorted(tuple(r) for r in queries.QUERIES["op11_k2_treap"](spark, SF_SMALL).collect())
    assert got == sorted(sql_rows("op11_k2_treap"))


def sql_rows(name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con.execute(queries.SQL[name]).fetchall()


def test_words_with_equal_keys_are_told_apart():
    parts = [b"longer-word".translate(ranked_search._TERM_BYTES), b"abcdefghij abcdefghij abcdefghik zz", b"", b"y" * 300 + b" " + b"y" * 301]
    parts = [p.translate(ranked_search._TERM_BYTES) for p in parts]
    for kw in ({}, {"mixed": lambda h: np.full_like(h, 5)}):
        w = ranked_search.Words(parts, **kw)
        group = np.cumsum(w.head)
        ids = dict(zip([w.string(i) for i in w.order.tolist()], group.tolist()))
        assert sorted(ids) == sorted({x for p in parts for x in p.split(b"\0") if x}) and len(set(ids.values())) == len(ids)
        for i, g in zip(w.order.tolist(), group.tolist()):
            assert ids[w.string(i)] == g


@pytest.mark.parametrize("seed", range(6))
def test_treap_holds_every_cell(seed):
    rng = np.random.default_rng(seed)
    n_rows, n_cols = int(rng.integers(1, 60)), int(rng.integers(1, 400))
    grid = np.where(rng.random((n_rows, n_cols)) < rng.choice([0.02, 0.3, 1.0]), rng.integers(1, 1_000_000, (n_rows, n_cols)), 0)
    grid[0, 0] = 7
    row, col = np.nonzero(grid)
    treap = ranked_search.Treap(ranked_search.write_treap(row, col, grid[row, col]))
    rows = rng.permutation(n_rows)[: max(1, n_rows // 2)]
    weights = rng.integers(0, 20_000, len(rows))
    scores = weights @ grid[rows]
    for k in (1, 5, 1000):
        cols, got = treap.search(rows, weights, k)
        assert np.array_equal(scores[cols], got) and len(set(cols.tolist())) == len(cols)
        assert sorted(got.tolist(), reverse=True)[:k] == [s for s in sorted(scores.tolist(), reverse=True) if s > 0][:k]


# ---- fill in middle ---------------------------------------------------------

def plain_cut(doc_id, text, fim=100, spm=50):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(lines)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 40, 1000, 20000])
def test_skip_list_reaches_every_rank(n):
    rng = random.Random(n)
    widths = [rng.randrange(0, 90) for _ in range(n)]
    lines, upto = fill_in_middle.SkipList(widths), [0]
    for w in widths:
        upto.append(upto[-1] + w)
    for rank in {0, 1, n // 3, n - 1, n} | {rng.randrange(n + 1) for _ in range(300)}:
        if 0 <= rank <= n:
            assert lines.seek(rank) == upto[rank]
    if n == 20000:  # express lanes halve the walk many times over
        assert len(lines.lanes) >= 5 and len(lines.lanes[-1][0]) <= fill_in_middle.FEW


@pytest.mark.parametrize("fim, spm", [(100, 50), (40, 0), (0, 50)])
def test_fill_in_middle_on_awkward_rows(spark, table_of, awkward, fim, spm):
    rows = awkward + [(20, "a<S>b\nc"), (21, "<P"), (22, "x\n\n<\nP>\n"), (23, "é\nßü\n" * 4000), (24, "\n")] + [(i, "l1\nl2 é\nl3") for i in range(30, 90)]
    got = fill_in_middle.transform(table_of(rows, extra=True), fim, spm)
    got = got.withColumn("back", fill_in_middle.restore(got.output, got.form))
    want = sorted(((i, *plain_cut(i, t, fim, spm), t or "") for i, t in rows), key=repr)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == want
    assert {"psm", "spm", "plain"} >= {r[2] for r in want} and (fim < 100 or len({r[2] for r in want}) == 3)


def test_fill_in_middle_query_is_its_sql(spark, table_of):
    got = sorted((tuple(r) for r in queries.QUERIES["op12_skip_list_fim"](spark, SF_SMALL).collect()), key=repr)
    assert got == sorted(sql_rows("op12_skip_list_fim"), key=repr)
    assert fill_in_middle.transform(table_of([])).count() == 0


# ---- mixing -----------------------------------------------------------------

def plain_targets(size, weights=(5, 2, 1), most=3):
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, total = {}, sum(size.values())
    while True:
        rest, share = total - sum(out.values()), sum(w for s, w in weight.items() if s not in out)
        over = [s for s in size if s not in out and rest * weight[s] > share * most * size[s]]
        if not over:
            return {s: float(out[s]) if s in out else rest * weight[s] / share for s in size}
        out.update({s: most * size[s] for s in over})


def plain_rates(sizes, target, most=3):
    """The tilt that meets the target, by bisection."""
    total = sum(sizes)
    if not total or target >= most * total:
        return [float(most) if s else 1.0 for s in sizes]
    mean = total / sum(s > 0 for s in sizes)
    rates = lambda a: [float(most) if a * s / mean >= math.log(most) else math.exp(a * s / mean) for s in sizes]
    lo, hi = -1e4, 1e4
    for _ in range(300):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(r * s for r, s in zip(rates(mid), sizes)) < target else (lo, mid)
    return rates(lo)


def check_mix(rows, got):
    """rows: (doc_id, text, source); got: rows of copies()."""
    by = defaultdict(list)
    for d, t, s in rows:
        by[s].append((d, len((t or "").translate({c: 32 for c in range(9, 14)}).split(" ")) - (t or "").translate({c: 32 for c in range(9, 14)}).split(" ").count("")))
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((d, s, n) for s, v in by.items() for d, n in v)
    total = {s: sum(n for _, n in v) for s, v in by.items()}
    want = plain_targets(total)
    for s, v in by.items():
        mine = [r for r in got if r["source"] == s]
        assert {r["source_size"] for r in mine} == {total[s]}
        assert all(math.isclose(r["target"], want[s], rel_tol=1e-12) for r in mine)
        assert all(r["copies"] in (math.floor(r["rate"]), math.ceil(r["rate"])) and 0 <= r["copies"] <= 3 for r in mine)
        rate = dict(zip([n for _, n in v], plain_rates([n for _, n in v], want[s])))
        assert all(math.isclose(r["rate"], rate[r["size"]], rel_tol=1e-5, abs_tol=1e-7) for r in mine)
        assert math.isclose(sum(r["rate"] * r["size"] for r in mine), want[s], rel_tol=1e-8)
        assert abs(sum(r["copies"] * r["size"] for r in mine) - want[s]) <= max(n for _, n in v)


def source_rows(rows, sources):
    return [(d, t, sources[i % len(sources)]) for i, (d, t) in enumerate(rows)]


@pytest.mark.parametrize("sources", [["b", "a", None, "é", "B"], [None]])
def test_mixture_on_awkward_rows(spark, table_of, awkward, sources):
    rows = source_rows(awkward + [(100 + i, words(i % 23, i)) for i in range(400)], sources)
    docs = table_of([(d, t, None, s) for d, t, s in rows], extra=True)
    got = mixture.copies(docs).collect()
    check_mix(rows, got)
    again = mixture.copies(docs.repartition(5), slot=7).collect()  # other slots may choose other documents of a class
    check_mix(rows, again)
    assert sorted(map(repr, mixture.copies(docs.repartition(3)).collect())) == sorted(map(repr, got))


def test_mixture_of_hot_and_full_sources(spark, table_of):
    """A source with most tokens, one of 3 words (its target is full), one of empty texts, one hot class."""
    rows = ([(i, words(10), "a") for i in range(900)] + [(1000 + i, words(3 + i % 50, i), "b") for i in range(300)]
            + [(2000, "x y z", "c"), (2001, "", "d"), (2002, None, "d")])
    got = mixture.copies(table_of([(d, t, None, s) for d, t, s in rows]), slot=50).collect()
    check_mix(rows, got)
    assert [r["copies"] for r in got if r["source"] == "c"] == [3] and {r["target"] for r in got if r["source"] == "d"} == {0.0}


def test_mixture_of_few_or_no_tokens(spark, table_of):
    assert mixture.copies(table_of([])).count() == 0
    got = mixture.copies(table_of([(1, None, None, "a"), (2, " ", None, None)])).collect()
    check_mix([(1, None, "a"), (2, " ", None)], got)


def test_mixture_query(spark, sf_docs):
    got = queries.QUERIES["op13_entropy_balancing"](spark, SF_SMALL).collect()
    per = defaultdict(lambda: [0, 0, 0.0, 0])
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        s = per[sf_docs[r["doc_id"]]["source"]]
        s[:] = [s[0] + r["size"], s[1] + r["taken"], r["target"], max(s[3], r["size"])]
    want = plain_targets({s: v[0] for s, v in per.items()})
    assert len(got) == len(sf_docs) and all(math.isclose(v[2], want[s]) and abs(v[1] - v[2]) <= v[3] for s, v in per.items())
