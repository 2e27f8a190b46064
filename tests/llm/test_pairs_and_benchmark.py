"""Preference pairs and decontamination: DuckDB, brute force, awkward rows."""

import re

import duckdb
import pytest

from llm_tables import SF_SMALL, awkward, sf_docs, table_of  # noqa: F401 - fixtures
from retention.llm import decontaminate as dc
from retention.llm import preferences as pf
from retention.llm import queries
from tools.oracle_check import TABLES, digest


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(queries.SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns) and digest(df.columns, rows) == digest(cols, res.fetchall())


TURNS = "conv_id long, turn long, role string, text string"


def test_longest_common_prefix(spark):
    chats = {0: [("system", "be kind"), ("user", "hi"), ("assistant", "hello"), ("user", "more"), ("assistant", "yes")],
             1: [("system", "be kind"), ("user", "hi"), ("assistant", "hello"), ("user", "more"), ("assistant", "no"), ("user", "?")],
             2: [("user", "same")], 3: [("user", "same")],
             4: [("user", "a"), ("assistant", "b")], 5: [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")],
             6: [(None, None), ("assistant", "x")], 7: [("", ""), ("assistant", "y")], 8: [("user", "alone")]}
    rows = [(i, n, *t) for i, c in chats.items() for n, t in enumerate(c)]
    rows += [(6, 1, "assistant", "x"), (None, 0, "user", "nobody")]  # a repeated row, and one without id
    t = spark.createDataFrame(rows, TURNS)
    out = {r.pair_id: r for r in pf.format_pairs(t, pf.neighbours(t)).collect()}
    assert set(out) == {0, 1, 2, 3}
    r = out[0]
    assert r.n_prompt_turns == 4 and r.prompt == "".join(f"<|{a}|>\n{b}<|end|>\n" for a, b in chats[0][:4])
    assert r.chosen == "<|assistant|>\nyes<|end|>\n" and r.rejected == "<|assistant|>\nno<|end|>\n<|user|>\n?<|end|>\n"
    for text, spans, said in ((r.chosen, r.chosen_spans, "yes"), (r.rejected, r.rejected_spans, "no")):
        assert [text[s.start:s.stop] for s in spans] == [said + "<|end|>\n"]
    assert r.usable and not out[1].usable and (out[1].chosen, out[1].rejected) == ("", "")
    assert out[2].n_prompt_turns == 2 and out[2].chosen == "" and out[2].rejected.endswith("d<|end|>\n") and not out[2].usable
    assert out[3].n_prompt_turns == 1 and out[3].usable
    assert pf.format_pairs(spark.createDataFrame([], TURNS), pf.neighbours(spark.createDataFrame([], TURNS))).count() == 0
    assert not re.search("Python|Pandas|Arrow", pf.format_pairs(t, pf.neighbours(t))._jdf.queryExecution().executedPlan().toString())


def test_swapped_answers_share_a_prompt(spark):
    """Every conversation has a row; the prompt is all before its last assistant turn."""
    chats = {0: [("user", "hi"), ("assistant", "hello"), ("user", "more"), ("assistant", "yes"), ("user", "bye")],
             5: [("user", "q"), ("assistant", "five")], 9: [("user", "no answer")], 64: [("assistant", "alone")],
             200: [("user", "a"), ("assistant", "same")], 201: [("user", "b"), ("assistant", "same")], 63: [(None, None), ("assistant", "z")]}
    rows = [(i, n, *t) for i, c in chats.items() for n, t in enumerate(c)] + [(5, 1, "assistant", "five"), (None, 0, "user", "nobody")]
    both, pairs = pf.swapped_answers(spark.createDataFrame(rows, TURNS))
    donors = {r.pair_id: r.donor_id for r in pairs.collect()}
    assert donors == {0: 5, 5: 63, 63: 0, 9: None, 64: 64, 200: 201, 201: 200}
    out = {r.pair_id: r for r in pf.format_pairs(both, pairs).collect()}
    assert {i: r.n_prompt_turns for i, r in out.items()} == {0: 3, 5: 1, 63: 1, 9: 1, 64: 1, 200: 2, 201: 2}
    show = lambda turns: "".join(f"<|{a or ''}|>\n{b or ''}<|end|>\n" for a, b in turns)
    assert out[0].prompt == show(chats[0][:3]) and out[0].chosen == show(chats[0][3:])
    assert out[0].rejected == show([("assistant", "five"), ("user", "bye")]) and out[0].usable and out[5].usable and out[63].usable
    assert not any(out[i].usable or out[i].chosen for i in (9, 64, 200, 201))
    empty = pf.swapped_answers(spark.createDataFrame([], TURNS))
    assert pf.format_pairs(*empty).count() == 0


def test_prompt_and_completions_are_the_conversations(spark):
    """Exact round trip: prompt + completion is each side's whole rendering."""
    t = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    whole = {r.conv_id: "".join(x.shown for x in r.turns) for r in pf.rendered_turns(t).collect()}
    pairs = spark.createDataFrame([(i, i, (i * 7) % len(whole)) for i in whole], "pair_id long, chosen_id long, rejected_id long")
    for r in pf.format_pairs(t, pairs).collect():
        assert r.prompt + r.chosen == whole[r.chosen_id] and r.prompt + r.rejected == whole[r.rejected_id]
        assert "".join(r.chosen[s.start:s.stop] for s in r.chosen_spans).count("<|end|>") == len(r.chosen_spans)


def plain_words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def expected_hits(docs, items):
    windows = {}
    for i, t in items:
        w = plain_words(t)
        n = min(10, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[s:s + n]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, found = plain_words(t), set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                if (k := tuple(w[s:s + n])) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[k]
        out.append((d, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def test_contamination_awkward(spark, table_of, awkward):
    from llm_tables import words
    items = [(1, words(30, 3)), (2, words(12, 3)), (3, None), (4, ""), (5, "one"), (6, "No, ID!"), (None, "ünï d"),
             (7, words(30, 3)), (7, words(30, 3)), (11, "w " * 25)]
    docs = awkward + [(20, "W w w " * 9), (21, "w " * 9), (22, words(60, 3)[:40]), (23, "ONE.two"), (24, words(9, 3))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = dc.contamination(table_of(docs, extra=True), bench).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got], key=key) == sorted(expected_hits(docs, items), key=key)
    left = dc.decontaminate(table_of(docs, extra=True), bench)
    hit = {(d, t) for (d, t), e in zip(docs, expected_hits(docs, items)) if e[2]}
    assert sorted(map(str, [(r.doc_id, r.text) for r in left.collect()])) == sorted(str(d) for d in docs if d not in hit)
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.decontaminate(table_of(docs), none).count() == len(docs)
    assert dc.contamination(table_of([]), bench).count() == 0
