"""The corpus pipeline against a plain version of each stage on its own input."""

import re

from tokenizers import Tokenizer

import corpus_pipeline
from llm_tables import SF_SMALL, awkward, sf_docs, table_of  # noqa: F401 - fixtures
from retention.llm import quality_rules as qr
from retention.llm.common import stored, table
from retention.llm.tokens import default_path
from test_lines_and_chunks import expected_lines
from test_near_duplicates import components, fingerprint
from test_pairs_and_benchmark import expected_hits
from test_scores_and_rules import counts
from test_tokens_and_packing import check_pieces

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, str(r[1])))


def test_stages_are_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_templates", "simhash", "decontamination", "packing"]


def plain_kept(docs, cutoffs, lexicon):
    """Verdicts from counts made in Python and the certified cutoffs."""
    out = []
    for i, t, lang in docs:
        n_words, chars, symbols, dup, repeat, failed = counts(t)
        n_lines = sum(bool(x.strip(" \t\n\x0b\x0c\r")) for x in (t or "").split("\n"))
        plain = set(re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower()))
        value = {"symbols": symbols / max(n_words, 1), "capitals": sum("A" <= c <= "Z" for c in t or "") / max(chars, 1),
                 "same_lines": dup / max(n_lines, 1), "repeats": repeat / max(n_words, 1), "toxic": len(plain & set(lexicon))}
        cut = {**cutoffs.get("*", {}), **cutoffs.get(lang or "", {})}
        if not failed and not any(value[r] > c for r, c in cut.items()):
            out.append((i, t))
    return out


def test_each_stage_against_its_plain_version(spark):
    sf = SF_SMALL
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    lexicon = qr.toxic_words(docs, labels)
    measured = qr.measure(docs.selectExpr("doc_id as __id", "text", "coalesce(lang, '') as __stratum"), lexicon)
    cutoffs = {r.stratum: r.cutoffs for r in qr.calibrate(measured, labels).collect()}
    plain = Tokenizer.from_file(default_path())
    steps = dict(corpus_pipeline.STAGES)

    now = stored(steps["quality_rules"](spark, docs, sf), "a")
    assert now.columns == COLUMNS
    assert rows_of(now) == sorted(plain_kept([(r.doc_id, r.text, r.lang) for r in docs.collect()], cutoffs, lexicon))

    before = rows_of(now)
    now = stored(steps["line_templates"](spark, now, sf), "b")
    want = expected_lines(before)
    assert now.columns == COLUMNS
    assert rows_of(now) == sorted((d, want[d, t][1]) for d, t in before if not want[d, t][0] or want[d, t][1].strip())
    assert all(r.n_chars == len(r.text) for r in now.collect())

    before = rows_of(now)
    now = stored(steps["simhash"](spark, now, sf), "c")
    f = {d: fingerprint(t) for d, t in before}
    roots = components([(a, b) for a in f for b in f if a < b and (f[a] ^ f[b]).bit_count() <= 4], f)
    assert now.columns == COLUMNS and rows_of(now) == [(d, t) for d, t in before if roots[d] == d]

    before = rows_of(now)
    now = stored(steps["decontamination"](spark, now, sf), "d")
    hits = expected_hits(before, [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()])
    assert now.columns == COLUMNS and rows_of(now) == [d for d, h in zip(before, hits) if not h[2]]

    left = rows_of(now)
    pieces = steps["packing"](spark, now, sf).collect()
    check_pieces(pieces, left, lambda t: plain.encode(t, add_special_tokens=False).ids, 4096)
    assert 0 < len(left) < docs.count()

    whole = corpus_pipeline.run(spark, sf).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, whole)) == sorted(map(key, pieces))


def test_stages_on_awkward_and_empty_tables(spark, table_of, awkward, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    for rows in (awkward, []):
        docs = table_of(rows, extra=True)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            if name != "packing":
                assert out.columns == docs.columns
                docs = stored(out, name)
            else:
                assert out.count() >= docs.count()


def test_entry_lists_every_operator():
    import __spark_entry__ as entry
    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10 and "pipeline" in names
