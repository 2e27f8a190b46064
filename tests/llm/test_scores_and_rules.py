"""Language-model scores and certified quality rules against plain versions."""

import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_tables import SF_SMALL, awkward, sf_docs, table_of, words  # noqa: F401 - fixtures
from retention.llm import ppm
from retention.llm import quality_rules as qr


# ---- prediction by partial matching

class PlainModel:
    def __init__(self, texts):
        self.count = [collections.defaultdict(collections.Counter) for _ in range(ppm.ORDER + 1)]
        for t in texts:
            b = bytes(ppm.ORDER) + t + b"\0"
            for i in range(ppm.ORDER, len(b)):
                for k in range(ppm.ORDER + 1):
                    self.count[k][b[i - k:i]][b[i]] += 1

    def log10(self, before, symbol):
        out, gone = 0.0, set()
        for k in range(ppm.ORDER, -1, -1):
            seen = {s: n for s, n in self.count[k].get(before[ppm.ORDER - k:], {}).items() if s not in gone}
            if seen:
                size = sum(seen.values()) + len(seen)
                if symbol in seen:
                    return out + math.log10(seen[symbol] / size)
                out += math.log10(len(seen) / size)
                gone |= set(seen)
        return out - math.log10(256 - len(gone))

    def score(self, t):
        b = bytes(ppm.ORDER) + t + b"\0"
        return sum(self.log10(b[i - ppm.ORDER:i], b[i]) for i in range(ppm.ORDER, len(b)))


def held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1


def expected_scores(docs, scored):
    train = [(t or "").encode() for i, t in docs if not held(i)]
    count = collections.Counter(w for t in train for w in [*t.lower().split(), None])
    n, v, model, out = sum(count.values()), len(count), PlainModel(train), []
    for i, t in scored:
        w = [*(t or "").encode().lower().split(), None]
        out.append((i, held(i), len(w), sum(count[x] > 0 for x in w), n,
                    sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), model.score((t or "").encode())))
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[6], 3))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    np.testing.assert_allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


@pytest.mark.parametrize("block", [60_000, ppm.BLOCK])
def test_score_query_against_plain_model(spark, sf_docs, block):
    docs = [(i, r["text"]) for i, r in sf_docs.items()]
    some = [d for d in docs if len(d[1]) < 1200]
    rows = (ppm.query(spark, SF_SMALL) if block == ppm.BLOCK else
            ppm.scores(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), block)).collect()
    got = {r.doc_id: r for r in rows}
    assert len(got) == len(docs)
    same([got[i] for i, _ in some], expected_scores(docs, some))


def test_probabilities_add_up():
    texts = [b"abracadabra", b"banana band", b"", bytes(range(250)), b"a" * 40]
    keys, counts = ppm.block_grams(texts, [True] * len(texts))
    pairs = np.bincount((keys & np.uint64(0xFFFF)).astype(np.int64), counts, 1 << 16).astype(np.int64)
    trie = ppm.Trie(keys, counts, pairs)
    for before in (b"abra", b"cada", b"zzzz", b"\0\0\0\0", b"nana", b"\xff\xff\xffa"):
        all_next = np.array([int.from_bytes(before + bytes([s]), "big") for s in range(256)], np.uint64)
        assert abs(sum(10 ** trie.log10(all_next)) - 1) < 1e-9
        plain = PlainModel(texts)
        np.testing.assert_allclose(trie.log10(all_next), [plain.log10(before, s) for s in range(256)], rtol=1e-9, atol=1e-12)


def test_held_out_text_is_likelier_than_noise(spark, sf_docs):
    """Held-out accuracy: words in a text's own order score above the same bytes shuffled."""
    docs = [(i, r["text"]) for i, r in sf_docs.items()]
    model = PlainModel([t.encode() for i, t in docs if not held(i)])
    rng, wins, tried = np.random.default_rng(1), 0, 0
    for i, t in docs:
        if held(i) and 200 < len(t) < 1500:
            mixed = bytes(rng.permutation(np.frombuffer(t.encode(), np.uint8)))
            wins, tried = wins + (model.score(t.encode()) > model.score(mixed)), tried + 1
    assert tried > 5 and wins == tried


def test_scores_awkward(spark, table_of, awkward):
    rows = ppm.scores(table_of(awkward, extra=True)).collect()
    same(rows, expected_scores(awkward, awkward))
    assert ppm.scores(table_of([])).count() == 0
    only = next(i for i in range(100) if held(i))
    (r,) = ppm.scores(table_of([(only, "ab")])).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (2, 0, 0) and abs(r.score + 3 * math.log10(256)) < 1e-9


# ---- quality rules

def counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    three = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {i + j for i in range(len(w) - 2) if three[tuple(w[i:i + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def base(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_rule_query_counts(spark, sf_docs):
    rows = qr.query(spark, SF_SMALL).collect()
    assert {r.doc_id: base(r) for r in rows} == {i: counts(r["text"]) for i, r in sf_docs.items()}
    assert not any(r.kept and r.base_failed for r in rows)


def labelled(n=1200):
    """Good prose, symbol junk and toxic prose in two languages, some of it labelled."""
    rows, labels = [], []
    for i in range(n):
        kind = i % 6
        text = words(70, seed=i * 5, step=3 + i % 5) + " n" + "".join(chr(97 + int(x)) for x in str(i))  # no two are equal
        if kind == 4:
            text = " ".join(w + "$$$" for w in text.split())
        if kind == 5:
            text = " ".join(w if j % 9 else ("vilely", "grimly", "fouly")[(i // 6 + j // 9) % 3] for j, w in enumerate(text.split()))
        rows.append((i, text, "en" if i % 2 else "fr", "s", len(text)))
        if i % 3 != 2 or kind == 5:
            labels.append((i, int(kind != 4), int(kind == 5)))
    return rows, labels


def test_rules_catch_bad_and_leave_good(spark, table_of):
    rows, labels = labelled()
    kept = {r.doc_id for r in qr.accept(table_of(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    good = {r[0] for r in rows if r[0] % 6 < 4 and not counts(r[1])[-1]}
    bad = {r[0] for r in rows if r[0] % 6 >= 4}
    assert len(good) > 500 and good <= kept
    assert len(bad & kept) <= 0.02 * len(bad)


def test_certificate_is_the_exact_binomial_tail(spark, table_of):
    rows, labels = labelled()
    docs = table_of(rows)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    lexicon = qr.toxic_words(docs, lab)
    assert {"vilely", "grimly", "fouly"} <= set(lexicon)
    measured = qr.measure(docs.select(F.col("doc_id").alias("__id"), "text", F.col("lang").alias("__stratum")), lexicon)
    found = {r.stratum: r.cutoffs for r in qr.calibrate(measured, lab).collect()}
    halves = {r["__id"]: r["half"] for r in measured.select("__id", qr._half(F.col("m.text_hash")).alias("half")).collect()}
    good = {i for i, q, t in labels if q == 1 and t == 0}
    by_id = {i for i, _, _ in labels}
    families = 3 * len(qr.RULES)

    def tail(n, k):
        return sum(math.comb(n, j) * qr.LIMIT**j * (1 - qr.LIMIT)**(n - j) for j in range(k + 1))
    for stratum, cutoffs in found.items():
        n = {r[1]: r for r in rows if halves[r[0]] == 1 and stratum in ("*", r[2]) and not counts(r[1])[-1] and r[0] in by_id}
        n = [r for t, r in n.items() if all(x[0] in good for x in rows if x[1] == t and x[0] in by_id and stratum in ("*", x[2]))]
        if "symbols" in cutoffs:
            k = sum(counts(r[1])[2] / counts(r[1])[0] > cutoffs["symbols"] for r in n)
            assert tail(len(n), k) <= qr.DELTA / families
    assert "symbols" in found["fr"] and "toxic" in found["en"] and set(found["*"]) >= {"symbols", "toxic"}


def test_rules_without_labels_and_awkward(spark, table_of, awkward):
    docs = table_of(awkward, extra=True)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = qr.judge(docs, none)
    assert out.columns == docs.columns + ["__m", "__base_failed", "__kept"]
    rows = out.collect()
    assert len(rows) == len(awkward)
    for r in rows:
        m = r["__m"]
        assert (*[m[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], r["__base_failed"]) == counts(r.text)
        assert r["__kept"] == (not r["__base_failed"])
    odd = spark.createDataFrame([(None, 1, 0), (6, None, 1), (6, 1, None), (6, 0, 0), (999, 0, 1)], "doc_id long, quality int, toxic int")
    assert qr.accept(docs, odd).columns == docs.columns
    assert qr.accept(table_of([]), none).count() == 0


def test_rules_run_without_python(spark):
    plan = qr.query(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def signals(spark, n, stratum, symbols):
    """(__id, __stratum, m) of ``n`` rows of 100 words; SQL over id gives the stratum and the number of symbols."""
    return spark.range(n).selectExpr("id as __id", f"{stratum} as __stratum", f"""named_struct('n_words', 100L, 'word_chars', 500L,
        'n_symbols', cast({symbols} as bigint), 'n_dup_lines', 0L, 'n_repeat_words', 0L, 'n_lines', 5L, 'n_capitals', 0L,
        'n_toxic', 0L, 'text_hash', id) as m""")


def test_pooled_cutoff_only_where_labels_are_too_few(spark):
    """xx: good rows full of symbols; ww: no bad rows; yy: ten labels; zz: none; the rest is en, a fifth of it bad."""
    stratum = """case when id >= 20000 then 'zz' when id % 50 = 0 then 'xx' when id % 50 = 1 then 'ww'
                 when id % 2000 = 7 then 'yy' else 'en' end"""
    measured = signals(spark, 20100, stratum, "if(id % 50 = 0 or id % 10 in (3, 7), 100, 0)")
    labels = spark.range(20000).selectExpr("id as doc_id", "if(id % 10 in (3, 7), 0, 1) as quality", "0 as toxic")
    cutoffs = qr.calibrate(measured, labels)
    found = {r.stratum: r.cutoffs for r in cutoffs.collect()}
    assert found["*"]["symbols"] < 1 and found["en"]["symbols"] < 1
    assert found["xx"]["symbols"] == found["ww"]["symbols"] == math.inf and "yy" not in found and "zz" not in found
    rows = qr._verdict(measured, cutoffs).groupBy("__stratum").agg(
        F.count_if("__kept").alias("kept"), F.count_if(F.col("m.n_symbols") == 0).alias("clean"), F.count("*").alias("n")).collect()
    rows = {r["__stratum"]: r for r in rows}
    assert rows["xx"].kept == rows["xx"].n == 400
    assert all(rows[s].kept == rows[s].clean for s in ("en", "ww", "yy", "zz")) and rows["yy"].clean == 0 < rows["zz"].clean


def test_copies_count_once(spark):
    """3,000 labelled copies of one good text are one trial: they certify nothing."""
    measured = signals(spark, 3000, "'en'", "0").withColumn("m", F.col("m").withField("text_hash", F.lit(7).cast("long")))
    labels = spark.range(3000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    assert qr.calibrate(measured, labels).count() == 0


def test_cutoffs_rest_on_all_labels(spark):
    """A language with 400 of 300,000 labels, 200 of them good, has its own certificate."""
    measured = signals(spark, 300_000, "if(id % 1000 in (0, 1) and id < 200000, 'rare', 'en')", "if(id % 2 = 1, 100, 0)")
    labels = spark.range(300_000).selectExpr("id as doc_id", "if(id % 2 = 1, 0, 1) as quality", "0 as toxic")
    found = {r.stratum: r.cutoffs for r in qr.calibrate(measured, labels).collect()}
    assert found["rare"]["symbols"] < 1 and found["en"]["symbols"] < 1
