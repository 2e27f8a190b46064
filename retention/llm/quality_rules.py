"""Quality rules whose cutoffs are certified on labelled documents.

Every rule rejects a document whose signal exceeds a cutoff. Candidate cutoffs
are a fixed grid, most lenient first. For each stratum (language) and rule the
labelled texts are split in two by a hash of the text. Each different text counts once (at its
worst label), so copies neither fall on both sides nor pass for independent trials:

* the certifying half gives, for each cutoff, how many good documents it
  rejects. The cutoff passes if ``P(Bin(n, LIMIT) <= k)``, the exact binomial
  tail, is at most ``DELTA`` divided by the number of (stratum, rule) families
  (Bonferroni); inside a family cutoffs are tested in order and the first
  failure ends it (fixed-sequence testing), which needs no further correction.
  So with probability 1 - DELTA no rule in force rejects more than LIMIT of a
  stratum's good documents.
* the fitting half picks, among the certified cutoffs, the one that catches
  most bad documents at ``COST`` bad ones for each good one it loses; a rule
  that gains nothing stays off. The toxic word list comes from this half, too.

A (stratum, rule) whose certifying half is too small to pass even with no good
document rejected uses the cutoff of all strata together (stratum ``*``), which
then holds for the mixture only. Where the half is large enough and the test failed
or the rule gains nothing, the rule is off in that stratum: its cutoff is infinite.

All of it is built-in column functions, aggregates and joins. The cutoffs rest on
all labels: these are joined by id and only counts for each (stratum, rule, cutoff)
are left, from which the tail is summed (a term for each good document lost, LIMIT
of them at most). The word list is fitted on ``LEXICON_ROWS`` labels by smallest
hash of the id, so their broadcast has a fixed bound.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retention.llm.common import shielded, stored, table

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
LIMIT, DELTA, COST = 0.05, 0.1, 5.0
LEXICON_ROWS = 20_000
LEXICON_SIZE, LEXICON_DOCS, LEXICON_RATIO = 1_000, 4, 20.0

#: Fixed values of the contract: white space, symbols.
SPACE, SYMBOLS = " \t\n\u000b\f\r", "#*$%&|<>"
_SPLIT = r"[\x20\x09-\x0D]+"

#: Rule -> (signal over the columns of ``measure``, cutoffs from lenient to strict).
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols": ("n_symbols / greatest(n_words, 1)", [2.0, 1.0, 0.7, 0.5, 0.35, 0.25, 0.15, 0.1]),
    "capitals": ("n_capitals / greatest(word_chars, 1)", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3]),
    "same_lines": ("n_dup_lines / greatest(n_lines, 1)", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3]),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", [0.45, 0.4, 0.35, 0.3, 0.25, 0.2]),
    "toxic": ("n_toxic", [8.0, 5.0, 3.0, 2.0, 1.0, 0.0]),
}


def _occurrences(text: Column, char_class: str) -> Column:
    return F.size(F.split(text, char_class)) - 1


def _plain_words(text: Column) -> Column:
    """Lower-case words without ASCII punctuation, for the word list."""
    return F.split(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def measure(docs: DataFrame, lexicon: list[str]) -> DataFrame:
    """``docs`` with one column ``m``: a struct of the contract's counts and the rules' signals.

    Null text counts as empty. Each step is a projection over a column of the
    step before, so nothing is computed twice and no row leaves its partition.
    ``m`` hangs on a row number so that no later filter is pushed below it: there
    its condition would compute the word list again for every element.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACE))
    d = docs.withColumn("__w", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPLIT)))
    d = d.withColumn("__l", F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != ""))
    three = F.when(F.size("__w") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("__w") - 3), lambda i: F.xxhash64(
            F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2)))).otherwise(F.array().cast("array<bigint>"))
    d = d.withColumn("__h", three)
    repeated = F.size(F.array_distinct("__h")) < F.size("__h")
    d = d.withColumn("__s", F.when(repeated, F.sort_array(
        F.transform("__h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    d = d.withColumn("__p", F.expr(
        "sort_array(transform(filter(transform(__s, (x, j) -> named_struct('i', x.i, 'twice', "
        "x.h <=> get(__s, j - 1).h or x.h <=> get(__s, j + 1).h)), x -> x.twice), x -> x.i))"))
    covered = F.expr("coalesce(aggregate(__p, named_struct('e', 0, 'n', 0L), (a, x) -> "
                     "named_struct('e', x + 3, 'n', a.n + (x + 3 - greatest(a.e, x))), a -> a.n), 0L)")
    toxic = F.size(F.array_intersect(_plain_words(text), F.array(*[F.lit(w) for w in lexicon]))) if lexicon else F.lit(0)
    return d.withColumn("m", F.when(F.monotonically_increasing_id() >= 0, F.struct(
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        _occurrences(text, f"[{SYMBOLS}]").cast("long").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"), F.size("__l").cast("long").alias("n_lines"),
        _occurrences(text, "[A-Z]").cast("long").alias("n_capitals"),
        toxic.cast("long").alias("n_toxic"), F.xxhash64(text).alias("text_hash")))).drop("__w", "__l", "__h", "__s", "__p")


def base_failed() -> Column:
    return (F.col("m.n_words") < MIN_WORDS) | (100 * F.col("m.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("m.n_words"))


def _signals() -> list[Column]:
    import re
    names = r"\b(n_words|word_chars|n_symbols|n_dup_lines|n_repeat_words|n_lines|n_capitals|n_toxic)\b"
    return [F.expr(re.sub(names, r"m.\1", expr)).cast("double").alias(rule) for rule, (expr, _) in RULES.items()]


def _half(text_hash: Column) -> Column:
    """0: the text is for fitting, 1: for certifying."""
    return F.pmod(F.xxhash64(F.lit("half"), text_hash), F.lit(2))


def _labelled(labels: DataFrame, rows: int | None = None) -> DataFrame:
    """The labels, or ``rows`` of them at most (smallest hash of the id first): __id, toxic, good."""
    one = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
           .agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")))
    out = one.select(F.col("doc_id").cast("long").alias("__id"), "toxic",
                     ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"))
    return out if rows is None else out.orderBy(F.xxhash64(F.lit("sample"), "__id"), "__id").limit(rows)


def toxic_words(docs: DataFrame, labels: DataFrame) -> list[str]:
    """Words far more usual in toxic documents of the fitting half than in its others, by distinct text."""
    rows = F.broadcast(_labelled(labels, LEXICON_ROWS))
    words = (docs.select(F.col("doc_id").cast("long").alias("__id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
             .join(rows, "__id").withColumn("t", F.xxhash64("text")).where(_half(F.col("t")) == 0)
             .select("toxic", "t", F.array_distinct(_plain_words(F.col("text"))).alias("w")))
    words = stored(words, "labelled_words")
    texts = words.groupBy("toxic").agg(F.count_distinct("t").alias("n")).collect()
    n = {r["toxic"]: r["n"] for r in texts}
    if not n.get(1) or not n.get(0):
        return []
    each = words.select("toxic", "t", F.explode("w").alias("word")).where("length(word) > 2").distinct()
    seen = each.groupBy("word").agg(F.count_if(F.col("toxic") == 1).alias("bad"), F.count_if(F.col("toxic") == 0).alias("ok"))
    ratio = ((F.col("bad") + 0.5) / (n[1] + 1)) / ((F.col("ok") + 0.5) / (n[0] + 1))
    top = (seen.where(F.col("bad") >= LEXICON_DOCS).withColumn("ratio", ratio).where(F.col("ratio") >= LEXICON_RATIO)
           .orderBy(F.desc("ratio"), "word").limit(LEXICON_SIZE).select("word").collect())
    return sorted(r["word"] for r in top)


def calibrate(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """(stratum, cutoffs map<rule, cutoff>): the rules settled in each stratum, infinite where off; ``*`` is all together.

    A rule is missing where the stratum has too few labels to settle it.

    ``measured``: (__id, __stratum, m) of the labelled documents at least.
    """
    grid = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(i).alias("step"), F.lit(float(c)).alias("cutoff"))
                     for rule, (_, cuts) in RULES.items() for i, c in enumerate(cuts)])
    shown = (measured.join(_labelled(labels), "__id").where(~base_failed())
             .select("__stratum", "good", "m.text_hash", F.struct(*_signals()).alias("v"))
             .select("good", "text_hash", "v", F.explode(F.array("__stratum", F.lit("*"))).alias("stratum"))
             .groupBy("stratum", "text_hash").agg(F.bool_and("good").alias("good"), F.first("v").alias("v"))
             .withColumn("half", _half(F.col("text_hash"))))
    value = F.coalesce(*[F.when(F.col("g.rule") == r, F.col(f"v.{r}")) for r in RULES])
    hits = (shown.select("stratum", "good", "half", "v", F.explode(grid).alias("g"))
            .groupBy("stratum", "g.rule", "g.step", "g.cutoff")
            .agg(F.count_if(F.expr("good and half = 1")).alias("n"),
                 F.count_if((value > F.col("g.cutoff")) & F.expr("good and half = 1")).alias("k"),
                 F.count_if((value > F.col("g.cutoff")) & F.expr("good and half = 0")).alias("lost"),
                 F.count_if((value > F.col("g.cutoff")) & F.expr("not good and half = 0")).alias("caught")))
    hits = stored(hits, "holdout")
    families = hits.select("stratum", "rule").distinct().count() or 1
    tail = F.expr(f"""case when k > {LIMIT} * n or n = 0 then 1.0D else aggregate(sequence(0L, k),
        named_struct('l', n * ln(1 - {LIMIT}D), 's', 0.0D),
        (a, j) -> named_struct('l', a.l + ln((n - j) / (j + 1.0D)) + ln({LIMIT}D / (1 - {LIMIT}D)), 's', a.s + exp(a.l)),
        a -> a.s) end""")
    failed = F.max((F.col("tail") > DELTA / families).cast("int")).over(
        Window.partitionBy("stratum", "rule").orderBy("step"))
    enough = F.max("n") * math.log(1 - LIMIT) <= math.log(DELTA / families)
    settled = (hits.withColumn("tail", tail).withColumn("failed", failed)
               .withColumn("gain", F.col("caught") - COST * F.col("lost")).groupBy("stratum", "rule")
               .agg(F.coalesce(F.expr("max_by(cutoff, struct(gain, -step)) filter (where failed = 0 and gain > 0)"),
                               F.when(enough, F.lit(math.inf))).alias("cutoff"))
               .where("cutoff is not null"))
    return settled.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))


def _stratum(stratum: str) -> Column:
    return F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("__stratum")


def _verdict(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``measured`` (with __stratum and m) and __base_failed, __kept."""
    cutoffs = stored(cutoffs, "cutoffs")
    pooled = {r["rule"]: r["cutoff"] for r in
              cutoffs.where("stratum = '*'").select(F.explode("cutoffs").alias("rule", "cutoff")).collect()}
    own = cutoffs.where("stratum <> '*'").withColumnsRenamed({"stratum": "__stratum", "cutoffs": "__cutoffs"})
    over = F.lit(False)
    for s, rule in zip(_signals(), RULES):
        cut = F.coalesce(F.col("__cutoffs")[rule], F.lit(pooled.get(rule)).cast("double"))
        over = over | F.coalesce(s > cut, F.lit(False))
    return (measured.join(own, "__stratum", "left").withColumn("__base_failed", base_failed())
            .withColumn("__kept", ~F.col("__base_failed") & ~over))


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """``docs`` with ``m`` (see ``measure``), ``base_failed`` and ``kept`` as columns __m, __base_failed, __kept,
    which ``docs`` has none of its own.

    An empty ``labels`` certifies nothing, so only the base rules reject. Labels
    of unknown documents, null ids or null quality are ignored; repeated labels
    count once, at their worst.
    """
    lexicon = toxic_words(docs, labels)
    safe, back = shielded(docs, "doc_id", "text", stratum)
    d = stored(measure(safe.withColumn("__stratum", _stratum(stratum)), lexicon), "measured")
    cutoffs = calibrate(d.select(F.col("doc_id").cast("long").alias("__id"), "__stratum", "m"), labels)
    return _verdict(d, cutoffs).select(*back, F.col("m").alias("__m"), "__base_failed", "__kept")


def accept(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The rows of ``docs`` that neither the base rules nor a certified rule rejects, with all their columns, whatever their names."""
    safe, back = shielded(docs, "doc_id", "text", stratum)
    return judge(safe, labels, stratum).where("__kept").select(*back)


def query(spark, sf_dir: str) -> DataFrame:
    """The contract's counts and the verdict; every text is measured once and what it gives is kept."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "labels")
    measured = stored(measure(docs.select(F.col("doc_id").cast("long").alias("__id"), "text", _stratum("lang")),
                              toxic_words(docs, labels)).select("__id", "__stratum", "m"), "measured")
    return _verdict(measured, calibrate(measured, labels)).select(
        F.col("__id").alias("doc_id"), "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words",
        F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept"))
