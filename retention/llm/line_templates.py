"""Line deduplication with a log-template tree of fixed depth.

A line's leaf in the tree is its number of tokens and its first ``DEPTH``
tokens; a token with a digit counts as a variable field there and everywhere
(``<*>``). Inside a leaf, a token is constant at its position when at least
``MIN_DOCS`` lines of the leaf have it there, and variable otherwise. The line's
template is its leaf with variable positions generalised; it stands for the line
if at least ``SIMILARITY`` of the fields without digits are constant. A template
found in ``MIN_DOCS`` documents recurs: its first line (smallest doc_id, then
position) stays, its others are dropped.

In a leaf of more than ``MIN_DOCS / SHARE`` lines the values of a variable field
reach ``MIN_DOCS`` by the size of the leaf alone. There a line has a second, wider
template of the tokens that at least ``SHARE`` of the leaf's lines have at their
position, under the same conditions, and goes if either recurs before it. Lines of
one template share the wider one, too, so the first line of the wider one stays.

The tree is never held in one place: leaves, then tokens of their positions,
then templates are counted by Spark with partial sums. A bit filter of fixed
size carries the frequent leaves to the second scan; it errs only towards more
lines to look at. Equal lines are collapsed before they are taken apart.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.llm.common import columns_of, ids_and_text, shielded, stored, table, texts

DEPTH, MIN_DOCS, SIMILARITY, SHARE = 3, 5, 0.75, 0.05
FIELD = b"<*>"
#: Bits of the filter of frequent leaves (2 MB).
FILTER_BITS = 24

_DIGIT = re.compile(rb"\S*\d\S*")


def fields(line: bytes) -> list[bytes]:
    """Tokens of a line; those with a digit become ``<*>``."""
    return (_DIGIT.sub(FIELD, line) if re.search(rb"\d", line) else line).split()


def leaf_of(tokens: list[bytes], depth: int = DEPTH) -> int:
    return xxhash.xxh64_intdigest(b"%d " % len(tokens) + b" ".join(tokens[:depth]))


def _leaves(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: list[int] = []
            for t in texts(b):
                seen += {leaf_of(f, depth) for line in set(t.split(b"\n")) if (f := fields(line))}
            leaf, n = np.unique(np.array(seen, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(leaf.view(np.int64)), pa.array(n, pa.int64())], ["leaf", "n"])
    return run


def _filter(leaves: DataFrame) -> np.ndarray:
    rows = (leaves.groupBy(F.shiftrightunsigned("leaf", 64 - FILTER_BITS + 5).cast("int").alias("word"))
            .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(leaf, {64 - FILTER_BITS}) & 31 as int))")).alias("bits"))
            .collect())
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    for r in rows:
        out[r["word"]] = r["bits"]
    return out


def _candidates(depth: int, filt: np.ndarray):
    """(doc_id, text_hash, n_lines, lines: [(no, leaf, masked line)]) of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, bits = 64 - FILTER_BITS, memoryview(filt)
        kind = pa.list_(pa.struct([("no", pa.int32()), ("leaf", pa.int64()), ("key", pa.binary()), ("masked", pa.binary())]))
        for b in batches:
            out, n_lines = [], []
            for t in texts(b):
                found, lines = [], t.split(b"\n")
                n_lines.append(len(lines))
                for no, line in enumerate(lines):
                    if f := fields(line):
                        leaf = leaf_of(f, depth)
                        slot = leaf >> shift
                        if bits[slot >> 5] >> (slot & 31) & 1:
                            masked = b" ".join(f)
                            found.append((no, leaf - (leaf >> 63 << 64), xxhash.xxh3_128_digest(masked), masked))
                out.append(found)
            flat = [x for found in out for x in found]
            ends = np.cumsum([0] + [len(found) for found in out]).astype(np.int32)
            cols = list(zip(*flat)) if flat else [[], [], [], []]
            lines = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cols, kind.value_type)], fields=list(kind.value_type)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n_lines, pa.int64()), lines], ["doc_id", "text_hash", "n_lines", "lines"])
    return run


def line_groups(docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text_hash, n_lines, drops array<int>): the line numbers to drop from each document.

    Rows that repeat both doc_id and text are one document. Null or empty text
    is one line without tokens, which is never dropped; neither is a line of
    variable fields only.
    """
    keyed = ids_and_text(docs).withColumn("text_hash", F.xxhash64("text"))
    leaves = (keyed.mapInArrow(_leaves(depth), "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n"))
              .where(F.col("n") >= min_docs).select("leaf"))
    rows = stored(keyed.mapInArrow(_candidates(depth, _filter(leaves)), "doc_id long, text_hash long, n_lines long, "
                                   "lines array<struct<no:int,leaf:long,key:binary,masked:binary>>"), "candidates")
    lines = rows.select("doc_id", "text_hash", F.inline("lines"))
    distinct = stored(lines.groupBy("key").agg(F.first("leaf").alias("leaf"), F.first("masked").alias("masked"),
                                               F.count("*").alias("n")), "lines")
    tokens = (distinct.select("key", "leaf", "n", F.posexplode(F.split(F.col("masked").cast("string"), " ")).alias("pos", "token"))
              .where(F.col("token") != FIELD.decode()))
    large = distinct.groupBy("leaf").agg(F.sum("n").alias("size")).where(F.col("size") * SHARE > min_docs)
    constant = (tokens.groupBy("leaf", "pos", "token").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs)
                .join(large, "leaf", "left")
                .select("leaf", "pos", "token", F.coalesce(F.col("n") >= SHARE * F.col("size"), F.lit(True)).alias("wide")))
    marked = tokens.join(constant, ["leaf", "pos", "token"], "left")

    def template_of(kept: str):
        stands = (F.size(kept) > 0) & (F.size(kept) >= similarity * F.col("fields"))
        return F.when(stands, F.sha2(F.to_json(F.struct("leaf", F.col(kept).alias("kept"))), 256))
    template = (marked.groupBy("key").agg(
        F.first("leaf").alias("leaf"), F.count("*").alias("fields"),
        F.array_sort(F.collect_list(F.when(F.col("wide").isNotNull(), F.struct("pos", "token")))).alias("narrow"),
        F.array_sort(F.collect_list(F.when(F.col("wide"), F.struct("pos", "token")))).alias("broad"))
        .select("key", F.array_distinct(F.array_compact(F.array(template_of("narrow"), template_of("broad")))).alias("templates"))
        .where(F.size("templates") > 0))
    placed = stored(lines.select("doc_id", "text_hash", "no", "key").join(template, "key")
                    .select("doc_id", "text_hash", "no", F.explode("templates").alias("template")), "placed")
    order = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "text_hash", "no")
    recurring = (placed.groupBy("template", "doc_id", "text_hash").agg(F.min("no").alias("no"))
                 .groupBy("template").agg(F.count("*").alias("docs"), F.min(order).alias("first"))
                 .where(F.col("docs") >= min_docs).select("template", "first"))
    drops = (placed.join(recurring, "template").where(order != F.col("first"))
             .groupBy("doc_id", "text_hash").agg(F.collect_set("no").alias("drops"))
             .withColumnsRenamed({"doc_id": "__id", "text_hash": "__hash"}))
    return (rows.select("doc_id", "text_hash", "n_lines").dropDuplicates(["doc_id", "text_hash"])
            .join(drops, F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("text_hash").eqNullSafe(F.col("__hash")), "left")
            .select("doc_id", "text_hash", "n_lines", "drops"))


def drop_lines(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """``docs`` with the lines in ``groups`` (see ``line_groups``) taken out of ``text``, and
    __n_lines, __n_dropped long (``docs`` has no columns of these names, nor others that begin
    with two underscores; see ``common.shielded``); null text stays null."""
    found = groups.withColumnsRenamed({c: f"__{c}" for c in groups.columns})
    joined = docs.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col("__doc_id"))
                       & F.xxhash64(F.col("text").cast("string")).eqNullSafe(F.col("__text_hash")), "left")
    # The row number keeps later filters above this step; below it they would split again for every line.
    split = joined.withColumn("__lines", F.when(F.col("__drops").isNotNull() & (F.monotonically_increasing_id() >= 0),
                                                F.split("text", "\n")))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "__drops")
    text = F.when(F.col("__lines").isNull(), F.col("text")).otherwise(
        F.concat_ws("\n", F.transform(kept, lambda i: F.get("__lines", i))))
    dropped = F.when(F.col("__drops").isNull(), 0).otherwise(F.size("__drops")).cast("long")
    return (split.withColumn("text", text).withColumn("__n_dropped", dropped)
            .select(*columns_of(docs), "__n_lines", "__n_dropped"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` (same columns, whatever their names) without recurring lines; ``n_chars`` follows where there is one.

    A document that loses all its words this way goes; one that had none before stays. An
    empty table stays empty; a very long text is one row of lines.
    """
    kind = dict(docs.dtypes).get("n_chars")
    docs, back = shielded(docs, "doc_id", "text", "n_chars")
    groups = line_groups(docs).where("drops is not null")
    out = drop_lines(docs, groups).where(
        (F.col("__n_dropped") == 0) | (F.btrim("text", F.lit(" \t\n\u000b\f\r")) != ""))
    if kind is not None:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return out.select(*back)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_lines(docs, line_groups(docs)).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), "text")
