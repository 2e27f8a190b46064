"""Small tables for the training-data operators, among them the awkward ones."""

import pyarrow.parquet as pq
import pytest

SF_SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"
#: Columns that clash with names the operators use, and one with a dot.
EXTRA = ("row long, fp string, text_hash string, n_words string, m string, found string, `a.b` string, first string, "
         "__id string, __hash string, __rows string, __lines string, __drops string, __n_lines string, __n_dropped string, "
         "__in_0 string, __stratum string, __cutoffs string")


def words(n, seed=0, step=7):
    """``n`` distinct-looking words, the same for the same seed."""
    return " ".join(f"w{chr(97 + (seed + i) % 26)}{chr(97 + (seed * 3 + i * step) % 26)}{chr(97 + i // 26 % 26)}x" for i in range(n))


@pytest.fixture(scope="session")
def sf_docs():
    return {r["doc_id"]: r for r in pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()}


@pytest.fixture(scope="session")
def table_of(spark):
    def make(rows, schema=SCHEMA, extra=False):
        if not extra:
            return spark.createDataFrame([tuple(r) + (None,) * (5 - len(r)) for r in rows], schema)
        return spark.createDataFrame([tuple(r) + (None,) * (5 - len(r)) + (7, *["x"] * 17) for r in rows], f"{SCHEMA}, {EXTRA}")
    return make


@pytest.fixture(scope="session")
def awkward():
    """Nulls, empties, white space, ties, repeated rows, one very long text, one long word."""
    long_text = "\n".join(words(40, seed=i) for i in range(600))
    return [(1, None), (2, ""), (3, " \n\t\x0b\x0c\r "), (4, "one"), (5, "one"), (5, "one"), (None, "no id"), (None, None),
            (6, words(60, 3)), (7, words(60, 3)), (8, words(60, 3)), (8, words(60, 3)), (9, "a\n\n\nb\n"),
            (10, long_text), (11, "é" * 5000), (12, "x" * 30000), (13, "Ünï   \x1c \x00 d")]
