"""Scalar helpers on hand-made values (FIXTURES.md 3.4)."""

import math

from pyspark.sql import functions as F

from retention.functions import (guarded_corr, safe_bigint, safe_divide,
                                 safe_double, snake_case, title_label, ws_trim)


def _one(spark, col, rows, schema="x string"):
    df = spark.createDataFrame([(r,) for r in rows], schema)
    return [r[0] for r in df.select(col).collect()]


def test_safe_double_rejects_java_suffixes(spark):
    got = _one(spark, safe_double("x"), ["12.5", "1e3", "5d", "1f", "0x1A", "inf", "NaN", "", " 7 ", None, "bad"])
    assert got[:2] == [12.5, 1000.0]
    assert got[2] is None and got[3] is None and got[4] is None
    assert math.isinf(got[5]) and math.isnan(got[6])
    assert got[7] is None and got[8] == 7.0 and got[9] is None and got[10] is None


def test_safe_bigint(spark):
    got = _one(spark, safe_bigint("x"), ["12", "12.5", "1e3", "0x1A", "-3", "9223372036854775808", "\t5\n", ""])
    assert got == [12, None, None, 26, -3, None, 5, None]


def test_ws_trim_unicode(spark):
    got = _one(spark, ws_trim("x"), ["\tYes\n", " No ", " a b ", "　x"])
    assert got == ["Yes", "No", "a b", "x"]


def test_title_label(spark):
    got = _one(spark, title_label("x"), ["yes ", " NO", None, "Yes"])
    assert got == ["Yes", "No", "Nan", "Yes"]


def test_safe_divide(spark):
    df = spark.createDataFrame([(5.0, 0), (5.0, 2), (None, 1), (1.0, None)], "a double, b bigint")
    assert [r[0] for r in df.select(safe_divide("a", "b")).collect()] == [None, 2.5, None, None]


def test_guarded_corr_constant_and_single_row(spark):
    const = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], "a double, b double")
    assert const.agg(guarded_corr("a", "b")).first()[0] is None
    one = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert one.agg(guarded_corr("a", "b")).first()[0] is None
    empty = spark.createDataFrame([], "a double, b double")
    assert empty.agg(guarded_corr("a", "b")).first()[0] is None
    pairs = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, None), (4.0, 8.0)], "a double, b double")
    r = pairs.agg(guarded_corr("a", "b")).first()[0]
    assert abs(r - 0.99982) < 1e-4


def test_snake_case_headers():
    assert snake_case("customerID") == "customer_id"
    assert snake_case("StreamingTV") == "streaming_tv"
    assert snake_case("Monthly Charges") == "monthly_charges"
    assert snake_case("__Total--Charges__") == "total_charges"


def test_snake_case_words():
    from retention.functions import snake_case
    for given, want in {"customerID": "customer_id", "SeniorCitizen": "senior_citizen", "  Total Charges ": "total_charges",
                        "a--B__c": "a_b_c", "X1Y": "x1_y", "__x__": "x", "ABC": "abc", "é1": "1", "": ""}.items():
        assert snake_case(given) == want
