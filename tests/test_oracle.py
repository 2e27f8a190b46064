"""Every registered query with an oracle: Spark vs DuckDB on the smallest
fixture (row count, column names, order-insensitive value digest), as the
driver does at sf0.01. Training queries are covered by test_model.py."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from retention.plans import catalog as CAT
from tools.oracle_check import TABLES, digest
from tools.type_check import SPARK_TO_DUCK

#: Fitted numbers that no other engine computes; tests/test_model.py checks them.
FITTED = {"logreg_coefficients", "model_metrics", "threshold_rows", "score_by_id_rows", "score_from_json_rows"}
NAMES = sorted(k for k in E.oracle_sql() if k in CAT.QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(CAT.QUERIES) - set(E.oracle_sql()) == FITTED


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows) == digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["contract_type", "n", "churn_rate"]
    assert df.count() > 0
