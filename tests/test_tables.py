"""Sources and sinks: CSV budget, partition writes, re-run safety, registry."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from retention.plans import registry as RG, status as ST
from retention.schemas import RAW_TEXT_SCHEMA
from retention.sources import landing as L, tables as TB

ROW = ["1", "Male", "0", "Yes", "No", "5", "Yes", "No", "DSL", "No", "No", "No", "No", "No", "No",
       "One year", "Yes", "Mailed check", "20.5", "100", "No", "2025-08-24"]


def _write_csv(path, rows):
    with open(path, "w") as f:
        f.write(",".join(RAW_TEXT_SCHEMA.fieldNames()) + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")


def _aside(spark, path):
    return {(r.reason, r.source) for r in spark.read.parquet(path).collect()}


def test_bad_record_budget_and_quarantine(spark, scratch):
    short, wrong, whole = ROW[:5], list(ROW), list(ROW)
    wrong[18], whole[5] = "abc", "3.7"  # monthly_charges, and a whole-number column
    _write_csv(f"{scratch}/ok.csv", [ROW] * 3 + [short, wrong, whole])
    assert L.load_csv(spark, f"{scratch}/ok.csv", f"{scratch}/q1", L.Budget(count=3)).count() == 3
    assert _aside(spark, f"{scratch}/q1") == {
        ("too few fields", ",".join(short)), ("monthly_charges", ",".join(wrong)), ("tenure", ",".join(whole))}
    for budget in (L.Budget(count=2), L.Budget(count=None, share=0.49)):
        with pytest.raises(L.BadRecordBudgetExceeded):
            L.load_csv(spark, f"{scratch}/ok.csv", f"{scratch}/q2", budget)
    assert len(_aside(spark, f"{scratch}/q2")) == 3  # set aside before the load fails
    assert L.load_csv(spark, f"{scratch}/ok.csv", f"{scratch}/q3", L.Budget(None, 0.5)).count() == 3
    _write_csv(f"{scratch}/many.csv", [ROW] * 3 + [short] * 1001)
    with pytest.raises(L.BadRecordBudgetExceeded):
        L.load_csv(spark, f"{scratch}/many.csv", f"{scratch}/q4")


def test_quoted_newline_and_long_rows(spark, scratch):
    q = list(ROW)
    q[1] = '"Ma\nle"'
    _write_csv(f"{scratch}/q.csv", [q, ROW + ["extra"], ROW[:3]])
    out = L.load_csv(spark, f"{scratch}/q.csv", f"{scratch}/aside").collect()
    assert len(out) == 2 and out[0].gender == "Ma\nle"


def test_counts_come_from_the_parse(spark, scratch):
    """Rows, bad rows and missing values as the write saw them; an empty file counts nothing."""
    wrong, blank = list(ROW), list(ROW)
    wrong[18], blank[18], blank[19] = "abc", "", " "
    _write_csv(f"{scratch}/a.csv", [ROW, wrong, blank, blank, ROW[:4]])
    good, counts = L.load_counted(spark, f"{scratch}/a.csv", f"{scratch}/q")
    assert counts == {"rows": 5, "bad": 2, "null_tenure": 0, "null_monthly_charges": 2, "null_total_charges": 2}
    rows, seen = TB.counted(good, blanks=F.count_if(F.col("monthly_charges").isNull()))
    TB.create_table(rows, f"{scratch}/t")
    assert seen.get == {"rows": 3, "blanks": 2} and spark.read.parquet(f"{scratch}/t").count() == 3
    _write_csv(f"{scratch}/none.csv", [])
    assert L.load_counted(spark, f"{scratch}/none.csv", f"{scratch}/q")[1]["rows"] == 0


def test_new_columns_are_loaded_by_header(spark, scratch):
    names = RAW_TEXT_SCHEMA.fieldNames()
    _write_csv(f"{scratch}/a.csv", [ROW])
    with open(f"{scratch}/b.csv", "w") as f:  # a new column in the middle, another order, one column absent
        cols = ["ingest_date", "tier"] + [c for c in names if c not in ("ingest_date", "gender")]
        f.write(",".join(cols) + "\n")
        f.write(",".join({**dict(zip(names, ROW)), "tier": "gold", "tenure": "6"}[c] for c in cols) + "\n")
        f.write(",".join({**dict(zip(names, ROW)), "tier": "tin", "tenure": "x"}[c] for c in cols) + "\n")
    good, counts = L.load_counted(spark, [f"{scratch}/a.csv", f"{scratch}/b.csv"], f"{scratch}/q", by_header=True)
    got = {(r.tenure, r.tier, r.gender, r.monthly_charges, str(r.ingest_date)) for r in good.collect()}
    assert got == {(5, None, "Male", 20.5, "2025-08-24"), (6, "gold", None, 20.5, "2025-08-24")}
    assert counts["rows"] == 3 and counts["bad"] == 1 and good.columns == [*names, "tier"]
    TB.create_or_write(spark, L.load_csv(spark, f"{scratch}/a.csv", f"{scratch}/q"), f"{scratch}/t")
    TB.create_or_write(spark, good.withColumn("ingest_date", F.date_add("ingest_date", 1)), f"{scratch}/t")
    table = TB.read_table(spark, f"{scratch}/t")
    assert {(str(r.ingest_date), r.tier) for r in table.collect()} == {("2025-08-24", None), ("2025-08-25", None), ("2025-08-25", "gold")}


@pytest.mark.parametrize("names", [("ingest_date", "tenure", "tenure"), ("ingest_date", "Tenure"), ("tenure",), ("ingest_date", "")])
def test_headers_that_are_refused(names):
    with pytest.raises(L.SchemaRefused):
        L.reconcile(names)


def test_source_reader_matches_a_plain_csv_read(spark, scratch):
    """Quoted newlines, several files, and files whose headers differ."""
    import duckdb
    import os
    os.makedirs(f"{scratch}/src/sub")
    files = {"a.csv": 'id,note,gender\n1,"two\nlines",Male\n2,"a ""word""",Female\n', "b.csv": "id,note,gender\n3,plain,Male\n",
             "sub/c.csv": "gender,id,extra\nFemale,4,x\n"}
    for name, text in files.items():
        with open(f"{scratch}/src/{name}", "w") as f:
            f.write(text)
    cols = ["id", "note", "gender", "extra"]
    got = sorted(map(tuple, L.read_source(spark, f"{scratch}/src").select(*cols).collect()))
    want = duckdb.sql(f"select id, note, gender, extra from read_csv('{scratch}/src/**/*.csv', header=true, all_varchar=true,"
                      " union_by_name=true)").fetchall()
    assert got == sorted(want) and len(got) == 4
    assert L.read_source(spark, f"{scratch}/src", first_only=True).count() == 2


def test_daily_path():
    assert L.daily_path("gs/base", "2025-08-24") == "gs/base/24-08-2025/churn_raw.csv"


def test_rerun_replaces_only_its_day(spark, scratch):
    path = f"{scratch}/t"
    d1 = spark.createDataFrame([(1, dt.date(2025, 8, 23)), (2, dt.date(2025, 8, 24))], "v int, ingest_date date")
    assert TB.create_or_write(spark, d1, path) == "created"
    day = spark.createDataFrame([(3, dt.date(2025, 8, 24))], "v int, ingest_date date")
    TB.create_or_write(spark, day, path)
    TB.create_or_write(spark, day, path)
    got = sorted((r.v, str(r.ingest_date)) for r in spark.read.parquet(path).collect())
    assert got == [(1, "2025-08-23"), (3, "2025-08-24")]


def test_partition_filter_in_plan(spark, scratch):
    path = f"{scratch}/p"
    df = spark.createDataFrame([(i, dt.date(2025, 8, 20 + i % 3)) for i in range(30)], "v int, ingest_date date")
    TB.create_table(df, path)
    from retention.operators.clean import day_lit, latest_partition
    q = spark.read.parquet(path).where(F.col("ingest_date") == day_lit("2025-08-21")).where(F.col("v") > 3)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and "PushedFilters: [IsNotNull(v), GreaterThan(v,3)]" in plan
    assert latest_partition(spark.read.parquet(path)).count() == 10


def test_status_gate(spark, scratch):
    path = f"{scratch}/status"
    with pytest.raises(ST.GateError):
        ST.assert_prev_success(spark, path, "r1", "load_raw")
    with ST.step(spark, path, "r1", "load_raw") as info:
        info["message"] = "ok"
    ST.assert_prev_success(spark, path, "r1", "load_raw")
    with pytest.raises(ZeroDivisionError):
        with ST.step(spark, path, "r1", "clean", gate="load_raw"):
            1 / 0
    with pytest.raises(ST.GateError):
        ST.assert_prev_success(spark, path, "r1", "clean")


def test_registry_lifecycle(spark, scratch):
    base = f"{scratch}/reg"
    RG.ensure_registry(spark, base)
    reg = RG.upsert_running(RG.read_registry(spark, base), spark.createDataFrame([("r1",)], "run_id string"))
    RG.write_registry(spark, base, reg)
    reg, v = RG.bind_version(spark, RG.read_registry(spark, base), "r1")
    assert v == 1
    RG.write_registry(spark, base, reg)
    reg2, v2 = RG.bind_version(spark, RG.read_registry(spark, base), "r2")
    assert v2 == 2
    RG.write_registry(spark, base, reg2)
    for run, ver in (("r1", 1), ("r2", 2)):
        t = spark.createDataFrame([(run, ver, f"uri/{ver}", "{}")],
                                  "run_id string, version bigint, artifact_uri string, metrics_json string")
        RG.write_registry(spark, base, RG.promote(RG.read_registry(spark, base), t))
    cur = RG.read_registry(spark, base)
    assert cur.where("is_latest").count() == 1
    assert RG.require_model(cur) == (2, "uri/2")
    assert RG.require_model(cur, 1) == (1, "uri/1")
    failed = RG.mark_failed(cur, "r2", 2, "x" * 100000)
    row = failed.where("version = 2").first()
    assert row.status == "FAILED" and len(row.metrics_json) == 90000


def test_feature_metadata_query(spark):
    from retention.plans import metadata as MDT
    md = MDT.seed_metadata(spark, dt.date(2025, 8, 24))
    assert md.count() == 17
    assert MDT.query_metadata(md, source="clean").count() == 7
    assert [r.feature_name for r in MDT.query_metadata(md, feature_name="tenure", limit=1).collect()] == ["tenure"]


def test_lowercase_and_camel_headers(spark):
    from retention.operators.prepare import conform
    from retention.schemas import EXPECTED_RAW_COLUMNS
    lower = spark.createDataFrame([("1", "0", "Yes", " yes ")], "customerid string, seniorcitizen string,"
                                                              " techsupport string, churn string")
    camel = spark.createDataFrame([("1", "0", "Yes", "no")], "customerID string, SeniorCitizen string,"
                                                             " TechSupport string, Churn string")
    for df in (lower, camel):
        out = conform(df)
        assert out.columns[:len(EXPECTED_RAW_COLUMNS)] == EXPECTED_RAW_COLUMNS
        assert set(out.columns[len(EXPECTED_RAW_COLUMNS):]) >= {"customer_id"}
        r = out.first()
        assert r.senior_citizen == "0" and r.tech_support == "Yes" and r.gender is None
    assert conform(lower).first().churn == "Yes" and conform(camel).first().churn == "No"


def test_schema_evolution_and_missing_table(spark, scratch):
    """A new column comes with a new day; old days show NULL, with or without a given schema."""
    from pyspark.sql import types as T
    path = f"{scratch}/evolving"
    TB.create_or_write(spark, spark.createDataFrame([(1, dt.date(2025, 8, 23))], "v int, ingest_date date"), path)
    TB.create_or_write(spark, spark.createDataFrame([(2, "x", dt.date(2025, 8, 24))], "v int, extra string, ingest_date date"), path)
    schema = T.StructType.fromDDL("v int, extra string, ingest_date date")
    for got in (TB.read_table(spark, path), TB.read_table(spark, path, schema)):
        assert sorted(tuple(r) for r in got.select("v", "extra").collect()) == [(1, None), (2, "x")]
    with pytest.raises(L.TableMissing):
        L.require_table(spark, f"{scratch}/nope")
    assert not TB.usable(spark, f"{scratch}/nope") and TB.usable(spark, path)


def test_empty_errors(spark):
    from retention.operators import profile as PR
    from retention.plans import model as MD
    df = spark.createDataFrame([(1, 0, dt.date(2025, 8, 24), 3.0)],
                               "customer_id bigint, churn_label bigint, ingest_date date, tenure double")
    with pytest.raises(MD.NoTrainingData):
        MD.load_training_rows(df, "2025-08-23")
    with pytest.raises(PR.ProfileInputError):
        PR.require_rows(df.where("false"))
    with pytest.raises(PR.ProfileInputError):
        PR.pick_columns(df.drop("churn_label"))
    assert MD.split_columns(df) == (["tenure"], [])


def test_schemas_of_clean_and_feature_tables(spark):
    from conftest import SF_SMALL
    from retention.plans import catalog as CAT
    from retention.schemas import CLEAN_SCHEMA, FEATURE_SCHEMA
    for df, schema in ((CAT.clean_all(spark, SF_SMALL), CLEAN_SCHEMA), (CAT.features_all(spark, SF_SMALL), FEATURE_SCHEMA)):
        assert df.dtypes == [(f.name, f.dataType.simpleString()) for f in schema.fields]


def test_payload_types_are_checked(spark):
    from retention.plans import scoring as SC
    cases = {'{"tenure": 5, "is_senior": true, "zzz": 1}': True, '{"tenure": "7.5", "services_count": 2.0}': True,
             '{"tenure": null}': True, "{}": True, '{"is_senior": "yes", "has_internet": 0}': True,
             '{"tenure": "abc"}': False, '{"services_count": 2.5}': False, '{"contract_type": 7}': False,
             '{"is_senior": "maybe"}': False, '{"is_senior": 2}': False, '{"tenure": [1]}': False, "[1]": False, "5": False,
             "{bad json": False, "": False, None: False}
    df = spark.createDataFrame(list(enumerate(cases)), "payload_id int, payload string")
    rows = {r.payload_id: r for r in SC.parse_payloads(df).collect()}
    for i, (text, ok) in enumerate(cases.items()):
        assert rows[i].valid_json == ok, text
        assert rows[i].bad_payload == (None if ok else text)
    assert rows[0].tenure == 5.0 and rows[0].is_senior is True and rows[1].tenure == 7.5 and rows[1].services_count == 2
    assert rows[4].is_senior is True and rows[4].has_internet is False and rows[5].tenure is None


def test_merge_upsert_generic(spark):
    from retention.operators.upsert import merge_upsert
    t = spark.createDataFrame([("a", 1, 10), ("b", None, 20), ("b", 2, 30)], "k string, v int, x int")
    s = spark.createDataFrame([("b", 99), ("c", 7)], "k string, x int")
    out = merge_upsert(t, s, ["k"], target_cond=F.col("v").isNull(),
                       when_matched={"x": F.col("_s_x") + F.col("x")},
                       when_not_matched={"v": F.lit(0)})
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == sorted([("a", 1, 10), ("b", 2, 30), ("b", None, 119), ("c", 0, 7)], key=repr)
