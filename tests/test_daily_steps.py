"""The daily pipeline end to end on CSV files written from the fixture."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from retention.plans import daily as D, status as ST
from retention.plans.catalog import AS_OF
from retention.sources import landing as L
from retention.sources.fixture import PRIMARY_HEADERS, two_sources
from conftest import SF_SMALL


def _write_source(df, path, spark):
    df.orderBy("k").drop("k").coalesce(1).write.option("header", True) \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def test_prepare_scan_order_ids(spark, scratch):
    prim, sec = two_sources(spark, SF_SMALL)
    _write_source(prim, f"{scratch}/primary", spark)
    _write_source(sec, f"{scratch}/custom", spark)
    p = L.read_source(spark, f"{scratch}/primary")
    assert p.columns[:len(PRIMARY_HEADERS)] == PRIMARY_HEADERS
    s = L.read_optional_source(spark, f"{scratch}/custom")
    assert L.read_optional_source(spark, f"{scratch}/absent") is None
    from retention.operators import prepare as PP
    got = PP.prepare(p, s, AS_OF, L.ORDER_COLS, scan_order=True).orderBy("customer_id").collect()
    ref = PP.prepare(*two_sources(spark, SF_SMALL), AS_OF, ["k"]).orderBy("customer_id").collect()
    assert [r.customer_id for r in got] == list(range(1, len(ref) + 1))
    assert [tuple(r) for r in got] == [tuple(r) for r in ref]
    assert all(r.tech_support is None for r in got[len(got) - s.count():])


def test_daily_pipeline(spark, scratch):
    prim, sec = two_sources(spark, SF_SMALL)
    _write_source(prim, f"{scratch}/in/primary", spark)
    _write_source(sec, f"{scratch}/in/custom", spark)
    wh = D.Warehouse(f"{scratch}/wh")
    D.init_warehouse(spark, wh)
    run = "run-1"
    D.prepare_day(spark, wh, f"{scratch}/in/primary", f"{scratch}/in/custom", AS_OF)
    n = D.load_day(spark, wh, run, AS_OF)
    assert n > 0
    with pytest.raises(ST.GateError):
        D.features_day(spark, wh, "other-run", AS_OF)
    D.clean_day(spark, wh, run, AS_OF)
    D.clean_day(spark, wh, run, AS_OF)  # re-run replaces the day
    cl = spark.read.parquet(wh.clean)
    assert cl.count() == cl.select("customer_id").distinct().count()
    rep = D.validate_day(spark, wh, run, AS_OF)
    assert rep.count() == 8
    D.profile_day(spark, wh, run, AS_OF)
    import os
    assert len([x for x in os.listdir(wh.output(AS_OF, "eda")) if not x.startswith(".")]) == 10
    assert spark.read.parquet(wh.output(AS_OF, "prepare")).first()["rows"] > 0
    read = spark.read.option("header", True).option("multiLine", True).csv(L.daily_path(wh.landing, AS_OF)).count()
    aside = spark.read.parquet(wh.p("quarantine")).count() if os.path.exists(wh.p("quarantine")) else 0
    assert n + aside == read
    D.features_day(spark, wh, run, AS_OF)
    assert spark.read.parquet(wh.features).count() == cl.count()
    uri, version = D.train_day(spark, wh, run, AS_OF)
    from retention.plans import registry as RG
    reg = RG.read_registry(spark, wh.registry)
    assert RG.require_model(reg) == (version, uri) and version == 1
    assert reg.where("is_latest").count() == 1
    log = ST.latest_status(ST.read_status(spark, wh.status)).where(F.col("run_id") == run)
    assert {r.step: r.status for r in log.collect()} == {
        "load_raw": "SUCCESS", "clean": "SUCCESS", "validate_clean": "SUCCESS", "eda": "SUCCESS",
        "features": "SUCCESS", "train": "SUCCESS"}


def test_stream_picks_up_each_day_once(spark, scratch):
    from retention.plans import catalog as CAT
    from retention.schemas import RAW_SCHEMA
    from retention.streaming.ingest import ingest_available
    raw = CAT.raw(spark, SF_SMALL).drop("k")
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in RAW_SCHEMA.fieldNames()])
    landing, table, ckpt = f"{scratch}/landing", f"{scratch}/raw", f"{scratch}/ckpt"
    day_a, day_b = "2025-08-22", "2025-08-23"
    L.write_daily_csv(text.where(F.col("ingest_date") == day_a), landing, day_a)
    ingest_available(spark, landing, table, ckpt, f"{scratch}/aside")
    n_a = spark.read.schema(RAW_SCHEMA).parquet(table).count()
    assert n_a > 0
    ingest_available(spark, landing, table, ckpt, f"{scratch}/aside")  # nothing new: unchanged
    assert spark.read.schema(RAW_SCHEMA).parquet(table).count() == n_a
    L.write_daily_csv(text.where(F.col("ingest_date") == day_b), landing, day_b)
    ingest_available(spark, landing, table, ckpt, f"{scratch}/aside")
    got = spark.read.schema(RAW_SCHEMA).parquet(table)
    per_day = {str(r.ingest_date): r["count"] for r in got.groupBy("ingest_date").count().collect()}
    assert set(per_day) == {day_a, day_b} and per_day[day_a] == n_a
    # a second file for day B lands in the same folder: the day is rebuilt from all its files
    extra = (text.where((F.col("ingest_date") == day_b) & F.col("tenure").rlike("^[0-9]+$"))
             .orderBy("customer_id").limit(3))
    extra.write.mode("append").option("header", True).csv(L.daily_path(landing, day_b))
    ingest_available(spark, landing, table, ckpt, f"{scratch}/aside")
    per_day2 = {str(r.ingest_date): r["count"] for r in
                spark.read.schema(RAW_SCHEMA).parquet(table).groupBy("ingest_date").count().collect()}
    assert per_day2[day_a] == n_a and per_day2[day_b] == per_day[day_b] + 3


def test_late_and_redelivered_files(spark, scratch):
    """Batches of two files: a file delivered again (same or other name, same or later batch) counts once;
    a late file joins its day; rows that repeat inside a file stay; bad rows are set aside once a batch."""
    import os
    from retention.schemas import RAW_SCHEMA, RAW_TEXT_SCHEMA
    from retention.streaming.ingest import ingest_available
    names = RAW_TEXT_SCHEMA.fieldNames()

    def row(i, day, tenure="5"):
        return ",".join({**dict.fromkeys(names, "x"), "customer_id": str(i), "senior_citizen": "0", "tenure": tenure,
                         "monthly_charges": "1.5", "total_charges": "2", "ingest_date": day}[c] for c in names)

    def drop(name, *rows):
        os.makedirs(f"{scratch}/landing/d", exist_ok=True)
        with open(f"{scratch}/landing/d/{name}.csv", "w") as f:
            f.write("\n".join([",".join(names), *rows]) + "\n")

    def take():
        ingest_available(spark, f"{scratch}/landing", f"{scratch}/raw", f"{scratch}/ckpt", f"{scratch}/aside", L.Budget(count=2),
                         "d", files_per_batch=2)
        rows = spark.read.schema(RAW_SCHEMA).parquet(f"{scratch}/raw").collect()
        return sorted((r.customer_id, str(r.ingest_date)) for r in rows)
    a, b = "2025-08-22", "2025-08-23"
    drop("one", row(1, a), row(1, a), row(2, b))
    drop("one-copy", row(1, a), row(1, a), row(2, b))
    drop("two", row(3, a), row(9, a, "bad"))
    want = [(1, a), (1, a), (2, b), (3, a)]
    assert take() == want and take() == want  # nothing new the second time
    drop("two-again", row(3, a), row(9, a, "bad"))
    drop("late", row(4, a))
    assert take() == sorted([*want, (4, a)])
    assert spark.read.parquet(f"{scratch}/aside").count() == 2  # one for each delivery, kept with its batch
    drop("many", *[row(i, b, "bad") for i in range(3)])
    with pytest.raises(Exception, match="3 of 3 rows are bad"):
        take()


def test_cli_parses_and_runs_a_gate_failure(spark, scratch):
    import retention.__main__ as M
    with pytest.raises(SystemExit):
        M.main(["bogus", "--warehouse", scratch])
    with pytest.raises(ST.GateError):
        M.main(["clean", "--warehouse", f"{scratch}/wh", "--run-id", "r9", "--date", AS_OF])
