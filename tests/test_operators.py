"""Operators on hand-made rows and on the small fixture (properties)."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from retention.operators import clean as C, features as FE, profile as PR, quality as Q
from retention.operators.ordering import by_key, by_share, by_value, contiguous_ids, ranged_ids, running_sum
from retention.operators.quantiles import exact_quantiles, sketched_quantiles, value_sketches
from retention.plans import catalog as CAT
from conftest import SF_SMALL


def _raw_rows(spark, rows):
    from retention.schemas import RAW_TEXT_SCHEMA
    return spark.createDataFrame(rows, RAW_TEXT_SCHEMA).withColumn("ingest_date", F.col("ingest_date").cast("date"))


BASE = ["1", "Male", "0", "Yes", "No", "5", "Yes", "No", "DSL", "Yes", "No", "No", "No", "No", "No",
        "One year", "Yes", "Mailed check", "20.5", "100", "Yes", "2025-08-24"]


def test_clean_casts_trims_and_labels(spark):
    r2 = list(BASE); r2[0] = "2"; r2[1] = "\tFemale\n"; r2[5] = "12.5"; r2[18] = ""; r2[19] = " "; r2[20] = "Yes "
    r3 = list(BASE); r3[0] = None
    r4 = list(BASE); r4[0] = "4"; r4[20] = None; r4[21] = "2025-08-23"
    out = C.clean(_raw_rows(spark, [tuple(BASE), tuple(r2), tuple(r3), tuple(r4)]), "2025-08-24").collect()
    assert [r.customer_id for r in out] == [1, 2]
    a, b = out
    assert a.churn_label == 1 and a.tenure == 5 and a.total_charges == 100.0
    assert b.gender == "Female" and b.tenure is None and b.monthly_charges is None
    assert b.total_charges is None and b.churn == "Yes" and b.churn_label == 1
    assert b.ingest_date == dt.date(2025, 8, 24)


def test_features_rules(spark):
    rows = []
    for i, (ten, mon, contract, sec) in enumerate([("0", "10", "Two year", "Yes"), ("-3", "20", "Unknown", None),
                                                    ("30", "30", "Month-to-month", "No"), (None, "40", "One year", "Yes"),
                                                    ("60", "50", "One year", "Yes")]):
        r = list(BASE); r[0] = str(i + 1); r[5] = ten; r[18] = mon; r[15] = contract; r[9] = sec
        rows.append(tuple(r))
    f = {r.customer_id: r for r in FE.build_features(C.clean(_raw_rows(spark, rows))).collect()}
    assert f[1].avg_charges_per_tenure is None and f[1].contract_length_months == 24
    assert f[2].services_count is None and f[2].charges_per_service is None and f[2].contract_length_months is None
    assert f[2].tenure_bucket == "<12m" and f[3].tenure_bucket == "25-48m" and f[4].tenure_bucket == "unknown"
    assert f[5].tenure_bucket == ">48m"
    # p80 (nearest rank) of 10..50 is 40: only 50 is strictly above
    assert [f[i].is_high_spender for i in range(1, 6)] == [False, False, False, False, True]


def test_contiguous_ids_no_gaps(spark):
    df = spark.range(0, 200_000).select(((F.col("id") * 7919) % 200_000).alias("k"))
    ids = contiguous_ids(df, ["k"])
    assert ids.where("id <> k + 1").isEmpty() and ids.count() == 200_000
    two = df.select("k", (F.col("k") % 2).alias("s"))
    got = contiguous_ids(two, ["k"], prefix=["s"])
    assert got.where("id <> s * 100000 + floor(k / 2) + 1").isEmpty()


def test_running_sum_partitions(spark):
    df = spark.createDataFrame([(g, v / 100.0, 1) for g in ("a", "b", None) for v in range(100)], "g string, v double, c int")
    for bucket in (by_share, by_value, by_key):
        out = running_sum(df, ["v"], "c", ["g"], "cum", bucket=bucket).collect()
        assert len(out) == 300 and all(r.cum == round(r.v * 100) + 1 for r in out)


def test_buckets_never_decrease(spark):
    import math
    values = [-1e300, -5.5, -1.0, -1e-9, 0.0, 1e-9, 0.5, 1.0, 1.0000001, 77.0, 1e6, 1e300, math.inf, math.nan]
    got = [r.b for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
           .select("i", by_value(F.col("x")).alias("b")).orderBy("i").collect()]
    assert got == sorted(got)


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    vals = [float((i * 37) % 101) for i in range(333)] + [5.0] * 200 + [0.5 * i - 9 for i in range(50)]
    df = spark.createDataFrame([(v, i % 2) for i, v in enumerate(vals)], "x double, g int")
    q = exact_quantiles(df, ["x"], [0.0, 0.1, 0.25, 0.5, 0.9, 1.0], by=["g"]).collect()
    assert len(q) == 12
    for r in q:
        sub = [v for i, v in enumerate(vals) if i % 2 == r.g]
        assert abs(r.value - np.percentile(sub, r.p * 100)) < 1e-9 and r.n == len(sub)
    for p in (0.8, 0.5, 1.0):
        expect = df.selectExpr(f"percentile_disc({p}) within group (order by x)").first()[0]
        assert exact_quantiles(df, ["x"], [p], kind="disc").first().value == expect
    assert exact_quantiles(df.where("false"), ["x"], [0.5]).count() == 0


@pytest.mark.parametrize("kind", ["linear", "disc"])
def test_sketched_quantiles_are_the_exact_ones(spark, kind):
    """Groups under and over the sketch's size, one hot value, a narrow band, infinities, NaN and NULL."""
    import random
    r = random.Random(3)
    draw = lambda: r.choice([7.0, 7.0, 1e6 + r.random() * 2000, -r.random() * 5, float("inf"), float("-inf"), float("nan"), None])
    rows = [(g, draw()) for g, n in (("a", 30000), ("b", 50), (None, 6000)) for _ in range(n)] + [("one", 1.0), ("nothing", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    probs = [0.0, 0.1, 0.25, 0.5, 0.8, 0.97, 1.0]
    want = sorted(map(repr, exact_quantiles(df, ["x"], probs, ["g"], kind).collect()))
    assert sorted(map(repr, sketched_quantiles(df, ["x"], probs, ["g"], kind).collect())) == want and len(want) == 4 * len(probs)
    stored = value_sketches(df, ["x"], ["g"])
    assert sorted(map(repr, sketched_quantiles(df, ["x"], probs, ["g"], kind, stored, few=False).collect())) == want
    assert sketched_quantiles(df.where("false"), ["x"], probs, ["g"], kind).count() == 0


def test_a_rank_outside_its_bracket_fails(spark):
    df = spark.range(50_000).select(F.col("id").cast("double").alias("x"))
    wrong = value_sketches(df.select(F.col("x") + 25_000).toDF("x"), ["x"])
    with pytest.raises(Exception, match="outside its sketch"):
        sketched_quantiles(df, ["x"], [0.2], sketches=wrong).collect()


def test_ranged_ids_on_sparse_and_hot_keys(spark):
    """Keys over 2**62, text, nulls, and a key that a third of the rows share: ids in order, no task with all rows."""
    rows = [((i * 2654435761 * 998244353) % (1 << 62), f"t{i % 977}") for i in range(20_000)] + [(77, None)] * 10_000 + [(None, "n")]
    df = spark.createDataFrame(rows, "k long, t string").repartition(6)
    out = ranged_ids(df, ["k", "t"], start=5)
    got = out.orderBy("id").collect()
    assert [r.id for r in got] == list(range(5, 5 + len(rows)))
    key = [(r.k is not None, r.k or 0, r.t is not None, r.t or "") for r in got]
    assert key == sorted(key)
    assert ranged_ids(df.where("false"), ["t"]).count() == 0


def test_histogram_counts_sum_to_non_null(spark):
    f = CAT.features_all(spark, SF_SMALL)
    h = PR.histogram(f).groupBy("column").agg(F.sum("count").alias("n"), F.count("*").alias("bins"))
    for r in h.collect():
        assert r.bins == 30
        assert r.n == f.where(F.col(r.column).isNotNull()).count()


def test_validation_report_shape(spark):
    rep = Q.validation_report(CAT.clean_all(spark, SF_SMALL), "2025-08-24").collect()
    assert sorted({r.check for r in rep}) == sorted(Q.CHECK_NAMES)
    assert len(rep) == 8


def _allocation(counts: dict, frac: float = 0.25) -> dict:
    """Reference sizes: n_test = ceil(frac * n); train per label by floor of the
    proportional share plus largest remainders (ties: smaller label)."""
    import math
    n = sum(counts.values())
    n_test = math.ceil(frac * n)
    n_train = n - n_test
    cont = {k: v * n_train / n for k, v in counts.items()}
    train = {k: math.floor(c) for k, c in cont.items()}
    need = n_train - sum(train.values())
    for k in sorted(counts, key=lambda k: (-(cont[k] - math.floor(cont[k])), k))[:need]:
        train[k] += 1
    return {k: counts[k] - train[k] for k in counts}


def test_stratified_split_sizes(spark):
    from retention.plans import model as MD
    f = CAT.features_all(spark, SF_SMALL)
    s = MD.stratified_split(f)
    got = {(r.churn_label, r.is_test): r["count"] for r in s.groupBy("churn_label", "is_test").count().collect()}
    counts = {lbl: got.get((lbl, True), 0) + got.get((lbl, False), 0) for lbl in (0, 1)}
    assert {lbl: got.get((lbl, True), 0) for lbl in (0, 1)} == _allocation(counts)
    assert s.count() == f.count()
    for table in ({0: 7, 1: 3}, {0: 10694, 1: 3885}, {0: 1, 1: 1, 2: 1}, {0: 5, 1: 5, 2: 2}, {1: 9}):
        df = spark.createDataFrame(list(table.items()), "churn_label bigint, _n bigint")
        q = {r.churn_label: r._test for r in MD.test_quota(df).collect()}
        assert q == _allocation(table), table



def test_hash_split_shares(spark):
    from retention.plans import model as MD
    df = spark.range(0, 20000).select((F.col("id") + 1).alias("customer_id"),
                                      F.lit("2025-08-24").cast("date").alias("ingest_date"),
                                      (F.col("id") % 4 == 0).cast("bigint").alias("churn_label"))
    s = MD.stratified_split(df, exact=False)
    share = s.where("is_test").count() / 20000
    assert 0.23 < share < 0.27
    assert s.where("is_test").count() == MD.stratified_split(df, exact=False).where("is_test").count()


def test_cluster_conf():
    from retention.session import cluster_conf
    c = cluster_conf(4000, 100 << 40)
    assert int(c["spark.sql.shuffle.partitions"]) >= 400000


def test_p80_is_the_nearest_rank(spark):
    c = CAT.clean_all(spark, SF_SMALL)
    a = {r.ingest_date: r.p80_monthly for r in FE.daily_p80(c).collect()}
    disc = c.groupBy("ingest_date").agg(F.expr("percentile_disc(0.8) within group (order by monthly_charges)").alias("p"))
    assert a == {r.ingest_date: r.p for r in disc.collect()}
    assert set(r.ingest_date for r in FE.daily_p80(c, exact=False).collect()) == set(a)


def test_profile_approx_quartiles_close(spark):
    c = CAT.clean_all(spark, SF_SMALL)
    ex = {r.column: r for r in PR.numeric_summary(c).collect()}
    ap = {r.column: r for r in PR.numeric_summary(c, exact=False).collect()}
    assert set(ex) == set(ap)
    for k in ex:
        span = (ex[k]["max"] - ex[k]["min"]) or 1.0
        for q in ("p25", "p50", "p75"):
            assert abs(ex[k][q] - ap[k][q]) <= 0.05 * span
    assert PR.box_stats(c, exact=False).count() == PR.box_stats(c).count()


def test_prepare_preview_and_counts(spark):
    from retention.operators import prepare as PP
    from retention.sources.fixture import two_sources
    out = PP.prepare(*two_sources(spark, SF_SMALL), "2025-08-24", ["k"])
    assert [r.customer_id for r in PP.preview(out).collect()] == [1, 2, 3, 4, 5]
    c = PP.sanity_counts(PP.coerce_numeric(PP.union_sources(*two_sources(spark, SF_SMALL), keep=("k",)))).first()
    assert c.rows == out.count() and c.null_churn == 0


def test_sketches_of_days_answer_for_all_of_them(spark, tmp_path):
    from retention.operators import sketches as SK
    n = 60_000
    rows = spark.range(n).selectExpr("id % 20000 as customer_id", "case when id % 10 = 0 then null else concat('v', pmod(hash(id), 7)) end as v",
                                     "date_add(date '2025-08-20', cast(id % 4 as int)) as ingest_date")
    SK.write_sketches(rows, ["customer_id", "v"], str(tmp_path / "s"))
    got = {r["column"]: r for r in SK.report(spark, str(tmp_path / "s")).collect()}
    assert abs(got["customer_id"].distinct_values - 20000) < 0.05 * 20000 and got["customer_id"].rows == n
    want = rows.where("v is not null").groupBy("v").count().orderBy(F.desc("count"), "v").collect()
    assert got["v"].nulls == n // 10 and got["v"].distinct_values == 7
    assert [(x["value"], x["count"]) for x in got["v"].frequent] == [(r.v, r["count"]) for r in want]
    part = {r["column"]: r for r in SK.report(spark, str(tmp_path / "s"), "2025-08-21", "2025-08-22").collect()}
    assert part["v"].rows == n // 2 and abs(part["customer_id"].distinct_values - 10000) < 500
    SK.write_sketches(rows.where("ingest_date = '2025-08-20'"), ["customer_id", "v"], str(tmp_path / "s"))  # a re-run replaces its day
    assert {r["column"]: r.rows for r in SK.report(spark, str(tmp_path / "s")).collect()}["v"] == n
