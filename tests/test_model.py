"""Training, persistence and scoring on the small fixture (AUC in a band)."""

from pyspark.sql import functions as F

from retention.operators import metrics as MT
from retention.plans import catalog as CAT, model as MD, scoring as SC
from conftest import SF_SMALL

compare = MD.compare


def test_auc_matches_brute_force(spark):
    import itertools
    rows = [(int(i % 3 == 0), float((i * 37) % 10) / 10) for i in range(120)]
    df = spark.createDataFrame(rows, "label bigint, score double")
    auc = MT.roc_auc(df).first()["auc"]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    brute = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg)) / (len(pos) * len(neg))
    assert abs(auc - brute) < 1e-12


def test_train_save_load_score(spark, tmp_path):
    f = CAT.features_all(spark, SF_SMALL)
    best, model, metrics = MD.train_and_evaluate(f, ["logreg"])
    assert best == "logreg" and 0.0 <= metrics["logreg"]["roc_auc"] <= 1.0
    uri, muri = MD.save_model(model, metrics, str(tmp_path), 1, best, spark)
    loaded = MD.load_model(uri)
    ids = spark.createDataFrame([(2,), (3,), (10 ** 9,)], "customer_id bigint")
    out = {r.customer_id: r for r in SC.score_by_id(loaded, f, ids, 1).collect()}
    assert out[10 ** 9].found is False and out[10 ** 9].churn_probability is None
    found = [r for r in out.values() if r.found]
    assert found and all(0.0 <= r.churn_probability <= 1.0 and r.prediction in (0, 1) for r in found)
    pay = spark.createDataFrame([(1, '{"tenure": 5, "contract_type": "One year", "zzz": 1}'), (2, "{bad json")],
                                "payload_id int, payload string")
    res = {r.payload_id: r for r in SC.score_payloads(loaded, pay, 1).collect()}
    assert res[1].valid_json and res[1].churn_probability is not None
    assert not res[2].valid_json and res[2].churn_probability is None
    assert res[2].bad_payload == "{bad json" and res[1].bad_payload is None


def test_one_hot_unknown_is_all_zero(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    train = spark.createDataFrame([("a",), ("b",), ("b",)], "c string")
    pre = MD.preprocess_stage([], ["c"], {}, {}, {"c": "b"})
    model = Pipeline(stages=[pre] + MD.encoder_stages([], ["c"])[:2]).fit(train)
    test = spark.createDataFrame([("a",), ("b",), ("zzz",), (None,)], "c string")
    got = [list(r[0]) for r in model.transform(test).select(vector_to_array("c__v")).collect()]
    assert got == [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0], [0.0, 1.0]]


def test_mode_ties_pick_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "c string")
    assert MD.mode_values(df, ["c"]) == {"c": "a"}


def test_duckdb_finds_the_gradient_zero(spark):
    """The optimum of the penalised loss, proved by another engine: DuckDB imputes, scales, encodes and
    scores the training rows with the returned coefficients and sums the derivatives."""
    import duckdb
    from retention.plans.oracle import _MODEL_CAT as cats, _MODEL_NUM as nums
    model, train, _, n = CAT._fitted(spark, SF_SMALL, "logreg")
    cert = MD.logreg_certificate(model, train, n).collect()
    rows = train.toPandas()  # noqa: F841 - DuckDB reads it
    con = duckdb.connect()
    con.execute("create table c (term varchar, coefficient double)")
    con.executemany("insert into c values (?, ?)", [(r.term, r.coefficient) for r in cert])
    con.execute("create table t as select row_number() over () as i, * from rows")
    num = " union all ".join(
        f"""select i, '{c}' as term, (v - avg(v) over ()) / coalesce(nullif(stddev_pop(v) over (), 0), 1) as x from (
            select i, coalesce(cast({c} as double), (select quantile_cont(cast({c} as double), 0.5) from t)) as v from t)""" for c in nums)
    cat = " union all ".join(
        f"""select i, '{c}=' || coalesce({c}, (select arg_min(v, (-n, v)) from (select {c} as v, count(*) as n from t
            where {c} is not null group by {c}))), 1.0 from t""" for c in cats)
    got = dict(con.execute(f"""
        with x as ({num} union all {cat} union all select i, '(intercept)', 1.0 from t),
        p as (select i, 1 / (1 + exp(-sum(x * coefficient))) as p from x join c using (term) group by i)
        select term, sum((p - churn_label) * x) / {n} + case when term = '(intercept)' then 0 else any_value(coefficient) / {n} end
        from x join p using (i) join t using (i) join c using (term) group by term""").fetchall())
    assert set(got) == {r.term for r in cert} and len(cert) > 20
    assert all(abs(got[r.term] - r.gradient) < 1e-9 and abs(r.gradient) < CAT.ZERO_GRADIENT for r in cert)


def test_scored_rows_follow_the_coefficients(spark):
    """Probabilities of the scoring queries lie in [0, 1], decide at the threshold and agree with each other."""
    rows = {(r.customer_id, str(r.ingest_date)): r for r in CAT.QUERIES["threshold_rows"](spark, SF_SMALL).collect()}
    assert rows and all(0 <= r.score <= 1 and r.prediction == (r.score >= 0.5) for r in rows.values())
    by_id = CAT.QUERIES["score_by_id_rows"](spark, SF_SMALL).collect()
    found = [r for r in by_id if r.found]
    assert found and all(0 <= r.churn_probability <= 1 and r.prediction == (r.churn_probability >= 0.5) for r in found)
    assert all(r.churn_probability is None and r.prediction is None for r in by_id if not r.found)
    both = [(r, k) for k, r in rows.items() for f in found if f.customer_id == k[0] and abs(f.churn_probability - r.score) < 1e-6]
    assert both  # the same row scored twice has one probability
    json = CAT.QUERIES["score_from_json_rows"](spark, SF_SMALL).collect()
    assert all((r.churn_probability is None) == (not r.valid_json) == (r.bad_payload is not None) for r in json)
    same = {(r.payload_id, str(r.ingest_date)): r.churn_probability for r in json if r.valid_json}
    assert all(abs(same[k] - r.score) < 1e-6 for k, r in rows.items() if k in same)


def test_forest_keeps_places_and_same_trees(spark):
    """the registered forest keeps each row's place in its trees, and grows the trees it grew without."""
    from pyspark.ml.feature import VectorAssembler
    rows = spark.range(400).select((F.col("id") * 7 % 31).cast("double").alias("a"), (F.col("id") * 13 % 17).cast("double").alias("b"),
                                   (F.col("id") * 7 % 31 * 2 > F.col("id") * 13 % 17 * 3).cast("double").alias(MD.LABEL))
    x = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    forest = MD.candidates(400, 5)["rf"]
    assert forest.getCacheNodeIds() and forest.getNumTrees() == 250 and forest.getMaxDepth() == 5
    few = forest.copy({forest.numTrees: 8})
    assert few.fit(x).toDebugString.split("\n")[1:] == few.copy({few.cacheNodeIds: False}).fit(x).toDebugString.split("\n")[1:]


def test_training_rows_fill_every_core_evenly(spark):
    """files of uneven size, or more of them than cores, do not set the tasks of a fit."""
    cores = spark.sparkContext.defaultParallelism
    many = spark.range(MD.ROWS_PER_TASK * cores).select((F.col("id") + 1).alias("customer_id"), F.current_date().alias("ingest_date"))
    for df in (many.repartition(cores + 3, "customer_id"), many.coalesce(1)):
        sizes = MD.spread(df).rdd.glom().map(len).collect()
        assert len(sizes) == cores and sum(sizes) == MD.ROWS_PER_TASK * cores and max(sizes) < 1.2 * min(sizes)
    assert MD.spread(many.limit(10).repartition(3)).rdd.getNumPartitions() == 3
    assert MD.spread(many.limit(0)).count() == 0


def test_metrics_read_scores_and_do_not_score_again(spark, monkeypatch):
    """the table that the metrics aggregate several times is on disk, one row for each test row."""
    seen = {}
    monkeypatch.setattr(CAT.MD, "compare", lambda s, scored: seen.update(scored) or compare(s, scored))
    got = {r.model: r for r in CAT.QUERIES["model_metrics"](spark, SF_SMALL).collect()}
    assert set(got) == set(seen) == {"logreg", "rf"}
    for which, rows in seen.items():
        model, _, test, _ = CAT._fitted(spark, SF_SMALL, which)
        again = MD.positive_probability(model.transform(test)).select(F.col(MD.LABEL).cast("bigint").alias("label"), "score")
        assert rows.count() == test.count() and rows.exceptAll(again).isEmpty()
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Scan ExistingRDD" in plan and "UDF" not in plan and "Project" not in plan
        assert got[which].roc_auc == MT.roc_auc(again).first()["auc"]
