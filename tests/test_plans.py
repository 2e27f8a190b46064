"""Physical-plan properties of the registered queries."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from retention.plans import catalog as CAT

# Queries that train models or drain a stream run jobs while being defined.
EAGER = {"train_logreg", "train_rf", "threshold_predictions", "score_by_id", "score_from_json",
         "ingest_incremental", "load_bad_record_budget", "one_hot_matrix", "logreg_certificate", "logreg_coefficients",
         "model_metrics", "threshold_rows", "score_by_id_rows", "score_from_json_rows", "load_budget_outcomes",
         "load_field_addition", "latest_clean_table", "prep_sparse_ids", "sketch_report", "customer_lookup_table",
         "ingest_redelivered"}
CHEAP = sorted(k for k in CAT.QUERIES if k not in EAGER)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHEAP)
def test_no_python_udf_and_pruned_scans(spark, name):
    plan = _plan(CAT.QUERIES[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # the customer / orders scans read only the columns the fixture uses
    for line in plan.splitlines():
        if "FileScan parquet" in line and "orders.parquet" in line:
            assert "o_orderkey" not in line and "o_orderstatus" not in line


def scans(plan, table):
    return sum("FileScan parquet" in line and f"{table}.parquet" in line for line in plan.splitlines())


@pytest.mark.parametrize("name", ["feature_services_count", "feature_ratios", "counts_clean_vs_features", "tenure_cohorts",
                                  "segment_contract", "metrics_confusion", "segment_contract_latest"])
def test_the_p80_is_computed_only_where_it_is_read(spark, name):
    plan = _plan(CAT.QUERIES[name](spark, SF_SMALL))
    assert "kll" not in plan and scans(plan, "customer") == (2 if name.startswith("counts") else 1)


def test_p80_reads_its_rows_twice(spark):
    plan = _plan(CAT.QUERIES["feature_p80"](spark, SF_SMALL))
    assert scans(plan, "customer") == 2 and scans(plan, "orders") == 0
    shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert len(shuffles) <= 3


def test_newest_partition_is_found_without_a_scan(spark, tmp_path):
    from retention.sources import tables as TB
    path = str(tmp_path / "t")
    TB.create_table(CAT.features_all(spark, SF_SMALL), path)
    q = TB.read_newest(spark, path)
    plan = _plan(q)
    assert "Subquery" not in plan and plan.count("FileScan parquet") == 1 and "PartitionFilters: [isnotnull(ingest_date" in plan
    assert {str(r.ingest_date) for r in q.select("ingest_date").distinct().collect()} == {"2025-08-24"}
    assert TB.partition_values(spark, path)[-1] == "2025-08-24" and TB.partition_values(spark, path + "-none") == []


def test_merge_leaves_a_bucketed_target_in_place(spark, tmp_path):
    from retention.operators.upsert import merge_upsert, write_bucketed
    target = spark.range(2000).selectExpr("concat('run-', id) as run_id", "id as version", "'OLD' as status")
    write_bucketed(target, "bucketed_target", str(tmp_path / "t"), ["run_id"], 8)
    source = spark.range(1990, 2010).selectExpr("concat('run-', id) as run_id")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = merge_upsert(spark.table("bucketed_target"), source, ["run_id"], when_matched={"status": F.lit("NEW")},
                           when_not_matched={"status": F.lit("NEW")}, nullable_keys=False)
        plan = _plan(out)
        assert plan.count("Bucketed: true") == 2
        lines = [x.replace(":", " ").replace("+-", "  ") for x in plan.splitlines()]
        indent = [len(x) - len(x.lstrip()) for x in lines]
        for at, line in enumerate(lines):  # no shuffle above the target's scans: what moves is the source alone
            if "FileScan" in line:
                depth = indent[at]
                for up in range(at - 1, -1, -1):
                    if indent[up] < depth:
                        depth = indent[up]
                        assert "Exchange" not in lines[up]
        assert "Exchange hashpartitioning" in plan
        rows = {r.run_id: (r.version, r.status) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("drop table bucketed_target")
    assert len(rows) == 2010 and rows["run-1995"] == (1995, "NEW") and rows["run-2005"] == (None, "NEW") and rows["run-7"] == (7, "OLD")


def test_merge_refuses_a_repeated_key(spark):
    from retention.operators.upsert import merge_upsert
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(Exception, match="key twice"):
        merge_upsert(target, spark.createDataFrame([("a", 2), ("b", 3), ("b", 4)], "k string, v int"), ["k"]).collect()
    out = merge_upsert(target, spark.createDataFrame([("a", 2), (None, 3)], "k string, v int"), ["k"], when_matched={"v": F.col("_s_v")})
    assert sorted(map(tuple, out.collect()), key=repr) == [("a", 2), (None, 3)]


def scan_rows(df):
    """Rows that the plan's scan has put out."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    todo = [node]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif node.nodeName().startswith("Scan parquet"):
            return node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]


def test_a_lookup_skips_row_groups(spark, tmp_path):
    """Keys lie scattered, so bounds skip nothing: the Bloom filters do."""
    from retention.sources import tables as TB
    n = 40_000
    rows = spark.range(n).selectExpr("(id * 7919) % 40000 * 3 as customer_id", "date '2025-08-24' as ingest_date").repartition(8, "customer_id")
    for path, bloom in ((str(tmp_path / "plain"), None), (str(tmp_path / "bloom"), {"customer_id": n})):
        TB.create_table(rows, path, bloom=bloom)
    keys = spark.createDataFrame([(3 * k,) for k in (5, 777)] + [(1,), (None,), (15,)], "customer_id long")
    got = {}
    for kind in ("plain", "bloom"):
        df = TB.lookup(spark, str(tmp_path / kind), "customer_id", keys)
        got[kind] = scan_rows(df)
        assert sorted(r.customer_id for r in df.collect()) == [15, 2331]
    assert got["plain"] == n and got["bloom"] <= n // 2
    joined = TB.lookup(spark, str(tmp_path / "bloom"), "customer_id", keys, short=1)
    assert "Join" in _plan(joined) and sorted(r.customer_id for r in joined.collect()) == [15, 2331]


def test_day_filter_reaches_scan(spark, tmp_path):
    from retention.operators import clean as C
    from retention.sources import tables as TB
    path = str(tmp_path / "raw")
    TB.create_table(CAT.raw(spark, SF_SMALL).drop("k"), path)
    q = C.clean(spark.read.parquet(path), "2025-08-24")
    plan = _plan(q)
    assert "PartitionFilters: [isnotnull(ingest_date" in plan
    assert "PushedFilters: [IsNotNull(customer_id)]" in plan
    assert q.count() == CAT.clean_all(spark, SF_SMALL).where(F.col("ingest_date") == "2025-08-24").count()


def test_latest_partition_is_a_partition_filter(spark, tmp_path):
    from retention.operators.clean import latest_partition
    from retention.sources import tables as TB
    path = str(tmp_path / "f")
    TB.create_table(CAT.features_all(spark, SF_SMALL), path)
    q = latest_partition(spark.read.parquet(path))
    plan = _plan(q)
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and "Subquery" in plan
    assert {str(r.ingest_date) for r in q.select("ingest_date").distinct().collect()} == {"2025-08-24"}


@pytest.mark.parametrize("name", CHEAP)
def test_single_partition_only_under_aggregates(spark, name):
    """An Exchange SinglePartition may only take partial sums: a global aggregate, or
    the bucket totals whose running offsets the id and AUC queries need."""
    lines = _plan(CAT.QUERIES[name](spark, SF_SMALL)).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            child = lines[i + 1] if i + 1 < len(lines) else ""
            assert "Aggregate" in child, (name, line, child)


def _reads(name, spark):
    return _plan(CAT.QUERIES[name](spark, SF_SMALL)).count("FileScan parquet")


def test_reports_and_promotion_read_their_input_a_few_times(spark):
    per_pass = _reads("clean_table", spark)
    assert _reads("validation_report", spark) <= 6 * per_pass
    assert _reads("registry_promote", spark) <= 3 * _reads("registry_list", spark)


def test_building_features_runs_no_job(spark):
    from retention.operators import features as FE
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "feature plan")
    FE.build_features(CAT.clean_all(spark, SF_SMALL))
    assert not tracker.getJobIdsForGroup("build")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
