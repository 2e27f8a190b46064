"""Summarise the physical plan of every registered churn query (PLANS.md).

usage: python tools/plan_summary.py [sf_dir] > PLANS.md

Counts shuffles (hash / range / single-partition exchanges), broadcasts,
nested-loop joins, Python evaluation nodes and scans with pushed or partition
filters. Queries that build jobs while being defined (training, checkpoints,
the stream) are listed without a plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

EAGER = {"train_logreg", "train_rf", "threshold_predictions", "score_by_id", "score_from_json", "model_metrics",
         "logreg_certificate", "logreg_coefficients", "threshold_rows", "score_by_id_rows", "score_from_json_rows",
         "ingest_incremental", "ingest_redelivered", "load_bad_record_budget", "load_budget_outcomes", "load_field_addition",
         "latest_clean_table", "customer_lookup_table", "sketch_report", "prep_sparse_ids"}


def summarise(plan: str) -> dict:
    return {
        "hash": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range": len(re.findall(r"Exchange rangepartitioning", plan)),
        "single": len(re.findall(r"Exchange SinglePartition", plan)),
        "bcast": len(re.findall(r"BroadcastExchange", plan)),
        "nlj": len(re.findall(r"BroadcastNestedLoopJoin|CartesianProduct", plan)),
        "python": len(re.findall(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", plan)),
        "scans": len(re.findall(r"FileScan parquet", plan)),
        "pushed": len(re.findall(r"PushedFilters: \[[^\]]+\]", plan)),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from retention.plans.catalog import QUERIES
    from retention.session import build_session
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_summary.py` at `{sf_dir}` (AQE initial plans; subquery and broadcast"
          " sides included). Single-partition exchanges only feed aggregates over bounded inputs.\n")
    print("| query | hash shuffles | range | single-partition | broadcasts | nested-loop joins |"
          " Python nodes | parquet scans | scans with pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in sorted(QUERIES.items()):
        if name in EAGER:
            print(f"| {name} | (builds jobs while defined: training, checkpoint or stream) | | | | | | | |")
            continue
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"| {name} | {s['hash']} | {s['range']} | {s['single']} | {s['bcast']} | {s['nlj']} |"
              f" {s['python']} | {s['scans']} | {s['pushed']} |")
    spark.stop()


if __name__ == "__main__":
    main()
