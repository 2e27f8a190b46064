"""Probe the distributed ordering paths on synthetic rows (spark.range).

usage: python tools/scale_probe.py [rows]

Checks: contiguous ids are exactly 1..N, exact quantiles of many distinct values, and ROC AUC over many distinct
scores. Synthetic input is used only here, to exercise operator scaling;
registered queries read the driver tables.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 2_000_000
    from pyspark.sql import functions as F
    from retention.operators.metrics import roc_auc
    from retention.operators.ordering import contiguous_ids
    from retention.operators.quantiles import exact_quantiles
    from retention.session import build_session
    spark = build_session("local[8]", 8, extra={"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    df = spark.range(0, n).select(((F.col("id") * 7919) % n).alias("k"), (F.col("id") % 3).alias("g"))
    t = time.time()
    r = contiguous_ids(df, ["k"], prefix=["g"])
    chk = r.agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count_distinct("id").alias("d")).first()
    assert (chk.lo, chk.hi, chk.d) == (1, n, n), chk
    print(f"ids: {n} rows, {time.time() - t:.1f}s")
    v = spark.range(0, n).select((F.sin(F.col("id")) * 1000).alias("x"), (F.col("id") % 2).alias("g"))
    t = time.time()
    q = exact_quantiles(v, ["x"], [0.25, 0.5, 0.9], by=["g"]).collect()
    print(f"quantiles: {len(q)} values, {time.time() - t:.1f}s")
    s = spark.range(0, n).select((F.col("id") % 7 == 0).cast("bigint").alias("label"),
                                 F.abs(F.sin(F.col("id"))).alias("score"))
    t = time.time()
    a = roc_auc(s).first()
    print(f"auc: {a.auc:.6f} over {a.n_pos + a.n_neg} rows, {time.time() - t:.1f}s")
    spark.stop()


if __name__ == "__main__":
    main()
