"""Command line for an external scheduler: one daily step per call.

  python -m retention <step> --warehouse URI --run-id ID --date YYYY-MM-DD [...]
  spark-submit --py-files retention.zip retention/__main__.py <step> ...

Steps: prepare (needs --primary, optional --secondary), load, clean,
validate, eda, features (--gate clean|validate_clean), train,
score (--ids PATH of a Parquet table with customer_id, --out URI),
ingest (drain new landing files with the streaming job, --checkpoint URI).
Master and ``spark.checkpoint.dir`` come from the submit configuration.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="retention")
    ap.add_argument("step", choices=["prepare", "load", "clean", "validate", "eda", "features", "train",
                                     "score", "ingest"])
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--run-id", default="manual")
    ap.add_argument("--date", help="YYYY-MM-DD")
    ap.add_argument("--primary")
    ap.add_argument("--secondary")
    ap.add_argument("--gate", default="validate_clean", choices=["clean", "validate_clean"])
    ap.add_argument("--mode", default="replace", choices=["replace", "append"])
    ap.add_argument("--ids")
    ap.add_argument("--out")
    ap.add_argument("--version", type=int)
    ap.add_argument("--checkpoint")
    a = ap.parse_args(argv)

    from retention.plans import daily as D, registry as RG, scoring as SC
    from retention.session import build_session
    from retention.sources import tables as TB

    spark = build_session()
    wh = D.Warehouse(a.warehouse)
    D.init_warehouse(spark, wh)
    if a.step == "prepare":
        print(D.prepare_day(spark, wh, a.primary, a.secondary, a.date))
    elif a.step == "load":
        print(f"loaded {D.load_day(spark, wh, a.run_id, a.date, a.mode)} rows")
    elif a.step == "clean":
        D.clean_day(spark, wh, a.run_id, a.date, a.mode)
    elif a.step == "validate":
        D.validate_day(spark, wh, a.run_id, a.date).show(truncate=False)
    elif a.step == "eda":
        D.profile_day(spark, wh, a.run_id, a.date)
    elif a.step == "features":
        D.features_day(spark, wh, a.run_id, a.date, gate=a.gate, mode=a.mode)
    elif a.step == "train":
        print(D.train_day(spark, wh, a.run_id, a.date))
    elif a.step == "score":
        from retention.plans.model import load_model
        version, uri = RG.require_model(RG.read_registry(spark, wh.registry), a.version)
        out = SC.score_by_id(load_model(uri), TB.read_table(spark, wh.features), spark.read.parquet(a.ids),
                             version)
        out.write.mode("overwrite").parquet(a.out)
    elif a.step == "ingest":
        from retention.streaming.ingest import ingest_available
        ingest_available(spark, wh.landing, wh.raw, a.checkpoint or wh.p("_ingest_checkpoint"), wh.p("quarantine"))
    return 0


if __name__ == "__main__":
    sys.exit(main())
