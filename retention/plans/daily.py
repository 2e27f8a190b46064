"""The daily batch: prepare -> load -> clean -> validate -> profile -> features
-> train, each step gated on its predecessor through the status log.

A warehouse is a base folder (any Hadoop FS URI) holding the tables:
raw/, clean/, features/ (partitioned by ingest_date), pipeline_status/,
model_registry/, feature_metadata/, and the dated outputs under
landing/<dd-MM-yyyy>/output/.
"""

from __future__ import annotations

import dataclasses
import json

from pyspark import StorageLevel

from pyspark.sql import DataFrame, SparkSession, functions as F

from retention.operators import clean as C, features as FE, prepare as PP, profile as PR, quality as Q, sketches as SK
from retention.operators.clean import day_lit
from retention.plans import model as MD, registry as RG, status as ST
from retention.schemas import CLEAN_SCHEMA, FEATURE_SCHEMA, PROFILE_CATEGORICAL_CANDIDATES, RAW_SCHEMA
from retention.sources import landing as L, tables as TB


#: Columns of the clean table whose sketches are kept by day.
SKETCHED = ["customer_id", *[c for c in PROFILE_CATEGORICAL_CANDIDATES if c in CLEAN_SCHEMA.fieldNames()]]
#: Customers expected in a file of the feature table: sizes the Bloom filters of its lookups.
FEATURE_IDS_PER_FILE = 1_000_000


@dataclasses.dataclass(frozen=True)
class Warehouse:
    base: str

    def p(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    @property
    def raw(self): return self.p("raw")
    @property
    def clean(self): return self.p("clean")
    @property
    def features(self): return self.p("features")
    @property
    def status(self): return self.p("pipeline_status")
    @property
    def registry(self): return self.p("model_registry")
    @property
    def landing(self): return self.p("landing")

    def output(self, day, kind: str) -> str:
        return f"{self.landing}/{L.day_folder(day)}/output/{kind}"


def init_warehouse(spark: SparkSession, wh: Warehouse) -> None:
    """Create the raw table (empty, schema fixed) and the registry."""
    if not TB.usable(spark, wh.raw):
        spark.createDataFrame([], RAW_SCHEMA).write.mode("overwrite").partitionBy("ingest_date").parquet(wh.raw)
    RG.ensure_registry(spark, wh.registry)


def prepare_day(spark: SparkSession, wh: Warehouse, primary: str, secondary: str | None, day) -> str:
    """Prepare: two sources -> one headered CSV for the day (no status row)."""
    p = L.read_source(spark, primary)
    s = L.read_optional_source(spark, secondary) if secondary else None
    raw = PP.prepare(p, s, day, L.ORDER_COLS, scan_order=True)
    out = L.write_daily_csv(raw, wh.landing, day)
    PP.sanity_counts(raw).write.mode("overwrite").parquet(wh.output(day, "prepare"))
    return out


def load_day(spark: SparkSession, wh: Warehouse, run_id: str, day, mode: str = "replace",
             budget: L.Budget = L.Budget()) -> int:
    """Load the day's landing file into raw. ``replace`` (default) rewrites the
    day so a re-run is idempotent; ``append`` adds the rows again (parity with
    an append-only load job). Bad rows go to the warehouse's quarantine table;
    beyond ``budget`` the step fails. Files are read by their own headers, so a new
    column is kept (S6). Counts are observed by the parse and by the write."""
    with ST.step(spark, wh.status, run_id, "load_raw") as info:
        reg = RG.read_registry(spark, wh.registry)
        RG.write_registry(spark, wh.registry,
                          RG.upsert_running(reg, spark.createDataFrame([(run_id,)], "run_id string")))
        L.require_table(spark, wh.raw)
        good, counts = L.load_counted(spark, L.daily_path(wh.landing, day), wh.p("quarantine"), budget, by_header=True)
        rows, written = TB.counted(good)
        TB.write_partitions(rows, wh.raw, mode)
        n = spark.read.schema(RAW_SCHEMA).parquet(wh.raw).count()  # S12: the table's rows, from the file footers
        info["message"] = f"loaded {written.get['rows']} rows of {counts['rows']} ({counts['bad']} bad); the table has {n}"
    return n


def clean_day(spark: SparkSession, wh: Warehouse, run_id: str, day, mode: str = "replace") -> None:
    with ST.step(spark, wh.status, run_id, "clean", gate="load_raw"):
        raw = spark.read.schema(RAW_SCHEMA).parquet(wh.raw)
        rows = C.clean(raw, day)
        TB.create_or_write(spark, rows, wh.clean, mode)
        done = TB.read_table(spark, wh.clean, CLEAN_SCHEMA).where(F.col("ingest_date") == day_lit(day))
        SK.write_sketches(done, SKETCHED, wh.p("clean_sketches"))


def validate_day(spark: SparkSession, wh: Warehouse, run_id: str, day) -> DataFrame:
    """Reports, never blocks: SUCCESS whatever the counts."""
    with ST.step(spark, wh.status, run_id, "validate_clean", gate="clean"):
        rep = Q.validation_report(TB.read_table(spark, wh.clean, CLEAN_SCHEMA), day)
        out = wh.output(day, "validation")
        rep.select("check", "result_json").write.mode("overwrite").option("header", True).csv(out)
    return spark.read.option("header", True).csv(out)


def profile_day(spark: SparkSession, wh: Warehouse, run_id: str, day) -> None:
    with ST.step(spark, wh.status, run_id, "eda", gate="validate_clean"):
        # Ten reports read the same day: keep its rows for the step only
        # (MEMORY_AND_DISK; recomputed from the partition if a block is lost).
        df = (TB.read_table(spark, wh.clean, CLEAN_SCHEMA).where(F.col("ingest_date") == day_lit(day))
              .persist(StorageLevel.MEMORY_AND_DISK))
        try:
            PR.require_rows(df)
            PR.pick_columns(df)
            out = wh.output(day, "eda")
            for name, fn in [("summary_numeric", PR.numeric_summary),
                             ("summary_categorical_uniques", PR.categorical_uniques),
                             ("correlation_numeric", PR.correlation_matrix),
                             ("top_label_correlations", PR.top_label_correlations),
                             ("categorical_churn_rates", PR.churn_rates_wide), ("top_rates", PR.top_rates),
                             ("churn_rate_sorted", PR.churn_rate_sorted),
                             ("histograms", PR.histogram), ("box_stats", PR.box_stats),
                             ("value_counts", PR.value_counts)]:
                fn(df).write.mode("overwrite").parquet(f"{out}/{name}")
        finally:
            df.unpersist()


def features_day(spark: SparkSession, wh: Warehouse, run_id: str, day, gate: str = "validate_clean",
                 mode: str = "replace") -> None:
    with ST.step(spark, wh.status, run_id, "features", gate=gate):
        cl = TB.read_table(spark, wh.clean, CLEAN_SCHEMA)
        TB.create_or_write(spark, FE.build_features(cl, day), wh.features, mode, bloom={"customer_id": FEATURE_IDS_PER_FILE})


def train_day(spark: SparkSession, wh: Warehouse, run_id: str, day) -> tuple[str, int]:
    with ST.step(spark, wh.status, run_id, "train", gate="features") as info:
        RG.ensure_registry(spark, wh.registry)
        reg, version = RG.bind_version(spark, RG.read_registry(spark, wh.registry), run_id)
        RG.write_registry(spark, wh.registry, reg)
        try:
            rows = MD.load_training_rows(TB.read_table(spark, wh.features, FEATURE_SCHEMA), day)
            best, model, metrics = MD.train_and_evaluate(rows)
            uri, muri = MD.save_model(model, metrics, wh.output(day, "model"), version, best, spark)
            mj = json.dumps({"version": version, "best_model": best, "candidates": metrics,
                             "model_uri": uri, "metrics_uri": muri})
            target = spark.createDataFrame([(run_id, version, uri, mj)],
                                           "run_id string, version bigint, artifact_uri string,"
                                           " metrics_json string")
            reg = RG.promote(RG.read_registry(spark, wh.registry), target)
            RG.write_registry(spark, wh.registry, reg)
        except Exception as e:
            RG.write_registry(spark, wh.registry,
                              RG.mark_failed(RG.read_registry(spark, wh.registry), run_id, version, str(e)))
            raise
        info["message"] = f"v{version} READY: {uri}"
    return uri, version
