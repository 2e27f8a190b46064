"""Run status log (append-only) and the gate between pipeline steps."""

from __future__ import annotations

import contextlib
import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from retention.schemas import STATUS_FAILED, STATUS_SCHEMA, STATUS_STARTED, STATUS_SUCCESS
from retention.sources.files import exists


class GateError(RuntimeError):
    pass


def append_status(spark: SparkSession, path: str, run_id: str, step: str, status: str,
                  message: str = "", now: _dt.datetime | None = None) -> None:
    """Append one (run_id, step, status, message, created_at) row."""
    ts = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    row = spark.createDataFrame([(run_id, step, status, message)],
                                "run_id string, step string, status string, message string")
    row.withColumn("created_at", ts).select(*STATUS_SCHEMA.fieldNames()) \
        .withColumn("log_day", F.to_date("created_at")).write.mode("append").partitionBy("log_day").parquet(path)


def read_status(spark: SparkSession, path: str, since: _dt.date | None = None) -> DataFrame:
    """The log, or with ``since`` its days from that one on (a partition filter). A log that has
    not been begun is empty; any other failure to read it is an error."""
    if not exists(spark, path):
        return spark.createDataFrame([], STATUS_SCHEMA)
    log = spark.read.schema(T.StructType([*STATUS_SCHEMA.fields, T.StructField("log_day", T.DateType())])).parquet(path)
    if since is not None:
        log = log.where(F.col("log_day") >= F.lit(since))
    return log.select(*STATUS_SCHEMA.fieldNames())


def latest_status(log: DataFrame) -> DataFrame:
    """T2 batch form: newest status per (run_id, step). ``max_by`` is
    partially aggregated, so a run with many rows never gathers in one task.
    Ties on created_at are broken by the status text and message."""
    key = F.struct("created_at", "status", "message")
    return log.groupBy("run_id", "step").agg(
        F.max_by("status", key).alias("status"), F.max("created_at").alias("created_at"))


def assert_prev_success(spark: SparkSession, path: str, run_id: str, prev_step: str) -> None:
    """The newest status of (run_id, prev_step) must be SUCCESS."""
    log = read_status(spark, path).where((F.col("run_id") == run_id) & (F.col("step") == prev_step))
    row = latest_status(log).first()
    if row is None or row["status"] != STATUS_SUCCESS:
        found = "never ran" if row is None else f"ended as {row['status']}"
        raise GateError(f"run {run_id}: step {prev_step} {found}, so the next step may not start")


@contextlib.contextmanager
def step(spark: SparkSession, path: str, run_id: str, name: str, gate: str | None = None):
    """Gate -> STARTED -> body -> SUCCESS (message set via the yielded dict)
    or FAILED(error text), re-raising the error."""
    if gate:
        try:
            assert_prev_success(spark, path, run_id, gate)
        except Exception as e:
            append_status(spark, path, run_id, name, STATUS_FAILED, str(e))
            raise
    append_status(spark, path, run_id, name, STATUS_STARTED)
    info = {"message": ""}
    try:
        yield info
    except Exception as e:
        append_status(spark, path, run_id, name, STATUS_FAILED, str(e))
        raise
    append_status(spark, path, run_id, name, STATUS_SUCCESS, info.get("message", ""))
