"""Incremental pickup of each day's dropped landing files.

``readStream`` over the landing folders carries the rows themselves, each with
the file that it came from; the checkpoint records which files were taken.
``trigger(availableNow=True)`` drains what is there and stops, which makes the
daily schedule a plain re-run of the same query.

Every micro-batch is typed and staged, by day and batch, in one write that
observes its counts (budget, bad rows to the quarantine). The days it touched are
then rebuilt from all that is staged for them: a late file joins its day, and a file
that was delivered again, whole or under another name, counts once (files of a day
with the same rows are one). Nothing per file reaches the driver: the ledger of files
is an aggregate of the staged rows. A batch that is re-delivered after a failure
overwrites its own staged rows and rebuilds the same days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from retention.schemas import RAW_SCHEMA, RAW_TEXT_SCHEMA
from retention.sources import landing as L, tables as TB

#: Where landing files lie under the landing folder, and files of one micro-batch.
PATTERN, FILES_PER_BATCH = "*/churn_raw.csv", 10_000

STAGED = T.StructType([*[f for f in RAW_SCHEMA.fields if f.name != TB.PART], T.StructField("_source", T.StringType()),
                       T.StructField("_reason", T.StringType()), T.StructField("_file", T.StringType()),
                       *[f for f in RAW_SCHEMA.fields if f.name == TB.PART], T.StructField("_batch", T.LongType())])


def stage(batch: DataFrame, batch_id: int, staged: str) -> dict[str, int]:
    """Writes a micro-batch's typed rows under their day and batch; returns how many, and how many are bad."""
    rows = L.typed_rows(batch, RAW_TEXT_SCHEMA.fieldNames(), keep=("_file",)).withColumn("_batch", F.lit(batch_id).cast("bigint"))
    seen = Observation()
    (rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count("_reason").alias("bad"))
     .write.partitionBy(TB.PART, "_batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(staged))
    return {k: v or 0 for k, v in seen.get.items()}


def file_ledger(rows: DataFrame) -> DataFrame:
    """(ingest_date, _batch, _file): the first delivery of each different file of a day. Files are
    different when their counts of rows or the sums of their rows' hashes are."""
    files = rows.groupBy(TB.PART, "_batch", "_file").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.xxhash64("_source").cast("decimal(38,0)")).alias("_sum"))
    first = files.groupBy(TB.PART, "_n", "_sum").agg(F.min(F.struct("_batch", "_file")).alias("_f"))
    return first.select(F.col(TB.PART).alias("_day"), F.col("_f._batch").alias("_b"), F.col("_f._file").alias("_name"))


def publish(spark: SparkSession, staged: str, batch_id: int, raw_table: str) -> None:
    """Rebuilds the days of a batch from all that is staged for them."""
    rows = spark.read.schema(STAGED).parquet(staged)
    touched = rows.where(F.col("_batch") == batch_id).select(TB.PART).distinct()
    rows = rows.join(F.broadcast(touched), TB.PART, "left_semi")  # a row for each day: prunes the other days' folders
    ledger = file_ledger(rows)
    once = rows.where("_reason is null").join(
        ledger, (F.col(TB.PART) == F.col("_day")) & (F.col("_batch") == F.col("_b")) & (F.col("_file") == F.col("_name")), "left_semi")
    TB.write_partitions(once.select(*RAW_SCHEMA.fieldNames()), raw_table, "replace")


def start_ingest(spark: SparkSession, landing: str, raw_table: str, checkpoint: str, quarantine: str,
                 budget: L.Budget = L.Budget(), available_now: bool = True, pattern: str = PATTERN,
                 staged: str | None = None, files_per_batch: int = FILES_PER_BATCH):
    staged = staged or f"{raw_table.rstrip('/')}_staged"
    text = T.StructType([*RAW_TEXT_SCHEMA.fields, T.StructField(L.CORRUPT, T.StringType())])
    stream = (spark.readStream.schema(text).option("header", True).option("multiLine", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", L.CORRUPT).option("maxFilesPerTrigger", files_per_batch)
              .csv(f"{landing.rstrip('/')}/{pattern}").select(*text.fieldNames(), F.col("_metadata.file_path").alias("_file")))

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        counts = stage(batch, batch_id, staged)
        if counts["bad"]:
            aside = session.read.schema(STAGED).parquet(staged).where((F.col("_batch") == batch_id) & F.col("_reason").isNotNull())
            (aside.select(F.col("_source").alias("source"), F.col("_reason").alias("reason"), F.current_timestamp().alias("loaded_at"),
                          F.col("_batch").alias("batch"))
             .write.partitionBy("batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(quarantine))
        budget.check(counts["bad"], counts["rows"])
        if counts["rows"]:
            publish(session, staged, batch_id, raw_table)

    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def ingest_available(spark: SparkSession, landing: str, raw_table: str, checkpoint: str, quarantine: str,
                     budget: L.Budget = L.Budget(), pattern: str = PATTERN, files_per_batch: int = FILES_PER_BATCH) -> None:
    q = start_ingest(spark, landing, raw_table, checkpoint, quarantine, budget, True, pattern, files_per_batch=files_per_batch)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
