"""Clean step: typed, trimmed, labelled rows of one day (or of every day).

A narrow projection + filter; with a partitioned source the date condition
becomes a PartitionFilter and the NOT NULL check a pushed Parquet filter.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, functions as F

from retention.functions import ws_trim, safe_bigint, safe_double, blank_to_null
from retention.schemas import CLEAN_TEXT_COLUMNS, CLEAN_COLUMNS


def day_lit(day) -> Column:
    if isinstance(day, (_dt.date, _dt.datetime)):
        day = day.isoformat()[:10]
    return F.lit(str(day)).cast("date")


def churn_label(churn) -> Column:
    """1 when the trimmed label is exactly 'Yes'; NULL and anything else -> 0."""
    c = F.col(churn) if isinstance(churn, str) else churn
    return F.when(ws_trim(c) == "Yes", F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def clean(raw: DataFrame, day=None) -> DataFrame:
    """Raw -> clean. ``day`` = one partition (the daily job); None = all days
    (identical to running the daily job once per day)."""
    types = dict(raw.dtypes)
    df = raw.where(F.col("customer_id").isNotNull())
    if day is not None:
        df = df.where(F.col("ingest_date") == day_lit(day))
    text = {c: ws_trim(F.col(c).cast("string")).alias(c) for c in CLEAN_TEXT_COLUMNS}
    cols = {
        "customer_id": safe_bigint("customer_id", types.get("customer_id")).alias("customer_id"),
        "senior_citizen": safe_bigint("senior_citizen", types.get("senior_citizen")).alias("senior_citizen"),
        "tenure": safe_bigint("tenure", types.get("tenure")).alias("tenure"),
        "monthly_charges": safe_double("monthly_charges", types.get("monthly_charges")).alias("monthly_charges"),
        "total_charges": safe_double(blank_to_null("total_charges"), "string").alias("total_charges"),
        "churn": ws_trim(F.col("churn").cast("string")).alias("churn"),
        "churn_label": churn_label("churn").alias("churn_label"),
        "ingest_date": (day_lit(day) if day is not None else F.col("ingest_date").cast("date")).alias("ingest_date"),
        **text,
    }
    return df.select(*[cols[c] for c in CLEAN_COLUMNS])


def latest_partition(df: DataFrame, part_col: str = "ingest_date") -> DataFrame:
    """Rows of the newest partition (``WHERE d = (SELECT MAX(d) ...)``).

    An uncorrelated scalar subquery: on a partitioned source it is planned as a
    PartitionFilter, and the inner MAX reads only partition values.
    """
    return df.where(F.col(part_col) == df.select(F.max(part_col)).scalar())
