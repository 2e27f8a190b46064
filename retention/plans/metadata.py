"""Feature metadata table: one row for each feature column, from the tables' schemas."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from retention.schemas import CLEAN_SCHEMA, FEATURE_METADATA_SCHEMA, FEATURE_SCHEMA

DEFAULT_LIMIT = 200
VERSION = "v1"
#: What a feature means, where its name alone does not say it.
MEANING = {
    "is_senior": "1 in senior_citizen of the clean row",
    "has_internet": "any internet service but No",
    "services_count": "add-ons with Yes, of six; NULL where one is unknown",
    "avg_charges_per_tenure": "total_charges per month of tenure, NULL for no months",
    "charges_per_service": "monthly_charges per add-on, NULL without add-ons",
    "internet_type": "internet_service of the clean row",
    "contract_type": "contract of the clean row",
    "contract_length_months": "months that the contract runs",
    "tenure_bucket": "range of months that holds tenure",
    "is_high_spender": "monthly_charges over the day's 80th percentile",
}


def seed_metadata(spark: SparkSession, created: _dt.date | None = None) -> DataFrame:
    """Name, type, meaning and source table of every feature column, stamped with ``created``
    (default today). Its source is the clean table where the column is taken over as it is."""
    d = created or _dt.date.today()
    clean = set(CLEAN_SCHEMA.fieldNames())
    rows = [(f.name, f.dataType.simpleString(), MEANING.get(f.name, f.name.replace("_", " ")),
             "clean" if f.name in clean else "features", VERSION, d) for f in FEATURE_SCHEMA.fields]
    return spark.createDataFrame(rows, FEATURE_METADATA_SCHEMA)


def write_metadata(df: DataFrame, path: str) -> None:
    """CREATE OR REPLACE semantics: a full rewrite of a small table."""
    df.write.mode("overwrite").parquet(path)


def query_metadata(df: DataFrame, feature_name: str | None = None, version: str | None = None,
                   source: str | None = None, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Optional exact filters, ordered by name, limited."""
    for col, val in (("feature_name", feature_name), ("version", version), ("source", source)):
        if val:
            df = df.where(F.col(col) == val)
    return df.orderBy("feature_name", "version", "source").limit(int(limit))
