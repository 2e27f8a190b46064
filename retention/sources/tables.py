"""Partitioned Parquet tables: create, replace one day, append, evolve schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from retention.sources.files import has_file, list_folders

PART = "ingest_date"
#: Folder of the NULL partition in the usual layout.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
#: Keys of a lookup that go into the scan's filter instead of a join (the session pushes lists of this length).
SHORT_LIST = 1000


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """With the known ``schema`` no file footer is opened beforehand; columns that older files lack
    are NULL. Without one the schemas of all files are merged."""
    return spark.read.schema(schema).parquet(path) if schema is not None else \
        spark.read.option("mergeSchema", True).parquet(path)


def partition_values(spark: SparkSession, path: str, part: str = PART) -> list[str]:
    """Values of the partition column, smallest first, from the folder names alone: no file is opened."""
    names = [n.split("=", 1)[1] for n in list_folders(spark, path) if n.startswith(f"{part}=")]
    return sorted(n for n in names if n != NULL_FOLDER)


def read_newest(spark: SparkSession, path: str, schema: T.StructType | None = None, part: str = PART) -> DataFrame:
    """The rows of the newest partition (none of an empty table). Its value comes from the folder
    names, so the plan is one scan of one partition, without a scan for the maximum. Sorts as text:
    dates as yyyy-MM-dd do."""
    table = read_table(spark, path, schema)
    values = partition_values(spark, path, part)
    return table.where(F.col(part) == F.lit(values[-1]).cast(table.schema[part].dataType)) if values else table.limit(0)


def counted(df: DataFrame, **aggregates: Column) -> tuple[DataFrame, Observation]:
    """``df`` with its row count (``rows``) and the given aggregates observed by whatever
    action writes it; ``.get`` of the second has them afterwards."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in aggregates.items()]), seen


def usable(spark: SparkSession, path: str) -> bool:
    """A table with at most one column counts as absent."""
    return has_file(spark, path, ".parquet") and len(spark.read.parquet(path).columns) > 1


def bloom_options(bloom: dict[str, int] | None) -> dict[str, str]:
    """Parquet options for Bloom filters: column -> different values expected in a file."""
    out = {}
    for c, n in (bloom or {}).items():
        out |= {f"parquet.bloom.filter.enabled#{c}": "true", f"parquet.bloom.filter.expected.ndv#{c}": str(n)}
    return out


def lookup(spark: SparkSession, path: str, column: str, keys: DataFrame, short: int = SHORT_LIST,
           schema: T.StructType | None = None) -> DataFrame:
    """Rows whose ``column`` is among the first column of ``keys``.

    At most ``short`` different keys are fetched and become an IN list that reaches the scan, where
    the files' Bloom filters and bounds skip whole row groups; a longer list is joined."""
    wanted = keys.select(F.col(keys.columns[0]).alias("_key")).where("_key is not null").distinct()
    few = wanted.limit(short + 1).collect()
    table = read_table(spark, path, schema)
    if len(few) <= short:
        return table.where(F.col(column).isin([r[0] for r in few]))
    return table.join(wanted, F.col(column) == F.col("_key"), "left_semi")


def create_table(df: DataFrame, path: str, part: str = PART, bloom: dict[str, int] | None = None) -> None:
    """CREATE OR REPLACE ... PARTITION BY part AS SELECT."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "static").options(**bloom_options(bloom))
     .partitionBy(part).parquet(path))


def write_partitions(df: DataFrame, path: str, mode: str = "replace", part: str = PART,
                     bloom: dict[str, int] | None = None) -> None:
    """Add the day(s) in ``df`` to the table.

    ``replace`` (default): dynamic partition overwrite -- the days present in
    ``df`` are replaced, all other days untouched, so a re-run is idempotent.
    ``append``: plain INSERT (a re-run duplicates the day)."""
    w = df.write.options(**bloom_options(bloom)).partitionBy(part)
    if mode == "replace":
        w.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    elif mode == "append":
        w.mode("append").parquet(path)
    else:
        raise ValueError(mode)


def create_or_write(spark: SparkSession, df: DataFrame, path: str, mode: str = "replace",
                    bloom: dict[str, int] | None = None) -> str:
    """Create when missing (or a <=1-column stub), else S9. New columns appear in the new files
    only (S6); ``read_table`` gives NULL for the old ones, and columns that ``df`` lacks are NULL in it."""
    if not usable(spark, path):
        create_table(df, path, bloom=bloom)
        return "created"
    write_partitions(df, path, mode, bloom=bloom)
    return mode
