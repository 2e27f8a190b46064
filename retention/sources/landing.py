"""Landing CSV files: read sources, write the daily file, load with a
bad-record budget.

Everything is read as text with an explicit schema (no inference pass), so
"bad" means only a row whose token count or typed conversion fails. Bad rows
are always set aside with their text and the reason. A load parses its files
once, into a table in the shared folder; rows, bad rows and missing values are
observed by that write, not counted by another scan.
"""

from __future__ import annotations

import csv
import datetime as _dt
import uuid
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from retention.functions import count_when, safe_double
from retention.schemas import MAX_BAD_RECORDS, PREP_NUMERIC_COLUMNS, RAW_SCHEMA, RAW_TEXT_SCHEMA
from retention.session import checkpoint_dir
from retention.sources.files import exists, list_files

CORRUPT = "_corrupt_record"
ORDER_COLS = ["_src_file", "_src_block", "_src_pos"]


class BadRecordBudgetExceeded(RuntimeError):
    pass


class TableMissing(RuntimeError):
    pass


class SchemaRefused(RuntimeError):
    pass


def day_folder(day) -> str:
    """dd-MM-yyyy folder name of a date."""
    d = day if isinstance(day, (_dt.date, _dt.datetime)) else _dt.date.fromisoformat(str(day)[:10])
    return d.strftime("%d-%m-%Y")


def daily_path(base: str, day, name: str = "churn_raw.csv") -> str:
    return f"{base.rstrip('/')}/{day_folder(day)}/{name}"


def with_row_order(df: DataFrame) -> DataFrame:
    """Order key of each row inside its file: (file, split start, position).
    Rows of one split are read in order, so the increasing id orders them."""
    return df.select("*", F.col("_metadata.file_path").alias("_src_file"),
                     F.col("_metadata.file_block_start").alias("_src_block"),
                     F.monotonically_increasing_id().alias("_src_pos"))


def header_groups(spark: SparkSession, files: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by their column names, from one distributed pass that keeps each file's first line."""
    first = (spark.read.text(files).select("value", F.col("_metadata.file_path").alias("file"),
                                           F.col("_metadata.file_block_start").alias("at"),
                                           F.monotonically_increasing_id().alias("line"))
             .where("at = 0").groupBy("file").agg(F.min_by("value", "line").alias("header")))
    out: dict[tuple[str, ...], list[str]] = {}
    for r in first.groupBy("header").agg(F.array_sort(F.collect_list("file")).alias("files")).orderBy("header").collect():
        out.setdefault(tuple(next(csv.reader([r["header"].lstrip("\ufeff")]))), []).extend(r["files"])
    return out


def read_source(spark: SparkSession, path: str, first_only: bool = False) -> DataFrame:
    """Headered CSV, every column text, quoted newlines allowed.

    All CSV files under ``path`` (recursively), each by its own header: files
    with one header are read together, groups are stacked by column name (a
    column that a file lacks is NULL there). ``first_only`` takes the first file
    in name order instead. The headers come from one distributed job; the driver
    sees the different ones and the file names."""
    files = [path] if path.endswith(".csv") else list_files(spark, path, ".csv")
    if not files:
        raise FileNotFoundError(f"{path} holds no file that ends in .csv")
    out = None
    for names, group in header_groups(spark, files[:1] if first_only else files).items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        rows = with_row_order(spark.read.option("header", True).option("multiLine", True).option("escape", '"')
                              .schema(schema).csv(group))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(f"the files under {path} are empty")
    return out


def read_optional_source(spark: SparkSession, path: str) -> DataFrame | None:
    """The secondary source, or None where it is absent."""
    if not exists(spark, path) or not (path.endswith(".csv") or list_files(spark, path, ".csv")):
        return None
    return read_source(spark, path)


def write_daily_csv(df: DataFrame, base: str, day, mode: str = "overwrite") -> str:
    """S3: headered CSV under <base>/<dd-MM-yyyy>/churn_raw.csv (a folder of
    part files written in parallel)."""
    out = daily_path(base, day)
    (df.write.mode(mode).option("header", True)
       # keep values byte-exact: Spark's CSV writer trims blanks by default
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(out))
    return out


@dataclass(frozen=True)
class Budget:
    """How many bad rows a load may have: at most ``count`` rows and at most ``share`` of its
    rows; None leaves that bound out. Within it bad rows are set aside, beyond it the load fails."""

    count: int | None = MAX_BAD_RECORDS
    share: float | None = None

    def check(self, bad: int, rows: int) -> None:
        if self.count is not None and bad > self.count:
            raise BadRecordBudgetExceeded(f"{bad} of {rows} rows are bad; {self.count} are allowed")
        if self.share is not None and bad > self.share * rows:
            raise BadRecordBudgetExceeded(f"{bad} of {rows} rows are bad; a share of {self.share} is allowed")


@dataclass(frozen=True)
class Fit:
    """How a file's columns meet the raw schema: ``added`` ones are new, ``absent`` ones it lacks."""

    added: tuple[str, ...]
    absent: tuple[str, ...]


def reconcile(names: tuple[str, ...], known: T.StructType = RAW_SCHEMA, required: tuple[str, ...] = ("ingest_date",)) -> Fit:
    """Columns of a file against those of its target, by name. A column that the target has not is
    added as text, one that the file has not is NULL. Refused: names that are empty, occur twice or
    differ from another column in case only, and files without a ``required`` column."""
    have = known.fieldNames()
    spelled = {c.lower(): c for c in have}
    twice = [n for n, k in Counter(n.lower() for n in names).items() if k > 1]
    other_case = [n for n in names if spelled.get(n.lower(), n) != n]
    lacking = [c for c in required if c not in names]
    if twice or other_case or lacking or not all(names):
        raise SchemaRefused(f"columns {names}: twice {twice}, other case {other_case}, required but absent {lacking}")
    return Fit(tuple(n for n in names if n not in have), tuple(c for c in have if c not in names))


def typed_rows(text: DataFrame, names: list[str], added: tuple[str, ...] = (), keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed raw columns of text rows with the fields ``names``, ``added`` ones as text, ``_source`` and
    ``_reason``: NULL for a good row, else what is wrong with it: too few fields, or the first column
    whose text is not of its type. Whole-number columns take whole numbers only. ``keep``: columns that
    are no fields of the file and follow as they are."""
    # A corrupt row is either too short (bad) or too long (extras ignored).
    wide = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names) + 1)])
    too_long = F.from_csv(F.col(CORRUPT), wide.simpleString()).getField(f"c{len(names)}").isNotNull()
    short = F.col(CORRUPT).isNotNull() & ~F.coalesce(too_long, F.lit(False))
    cols, reasons = [], [F.when(short, F.lit("too few fields"))]
    for f in RAW_SCHEMA.fields:
        if f.name not in text.columns:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f.name)
        x = F.trim(c)
        if isinstance(f.dataType, T.LongType):
            v = F.when(x.rlike(r"^[+-]?[0-9]+$"), x.try_cast("bigint"))
        elif isinstance(f.dataType, T.DoubleType):
            v = safe_double(c)
        elif isinstance(f.dataType, T.DateType):
            v = F.when(x.rlike(r"^\d{4}-\d{2}-\d{2}$"), x.try_cast("date"))
        else:
            cols.append(c.alias(f.name))
            continue
        reasons.append(F.when(c.isNotNull() & (x != "") & v.isNull(), F.lit(f.name)))
        cols.append(v.alias(f.name))
    fields = [F.col(f"`{c}`") for c in names]
    return text.select(*cols, *[F.col(f"`{c}`") for c in added], F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*fields))).alias("_source"),
                       F.coalesce(*reasons).alias("_reason"), *keep)


def _text_rows(spark: SparkSession, paths: str | list[str], names: list[str]) -> DataFrame:
    """All fields as text, and the whole text of rows that have another number of them."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    return (spark.read.schema(schema).option("header", True).option("multiLine", True).option("enforceSchema", True)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(paths))


def parse_landing(spark: SparkSession, paths: str | list[str], by_header: bool = False) -> tuple[DataFrame, dict[str, int]]:
    """Typed raw columns of landing files, ``_source`` text and ``_reason`` (NULL: good), and what the
    parse counted: ``rows``, ``bad`` and, of the good rows, ``null_<column>`` of the numeric columns (P12).

    Quoted newlines allowed, header skipped; too few fields or text of the wrong
    type make a row bad, extra trailing fields are ignored. ``by_header`` reads each file by its own
    header (``reconcile``) instead of by position; new columns follow the raw ones. The parse runs once
    and writes its rows to the shared folder; the counts are observed by that write."""
    groups = header_groups(spark, paths) if by_header else {tuple(RAW_TEXT_SCHEMA.fieldNames()): paths}
    rows = None
    for names, files in groups.items():
        part = typed_rows(_text_rows(spark, files, list(names)), list(names), reconcile(names).added)
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    good = F.col("_reason").isNull()
    seen = Observation()
    path = f"{checkpoint_dir(spark).rstrip('/')}/parsed-{uuid.uuid4().hex}"
    rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count("_reason").alias("bad"),
                 *[count_when(good & F.col(c).isNull()).alias(f"null_{c}") for c in PREP_NUMERIC_COLUMNS]).write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path), {k: v or 0 for k, v in seen.get.items()}


def load_counted(spark: SparkSession, paths: str | list[str], quarantine: str, budget: Budget = Budget(),
                 by_header: bool = False) -> tuple[DataFrame, dict[str, int]]:
    """S4 + S5: the good rows of landing files, typed to the raw schema, and the parse's counts.

    Nothing is lost: bad rows are appended to ``quarantine`` (Parquet: source,
    reason, loaded_at) before the budget is checked, so they can be looked at
    when the load fails, too. With ``by_header`` new columns are loaded as text (S6)."""
    parsed, counts = parse_landing(spark, paths, by_header)
    if counts["bad"]:
        (parsed.where("_reason is not null")
         .select(F.col("_source").alias("source"), F.col("_reason").alias("reason"),
                 F.current_timestamp().alias("loaded_at")).write.mode("append").parquet(quarantine))
    budget.check(counts["bad"], counts["rows"])
    return parsed.where("_reason is null").drop("_source", "_reason"), counts


def load_csv(spark: SparkSession, paths: str | list[str], quarantine: str, budget: Budget = Budget(),
             by_header: bool = False) -> DataFrame:
    """The rows of ``load_counted``."""
    return load_counted(spark, paths, quarantine, budget, by_header)[0]


def require_table(spark: SparkSession, path: str) -> None:
    """The target table must exist beforehand."""
    if not exists(spark, path):
        raise TableMissing(f"load needs an existing table at {path} (see plans.daily.init_warehouse)")
