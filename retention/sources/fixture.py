"""Test fixture: derive raw churn rows from the driver's ``customer`` and
``orders`` tables (mapping documented in FIXTURES.md section 3).

Everything here is a DataFrame plan: one partial+final aggregate of orders by
customer key, one join with customer (both sides keyed on the customer key,
so the aggregate's hash partitioning is reused), then narrow projections.
Duplicated rows are produced by an ``explode`` (no second scan, no union).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from retention.functions import idiv

RAW_FIXTURE_COLUMNS = [
    "k", "customer_id", "gender", "senior_citizen", "partner", "dependents",
    "tenure", "phone_service", "multiple_lines", "internet_service",
    "online_security", "online_backup", "device_protection", "tech_support",
    "streaming_tv", "streaming_movies", "contract", "paperless_billing",
    "payment_method", "monthly_charges", "total_charges", "churn", "ingest_date",
]

# Fixed values of the fixture mapping.
FIXTURE_DAYS = ["2025-08-22", "2025-08-23", "2025-08-24"]
CHURN_CUTOFF = "2000-12-01"
PAYMENT_BY_NATION_MOD4 = ["Electronic check", "Mailed check",
                          "Bank transfer (automatic)", "Credit card (automatic)"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _money_text(cents: str) -> Column:
    return F.concat(idiv(cents, 100).cast("string"), F.lit("."),
                    F.lpad((F.col(cents) % 100).cast("string"), 2, "0"))


def _no_net(seg: Column, otherwise: Column) -> Column:
    return F.when(seg == "HOUSEHOLD", F.lit("No internet service")).otherwise(otherwise)


def _yes_every(k: Column, m: int, yes: str = "Yes") -> Column:
    return F.when(k % m == 0, F.lit(yes)).otherwise(F.lit("No"))


def raw_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw row per customer key ``k`` (before the planted duplicates)."""
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer")
    o = (orders.groupBy("o_custkey")
         .agg(F.count(F.lit(1)).alias("n"),
              F.min("o_orderdate").cast("date").alias("d0"),
              F.max("o_orderdate").cast("date").alias("d1"),
              F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("tot_cents")))
    b = (customer.join(o, customer.c_custkey == o.o_custkey, "left")
         .select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nk"),
                 F.col("c_mktsegment").alias("seg"), "n", "d1",
                 F.datediff("d1", "d0").alias("days"),
                 (F.round(F.col("c_acctbal") * 100).cast("bigint") + 100000).alias("_acct"),
                 F.col("tot_cents"))
         .withColumn("m_cents", F.lit(2000) + idiv("_acct", 110))
         .withColumn("t_cents", idiv("tot_cents", 1000))
         .withColumn("_ten", F.col("days") * (F.col("k") % 4 + 1)))
    k, nk, seg = F.col("k"), F.col("nk"), F.col("seg")
    pay = F.element_at(F.array(*[F.lit(p) for p in PAYMENT_BY_NATION_MOD4]),
                       (nk % 4 + 1).cast("int"))
    day = F.element_at(F.array(*[F.lit(d).cast("date") for d in FIXTURE_DAYS]),
                       (nk % 3 + 1).cast("int"))
    return b.select(
        k,
        F.when(k % 101 == 0, F.lit(None)).otherwise(k + 1).cast("bigint").alias("customer_id"),
        F.when(k % 31 == 0, F.lit(None)).when(k % 2 == 0, F.lit(" Male"))
         .otherwise(F.lit("Female ")).alias("gender"),
        F.when(k % 29 == 0, F.lit(None)).when(nk % 5 == 0, F.lit("1"))
         .otherwise(F.lit("0")).alias("senior_citizen"),
        F.when(nk % 2 == 0, F.lit("Yes")).otherwise(F.lit(" No")).alias("partner"),
        F.when(nk % 7 == 0, F.lit("Yes")).otherwise(F.lit("No")).alias("dependents"),
        F.when(k % 27 == 0, F.lit("bad")).when(k % 53 == 0, F.lit("-3"))
         .when(k % 37 == 0, F.lit("0"))
         .otherwise(idiv("_ten", 120).cast("string")).alias("tenure"),
        F.when(k % 10 == 0, F.lit("No")).otherwise(F.lit("Yes")).alias("phone_service"),
        F.when(k % 10 == 0, F.lit("No phone service")).when(k % 3 == 0, F.lit("Yes"))
         .otherwise(F.lit("No")).alias("multiple_lines"),
        F.when(seg == "HOUSEHOLD", F.lit("No"))
         .when(seg.isin("BUILDING", "AUTOMOBILE"), F.lit("DSL"))
         .otherwise(F.lit("Fiber optic")).alias("internet_service"),
        _no_net(seg, F.when(k % 41 == 0, F.lit(None)).when(k % 3 == 0, F.lit(" Yes"))
                .otherwise(F.lit("No"))).alias("online_security"),
        _no_net(seg, _yes_every(k, 4)).alias("online_backup"),
        _no_net(seg, _yes_every(k, 5, "Yes ")).alias("device_protection"),
        _no_net(seg, _yes_every(k, 6)).alias("tech_support"),
        _no_net(seg, _yes_every(k, 7)).alias("streaming_tv"),
        _no_net(seg, _yes_every(k, 8)).alias("streaming_movies"),
        F.when(k % 97 == 0, F.lit("Unknown")).when(F.col("n") >= 12, F.lit("Two year"))
         .when(F.col("n") >= 9, F.lit("One year"))
         .otherwise(F.lit("Month-to-month")).alias("contract"),
        F.when(nk % 3 == 1, F.lit("Yes")).otherwise(F.lit("No")).alias("paperless_billing"),
        pay.alias("payment_method"),
        F.when(k % 43 == 0, F.lit("")).otherwise(_money_text("m_cents")).alias("monthly_charges"),
        F.when(k % 47 == 0, F.lit(" ")).when(F.col("t_cents").isNull(), F.lit(None))
         .otherwise(_money_text("t_cents")).alias("total_charges"),
        F.when(k % 61 == 0, F.lit(None))
         .when(F.col("d1") < F.lit(CHURN_CUTOFF).cast("date"), F.lit("Yes "))
         .otherwise(F.lit("No")).alias("churn"),
        day.alias("ingest_date"),
    )


def raw_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw table: every customer once, and every 89th key twice (planted duplicates)."""
    r = raw_unique(spark, sf_dir)
    copies = F.sequence(F.lit(0), F.when(F.col("k") % 89 == 0, F.lit(1)).otherwise(F.lit(0)))
    return (r.withColumn("_copy", F.explode(copies)).drop("_copy")
             .select(*RAW_FIXTURE_COLUMNS))


def scored_fixture(features: DataFrame) -> DataFrame:
    """Deterministic (label, score) pairs over a feature table for the metric
    operators: score = ((k*37) % 100) / 100 with k = customer_id - 1."""
    k = F.col("customer_id") - 1
    return features.select(
        "customer_id", "ingest_date",
        F.col("churn_label").cast("bigint").alias("label"),
        (((k * 37) % 100).cast("double") / F.lit(100.0).cast("double")).alias("score"))


# Headers of the primary source file (public telco churn layout), in file order.
PRIMARY_HEADERS = [
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure",
    "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity",
    "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
    "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod",
    "MonthlyCharges", "TotalCharges", "Churn",
]
_SNAKE_BODY = [c for c in RAW_FIXTURE_COLUMNS if c not in ("k", "customer_id", "ingest_date")]


def two_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """FIXTURES.md 3.3: the de-duplicated raw rows split into a primary source
    (keys with k % 10 < 7, CamelCase headers, own id column) and a secondary
    one (snake_case headers, no tech_support, an unknown ``note`` column).
    Every value is text, as read from CSV; ``k`` is the in-file row order."""
    r = raw_unique(spark, sf_dir)
    prim = r.where(F.col("k") % 10 < 7).select(
        "k", F.concat(F.lit("C"), F.col("k").cast("string")).alias("customerID"),
        *[F.col(c).cast("string").alias(h) for c, h in zip(_SNAKE_BODY, PRIMARY_HEADERS[1:])])
    sec = r.where(F.col("k") % 10 >= 7).select(
        "k", *[F.col(c).cast("string").alias(c) for c in _SNAKE_BODY if c != "tech_support"],
        F.concat(F.lit("note "), F.col("k").cast("string")).alias("note"))
    return prim, sec
