"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables and derives the raw, clean and feature
tables from them as one lazy plan, so its work grows with the data.
Aggregated doubles are rounded to 6 decimals for the engine comparison only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from retention.operators import clean as C, features as FE, segments as SG
from retention.sources.fixture import raw_fixture, read_table

AS_OF = "2025-08-24"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def r6(df: DataFrame, *cols: str) -> DataFrame:
    """Round the named double columns (or every double column) to 6 decimals."""
    targets = set(cols) if cols else {c for c, t in df.dtypes if t == "double"}
    return df.select(*[F.round(F.col(c), 6).alias(c) if c in targets else F.col(c)
                       for c in df.columns])


# Base plans (logical plans, not data) are built once per session and data
# folder: analysing the fixture mapping costs about a second of driver time,
# while every query still reads and computes everything from the files.
_PLANS: dict = {}


def _memo(kind, spark, d, build):
    """Reuse a base plan only for the same live session object."""
    key = (kind, d)
    hit = _PLANS.get(key)
    if hit is None or hit[0] is not spark or spark.sparkContext._jsc is None:
        hit = (spark, build())
        _PLANS[key] = hit
    return hit[1]


def raw(spark, d):
    return _memo("raw", spark, d, lambda: raw_fixture(spark, d))


def clean_all(spark, d):
    return _memo("clean", spark, d, lambda: C.clean(raw(spark, d)))


def features_all(spark, d):
    return _memo("features", spark, d, lambda: FE.build_features(clean_all(spark, d)))


# ---- tables and clean -------------------------------------------------------

@query("raw_row_count")
def _q(spark, d):
    return raw(spark, d).agg(F.count(F.lit(1)).alias("cnt"))


@query("clean_table")
def _q(spark, d):
    return clean_all(spark, d)


@query("clean_churn_label")
def _q(spark, d):
    return clean_all(spark, d).groupBy("churn", "churn_label").agg(F.count(F.lit(1)).alias("n"))


@query("latest_clean")
def _q(spark, d):
    return C.latest_partition(clean_all(spark, d))


@query("feature_table")
def _q(spark, d):
    return features_all(spark, d)


@query("features_except_partition")
def _q(spark, d):
    return features_all(spark, d).drop("ingest_date")


@query("latest_features")
def _q(spark, d):
    return C.latest_partition(features_all(spark, d))


# ---- segments ---------------------------------------------------------------

@query("counts_clean_vs_features")
def _q(spark, d):
    return SG.counts_side_by_side(clean_all(spark, d), features_all(spark, d))


@query("churn_distribution")
def _q(spark, d):
    return SG.churn_distribution(clean_all(spark, d))


@query("partition_counts_7d")
def _q(spark, d):
    return SG.partition_counts(features_all(spark, d), AS_OF, 7)


@query("segment_contract")
def _q(spark, d):
    return r6(SG.segment_contract(features_all(spark, d)))


@query("segment_internet_payment")
def _q(spark, d):
    return r6(SG.segment_internet_payment(features_all(spark, d)))


@query("label_correlations")
def _q(spark, d):
    return r6(SG.label_correlations(features_all(spark, d)))


@query("tenure_cohorts")
def _q(spark, d):
    return r6(SG.tenure_cohorts(features_all(spark, d)))


@query("high_risk_segments")
def _q(spark, d):
    return r6(SG.high_risk_segments(features_all(spark, d), min_rows=50, limit=15))


def _ids_from_orders(spark, d):
    """The lookup id list, derived from the data: every customer that placed
    an order (customer_id = key + 1), one request per order."""
    o = read_table(spark, d, "orders")
    return o.select((F.col("o_custkey") + 1).alias("customer_id"))


@query("customer_lookup")
def _q(spark, d):
    return SG.customer_lookup(features_all(spark, d), _ids_from_orders(spark, d))


@query("latest_customer_features")
def _q(spark, d):
    return SG.latest_customer_features(features_all(spark, d), _ids_from_orders(spark, d))


@query("segment_contract_latest")
def _q(spark, d):
    return r6(SG.segment_contract_latest(features_all(spark, d)))


# ---- feature sub-steps ------------------------------------------------------

@query("feature_p80")
def _q(spark, d):
    return FE.daily_p80(clean_all(spark, d))


@query("feature_high_spender")
def _q(spark, d):
    f = features_all(spark, d)
    return f.groupBy("ingest_date", "is_high_spender").agg(F.count(F.lit(1)).alias("n"))


@query("feature_services_count")
def _q(spark, d):
    return features_all(spark, d).groupBy("services_count").agg(F.count(F.lit(1)).alias("n"))


@query("feature_ratios")
def _q(spark, d):
    return features_all(spark, d).select("customer_id", "ingest_date", "avg_charges_per_tenure",
                                         "charges_per_service")


@query("feature_contract_months")
def _q(spark, d):
    return (clean_all(spark, d).select(F.col("contract"),
                                       FE.contract_months(F.col("contract")).alias("contract_length_months"))
            .groupBy("contract", "contract_length_months").agg(F.count(F.lit(1)).alias("n")))


@query("feature_tenure_bucket")
def _q(spark, d):
    return (features_all(spark, d).groupBy("tenure_bucket")
            .agg(F.count(F.lit(1)).alias("n"), F.min("tenure").alias("min_tenure"),
                 F.max("tenure").alias("max_tenure")))


# ---- data quality -----------------------------------------------------------
from retention.operators import quality as Q  # noqa: E402


@query("dq_row_count")
def _q(spark, d):
    return Q.row_count(clean_all(spark, d))


@query("dq_nulls")
def _q(spark, d):
    return Q.nulls(clean_all(spark, d))


@query("dq_label_values")
def _q(spark, d):
    return Q.label_values(clean_all(spark, d))


@query("dq_out_of_range")
def _q(spark, d):
    return Q.out_of_range(clean_all(spark, d))


@query("dq_basic_stats")
def _q(spark, d):
    return r6(Q.basic_stats(clean_all(spark, d)))


@query("dq_distinct_counts")
def _q(spark, d):
    return Q.distinct_counts(clean_all(spark, d))


@query("dq_duplicates")
def _q(spark, d):
    return Q.duplicates(clean_all(spark, d))


@query("dq_partitions_present")
def _q(spark, d):
    return Q.partitions_present(clean_all(spark, d))


@query("dq_report_long")
def _q(spark, d):
    return r6(Q.report_long(clean_all(spark, d)))


@query("validation_report")
def _q(spark, d):
    return Q.validation_report(clean_all(spark, d), digits=6)


# ---- profile (EDA tables) ---------------------------------------------------
from retention.operators import profile as PR  # noqa: E402


@query("profile_numeric")
def _q(spark, d):
    return r6(PR.numeric_summary(clean_all(spark, d)))


@query("profile_categorical_uniques")
def _q(spark, d):
    return PR.categorical_uniques(clean_all(spark, d))


@query("profile_correlation")
def _q(spark, d):
    return r6(PR.correlation_matrix(clean_all(spark, d)))


@query("profile_top_correlations")
def _q(spark, d):
    return r6(PR.top_label_correlations(clean_all(spark, d)))


@query("profile_churn_rates_long")
def _q(spark, d):
    return r6(PR.churn_rates_long(clean_all(spark, d)))


@query("profile_churn_rates_wide")
def _q(spark, d):
    return r6(PR.churn_rates_wide(clean_all(spark, d)))


@query("profile_top3_rates")
def _q(spark, d):
    return r6(PR.top_rates(clean_all(spark, d)))


@query("profile_histogram")
def _q(spark, d):
    return r6(PR.histogram(features_all(spark, d)))


@query("profile_box_stats")
def _q(spark, d):
    return r6(PR.box_stats(clean_all(spark, d)))


@query("profile_value_counts")
def _q(spark, d):
    return PR.value_counts(clean_all(spark, d))


@query("profile_churn_rate_sorted")
def _q(spark, d):
    return r6(PR.churn_rate_sorted(clean_all(spark, d)))


# ---- raw preparation --------------------------------------------------------
from retention.operators import prepare as PP  # noqa: E402
from retention.sources.fixture import raw_unique, two_sources  # noqa: E402


def _two(spark, d):
    return _memo("two_sources", spark, d, lambda: two_sources(spark, d))


def _union(spark, d):
    return _memo("union", spark, d, lambda: PP.union_sources(*_two(spark, d), keep=("k",)))


@query("prep_label_titlecase")
def _q(spark, d):
    r = _memo("raw_unique", spark, d, lambda: raw_unique(spark, d))
    return r.select("k", F.col("churn").alias("churn_raw"),
                    PP.title_label("churn").alias("churn"))


@query("prep_conform_schema")
def _q(spark, d):
    primary, secondary = (PP.conform(s, keep=("k",)) for s in _two(spark, d))
    return (primary.withColumn("source", F.lit("primary"))
            .unionByName(secondary.withColumn("source", F.lit("secondary")), allowMissingColumns=True))


@query("prep_union_sources")
def _q(spark, d):
    return _union(spark, d)


@query("prep_surrogate_ids")
def _q(spark, d):
    p, s = _two(spark, d)
    return PP.prepare(p, s, AS_OF, ["k"])


@query("prep_sparse_ids")
def _q(spark, d):
    """P8 for a text key: the rows of both sources in the order of a digest."""
    u = _union(spark, d).withColumn("key", F.md5(F.col("k").cast("string")))
    return PP.assign_ids(u, ["key"], sparse=True).select("customer_id", "source_ord", "key")


@query("prep_coerce_numeric")
def _q(spark, d):
    u = PP.assign_ids(PP.coerce_numeric(_union(spark, d)), ["k"])
    return u.select("customer_id", "tenure", "monthly_charges", "total_charges")


@query("prep_round_to_int")
def _q(spark, d):
    p, s = _two(spark, d)
    return PP.prepare(p, s, AS_OF, ["k"]).select("customer_id", "senior_citizen", "tenure")


@query("prep_null_counts")
def _q(spark, d):
    return PP.sanity_counts(PP.coerce_numeric(_union(spark, d)))


# ---- model training and evaluation ------------------------------------------
from retention.operators import metrics as MT  # noqa: E402
from retention.plans import model as MD  # noqa: E402
from retention.sources.fixture import scored_fixture  # noqa: E402


@query("stratified_split_counts")
def _q(spark, d):
    s = MD.stratified_split(features_all(spark, d))
    return s.groupBy("churn_label", "is_test").agg(F.count(F.lit(1)).alias("n"))


#: Folder of the training step's outcome for each data folder and session.
_TRAINED: dict = {}


def _trained(spark, d) -> str:
    """Folder of the training step's split and models: written once per session and folder (the
    split of M3 has its own query); every query that fits, evaluates or applies something reads it."""
    key = (d, spark.sparkContext.applicationId)
    if key not in _TRAINED:
        base = f"{checkpoint_dir(spark).rstrip('/')}/trained-{uuid.uuid4().hex}"
        MD.stratified_split(features_all(spark, d)).write.parquet(f"{base}/split")
        _TRAINED[key] = base
    return _TRAINED[key]


def _split(spark, d):
    """The split, written once: fitting and applying both read it."""
    return spark.read.parquet(f"{_trained(spark, d)}/split")


@query("impute_median")
def _q(spark, d):
    s = _split(spark, d)
    return MD.imputed_numbers(s, MD.split_columns(s.drop("is_test"))[0])


@query("standardize")
def _q(spark, d):
    s = _split(spark, d)
    return r6(MD.standardised_numbers(s, MD.split_columns(s.drop("is_test"))[0]))


@query("impute_mode")
def _q(spark, d):
    s = _split(spark, d)
    return MD.imputed_categories(s, MD.split_columns(s.drop("is_test"))[1])


# Kept out of the encoder's fitting rows, so that rows meet a category it has not seen.
WITHHELD_PAYMENT = "Mailed check"


@query("one_hot_matrix")
def _q(spark, d):
    from pyspark.ml import Pipeline
    s = _split(spark, d)
    cats = MD.split_columns(s.drop("is_test"))[1]
    fit = s.where(~F.col("is_test") & ~F.col("payment_method").eqNullSafe(F.lit(WITHHELD_PAYMENT)))
    pre = MD.preprocess_stage([], cats, {}, {}, MD.mode_values(fit, cats))
    enc = Pipeline(stages=[pre] + MD.encoder_stages([], cats)[:2]).fit(fit).transform(s)
    kv = F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"{c}__x").alias("category"),
        F.nullif(F.array_position(MD.vector_to_array(F.col(f"{c}__v")), 1.0) - 1, F.lit(-1)).cast("bigint").alias("position"))
        for c in cats]))
    return enc.select("customer_id", "ingest_date", "is_test", kv.alias("_kv")).select(
        "customer_id", "ingest_date", "is_test", "_kv.column", "_kv.category", "_kv.position")


#: Depth of the registered forest; the training step (plans.daily) takes the default of model.candidates, 30.
QUERY_FOREST_DEPTH = 12


def _fitted(spark, d, which):
    """(model, train, test, n_train) of one candidate, which is fitted once, saved in the training
    step's folder (M14) and loaded by every query that evaluates or applies it."""
    base = _trained(spark, d)
    split = _split(spark, d).withColumn(MD.LABEL, F.col(MD.LABEL).cast("double"))
    train, test = (split.where(F.col("is_test") == side).drop("is_test") for side in (False, True))
    n = train.count()
    if not FS.exists(spark, f"{base}/{which}/metadata/_SUCCESS"):
        _, _, pre, _ = MD.fit_preprocessing(train)
        MD.fit_and_reload(pre + [MD.candidates(n, QUERY_FOREST_DEPTH)[which]], train, f"{base}/{which}")
    return MD.load_model(f"{base}/{which}"), train, test, n


@query("train_logreg")
def _q(spark, d):
    """The intercept is not penalised, so the mean fitted probability is the training label rate."""
    model, train, test, _ = _fitted(spark, d, "logreg")
    fit = MD.positive_probability(model.transform(train)).agg(
        F.count(F.lit(1)).alias("n_train"), F.round(F.avg("score"), 3).alias("mean_probability"),
        F.round(F.avg(MD.LABEL), 3).alias("label_rate"))
    return fit.withColumn("n_test", F.lit(test.count()).cast("bigint"))


#: A derivative of the mean penalised loss below this is zero.
ZERO_GRADIENT = 1e-5


@query("logreg_certificate")
def _q(spark, d):
    """M8: the fitted terms, each with whether the penalised loss's derivative by it is zero."""
    model, train, _, n = _fitted(spark, d, "logreg")
    return MD.logreg_certificate(model, train, n).select(
        "term", (F.abs("gradient") < ZERO_GRADIENT).alias("zero_gradient"), F.lit(n).cast("bigint").alias("n_train"))


@query("logreg_coefficients")
def _q(spark, d):
    """M8: the coefficients and derivatives themselves (tests/test_model.py has DuckDB compute the latter from the former)."""
    model, train, _, n = _fitted(spark, d, "logreg")
    return MD.logreg_certificate(model, train, n)


@query("train_rf")
def _q(spark, d):
    model, train, test, n = _fitted(spark, d, "rf")
    forest = model.stages[-1]
    return MD.positive_probability(model.transform(MD.spread(test))).agg(
        F.lit(n).cast("bigint").alias("n_train"), F.count(F.lit(1)).alias("n_test"),
        F.lit(forest.getNumTrees).cast("bigint").alias("n_trees"),
        F.count_if(F.col("score").between(0, 1)).alias("n_scored"))


@query("model_metrics")
def _q(spark, d):
    """Both candidates' metrics on the test split, and which one is kept."""
    scored, depth = {}, {}
    for which in ("logreg", "rf"):
        model, _, test, _ = _fitted(spark, d, which)
        scored[which] = MD.scored_labels(model, test)
        depth[which] = max((t.depth for t in model.stages[-1].trees), default=0) if which == "rf" else None
    return MD.compare(spark, scored).join(
        spark.createDataFrame(list(depth.items()), "model string, deepest_tree int"), "model")


@query("threshold_predictions")
def _q(spark, d):
    model, _, test, _ = _fitted(spark, d, "logreg")
    scored = MT.predict(MD.positive_probability(model.transform(test)))
    return scored.groupBy(F.col(MD.LABEL).cast("bigint").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("score").between(0, 1)).alias("n_scored"),
        F.count_if((F.col("prediction") == 1) == (F.col("score") >= MT.THRESHOLD)).alias("n_consistent"))


@query("threshold_rows")
def _q(spark, d):
    """Every test row with its probability and decision."""
    model, _, test, _ = _fitted(spark, d, "logreg")
    return MT.predict(MD.positive_probability(model.transform(test))).select(
        "customer_id", "ingest_date", F.col(MD.LABEL).cast("bigint").alias("label"), "score", "prediction")


@query("metrics_confusion")
def _q(spark, d):
    return r6(MT.confusion_metrics(scored_fixture(features_all(spark, d))))


@query("metrics_auc")
def _q(spark, d):
    return r6(MT.roc_auc(scored_fixture(features_all(spark, d))))


# ---- status log, registry, metadata (inputs derived from the events table) --
from retention.plans import registry as RG, status as ST  # noqa: E402

FIXED_NOW = "2025-08-24 04:30:00"


def status_log_from_events(spark, d):
    """A run-status log derived from ``events``: one run per user, one step
    per event type, the status by value band."""
    e = read_table(spark, d, "events")
    return e.select(F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
                    F.col("event_type").alias("step"),
                    F.when(F.col("value") < 5, F.lit("FAILED")).when(F.col("value") < 100, F.lit("STARTED"))
                     .otherwise(F.lit("SUCCESS")).alias("status"),
                    F.col("props").alias("message"), F.col("ts").alias("created_at"))


def registry_from_events(spark, d):
    """A model registry derived from ``events``: signups are un-numbered runs,
    purchases READY models, errors FAILED, the rest TRAINING."""
    e = read_table(spark, d, "events")
    et = F.col("event_type")
    return e.select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
        F.when(et == "signup", F.lit(None)).otherwise(F.col("event_id")).cast("bigint").alias("version"),
        F.when(et == "purchase", F.lit("READY")).when(et == "error", F.lit("FAILED"))
         .when(et == "signup", F.lit("RUNNING")).otherwise(F.lit("TRAINING")).alias("status"),
        F.when(et == "purchase", F.concat(F.lit("models/v"), F.col("event_id").cast("string"))).alias("artifact_uri"),
        F.col("props").alias("metrics_json"), F.lit(False).alias("is_latest"),
        F.col("ts").alias("created_at"), F.col("ts").alias("updated_at"))


def _promoted(spark, d):
    reg = registry_from_events(spark, d)
    target = (reg.where(F.col("status") == "READY")
              .agg(F.max_by("run_id", "version").alias("run_id"), F.max("version").alias("version"))
              .withColumn("artifact_uri", F.concat(F.lit("models/promoted/v"), F.col("version").cast("string")))
              .withColumn("metrics_json", F.lit('{"roc_auc": 1.0}')))
    return RG.promote(reg, target, FIXED_NOW)


@query("status_latest")
def _q(spark, d):
    return ST.latest_status(status_log_from_events(spark, d))


@query("merge_upsert")
def _q(spark, d):
    runs = (read_table(spark, d, "orders")
            .select(F.concat(F.lit("run-"), F.col("o_custkey").cast("string")).alias("run_id")))
    return RG.upsert_running(registry_from_events(spark, d), runs, FIXED_NOW)


@query("registry_next_version")
def _q(spark, d):
    return RG.next_version(registry_from_events(spark, d))


@query("registry_promote")
def _q(spark, d):
    return _promoted(spark, d)


@query("registry_select")
def _q(spark, d):
    return RG.select_model(_promoted(spark, d))


@query("registry_list")
def _q(spark, d):
    return RG.list_versions(registry_from_events(spark, d))


# ---- scoring ----------------------------------------------------------------
from retention.plans import scoring as SC  # noqa: E402


def payloads_from_features(f):
    """Scoring payloads as JSON text built from feature rows (with one unknown field). By
    customer_id modulo 9, some hold a field of the wrong type or are no object at all."""
    fields = [F.col(c.name).cast(c.dataType).alias(c.name) for c in SC.PAYLOAD_SCHEMA.fields]
    whole = F.to_json(F.struct(*fields, F.lit("x").alias("unknown_field")))
    kind = F.col("customer_id") % 9
    text = (F.when(kind == 0, F.to_json(F.struct(F.lit("abc").alias("tenure"))))
            .when(kind == 1, F.to_json(F.struct(F.lit(2.5).alias("services_count"))))
            .when(kind == 2, F.to_json(F.struct(F.lit(7).alias("contract_type"))))
            .when(kind == 3, F.lit("[1, 2]")).when(kind == 4, F.lit("{no json")).otherwise(whole))
    return f.select(F.col("customer_id").alias("payload_id"), "ingest_date", text.alias("payload"))


@query("score_by_id")
def _q(spark, d):
    """Per requested id: found, the day of the feature row that was chosen, and whether it has a probability."""
    model, _, _, _ = _fitted(spark, d, "logreg")
    f = features_all(spark, d)
    ids = _ids_from_orders(spark, d).unionByName(
        read_table(spark, d, "customer").select((F.col("c_custkey") + 1).alias("customer_id")))
    newest = f.groupBy("customer_id").agg(F.max("ingest_date").alias("feature_day"))
    return (SC.score_by_id(model, f, ids, 1).join(newest, "customer_id", "left")
            .select("customer_id", "found", "feature_day", "model_version",
                    F.coalesce(F.col("churn_probability").between(0, 1), F.lit(False)).alias("scored"),
                    F.coalesce(F.col("prediction").isin(0, 1), F.lit(False)).alias("decided")))


@query("score_by_id_rows")
def _q(spark, d):
    """Per requested id its probability and decision, as the service returned them."""
    model, _, _, _ = _fitted(spark, d, "logreg")
    ids = _ids_from_orders(spark, d).unionByName(
        read_table(spark, d, "customer").select((F.col("c_custkey") + 1).alias("customer_id")))
    return SC.score_by_id(model, features_all(spark, d), ids, 1)


@query("score_from_json_rows")
def _q(spark, d):
    """Per payload its probability and decision, or its text where it is refused."""
    model, _, _, _ = _fitted(spark, d, "logreg")
    return SC.score_payloads(model, payloads_from_features(features_all(spark, d)), 1)


@query("score_from_json")
def _q(spark, d):
    model, _, _, _ = _fitted(spark, d, "logreg")
    return SC.score_payloads(model, payloads_from_features(features_all(spark, d)), 1).select(
        "payload_id", "ingest_date", "valid_json", F.col("bad_payload").isNotNull().alias("kept_text"),
        F.coalesce(F.col("churn_probability").between(0, 1), F.lit(False)).alias("scored"), "model_version")


@query("parse_feature_payload")
def _q(spark, d):
    p = SC.parse_payloads(payloads_from_features(features_all(spark, d)))
    return p.withColumn("bad_payload", F.col("bad_payload").isNotNull())


# ---- incremental ingest -----------------------------------------------------
import uuid  # noqa: E402

from retention.schemas import RAW_SCHEMA  # noqa: E402
from retention.session import checkpoint_dir  # noqa: E402
from retention.sources import landing as LD  # noqa: E402
from retention.sources import files as FS, tables as TB  # noqa: E402
from retention.streaming.ingest import ingest_available  # noqa: E402

# The fixture plants bad rows in every day, so the registered loads bound their share, not their number.
BAD_SHARE = LD.Budget(count=None, share=0.25)


def _landing_files(spark, d) -> str:
    """All days of the raw fixture as landing files, written in one job; returns the folder above them."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/ingest-{uuid.uuid4().hex[:12]}"
    rows = raw(spark, d).drop("k").select(*[F.col(c).cast("string").alias(c) for c in RAW_SCHEMA.fieldNames()])
    (rows.withColumn("day", F.date_format(F.col("ingest_date").cast("date"), "dd-MM-yyyy")).write.partitionBy("day")
     .option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(f"{base}/landing"))
    return base


@query("ingest_incremental")
def _q(spark, d):
    """Drop the days' landing files (derived from the tables) into a fresh folder under the shared
    checkpoint directory, drain it with the stream, and return the raw table the stream built."""
    base = _landing_files(spark, d)
    ingest_available(spark, f"{base}/landing", f"{base}/raw", f"{base}/_stream", f"{base}/quarantine",
                     BAD_SHARE, "day=*")
    FS.remove(spark, f"{base}/landing")
    return spark.read.schema(RAW_SCHEMA).parquet(f"{base}/raw")


@query("ingest_redelivered")
def _q(spark, d):
    """Every file is delivered again under another name after the first run; no row counts twice."""
    base = _landing_files(spark, d)
    take = lambda: ingest_available(spark, f"{base}/landing", f"{base}/raw", f"{base}/_stream", f"{base}/quarantine",
                                    BAD_SHARE, "day=*", files_per_batch=4)
    take()
    FS.copy_into(spark, f"{base}/landing", "again-")
    take()
    return spark.read.schema(RAW_SCHEMA).parquet(f"{base}/raw")


@query("load_bad_record_budget")
def _q(spark, d):
    """Every row that was read is either loaded or set aside with its text and a reason."""
    base = _landing_files(spark, d)
    good = LD.load_csv(spark, f"{base}/landing/*", f"{base}/quarantine", BAD_SHARE)
    aside = spark.read.schema("source string, reason string, loaded_at timestamp").parquet(f"{base}/quarantine")
    kept = good.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n")).select(
        "ingest_date", F.lit("loaded").alias("outcome"), "n")
    text = F.from_csv("source", ", ".join(f"{c} string" for c in RAW_SCHEMA.fieldNames()))
    set_aside = aside.groupBy(text.getField("ingest_date").cast("date").alias("ingest_date"), F.col("reason").alias("outcome")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return kept.unionByName(set_aside)


@query("load_budget_outcomes")
def _q(spark, d):
    """What the parse counted, and how a load with each bound ends: loaded, or refused."""
    base = _landing_files(spark, d)
    _, counts = LD.parse_landing(spark, f"{base}/landing/*")
    rows = []
    for name, budget in (("no bad row", LD.Budget(0)), ("1000 rows", LD.Budget()), ("1 %", LD.Budget(None, 0.01)),
                         ("25 %", BAD_SHARE)):
        try:
            budget.check(counts["bad"], counts["rows"])
            rows.append((name, "loaded"))
        except LD.BadRecordBudgetExceeded:
            rows.append((name, "refused"))
    return spark.createDataFrame(rows, "bound string, outcome string").select(
        "bound", "outcome", *[F.lit(counts[c]).cast("bigint").alias(c) for c in sorted(counts)])


@query("load_field_addition")
def _q(spark, d):
    """The newest day's files have a column more, in the middle of their header. Its values are
    kept, older days read NULL; every column lands under its own name."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/ingest-{uuid.uuid4().hex[:12]}"
    names = RAW_SCHEMA.fieldNames()
    rows = raw(spark, d).select("k", *[F.col(c).cast("string").alias(c) for c in names])
    tier = F.element_at(F.array(F.lit("gold"), F.lit("silver"), F.lit("none")), (F.col("k") % 3 + 1).cast("int"))
    new = F.col("ingest_date") == AS_OF
    for folder, part in (("old", rows.where(~new).select(*names)),
                         ("new", rows.where(new).select(*names[:3], tier.alias("loyalty_tier"), *names[3:]))):
        (part.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(f"{base}/landing/{folder}"))
    good = LD.load_csv(spark, f"{base}/landing/*", f"{base}/quarantine", BAD_SHARE, by_header=True)
    TB.create_or_write(spark, good, f"{base}/raw")
    return (TB.read_table(spark, f"{base}/raw").groupBy("ingest_date", "loyalty_tier", "contract")
            .agg(F.count(F.lit(1)).alias("n")))


@query("latest_clean_table")
def _q(spark, d):
    """The clean rows as a table by day, and its newest day found from the folder names."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/clean-{uuid.uuid4().hex[:12]}"
    TB.create_table(clean_all(spark, d), path)
    return TB.read_newest(spark, path, clean_all(spark, d).schema)


@query("sketch_report")
def _q(spark, d):
    """V6, E2, E10 over days: distinct and most frequent values from the days' sketches alone."""
    from retention.operators import sketches as SK
    path = f"{checkpoint_dir(spark).rstrip('/')}/sketches-{uuid.uuid4().hex[:12]}"
    SK.write_sketches(clean_all(spark, d), ["gender", "internet_service", "contract", "payment_method", "partner"], path)
    return SK.report(spark, path, top=3).select("column", "rows", "nulls", "distinct_values", F.to_json("frequent").alias("frequent"))


@query("customer_lookup_table")
def _q(spark, d):
    """A9 on a stored feature table: the rows of the customers with the most orders, found by the scan's filter."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/features-{uuid.uuid4().hex[:12]}"
    f = features_all(spark, d)
    TB.create_table(f, path, bloom={"customer_id": 100_000})
    most = (_ids_from_orders(spark, d).groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), "customer_id").limit(20))
    return TB.lookup(spark, path, "customer_id", most.select("customer_id"), schema=f.schema).drop("ingest_date")


@query("predict_threshold")
def _q(spark, d):
    """M10 on the deterministic scored fixture: positive when score >= 0.5."""
    return MT.predict(scored_fixture(features_all(spark, d))).select(
        "customer_id", "ingest_date", "score", "prediction", "label")
