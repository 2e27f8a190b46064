"""Batch scoring with a fitted PipelineModel.

The per-request lookups of the original service become joins: a DataFrame of
customer ids is matched to each customer's newest feature row, the model is
applied to all of them in one transform, and ids without features are
reported with ``found = false``. JSON payloads are parsed once into a variant
and each field is checked against its type (missing or null fields NULL,
unknown fields ignored); text that is no JSON object, or that holds a field of
the wrong type, is flagged, kept and not scored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F, types as T

from retention.operators.metrics import THRESHOLD
from retention.operators.segments import latest_customer_features
from retention.plans.model import positive_probability
from retention.schemas import PAYLOAD_SCHEMA  # noqa: F401 (re-exported)

#: Texts that stand for a truth value.
TRUE_TEXTS, FALSE_TEXTS = ["1", "true", "t", "yes", "y", "on"], ["0", "false", "f", "no", "n", "off"]


def _score(model: PipelineModel, df: DataFrame, version, keys=("customer_id",)) -> DataFrame:
    scored = positive_probability(model.transform(df))
    return scored.select(
        *keys,
        F.round("score", 6).alias("churn_probability"),
        (F.col("score") >= THRESHOLD).cast("int").alias("prediction"),
        F.lit(version).cast("bigint").alias("model_version"))


def score_by_id(model: PipelineModel, features: DataFrame, ids: DataFrame, version) -> DataFrame:
    """One row per requested id; unmatched ids have found = false."""
    req = ids.select(F.col("customer_id").cast("bigint").alias("customer_id")).distinct()
    scored = _score(model, latest_customer_features(features, req), version)
    return (req.join(scored, "customer_id", "left")
            .withColumn("found", F.col("churn_probability").isNotNull() | F.col("model_version").isNotNull()))


def _field(doc: Column, name: str, kind: T.DataType) -> tuple[Column, Column]:
    """(value, wrong): a payload field in its type. Numbers may come as text and whole numbers
    as 2.0; truth values as 0, 1 or a usual word; text only as text."""
    raw = F.try_variant_get(doc, f"$.{name}", "variant")
    shape = F.schema_of_variant(raw)
    text = F.trim(F.try_variant_get(doc, f"$.{name}", "string"))
    given = raw.isNotNull() & ~F.is_variant_null(raw)
    plain = shape.isin("STRING", "BIGINT", "DOUBLE", "FLOAT") | shape.startswith("DECIMAL")
    if isinstance(kind, T.StringType):
        value = F.when(shape == "STRING", F.try_variant_get(doc, f"$.{name}", "string"))
    elif isinstance(kind, T.BooleanType):
        word = F.lower(text)
        value = F.when(shape == "BOOLEAN", F.try_variant_get(doc, f"$.{name}", "boolean")).when(
            plain & word.isin(*TRUE_TEXTS, "1.0"), True).when(plain & word.isin(*FALSE_TEXTS, "0.0"), False)
    else:
        number = F.when(shape == "BOOLEAN", F.try_variant_get(doc, f"$.{name}", "boolean").cast("double")).when(
            plain, text.try_cast("double"))
        whole = (number == F.floor(number)) & (F.abs(number) < 2.0 ** 53)
        value = F.when(whole, number.try_cast("bigint")) if isinstance(kind, T.LongType) else number
    return value, given & value.isNull()


def parse_payloads(payloads: DataFrame, text_col: str = "payload") -> DataFrame:
    """T13 parsing: JSON text -> the 14 optional feature fields, ``valid_json`` and the
    original text of refused payloads (``bad_payload``). A refused payload has no fields."""
    keys = [c for c in payloads.columns if c != text_col]
    doc = payloads.select(*keys, text_col, F.try_parse_json(text_col).alias("_v"))
    fields = [(f.name, *_field(F.col("_v"), f.name, f.dataType)) for f in PAYLOAD_SCHEMA.fields]
    wrong = reduce(lambda a, b: a | b, [F.coalesce(w, F.lit(False)) for _, _, w in fields])
    valid = F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False)) & ~wrong
    read = doc.select(*keys, text_col, valid.alias("valid_json"), *[v.alias(n) for n, v, _ in fields])
    return read.select(*keys, *[F.when(F.col("valid_json"), F.col(n)).alias(n) for n, _, _ in fields], "valid_json",
                       F.when(~F.col("valid_json"), F.col(text_col)).alias("bad_payload"))


def score_payloads(model: PipelineModel, payloads: DataFrame, version, text_col: str = "payload") -> DataFrame:
    """Score parsed payloads in one pass (no join back, so repeated
    payload keys stay one row each); refused payloads get NULL scores."""
    p = parse_payloads(payloads, text_col)
    keys = [c for c in payloads.columns if c != text_col]
    scored = positive_probability(model.transform(p))
    ok = F.col("valid_json")
    return scored.select(
        *keys, "valid_json", "bad_payload",
        F.when(ok, F.round("score", 6)).alias("churn_probability"),
        F.when(ok, (F.col("score") >= THRESHOLD).cast("int")).alias("prediction"),
        F.when(ok, F.lit(version).cast("bigint")).alias("model_version"))
