"""Binary classification metrics as aggregates (no scored rows on the driver).

Confusion counts are one aggregate. ROC AUC is exact with ties counted half:
scores are grouped (map-side combined), negatives below each distinct score
come from the distributed running sum, and one final aggregate sums
pos * (neg_below + neg_same / 2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from retention.functions import count_when
from retention.operators.ordering import by_share, running_sum

THRESHOLD = 0.5


def predict(scored: DataFrame, score: str = "score", threshold: float = THRESHOLD,
            out: str = "prediction") -> DataFrame:
    """0/1 decision: positive when score >= threshold."""
    return scored.withColumn(out, (F.col(score) >= threshold).cast("bigint"))


def _zero_div(a, b):
    return F.coalesce(F.try_divide(a, F.nullif(b, F.lit(0))), F.lit(0.0))


def confusion_metrics(scored: DataFrame, label: str = "label", score: str = "score",
                      threshold: float = THRESHOLD) -> DataFrame:
    """tp/fp/fn/tn, accuracy, precision, recall, F1 (zero division -> 0)."""
    y, p = F.col(label) == 1, F.col(score) >= threshold
    c = scored.agg(count_when(y & p).alias("tp"), count_when(~y & p).alias("fp"),
                   count_when(y & ~p).alias("fn"), count_when(~y & ~p).alias("tn"))
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    prec = _zero_div(tp, tp + fp)
    rec = _zero_div(tp, tp + fn)
    return c.select("tp", "fp", "fn", "tn",
                    _zero_div(tp + tn, tp + fp + fn + tn).alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"),
                    _zero_div(2 * tp, 2 * tp + fp + fn).alias("f1"))


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row: auc (NULL when a class is absent), n_pos, n_neg."""
    by_score = scored.groupBy(F.col(score).alias("_s")).agg(
        count_when(F.col(label) == 1).alias("_pos"), count_when(F.col(label) != 1).alias("_neg"))
    cum = running_sum(by_score, ["_s"], "_neg", (), "_neg_le", bucket=by_share)
    part = cum.select("_pos", "_neg",
                      (F.col("_pos") * ((F.col("_neg_le") - F.col("_neg")) + F.col("_neg") / 2.0)).alias("_w"))
    agg = part.agg(F.sum("_w").alias("_w"), F.sum("_pos").alias("n_pos"), F.sum("_neg").alias("n_neg"))
    return agg.select(F.try_divide(F.col("_w"), F.nullif(F.col("n_pos") * F.col("n_neg"), F.lit(0)))
                      .alias("auc"), F.col("n_pos").cast("bigint").alias("n_pos"),
                      F.col("n_neg").cast("bigint").alias("n_neg"))
