"""Prediction records from scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.functions.scores import (
    DEFAULT_THRESHOLD,
    argmax_label,
    check_threshold,
    class_name,
    confidence,
    decide,
    softmax,
)
from veritally.sources.schema import require_columns

RECORD = ("label", "label_id", "confidence", "toxic_prob", "threshold")


def predict(
    df: DataFrame, threshold: float = DEFAULT_THRESHOLD, prob: str = "toxic_prob"
) -> DataFrame:
    """Add the prediction record to rows that have a probability."""
    require_columns(df, [prob])
    threshold = check_threshold(threshold)
    chosen = F.col("label_id")
    out = df.withColumn("label_id", decide(F.col(prob), threshold))
    out = out.withColumn("label", class_name(chosen))
    out = out.withColumn("confidence", confidence(F.col(prob), chosen))
    return out.withColumn("threshold", F.lit(threshold))


def label_errors(
    df: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    label: str = "labels",
    prob: str = "toxic_prob",
) -> DataFrame:
    """Add ``predicted_label``, ``is_correct`` and, on wrong rows, ``error_type``."""
    require_columns(df, [label, prob])
    predicted = F.col("predicted_label")
    wrong = F.col(label) != predicted
    return (
        df.withColumn("predicted_label", decide(F.col(prob), threshold))
        .withColumn("is_correct", ~wrong)
        .withColumn(
            "error_type", F.when(wrong, F.when(predicted == 1, "FP").otherwise("FN"))
        )
    )


def score_logits(df: DataFrame, logits: str = "logits") -> DataFrame:
    """Add the class-1 softmax probability and the argmax label."""
    require_columns(df, [logits])
    z = F.col(logits)
    return df.withColumn("toxic_prob", softmax(z)[1]).withColumn("argmax_label", argmax_label(z))
