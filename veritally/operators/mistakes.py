"""The most confident mistakes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritally.functions.scores import DEFAULT_THRESHOLD
from veritally.operators.lookup import fetch_by_key
from veritally.operators.predict import label_errors
from veritally.sources.schema import require_columns


def pick_extremes(wrong: DataFrame, n: int, key: str, prob: str) -> DataFrame:
    """``n`` false positives from the top of the scores, ``n`` false negatives from
    the bottom; equal scores by key, undefined scores last.

    Both come from one pass. Spark keeps only the best ``n`` of each kind per task
    before it merges them, so neither kind can overload the task it goes to.
    """
    surest_first = Window.partitionBy("error_type").orderBy(_doubt(prob).asc_nulls_last(), key)
    ranked = wrong.withColumn("_rank", F.row_number().over(surest_first))
    return ranked.where(F.col("_rank") <= n).drop("_rank")


def _doubt(prob: str) -> Column:
    """Small for confident mistakes of either kind."""
    return F.when(F.col("error_type") == "FP", -F.col(prob)).otherwise(F.col(prob))


def top_mistakes(
    scored: DataFrame,
    texts: DataFrame | None = None,
    n_top: int = 50,
    threshold: float = DEFAULT_THRESHOLD,
    key: str = "doc_id",
    label: str = "labels",
    prob: str = "toxic_prob",
    text: str = "text",
) -> DataFrame:
    """False positives by falling score, then false negatives by rising score.

    ``n_top`` of each, equal scores by key. They are found on (key, label,
    score); only then are their texts read, from ``texts`` or from ``scored``
    itself, so no shuffle carries texts.
    """
    texts = scored if texts is None else texts
    require_columns(scored, [key, label, prob])
    require_columns(texts, [key, text])
    wrong = label_errors(scored.select(key, label, prob), threshold, label, prob).where(
        ~F.col("is_correct")
    )
    picked = pick_extremes(wrong, n_top, key, prob)
    found = fetch_by_key(picked, texts.select(key, text), key, max_rows=2 * n_top)
    return found.select(
        key,
        text,
        F.col(label).cast("int").alias("true_label"),
        "predicted_label",
        prob,
        "error_type",
    ).orderBy(F.desc("error_type"), _doubt(prob).asc_nulls_last(), key)
