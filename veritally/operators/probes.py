"""Probe results and their summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.functions.ratios import ratio_or_null, rounded
from veritally.functions.scores import DEFAULT_THRESHOLD, check_threshold, confidence, decide
from veritally.operators.lookup import fetch_by_key
from veritally.operators.mistakes import pick_extremes
from veritally.sources.schema import require_columns

ATTENTION_BELOW = 0.75
REPORT_EXAMPLES = 5


def probe_results(
    scored_probes: DataFrame, threshold: float = DEFAULT_THRESHOLD, prob: str = "toxic_prob"
) -> DataFrame:
    """Add ``predicted_label, toxic_probability, confidence, is_correct``.

    A probe without a score, because its text could not be scored, gets no verdict.
    """
    require_columns(scored_probes, ["expected_label", prob])
    p, predicted = F.col("toxic_probability"), F.col("predicted_label")
    return (
        scored_probes.withColumnRenamed(prob, "toxic_probability")
        .withColumn(
            "predicted_label", F.when(p.isNotNull(), decide(p, check_threshold(threshold)))
        )
        .withColumn("confidence", confidence(p, predicted))
        .withColumn("is_correct", F.col("expected_label") == predicted)
    )


def probe_summary(results: DataFrame, category: str = "category") -> DataFrame:
    """One row for all probes (scope ``overall``) and one per category.

    Probes are counted per category, and both scopes are grouping sets over those
    counts, so each probe is read once and never expanded. Probes without a
    verdict stay out; those without a category count in the overall row alone.
    Precision and recall without a denominator are null; F1 is null also when
    either is 0. The overall row exists for an empty probe set too, with ``n`` 0.
    """
    require_columns(results, ["expected_label", "predicted_label", category])
    y, z = F.col("expected_label"), F.col("predicted_label")
    parts = ("n", "n_correct", "tp", "fp", "fn")
    counts = (
        results.where(z.isNotNull())
        .groupBy(F.col(category).cast("string").alias("category"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(y == z).alias("n_correct"),
            F.count_if((y == 1) & (z == 1)).alias("tp"),
            F.count_if((y == 0) & (z == 1)).alias("fp"),
            F.count_if((y == 1) & (z == 0)).alias("fn"),
        )
    )
    # Grouping sets over no rows give no overall row, so there is always one.
    nothing = results.sparkSession.range(0, 1, 1, 1).select(
        F.lit(None).cast("string").alias("category"),
        *[F.lit(0).cast("bigint").alias(c) for c in parts],
    )
    totals = (
        counts.unionByName(nothing)
        .groupingSets([[], ["category"]], "category")
        .agg(F.grouping_id().alias("level"), *[F.sum(c).alias(c) for c in parts])
        .where((F.col("level") == 1) | F.col("category").isNotNull())
        .withColumn("scope", F.when(F.col("level") == 1, "overall").otherwise("category"))
    )
    n, ok, tp, fp, fn = (F.col(c) for c in parts)
    precision, recall = ratio_or_null(tp, tp + fp), ratio_or_null(tp, tp + fn)
    p, r = F.col("_p"), F.col("_r")
    f1 = F.when((p > 0) & (r > 0), 2 * p * r / (p + r))
    accuracy = F.col("accuracy")
    return (
        totals.withColumn("_p", precision)
        .withColumn("_r", recall)
        .select(
            "scope",
            "category",
            "n",
            F.when(n > 0, ok).alias("n_correct"),
            rounded(ratio_or_null(ok, n)).alias("accuracy"),
            rounded(p).alias("precision"),
            rounded(r).alias("recall"),
            rounded(f1).alias("f1"),
        )
        .withColumn("needs_attention", F.coalesce(accuracy < ATTENTION_BELOW, F.lit(False)))
    )


def worst_category(summary: DataFrame) -> DataFrame:
    """The category with the lowest rounded accuracy, first by name on a tie."""
    return (
        summary.where((F.col("scope") == "category") & F.col("accuracy").isNotNull())
        .orderBy("accuracy", "category")
        .limit(1)
        .select("category", "accuracy")
    )


def probe_error_examples(
    results: DataFrame,
    texts: DataFrame | None = None,
    n: int = REPORT_EXAMPLES,
    key: str = "doc_id",
) -> DataFrame:
    """The ``n`` most confident false positives and false negatives of the report.

    The decision is already in ``is_correct``; texts are read last, for the
    picked rows only, from ``texts`` or from ``results`` itself.
    """
    texts = results if texts is None else texts
    require_columns(results, [key, "expected_label", "is_correct", "toxic_probability"])
    wrong = results.where(~F.col("is_correct")).select(
        key,
        "expected_label",
        "toxic_probability",
        F.when(F.col("expected_label") == 0, "FP").otherwise("FN").alias("error_type"),
    )
    picked = pick_extremes(wrong, n, key, "toxic_probability")
    return fetch_by_key(picked, texts.select(key, "text"), key, max_rows=2 * n)
