"""From logits to probabilities, labels and confidence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritally.functions.hashing import hash32

# Class names by label id.
CLASS_NAMES = {0: "non-toxic", 1: "toxic"}

DEFAULT_THRESHOLD = 0.5


def softmax(logits: Column) -> Column:
    """Softmax over an array of logits, shifted by its maximum."""
    shifted = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    total = F.aggregate(shifted, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(shifted, lambda x: x / total)


def toxic_probability(logits: Column) -> Column:
    """Two-class softmax of the toxic logit, without building arrays.

    The exponent is kept non-positive on both branches, so it cannot overflow.
    """
    gap = logits[1] - logits[0]
    small = F.exp(-F.abs(gap))
    return F.when(gap >= 0, 1 / (1 + small)).otherwise(small / (1 + small))


def argmax_label(logits: Column) -> Column:
    """Larger logit wins; a tie goes to class 0."""
    return (logits[1] > logits[0]).cast("int")


def check_threshold(threshold: float) -> float:
    if not 0.0 < threshold < 1.0:
        raise ValueError(f"threshold must lie strictly between 0 and 1, got {threshold}")
    return float(threshold)


def is_defined(prob: Column) -> Column:
    return prob.isNotNull() & ~F.isnan(prob)


def at_least(prob: Column, threshold: float) -> Column:
    """``prob >= threshold`` with null and NaN on the false side.

    Spark orders NaN above every number, so the bare comparison would be true.
    """
    return F.coalesce((prob >= F.lit(float(threshold))) & ~F.isnan(prob), F.lit(False))


def decide(prob: Column, threshold: float) -> Column:
    return at_least(prob, threshold).cast("int")


def class_name(label: Column) -> Column:
    return F.when(label == 1, F.lit(CLASS_NAMES[1])).when(label == 0, F.lit(CLASS_NAMES[0]))


def confidence(prob: Column, label: Column) -> Column:
    """Probability of the chosen class."""
    return F.when(label == 1, prob).otherwise(1 - prob)


def fixture_probability(doc_id: Column, toxic: Column) -> Column:
    """A score that any SQL engine can recompute, for tests apart from a model.

    It leans towards the label: toxic rows start 0.25 higher.
    """
    base = F.when(toxic == 1, F.lit(2500)).otherwise(F.lit(0))
    return (base + hash32(doc_id, "score") % 7501) / F.lit(10000.0)
