"""Accuracy by overlapping text slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritally.functions.ratios import ratio_or_null, rounded
from veritally.functions.scores import DEFAULT_THRESHOLD, decide
from veritally.functions.text import has_exclamation_or_question, has_non_ascii
from veritally.sources.schema import require_columns

# The slices and their order in a report.
SLICES = (
    "short_text_lt50chars",
    "medium_text_50_200chars",
    "long_text_gt200chars",
    "contains_exclamation_or_question",
    "no_exclamation_or_question",
    "contains_non_ascii",
    "ascii_only",
)


def text_facts(text: Column) -> list[Column]:
    """All that the slices need to know of a raw text, in three small columns.

    Take them where the texts are read: a later join then moves these and not
    the texts.
    """
    text = F.coalesce(text, F.lit(""))  # a null text is a short one in every slice
    length = F.length(text)
    return [
        F.when(length < 50, "short").when(length < 200, "medium").otherwise("long").alias(
            "length_bucket"
        ),
        has_exclamation_or_question(text).alias("has_punct"),
        has_non_ascii(text).alias("has_non_ascii"),
    ]


def error_slices(
    scored: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    label: str = "labels",
    prob: str = "toxic_prob",
    text: str = "text",
) -> DataFrame:
    """``slice, n, n_correct, accuracy``; accuracy is null for an empty slice.

    Takes the columns of :func:`text_facts` if the frame has them, else the text.
    A row is in three slices, so these are conditional counts in one pass rather
    than groups, and empty slices appear too.
    """
    require_columns(scored, [label, prob])
    facts = ("length_bucket", "has_punct", "has_non_ascii")
    if not set(facts) <= set(scored.columns):
        require_columns(scored, [text])
        scored = scored.select(label, prob, *text_facts(F.col(text)))
    bucket, punct, wide = (F.col(c) for c in facts)
    members = dict(
        zip(
            SLICES,
            [bucket == "short", bucket == "medium", bucket == "long", punct, ~punct, wide, ~wide],
        )
    )
    correct = F.col(label) == decide(F.col(prob), threshold)
    counts = scored.agg(
        *[F.count_if(m).alias(f"{s}_n") for s, m in members.items()],
        *[F.count_if(m & correct).alias(f"{s}_ok") for s, m in members.items()],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(s).alias("slice"),
                F.col(f"{s}_n").alias("n"),
                F.col(f"{s}_ok").alias("n_correct"),
            )
            for s in SLICES
        ]
    )
    return counts.select(F.inline(rows)).withColumn(
        "accuracy", rounded(ratio_or_null(F.col("n_correct"), F.col("n")))
    )
