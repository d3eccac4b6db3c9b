"""Corpus profile: label balance, lengths, histograms and token coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from veritally.functions.ratios import ratio_or_null, ratio_or_zero
from veritally.functions.text import char_length, word_length
from veritally.sources.schema import require_columns

MEASURES = ("char_len", "word_len")


def label_distribution(df: DataFrame, label: str = "labels") -> DataFrame:
    """Toxic rows, all rows and their percentage, per split."""
    require_columns(df, ["split", label])
    return (
        df.groupBy("split")
        .agg(F.count_if(F.col(label) == 1).alias("n_toxic"), F.count(F.lit(1)).alias("n_total"))
        .withColumn(
            "pct_toxic", F.round(100 * ratio_or_zero(F.col("n_toxic"), F.col("n_total")), 1)
        )
    )


def label_counts(df: DataFrame, label: str = "labels") -> DataFrame:
    """Rows per split and label; a missing label is not counted."""
    require_columns(df, ["split", label])
    return (
        df.where(F.col(label).isNotNull())
        .groupBy("split", F.col(label).alias("labels"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def class_imbalance(df: DataFrame, label: str = "labels") -> DataFrame:
    """Per split: percentage toxic, and non-toxic rows for each toxic one."""
    require_columns(df, ["split", label])
    pct = 100 * ratio_or_null(F.col("n_toxic"), F.col("n_total"))
    return (
        df.groupBy("split")
        .agg(F.count_if(F.col(label) == 1).alias("n_toxic"), F.count(label).alias("n_total"))
        .select(
            "split",
            F.round(pct, 4).alias("pct_toxic"),
            F.round(F.try_divide(F.lit(100.0), pct) - 1, 4).alias("imbalance_ratio"),
        )
    )


def with_text_lengths(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``char_len`` and ``word_len``; null and blank texts have no words."""
    require_columns(df, [text])
    t = F.col(text)
    return df.withColumn("char_len", char_length(t)).withColumn("word_len", word_length(t))


def _value_counts(df: DataFrame, label: str, measures: Sequence[str]) -> DataFrame:
    """``labels, measure, value, n``: rows per distinct value of each measure.

    Everything below works on this table. Its size depends on how many different
    lengths there are, not on the rows, and frequent lengths are merged on the
    map side. Measures are whole numbers; others are refused rather than cut off.
    """
    for m in measures:
        if not isinstance(df.schema[m].dataType, IntegralType):
            raise ValueError(f"measure '{m}' is {df.schema[m].dataType.simpleString()}, not integral")
    pairs = F.array(
        *[F.struct(F.lit(m).alias("measure"), F.col(m).cast("bigint").alias("value"))
          for m in measures]
    )
    return (
        df.select(F.col(label).alias("labels"), F.inline(pairs))
        .groupBy("labels", "measure", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def length_stats(
    df: DataFrame, label: str = "labels", measures: Sequence[str] = MEASURES
) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, to one digit.

    Quartiles are interpolated. The deviation comes from integer sums, so it
    does not depend on the order of the rows.
    """
    require_columns(df, [label, *measures])
    v, n = F.col("value").cast("decimal(38,0)"), F.col("n")
    quartiles = F.percentile("value", [0.25, 0.5, 0.75], n)
    total, squares = F.col("total"), F.col("squares")
    count = F.col("count").cast("decimal(38,0)")
    spread = (count * squares - total * total).cast("double")
    freedom = (count * (count - 1)).cast("double")
    return (
        _value_counts(df, label, measures)
        .groupBy("labels", "measure")
        .agg(
            F.sum("n").alias("count"),
            F.sum(v * n).cast("decimal(38,0)").alias("total"),
            F.sum(v * v * n).cast("decimal(38,0)").alias("squares"),
            F.min("value").alias("min"),
            quartiles.alias("q"),
            F.max("value").alias("max"),
        )
        .select(
            "labels",
            "measure",
            "count",
            F.round(ratio_or_null(total, count), 1).alias("mean"),
            F.round(F.sqrt(F.try_divide(spread, freedom)), 1).alias("std"),
            "min",
            F.round(F.col("q")[0], 1).alias("q25"),
            F.round(F.col("q")[1], 1).alias("q50"),
            F.round(F.col("q")[2], 1).alias("q75"),
            "max",
        )
    )


def histogram(
    df: DataFrame,
    measures: Sequence[str],
    bins: int,
    label: str | None = None,
) -> DataFrame:
    """Equal-width bins between the extremes of each group, empty bins included.

    Columns ``labels, measure, bin`` (1 to ``bins``), ``bin_start, bin_end, n``.
    The last bin holds the maximum. A group with one distinct value gets a range
    of half a unit on both sides. Without ``label`` all rows form one group.
    """
    if bins < 1:
        raise ValueError("a histogram needs at least one bin")
    if label is None:
        label = "_all"
        df = df.withColumn(label, F.lit(0))
    require_columns(df, [label, *measures])
    group = ["labels", "measure"]
    # As many rows as there are different lengths, so a group is no larger than
    # its longest text allows.
    whole_group = Window.partitionBy(*group)
    low = F.min("value").over(whole_group).cast("double")
    high = F.max("value").over(whole_group).cast("double")
    half = F.when(F.col("low") == F.col("high"), 0.5).otherwise(0.0)
    slot = F.least(F.width_bucket("value", "low", "high", F.lit(bins)), F.lit(bins))
    filled = (
        _value_counts(df, label, measures)
        .where(F.col("value").isNotNull())
        .withColumns({"low": low, "high": high})
        .withColumns({"low": F.col("low") - half, "high": F.col("high") + half})
        .groupBy(*group, "low", "high", slot.alias("bin"))
        .agg(F.sum("n").alias("n"))
    )
    # One row per group, holding its filled bins.
    per_group = filled.groupBy(*group, "low", "high").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("n_of_bin")
    )
    bin_, width = F.col("bin"), (F.col("high") - F.col("low")) / bins
    all_bins = F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(bins).cast("bigint")))
    out = per_group.withColumn("bin", all_bins).select(
        *group,
        "bin",
        F.round(F.col("low") + (bin_ - 1) * width, 6).alias("bin_start"),
        F.round(F.col("low") + bin_ * width, 6).alias("bin_end"),
        F.coalesce(F.try_element_at("n_of_bin", bin_), F.lit(0)).alias("n"),
    )
    return out.drop("labels") if label == "_all" else out


def token_coverage(df: DataFrame, max_length: int = 128, count: str = "n_tokens") -> DataFrame:
    """Percentage of texts that fit in ``max_length`` tokens, over the whole corpus."""
    require_columns(df, [count])
    return (
        df.agg(
            F.count_if(F.col(count) <= max_length).alias("n_within"), F.count(count).alias("n_texts")
        )
        .withColumn("pct_within", 100 * ratio_or_null(F.col("n_within"), F.col("n_texts")))
    )
