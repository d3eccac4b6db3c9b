"""Exact quantiles and histograms of fractional measures.

A double's bits, read as a whole number with the sign turned round, are in the order of the doubles.
A quantile is then found digit by digit: count how many rows have which leading digit, pick the
digit in which the wanted rank lies, and go on with the rows that begin so. Four digits of 16
bits decide. What is kept per group are counts of at most 65,536 digits, however many rows
or different values there are, and a value on a third of the rows is one count on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritally.functions.ratios import ratio_or_null
from veritally.functions.scores import is_defined
from veritally.session import store_table
from veritally.sources.schema import require_columns

DIGIT_BITS = 16
_PASSES = 64 // DIGIT_BITS
QUARTILES = (0.25, 0.5, 0.75)


def ordered_bits(value: Column) -> Column:
    """A double as a long in the same order; both zeros are one."""
    raw = F.call_function(
        "reflect", F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value.cast("double") + F.lit(0.0)
    ).cast("long")
    return F.when(raw >= 0, raw).otherwise(raw.bitwiseXOR(F.lit(2**63 - 1)))


def double_of_bits(bits: Column) -> Column:
    """The double that :func:`ordered_bits` made a long of."""
    raw = F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit(2**63 - 1)))
    return F.call_function("reflect", F.lit("java.lang.Double"), F.lit("longBitsToDouble"), raw).cast("double")


def _digit(bits: Column, number: int) -> Column:
    """Digit ``number`` from the front. The first carries the sign."""
    shifted = F.shiftright(bits, 64 - DIGIT_BITS * (number + 1))
    return shifted if number == 0 else shifted.bitwiseAND(F.lit(2**DIGIT_BITS - 1).cast("long"))


def _measured(df: DataFrame, measures: Sequence[str], label: str) -> DataFrame:
    """labels, measure, value of rows with a defined value."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])
    rows = df.select(F.col(label).alias("labels"), F.inline(pairs))
    return rows.where(is_defined(F.col("value")))


def quantiles(
    df: DataFrame, measures: Sequence[str], probabilities: Sequence[float] = QUARTILES, label: str = "labels"
) -> DataFrame:
    """Exact quantiles per label and measure: labels, measure, n, p, quantile.

    Between two ranks the value is interpolated. Null and NaN take no part, infinities do. A null
    label is a group of its own. Groups without values have no row.
    """
    require_columns(df, [label, *measures])
    if not all(0 <= p <= 1 for p in probabilities):
        raise ValueError(f"probabilities must lie between 0 and 1, got {list(probabilities)}")
    return _quantiles(_measured(df, measures, label), probabilities)


def _quantiles(rows: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    group = [F.struct("labels", "measure").alias("group")]
    bits = store_table(rows.select(*group, ordered_bits(F.col("value")).alias("bits")), "measured_bits")
    sizes = bits.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    at = (F.col("n") - 1) * F.col("p")
    ends = F.explode(F.array_distinct(F.array(F.floor(at), F.ceil(at)))).alias("rank")
    wanted = sizes.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
    # Ranks that are looked for, each with the digits found so far and its place among such rows.
    open_ = wanted.select("group", ends).distinct()
    open_ = store_table(open_.withColumns({"left": F.col("rank"), "prefix": F.lit(0).cast("long")}), "quantile_ranks")
    for number in range(_PASSES):
        here = bits
        if number:
            # The prefixes looked for are few; rows that begin otherwise are out of the race.
            prefixes = open_.select(F.col("group").alias("g"), F.col("prefix").alias("q")).distinct()
            begun = F.shiftright("bits", 64 - DIGIT_BITS * number)
            here = bits.join(prefixes, F.col("group").eqNullSafe(F.col("g")) & (begun == F.col("q")), "left_semi")
        begun = F.shiftright("bits", 64 - DIGIT_BITS * number) if number else F.lit(0).cast("long")
        counts = here.groupBy("group", begun.alias("prefix"), _digit(F.col("bits"), number).alias("digit")).agg(
            F.count(F.lit(1)).alias("n")
        )
        below = Window.partitionBy("group", "prefix").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("n").over(below), F.lit(0))
        found = counts.select(F.col("group").alias("g"), F.col("prefix").alias("q"), "digit", "n", before.alias("before"))
        after = F.col("left") - F.col("before")
        hit = (F.col("prefix") == F.col("q")) & (after >= 0) & (after < F.col("n"))
        longer = F.shiftleft("prefix", DIGIT_BITS).bitwiseOR(F.col("digit")) if number else F.col("digit")
        open_ = open_.join(found, F.col("group").eqNullSafe(F.col("g")) & hit)
        open_ = store_table(open_.select("group", "rank", after.alias("left"), longer.alias("prefix")), "quantile_digits")
    values = open_.select("group", "rank", double_of_bits(F.col("prefix")).alias("value"))
    placed = wanted.withColumns({"at": at, "low_rank": F.floor(at), "high_rank": F.ceil(at)})
    for end in ("low", "high"):
        found = values.toDF("g", "r", end)
        same = F.col("group").eqNullSafe(F.col("g")) & (F.col(f"{end}_rank") == F.col("r"))
        placed = placed.join(found, same).drop("g", "r")
    between = F.col("low") + (F.col("high") - F.col("low")) * (F.col("at") - F.col("low_rank"))
    # Equal ends may be infinite, which has no difference.
    value = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(between)
    return placed.select("group.labels", "group.measure", "n", "p", value.alias("quantile"))


def describe_fractions(
    df: DataFrame, measures: Sequence[str], label: str = "labels", digits: int = 6
) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of fractional measures.

    Columns as in :func:`~veritally.operators.profile.length_stats`, rounded to ``digits``. Sums of
    doubles depend on the order of their parts in digits beyond that. Null and NaN aren't counted.
    """
    require_columns(df, [label, *measures])
    rows = store_table(_measured(df, measures, label), "measured")
    value = F.col("value")
    stats = rows.groupBy("labels", "measure").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg(value).alias("mean"),
        F.when(F.count(F.lit(1)) > 1, F.stddev_samp(value)).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    found = _quantiles(rows, QUARTILES).groupBy("labels", "measure").pivot("p", list(QUARTILES))
    quartiles = found.agg(F.first("quantile")).toDF("of", "over", "q25", "q50", "q75")
    same = F.col("labels").eqNullSafe(F.col("of")) & (F.col("measure") == F.col("over"))
    both = stats.join(quartiles, same)
    rounded = [F.round(c, digits).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")]
    return both.select("labels", "measure", "count", *rounded)


def fractional_histogram(
    df: DataFrame, measures: Sequence[str], bins: int, label: str = "labels"
) -> DataFrame:
    """Equal-width bins between the extremes of each label and measure, empty bins included.

    Columns ``labels, measure, bin`` (1 to ``bins``), ``bin_start, bin_end, n, pct`` (of the group).
    Every bin holds its lower border, the last one both. A group with one distinct value gets a
    range of half a unit on both sides. Null, NaN and infinite values aren't counted.
    """
    if bins < 1:
        raise ValueError("a histogram needs at least one bin")
    require_columns(df, [label, *measures])
    rows = _measured(df, measures, label).where(F.abs("value") < float("inf"))
    rows = store_table(rows, "measured")
    ends = rows.groupBy("labels", "measure").agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.count(F.lit(1)).alias("total")
    )
    half = F.when(F.col("low") == F.col("high"), 0.5).otherwise(0.0)
    ends = ends.withColumns({"low": F.col("low") - half, "high": F.col("high") + half})
    ends = store_table(ends.withColumnsRenamed({"labels": "of", "measure": "over"}), "measured_ends")
    same = F.col("labels").eqNullSafe(F.col("of")) & (F.col("measure") == F.col("over"))
    share = (F.col("value") - F.col("low")) / (F.col("high") - F.col("low"))
    slot = F.least(F.floor(share * bins) + 1, F.lit(bins)).cast("bigint")
    counts = rows.join(ends, same).groupBy("of", "over", slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    per_group = counts.groupBy("of", "over").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("n_of"))
    per_group = per_group.withColumnsRenamed({"of": "labels", "over": "measure"})
    width = (F.col("high") - F.col("low")) / bins
    every = F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(bins).cast("bigint"))).alias("bin")
    n = F.coalesce(F.try_element_at("n_of", F.col("bin")), F.lit(0).cast("bigint"))
    return per_group.join(ends, same).select("labels", "measure", "low", "high", "total", "n_of", every).select(
        "labels",
        "measure",
        "bin",
        F.round(F.col("low") + (F.col("bin") - 1) * width, 6).alias("bin_start"),
        F.round(F.col("low") + F.col("bin") * width, 6).alias("bin_end"),
        n.alias("n"),
        F.round(100 * ratio_or_null(n, F.col("total")), 4).alias("pct"),
    )
