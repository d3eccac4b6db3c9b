"""Rank metrics: ROC-AUC, average precision, ROC and precision-recall points.

Scores are first counted per distinct value: a score shared by a third of all
rows becomes one row on the map side. What is left is a prefix sum over distinct
scores, which may be nearly as many as the rows. A window without partitions
would sum them in one task, so scores are cut into ranges, summed within each
range, and each range is shifted by the totals of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritally.functions.ratios import ratio_or_null
from veritally.functions.scores import is_defined
from veritally.session import store_table
from veritally.sources.schema import require_columns

# Products of counts pass 2^63 at a few billion rows.
_WIDE = "decimal(38,0)"

# Points of a bounded curve; fewer than this can't be promised for counts of 63 bits.
DEFAULT_POINTS = 10_000
FEWEST_POINTS = 200


def score_counts(
    scored: DataFrame,
    label: str = "labels",
    prob: str = "toxic_prob",
    extra: Sequence[Column] = (),
) -> DataFrame:
    """``score``, and how many positive and negative rows have it.

    ``extra`` holds further count aggregates to take in the same pass.
    """
    require_columns(scored, [label, prob])
    y = F.col(label)
    return scored.groupBy(F.col(prob).alias("score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"), *extra
    )


def auc_of_counts(counts: DataFrame) -> tuple[DataFrame, Column]:
    """One row of totals, and the ROC-AUC as an expression over it.

    A positive beats each negative with a lower score and half of those with an
    equal one. Summing within a range leaves only ``positives of the range x
    negatives of the ranges below``, so each range reduces to one row and the
    ranges are never joined back. Extra counts are summed along.
    """
    extra = [c for c in counts.columns if c not in ("score", "pos", "neg")]
    ranged = counts.repartitionByRange("score").withColumn("range_id", F.spark_partition_id())
    lower = (
        Window.partitionBy("range_id")
        .orderBy("score")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    pairs = F.col("pos").cast(_WIDE) * (2 * F.col("lower") + F.col("neg")).cast(_WIDE)
    undefined = ~F.coalesce(is_defined(F.col("score")), F.lit(False))
    ranges = (
        ranged.withColumn("lower", F.coalesce(F.sum("neg").over(lower), F.lit(0)))
        .groupBy("range_id")
        .agg(
            F.sum("pos").alias("pos"),
            F.sum("neg").alias("neg"),
            F.sum(pairs).alias("pairs"),
            F.count_if(undefined).alias("undefined"),
            *[F.sum(n).alias(n) for n in extra],
        )
    )
    # One row per range: as many as shuffle partitions, not as scores. Partition
    # numbers of a range partitioning follow the order of the scores.
    before = Window.orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    neg_below = F.coalesce(F.sum("neg").over(before), F.lit(0))
    across = 2 * F.col("pos").cast(_WIDE) * F.col("neg_below").cast(_WIDE)
    summary = ranges.withColumn("neg_below", neg_below).agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("n_pos"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("n_neg"),
        F.coalesce(F.sum("undefined"), F.lit(0)).alias("undefined"),
        F.sum(F.col("pairs") + across).alias("pairs"),
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in extra],
    )
    total = 2 * F.col("n_pos").cast(_WIDE) * F.col("n_neg").cast(_WIDE)
    auc = F.when(F.col("undefined") == 0, ratio_or_null(F.col("pairs"), total))
    return summary, auc


def auc_of_running(running: DataFrame) -> tuple[DataFrame, Column]:
    """One row with ``pairs``, and the AUC over it and the columns n_pos, n_neg, undefined.

    ``fp`` of a score counts the negatives there and above, so the rest lie below.
    """
    below = F.col("n_neg") - F.col("fp")
    won = F.col("pos").cast(_WIDE) * (2 * below + F.col("neg")).cast(_WIDE)
    total = 2 * F.col("n_pos").cast(_WIDE) * F.col("n_neg").cast(_WIDE)
    auc = F.when(F.col("undefined") == 0, ratio_or_null(F.col("pairs"), total))
    return running.agg(F.sum(won).alias("pairs")), auc


def roc_auc(scored: DataFrame, label: str = "labels", prob: str = "toxic_prob") -> DataFrame:
    """ROC-AUC with half credit for ties; null for one class or an undefined score."""
    summary, auc = auc_of_counts(score_counts(scored, label, prob))
    return summary.select("n_pos", "n_neg", auc.alias("roc_auc"))


def running_counts(
    scored: DataFrame, label: str = "labels", prob: str = "toxic_prob"
) -> DataFrame:
    """Per distinct score: true and false positives when it is the threshold.

    Columns ``score, pos, neg, next_pos, next_neg, tp, fp, n_pos, n_neg``, where
    ``tp`` and ``fp`` count the rows with this score or a higher one and
    ``next_`` refers to the next lower score. Rows without a defined score
    have no place on a curve and stay out.

    The ranges are used twice, for their totals and for the sums within, and
    must be the same both times. They are therefore stored in the shared folder,
    which also keeps them through the loss of an executor.
    """
    counts = score_counts(scored.where(is_defined(F.col(prob))), label, prob)
    in_ranges = counts.repartitionByRange(F.desc("score"))
    ranged = store_table(in_ranges.withColumn("range_id", F.spark_partition_id()), "score_ranges")
    everything = Window.partitionBy()
    in_order = Window.orderBy("range_id")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    # One row per range, so bounded by the number of shuffle partitions.
    offsets = (
        ranged.groupBy("range_id")
        .agg(
            F.sum("pos").alias("range_pos"),
            F.sum("neg").alias("range_neg"),
            F.max_by("pos", "score").alias("first_pos"),
            F.max_by("neg", "score").alias("first_neg"),
        )
        .select(
            "range_id",
            F.coalesce(F.sum("range_pos").over(before), F.lit(0)).alias("tp_before"),
            F.coalesce(F.sum("range_neg").over(before), F.lit(0)).alias("fp_before"),
            F.lead("first_pos").over(in_order).alias("next_range_pos"),
            F.lead("first_neg").over(in_order).alias("next_range_neg"),
            F.sum("range_pos").over(everything).alias("n_pos"),
            F.sum("range_neg").over(everything).alias("n_neg"),
        )
    )
    falling = Window.partitionBy("range_id").orderBy(F.desc("score"))
    upto = falling.rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumn("tp", F.sum("pos").over(upto))
        .withColumn("fp", F.sum("neg").over(upto))
        .withColumn("next_pos", F.lead("pos").over(falling))
        .withColumn("next_neg", F.lead("neg").over(falling))
        .join(F.broadcast(offsets), "range_id")
        .select(
            "score",
            "pos",
            "neg",
            F.coalesce("next_pos", "next_range_pos").alias("next_pos"),
            F.coalesce("next_neg", "next_range_neg").alias("next_neg"),
            (F.col("tp") + F.col("tp_before")).alias("tp"),
            (F.col("fp") + F.col("fp_before")).alias("fp"),
            "n_pos",
            "n_neg",
        )
    )


def _is_corner() -> Column:
    """First and last points, and those where the curve changes its step."""
    first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    last = F.col("next_pos").isNull()
    turns = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
    return first | last | turns


def average_precision(running: DataFrame) -> DataFrame:
    """Step sum of precision over recall gains; null without positives.

    Sums of doubles depend on the order of the parts, so the last digits are
    rounded away.
    """
    gain = F.col("pos") * ratio_or_null(F.col("tp"), F.col("tp") + F.col("fp"))
    return running.agg(
        F.round(ratio_or_null(F.sum(gain), F.max("n_pos")), 6).alias("average_precision")
    )


def roc_curve(running: DataFrame, drop_collinear: bool = False) -> DataFrame:
    """``threshold, fpr, tpr`` by falling threshold, from the point (0, 0).

    The first point has no threshold. With
    ``drop_collinear`` a point is left out when the next step equals the step
    that led to it, as it then lies on a straight line between its neighbours.
    """
    points = running.where(_is_corner()) if drop_collinear else running
    start = running.agg(F.max("n_pos").alias("n_pos"), F.max("n_neg").alias("n_neg")).select(
        F.lit(None).cast("double").alias("score"),
        F.lit(0).cast("bigint").alias("tp"),
        F.lit(0).cast("bigint").alias("fp"),
        "n_pos",
        "n_neg",
    )
    both = points.select("score", "tp", "fp", "n_pos", "n_neg").unionByName(start)
    return both.select(
        F.col("score").alias("threshold"),
        ratio_or_null(F.col("fp"), F.col("n_neg")).alias("fpr"),
        ratio_or_null(F.col("tp"), F.col("n_pos")).alias("tpr"),
    )


def pr_curve(running: DataFrame) -> DataFrame:
    """``threshold, precision, recall``, and the end point (1, 0) without threshold."""
    end = running.sparkSession.range(0, 1, 1, 1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return running.select(
        F.col("score").alias("threshold"),
        ratio_or_null(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio_or_null(F.col("tp"), F.col("n_pos")).alias("recall"),
    ).unionByName(end)


def thinned(running: DataFrame, max_points: int = DEFAULT_POINTS) -> DataFrame:
    """At most ``max_points`` rows of ``running``, none of the others far from the next one kept.

    Along the curve tp and fp only grow. They are cut in cells: recall and false positive rate in
    equal steps of 1 / k each, and the counts themselves in g steps per power of two. Of each
    cell the last point stays (and the first point of the curve). A point that goes lies in the cell of
    the next one kept, so between the two

    * tpr (recall) and fpr differ by less than 1 / k, and
    * tp and fp differ by a factor below 1 + 1 / g, hence fp / tp by such a factor, and precision,
      1 / (1 + fp / tp), by less than 1 / (4 g).

    The cells passed are at most 2 k + g (bits of n_pos + bits of n_neg) + 1, from which k and g
    follow. A curve that has no more points than allowed keeps all.

    One pass: the last point of a cell is a maximum, which tasks take first and a shuffle of at
    most ``max_points`` rows per task then merges, also where a cell crosses a border of ranges.
    """
    if max_points < FEWEST_POINTS:
        raise ValueError(f"a bounded curve needs at least {FEWEST_POINTS} points, got {max_points}")
    steps, per_octave = curve_steps(max_points, F.col("n_pos"), F.col("n_neg"))
    cell = F.struct(
        _whole_part(F.col("tp").cast(_WIDE) * steps, F.greatest("n_pos", F.lit(1))).alias("tpr"),
        _whole_part(F.col("fp").cast(_WIDE) * steps, F.greatest("n_neg", F.lit(1))).alias("fpr"),
        octave_cell(F.col("tp"), per_octave).alias("tp"),
        octave_cell(F.col("fp"), per_octave).alias("fp"),
    )
    first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    order = F.struct("tp", "fp")
    cells = running.select(cell.alias("cell"), first.alias("first"), order.alias("order"), F.struct(*running.columns).alias("row"))
    return cells.groupBy("cell", "first").agg(F.max_by("row", "order").alias("row")).select("row.*")


def curve_steps(max_points: int, n_pos: Column, n_neg: Column) -> tuple[Column, Column]:
    """Steps of tpr and fpr, and steps per power of two of tp and fp, for at most ``max_points`` cells."""
    bits = F.length(F.bin(n_pos)) + F.length(F.bin(n_neg))
    left = max_points - 3
    per_octave = F.greatest(_whole_part(F.lit(left // 2), bits), F.lit(1))
    return _whole_part(left - per_octave * bits, F.lit(2)), per_octave


def octave_cell(count: Column, per_octave: Column) -> Column:
    """Cells of a count from 0: each power of two is cut in ``per_octave`` equal parts."""
    bits = F.length(F.bin(count))
    power = F.pow(F.lit(2.0), bits - 1).cast(_WIDE)
    part = _whole_part(count.cast(_WIDE) * per_octave, power) - per_octave
    return F.when(count > 0, bits * per_octave + part).otherwise(0).cast("bigint")


def _whole_part(count: Column, of: Column) -> Column:
    return F.call_function("div", count, of)
