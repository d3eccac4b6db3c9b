"""Confusion counts, threshold metrics, operating points and core metrics.

A *scored* frame holds ``labels`` (0 or 1) and ``toxic_prob``. A null or NaN
score counts as a prediction of class 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritally.functions.ratios import ratio_or_null, ratio_or_zero, rounded
from veritally.functions.scores import (
    DEFAULT_THRESHOLD,
    argmax_label,
    at_least,
    decide,
    is_defined,
    toxic_probability,
)
from veritally.operators.curves import auc_of_counts, auc_of_running, score_counts
from veritally.sources.schema import require_columns

# The default thresholds and floors, and the names that reports carry.
DEFAULT_GRID = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
RECALL_FLOOR = 0.85
PRECISION_FLOOR = 0.90

METRIC_COLUMNS = ("threshold", "precision", "recall", "f1", "accuracy", "tp", "fp", "tn", "fn")


def confusion_counts(label: Column, predicted: Column) -> list[Column]:
    """The four counts, as aggregates with map-side partial sums."""
    return [
        F.count_if((label == 1) & (predicted == 1)).alias("tp"),
        F.count_if((label == 0) & (predicted == 1)).alias("fp"),
        F.count_if((label == 0) & (predicted == 0)).alias("tn"),
        F.count_if((label == 1) & (predicted == 0)).alias("fn"),
    ]


def confusion_matrix(
    scored: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    label: str = "labels",
    prob: str = "toxic_prob",
) -> DataFrame:
    require_columns(scored, [label, prob])
    return scored.agg(*confusion_counts(F.col(label), decide(F.col(prob), threshold)))


def f1_or_zero(precision: Column, recall: Column) -> Column:
    return F.coalesce(
        F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0)
    )


def _threshold_metrics(counts: DataFrame) -> DataFrame:
    """Rounded metrics from a frame with the four counts; undefined means 0."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    precision = ratio_or_zero(tp, tp + fp)
    recall = ratio_or_zero(tp, tp + fn)
    return (
        counts.withColumn("_p", precision)
        .withColumn("_r", recall)
        .withColumn("precision", rounded(F.col("_p")))
        .withColumn("recall", rounded(F.col("_r")))
        .withColumn("f1", rounded(f1_or_zero(F.col("_p"), F.col("_r"))))
        .withColumn("accuracy", rounded(ratio_or_zero(tp + tn, tp + fp + tn + fn)))
        .drop("_p", "_r")
    )


def sweep_by_position(
    scored: DataFrame,
    grid: Sequence[float] = DEFAULT_GRID,
    label: str = "labels",
    prob: str = "toxic_prob",
) -> DataFrame:
    """Metrics per grid value, with ``grid_pos`` for its place in the grid.

    A row needs only the number of thresholds its score reaches. Rows are counted
    by that number, in one pass and with at most grid size + 1 groups however
    skewed the scores are, and every threshold adds up the groups that reach it.
    An empty input still yields every threshold.
    """
    require_columns(scored, [label, prob])
    if not grid:
        raise ValueError("the threshold grid is empty")
    rising = sorted({float(t) for t in grid})
    reached = F.when(~F.coalesce(is_defined(F.col(prob)), F.lit(False)), 0)
    for n in range(len(rising), 0, -1):
        reached = reached.when(F.col(prob) >= rising[n - 1], n)
    groups = scored.groupBy(reached.otherwise(0).alias("reached")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    none = scored.sparkSession.range(0, 1, 1, 1).select(
        F.lit(0).alias("reached"),
        F.lit(0).cast("bigint").alias("pos"),
        F.lit(0).cast("bigint").alias("neg"),
    )
    thresholds = F.array(
        *[
            F.struct(
                F.lit(i).alias("grid_pos"),
                F.lit(float(t)).alias("threshold"),
                F.lit(rising.index(float(t)) + 1).alias("needed"),
            )
            for i, t in enumerate(grid)
        ]
    )
    hit = F.col("reached") >= F.col("needed")
    counts = (
        groups.unionByName(none)
        .select("*", F.inline(thresholds))
        .groupBy("grid_pos", "threshold")
        .agg(
            F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
            F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
            F.sum(F.when(hit, 0).otherwise(F.col("neg"))).alias("tn"),
            F.sum(F.when(hit, 0).otherwise(F.col("pos"))).alias("fn"),
        )
    )
    return _threshold_metrics(counts)


def threshold_sweep(
    scored: DataFrame,
    grid: Sequence[float] = DEFAULT_GRID,
    label: str = "labels",
    prob: str = "toxic_prob",
) -> DataFrame:
    """One row of metrics per threshold."""
    return sweep_by_position(scored, grid, label, prob).select(*METRIC_COLUMNS)


def metrics_at_threshold(
    scored: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    label: str = "labels",
    prob: str = "toxic_prob",
) -> DataFrame:
    return threshold_sweep(scored, [threshold], label, prob)


# Names of the operating points.
POINT_NAMES = ("best_f1", "high_recall_threshold", "high_precision_threshold")


def operating_point_row(
    sweep: DataFrame,
    recall_floor: float = RECALL_FLOOR,
    precision_floor: float = PRECISION_FLOOR,
) -> DataFrame:
    """One row with three structs: best F1, first threshold with enough recall,
    last with enough precision. Takes the rows of :func:`sweep_by_position`.

    The floors apply to the rounded metrics. Where no threshold reaches one, its
    struct is null. Ties in F1 go to the earlier grid position.
    """
    row, pos = F.struct(*METRIC_COLUMNS), F.col("grid_pos")
    enough_recall = F.when(F.col("recall") >= recall_floor, pos)
    enough_precision = F.when(F.col("precision") >= precision_floor, pos)
    # At most one row per grid value gets here.
    return sweep.agg(
        F.max_by(row, F.struct(F.col("f1"), -pos)).alias(POINT_NAMES[0]),
        F.min_by(row, enough_recall).alias(POINT_NAMES[1]),
        F.max_by(row, enough_precision).alias(POINT_NAMES[2]),
    )


def point_rows(row: DataFrame) -> DataFrame:
    """The three structs as three rows; an unreached point has null metrics."""
    pairs = F.array(
        *[F.struct(F.lit(n).alias("operating_point"), F.col(n).alias("point")) for n in POINT_NAMES]
    )
    return row.select(F.inline(pairs)).select("operating_point", "point.*")


def operating_points(
    scored: DataFrame,
    grid: Sequence[float] = DEFAULT_GRID,
    label: str = "labels",
    prob: str = "toxic_prob",
    recall_floor: float = RECALL_FLOOR,
    precision_floor: float = PRECISION_FLOOR,
) -> DataFrame:
    """The operating points of scored rows, one row each."""
    sweep = sweep_by_position(scored, grid, label, prob)
    return point_rows(operating_point_row(sweep, recall_floor, precision_floor))


def _summary(df: DataFrame, label: str, prob: Column, argmax: Column, threshold: float):
    """Totals over all rows with argmax and threshold hits, and the AUC over them."""
    scored = df.select(
        F.col(label).alias("labels"), argmax.alias("argmax"), prob.alias("toxic_prob")
    )
    y, top, hit = F.col("labels"), F.col("argmax"), decide(F.col("toxic_prob"), threshold)
    counts = score_counts(
        scored,
        extra=[
            F.count_if((y == 1) & (top == 1)).alias("top_tp"),
            F.count_if((y == 0) & (top == 1)).alias("top_fp"),
            F.count_if((y == 1) & (hit == 1)).alias("hit_tp"),
            F.count_if((y == 0) & (hit == 1)).alias("hit_fp"),
        ],
    )
    return auc_of_counts(counts)


def evaluation_metrics(
    df: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    label: str = "labels",
    logits: str | None = "logits",
    prob: str = "toxic_prob",
) -> DataFrame:
    """One row: core metrics, the confusion matrix as a struct, the threshold.

    Accuracy, precision, recall and F1 belong to the argmax label, the confusion
    matrix to the threshold; at a probability of exactly 0.5 the two differ.
    Undefined precision, recall or F1 is 0; AUC over one class or over an
    undefined score is null. A stored ``prob`` is what the threshold and the AUC go by,
    as in the sweep; without it the softmax of the logits stands in. Without logits the
    argmax label is ``prob > 0.5``.

    Rows are grouped by score once, which feeds the counts and the AUC alike.
    """
    require_columns(df, [label, logits or prob])
    if logits is None:
        p, argmax = F.col(prob), (at_least(F.col(prob), 0.5) & (F.col(prob) != 0.5)).cast("int")
    else:
        p = F.col(prob) if prob in df.columns else toxic_probability(F.col(logits))
        argmax = argmax_label(F.col(logits))
    return _metrics_row(*_summary(df, label, p, argmax, threshold), threshold)


def metrics_with_running_counts(
    df: DataFrame,
    running: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    label: str = "labels",
    logits: str | None = "logits",
    prob: str = "toxic_prob",
) -> DataFrame:
    """:func:`evaluation_metrics` of rows whose running counts are there already.

    The AUC is then a plain sum over the distinct scores, and the rows aren't grouped again.
    """
    require_columns(df, [label, prob])
    y, p = F.col(label), F.col(prob)
    top = (at_least(p, 0.5) & (p != 0.5)).cast("int") if logits is None else argmax_label(F.col(logits))
    hit = decide(p, threshold)
    counts = df.agg(
        F.count_if(y == 1).alias("n_pos"),
        F.count_if(y == 0).alias("n_neg"),
        F.count_if(~F.coalesce(is_defined(p), F.lit(False))).alias("undefined"),
        F.count_if((y == 1) & (top == 1)).alias("top_tp"),
        F.count_if((y == 0) & (top == 1)).alias("top_fp"),
        F.count_if((y == 1) & (hit == 1)).alias("hit_tp"),
        F.count_if((y == 0) & (hit == 1)).alias("hit_fp"),
    )
    pairs, auc = auc_of_running(running)
    return _metrics_row(counts.crossJoin(pairs), auc, threshold)  # one row each


def _metrics_row(summary: DataFrame, auc: Column, threshold: float) -> DataFrame:
    tp, fp = F.col("top_tp"), F.col("top_fp")
    fn, tn = F.col("n_pos") - tp, F.col("n_neg") - fp
    return summary.select(
        ratio_or_null(tp + tn, F.col("n_pos") + F.col("n_neg")).alias("accuracy"),
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp, tp + fn).alias("recall"),
        ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"),
        auc.alias("roc_auc"),
        F.struct(
            F.col("hit_tp").alias("tp"),
            F.col("hit_fp").alias("fp"),
            (F.col("n_neg") - F.col("hit_fp")).alias("tn"),
            (F.col("n_pos") - F.col("hit_tp")).alias("fn"),
        ).alias("confusion_matrix"),
        F.lit(float(threshold)).alias("threshold_used"),
    )


def core_metrics(
    df: DataFrame,
    label: str = "labels",
    logits: str | None = "logits",
    prob: str = "toxic_prob",
) -> DataFrame:
    """Accuracy, precision, recall and F1 of the argmax label, and ROC-AUC."""
    return evaluation_metrics(df, label=label, logits=logits, prob=prob).select(
        "accuracy", "precision", "recall", "f1", "roc_auc"
    )
