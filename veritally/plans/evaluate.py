"""The evaluation run: from scored rows to every metric, curve and report."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.functions.scores import DEFAULT_THRESHOLD
from veritally.operators.confusion import (
    DEFAULT_GRID,
    METRIC_COLUMNS,
    metrics_with_running_counts,
    operating_point_row,
    sweep_by_position,
)
from veritally.operators.curves import (
    DEFAULT_POINTS,
    average_precision,
    pr_curve,
    roc_curve,
    running_counts,
    thinned,
)
from veritally.operators.mistakes import top_mistakes
from veritally.operators.prepare import clean_rows, map_labels
from veritally.operators.slices import error_slices, text_facts
from veritally.operators.splits import TEST, VALIDATION
from veritally.operators.user_metrics import Metric, evaluate_metrics
from veritally.plans.prepare import split_corpus
from veritally.plans.scoring import Scorer, score_texts
from veritally.session import store_table
from veritally.sinks.reports import ReportSet, slices_document, write_csv, write_json


@dataclass(frozen=True)
class Evaluation:
    """The scored table on disk, and the folder of each report."""

    scored: DataFrame
    reports: dict[str, str]


def store_scored(scored: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write what the metrics need to the shared folder, once, and read it back.

    A row keeps its key, label, score and three facts about its raw text. A
    model then scores each text once however many metrics follow, each metric
    reads only its own columns, and a lost executor costs no rescoring.
    """
    columns = [c for c in (key, "labels", "toxic_prob", "logits") if c in scored.columns]
    return store_table(scored.select(*columns, *text_facts(F.col(text))), "scored")


def evaluate(
    scored: DataFrame,
    out_dir: str,
    split: str = TEST,
    threshold: float = DEFAULT_THRESHOLD,
    grid: Sequence[float] = DEFAULT_GRID,
    texts: DataFrame | None = None,
    n_top: int = 50,
    key: str = "doc_id",
    text: str = "text",
    max_points: int = DEFAULT_POINTS,
    user_metrics: Mapping[str, Metric] | None = None,
) -> Evaluation:
    """Write all reports on scored rows under ``out_dir``.

    ``texts`` is where the texts of the worst mistakes are read from. Give the
    corpus itself, or they come from the plan behind ``scored``. A curve with more than
    ``max_points`` points is thinned. ``user_metrics`` need logits and get a report of their own.

    Reports are published together as the last step; until then, and if anything fails,
    the set of the run before stays the current one.
    """
    table = store_scored(scored, key, text)
    logits = "logits" if "logits" in table.columns else None
    if user_metrics and not logits:
        raise ValueError("user metrics take logits, and the scorer gives none")
    running = store_table(running_counts(table), "running_counts")
    # The names of the reports.
    names = [
        f"eval_{split}_metrics.json",
        f"threshold_metrics_{split}.csv",
        f"threshold_summary_{split}.json",
        f"error_slices_{split}.json",
        "misclassified.csv",
        f"roc_curve_{split}.csv",
        f"pr_curve_{split}.csv",
        f"average_precision_{split}.json",
    ]
    own = f"user_metrics_{split}.json"
    reports = ReportSet(table.sparkSession, out_dir, [*names, own] if user_metrics else names)
    metrics, sweep, summary, slices, mistakes, roc, pr, ap = (reports.paths[n] for n in names)
    write_json(metrics_with_running_counts(table, running, threshold, logits=logits), metrics)
    points = sweep_by_position(table, grid).persist()  # as many rows as thresholds
    try:
        in_order = points.orderBy("grid_pos").coalesce(1)
        write_csv(in_order.select(*METRIC_COLUMNS), sweep)
        write_json(operating_point_row(points), summary)
    finally:
        points.unpersist()
    write_json(slices_document(error_slices(table, threshold)), slices)
    write_csv(
        top_mistakes(table, scored if texts is None else texts, n_top, threshold, key, text=text),
        mistakes,
    )
    few = running.limit(max_points + 1).count() <= max_points
    curve = running if few else store_table(thinned(running, max_points), "curve")
    # Part files follow the curve: ROC from (0, 0), precision-recall to its end point. Steps
    # between thinned points are no steps of the curve, so corners are only sought on the whole one.
    roc_points = roc_curve(curve, drop_collinear=few)
    write_csv(roc_points.orderBy(F.col("threshold").desc_nulls_first()), roc)
    write_csv(pr_curve(curve).orderBy(F.col("threshold").asc_nulls_last()), pr)
    write_json(average_precision(running), ap)
    if user_metrics:
        write_json(evaluate_metrics(table, user_metrics), reports.paths[own])
    return Evaluation(table, reports.publish())


def run_evaluation(
    corpus: DataFrame,
    scorer: Scorer,
    out_dir: str,
    split: str = TEST,
    threshold: float = DEFAULT_THRESHOLD,
    grid: Sequence[float] = DEFAULT_GRID,
    normalize: bool = True,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxicity",
    val_ratio: float = 0.1,
    test_ratio: float = 0.1,
    max_train: int | None = None,
    max_eval: int | None = None,
    seed: int = 42,
    present: Collection[str] | None = None,
    texts: DataFrame | None = None,
    max_points: int = DEFAULT_POINTS,
    user_metrics: Mapping[str, Metric] | None = None,
) -> Evaluation:
    """Split, clean, map labels, score one split and evaluate it.

    A row carries its raw text all the way, so a dropped row cannot shift texts
    against labels. Where ``corpus`` is a join, give the table that holds the
    texts as ``texts``, so that fetching a few of them does not join again.
    """
    if split not in (VALIDATION, TEST):
        raise ValueError(f"evaluate the validation or the test split, not '{split}'")
    rows = split_corpus(
        corpus, key, val_ratio, test_ratio, max_train, max_eval, seed, present
    ).where(F.col("split") == split)
    labelled = map_labels(clean_rows(rows, text, label), label)
    scored = score_texts(labelled, scorer, threshold, normalize, text)
    source = rows if texts is None else texts
    return evaluate(
        scored,
        out_dir,
        split,
        threshold,
        grid,
        source,
        key=key,
        text=text,
        max_points=max_points,
        user_metrics=user_metrics,
    )
