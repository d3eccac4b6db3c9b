from __future__ import annotations

import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from veritally.operators import confusion as C

PERFECT = [(0, 0.03), (0, 0.21), (0, 0.17), (1, 0.77), (1, 0.83)]
WRONG = [(0, 0.62), (0, 0.99), (0, 0.71), (1, 0.22), (1, 0.49)]
MIXED = [(0, 0.35), (1, 0.25), (0, 0.15), (1, 0.95), (1, 0.55), (0, 0.65)]


def at(scored, pairs, threshold=0.5):
    return rows(C.metrics_at_threshold(scored(pairs), threshold))[0]


def test_perfect_and_all_wrong(scored):
    got = at(scored, PERFECT)
    assert (got["precision"], got["recall"], got["f1"], got["accuracy"]) == (1, 1, 1, 1)
    assert (got["tp"], got["fp"], got["tn"], got["fn"]) == (2, 0, 3, 0)
    got = at(scored, WRONG)
    assert (got["precision"], got["recall"], got["f1"], got["accuracy"]) == (0, 0, 0, 0)
    assert (got["tp"], got["fp"], got["tn"], got["fn"]) == (0, 3, 0, 2)


def test_threshold_is_echoed_and_inclusive(scored):
    got = at(scored, [(1, 0.3), (0, 0.3)], 0.3)
    assert (got["threshold"], got["tp"], got["fp"]) == (0.3, 1, 1)


def test_recall_never_rises_and_counts_add_up(scored):
    random.seed(3)
    pairs = [(int(random.random() < 0.3), round(random.random(), 2)) for _ in range(300)]
    sweep = sorted(rows(C.threshold_sweep(scored(pairs))), key=lambda r: r["threshold"])
    assert [r["threshold"] for r in sweep] == list(C.DEFAULT_GRID)
    assert all(a["recall"] >= b["recall"] for a, b in zip(sweep, sweep[1:]))
    for r in sweep:
        t = r["threshold"]
        assert r["tp"] == sum(y == 1 and p >= t for y, p in pairs)
        assert r["fp"] == sum(y == 0 and p >= t for y, p in pairs)
        assert r["tp"] + r["fp"] + r["tn"] + r["fn"] == len(pairs)
        assert r["precision"] == pytest.approx(r["tp"] / max(1, r["tp"] + r["fp"]), abs=5.1e-5)


def test_empty_input_gives_zero_metrics_for_every_threshold(scored):
    sweep = rows(C.threshold_sweep(scored([])))
    assert len(sweep) == 9
    assert all(r["precision"] == r["recall"] == r["f1"] == r["accuracy"] == 0.0 for r in sweep)
    with pytest.raises(ValueError, match="grid"):
        C.threshold_sweep(scored([]), [])


def test_nan_and_null_scores_predict_class_zero(scored):
    got = at(scored, [(1, math.nan), (0, math.nan), (1, None), (1, 0.9)])
    assert (got["tp"], got["fp"], got["tn"], got["fn"]) == (1, 0, 1, 2)
    matrix = rows(C.confusion_matrix(scored([(1, math.nan), (0, None)])))[0]
    assert matrix == {"tp": 0, "fp": 0, "tn": 1, "fn": 1}


def points(df, **options):
    return {r["operating_point"]: r for r in rows(C.operating_points(df, **options))}


def test_operating_points(scored):
    got = points(scored(MIXED), grid=[0.1, 0.3, 0.5, 0.7])
    assert got["best_f1"]["threshold"] == 0.1
    assert got["high_recall_threshold"]["threshold"] == 0.1
    assert got["high_precision_threshold"]["threshold"] == 0.7
    assert isinstance(got["best_f1"]["tp"], int)


def test_unreached_point_is_null(scored):
    got = points(scored([(0, 0.9), (1, 0.9)]))
    assert got["high_precision_threshold"]["threshold"] is None
    assert got["high_precision_threshold"]["tp"] is None
    assert got["high_recall_threshold"]["threshold"] == 0.1


def test_f1_ties_go_to_the_first_grid_position(scored):
    assert points(scored(PERFECT), grid=[0.7, 0.3, 0.5])["best_f1"]["threshold"] == 0.7


def test_floors_apply_to_rounded_metrics(scored):
    # 17999 of 20000 is 0.89995, which rounds up to 0.9.
    pairs = [(1, 0.9)] * 17999 + [(0, 0.9)] * 2001
    got = points(scored(pairs), grid=[0.5])
    assert got["high_precision_threshold"]["precision"] == 0.9
    pairs = [(1, 0.9)] * 16999 + [(1, 0.1)] * 3001
    assert points(scored(pairs), grid=[0.5])["high_recall_threshold"]["recall"] == 0.85


def with_logits(df):
    p = F.col("toxic_prob")
    return df.withColumn("logits", F.array(F.log(1 - p), F.log(p)))


def test_argmax_and_threshold_disagree_at_one_half(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (0, [0.0, 0.0])], "labels int, logits array<double>")
    got = rows(C.evaluation_metrics(df, 0.5))[0]
    assert got["recall"] == 0.0 and got["accuracy"] == 0.5
    assert got["confusion_matrix"] == {"tp": 1, "fp": 1, "tn": 0, "fn": 0}
    assert got["threshold_used"] == 0.5 and got["roc_auc"] == 0.5


@pytest.mark.parametrize("logits", ["logits", None])
def test_core_metrics(scored, logits):
    got = rows(C.core_metrics(with_logits(scored(MIXED)), logits=logits))[0]
    assert got["accuracy"] == 4 / 6
    assert (got["precision"], got["recall"], got["f1"]) == (2 / 3, 2 / 3, 2 / 3)
    assert got["roc_auc"] == 6 / 9


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.7])
def test_matrix_goes_by_the_stored_probability(scored, threshold):
    """Logits on another scale must not move the matrix away from the sweep."""
    df = with_logits(scored(MIXED)).withColumn("logits", F.transform("logits", lambda x: 2 * x))
    matrix = rows(C.evaluation_metrics(df, threshold))[0]["confusion_matrix"]
    sweep = rows(C.metrics_at_threshold(df, threshold))[0]
    assert matrix == {n: sweep[n] for n in ("tp", "fp", "tn", "fn")}


def test_core_metrics_on_one_class_and_on_nothing(scored):
    got = rows(C.core_metrics(with_logits(scored([(0, 0.2), (0, 0.3)]))))[0]
    assert got == {"accuracy": 1.0, "precision": 0.0, "recall": 0.0, "f1": 0.0, "roc_auc": None}
    got = rows(C.core_metrics(with_logits(scored([]))))[0]
    assert got["roc_auc"] is None and got["accuracy"] is None
