from __future__ import annotations

import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from veritally.operators import confusion
from veritally.operators import curves as C


def sample(kind):
    random.seed(11)
    if kind == "distinct":
        return [(int(random.random() < 0.3), random.random()) for _ in range(400)]
    if kind == "ties":
        return [(int(random.random() < 0.3), round(random.random(), 1)) for _ in range(400)]
    # One score holds more than a third of the rows.
    return [(int(random.random() < 0.3), 0.25 if i % 5 < 2 else random.random()) for i in range(400)]


def brute_auc(pairs):
    pos = [p for y, p in pairs if y == 1]
    neg = [p for y, p in pairs if y == 0]
    wins = sum(2 * (a > b) + (a == b) for a in pos for b in neg)
    return wins / (2 * len(pos) * len(neg))


def brute_points(pairs):
    n_pos = sum(y for y, _ in pairs)
    n_neg = len(pairs) - n_pos
    out = []
    for t in sorted({p for _, p in pairs}, reverse=True):
        tp = sum(y == 1 and p >= t for y, p in pairs)
        fp = sum(y == 0 and p >= t for y, p in pairs)
        out.append((t, tp, fp, n_pos, n_neg))
    return out


@pytest.mark.parametrize("kind", ["distinct", "ties", "hot"])
def test_auc_equals_pair_counting(many_ranges, scored, kind):
    pairs = sample(kind)
    got = rows(C.roc_auc(scored(pairs)))[0]
    assert got["roc_auc"] == brute_auc(pairs)
    assert got["n_pos"] + got["n_neg"] == 400


def test_auc_undefined(scored):
    assert rows(C.roc_auc(scored([(1, 0.5)])))[0]["roc_auc"] is None
    assert rows(C.roc_auc(scored([])))[0]["roc_auc"] is None
    for bad in (math.nan, None):
        assert rows(C.roc_auc(scored([(1, 0.9), (0, 0.1), (1, bad)])))[0]["roc_auc"] is None


def test_products_of_counts_do_not_overflow(spark):
    counts = spark.createDataFrame(
        [(0.2, 0, 30_000_000_000), (0.8, 5_000_000_000, 0)], "score double, pos bigint, neg bigint"
    )
    summary, auc = C.auc_of_counts(counts)
    assert summary.select(auc.alias("a")).first().a == 1.0


@pytest.mark.parametrize("kind", ["distinct", "ties", "hot"])
def test_curves_equal_brute_force_over_several_ranges(many_ranges, scored, kind):
    pairs = sample(kind)
    running = C.running_counts(scored(pairs))
    expected = brute_points(pairs)
    got = sorted(((r.score, r.tp, r.fp, r.n_pos, r.n_neg) for r in running.collect()), reverse=True)
    assert got == expected

    roc = sorted((r.fpr, r.tpr) for r in C.roc_curve(running).collect())
    assert roc == sorted([(0.0, 0.0)] + [(fp / n, tp / p) for _, tp, fp, p, n in expected])

    pr = {(r.threshold, r.precision, r.recall) for r in C.pr_curve(running).collect()}
    assert pr == {(t, tp / (tp + fp), tp / p) for t, tp, fp, p, _ in expected} | {(None, 1.0, 0.0)}

    ap, last = 0.0, 0.0
    for _, tp, fp, p, _ in expected:
        ap += (tp / p - last) * (tp / (tp + fp))
        last = tp / p
    assert C.average_precision(running).first()[0] == pytest.approx(ap, abs=1e-6)


def test_the_ranges_are_really_several(many_ranges, scored):
    ranged = C.score_counts(scored(sample("distinct"))).repartitionByRange(F.desc("score"))
    assert ranged.select(F.spark_partition_id()).distinct().count() > 1


@pytest.mark.parametrize("kind", ["distinct", "ties", "hot"])
def test_dropping_collinear_points(many_ranges, scored, kind):
    pairs = sample(kind)
    points = [(tp, fp) for _, tp, fp, _, _ in brute_points(pairs)]
    keep = []
    for i, (tp, fp) in enumerate(points):
        if 0 < i < len(points) - 1:
            before, after = points[i - 1], points[i + 1]
            if after[0] - tp == tp - before[0] and after[1] - fp == fp - before[1]:
                continue
        keep.append((tp, fp))
    running = C.running_counts(scored(pairs))
    n_pos, n_neg = points[-1]
    got = sorted((r.tpr, r.fpr) for r in C.roc_curve(running, drop_collinear=True).collect())
    assert got == sorted([(0.0, 0.0)] + [(tp / n_pos, fp / n_neg) for tp, fp in keep])


def test_curves_of_one_class(scored):
    running = C.running_counts(scored([(0, 0.5), (0, 0.7)]))
    assert {r.tpr for r in C.roc_curve(running).where("threshold is not null").collect()} == {None}
    assert C.average_precision(running).first()[0] is None


def test_undefined_scores_stay_off_the_curves(scored):
    running = C.running_counts(scored([(1, 0.9), (0, math.nan), (1, None), (0, 0.1)]))
    assert sorted(r.score for r in running.collect()) == [0.1, 0.9]
    assert {(r.n_pos, r.n_neg) for r in running.collect()} == {(1, 1)}


def test_curves_of_nothing(scored):
    running = C.running_counts(scored([]))
    assert running.count() == 0
    assert rows(C.average_precision(running)) == [{"average_precision": None}]
    assert rows(C.pr_curve(running)) == [{"threshold": None, "precision": 1.0, "recall": 0.0}]


def test_metrics_from_running_counts_are_the_same(scored):
    random.seed(9)
    pairs = [(int(random.random() < 0.4), round(random.random(), 2)) for _ in range(400)]
    for more in ([], [(1, None)], [(0, float("nan"))]):
        df = scored(pairs + more)
        got = confusion.metrics_with_running_counts(df, C.running_counts(df), 0.3, logits=None)
        assert rows(got) == rows(confusion.evaluation_metrics(df, 0.3, logits=None))
