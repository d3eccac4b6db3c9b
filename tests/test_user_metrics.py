"""Metrics that a caller brings along."""

from __future__ import annotations

import math
import random
import sys

import numpy as np
import pytest
from conftest import rows
from pyspark import cloudpickle
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from veritally.catalog import Calibration, LogLoss
from veritally.operators.user_metrics import evaluate_metrics
from veritally.plans.evaluate import run_evaluation
from veritally.sinks.reports import current_reports

# Workers can't import test modules.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def scored(spark, n=500, seed=3):
    pick = random.Random(seed)
    data = [(i, [pick.gauss(0, 2), pick.gauss(0, 2)], int(pick.random() < 0.3)) for i in range(n)]
    return spark.createDataFrame(data, "id int, logits array<double>, labels int"), data


def loss_by_hand(data):
    return sum(math.log(sum(math.exp(x) for x in z)) - z[y] for _, z, y in data) / len(data)


@pytest.mark.parametrize("fan_in", [2, 3, 32])
def test_log_loss_on_skewed_partitions(spark, fan_in):
    df, data = scored(spark)
    # A third of the rows in one partition, a few in each of many, and empty ones.
    place = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 37)
    (got,) = rows(evaluate_metrics(df.repartition(50, place), {"l": LogLoss()}, fan_in=fan_in))
    assert got["l_mean"] == pytest.approx(loss_by_hand(data), rel=1e-12) and got["l_rows"] == 500


def test_states_are_merged_in_order(spark):
    class Order:
        names = ("falls",)

        def init(self):
            return []

        def update(self, state, logits, labels):
            return state + [int(x) for x in logits[:, 0]]

        def merge(self, left, right):
            return left + right

        def finish(self, state):
            return {"falls": float(sum(a > b for a, b in zip(state, state[1:])))}

    df = spark.range(0, 1000, 1, 13).select(F.array(F.col("id").cast("double")).alias("logits"), F.lit(0).alias("labels"))
    assert rows(evaluate_metrics(df, {"o": Order()}, fan_in=4)) == [{"o_falls": 0.0}]


def test_no_rows_and_undefined_rows(spark):
    df, _ = scored(spark, 4)
    for none in (df.limit(0), df.withColumn("labels", F.lit(None).cast("int")), df.where("id < 0").repartition(5)):
        (got,) = rows(evaluate_metrics(none, {"l": LogLoss(), "c": Calibration()}))
        assert got == {"l_mean": None, "l_rows": 0.0, "c_largest_gap": None}
    mixed = df.withColumn("logits", F.when(F.col("id") > 1, F.col("logits")))
    assert rows(evaluate_metrics(mixed, {"l": LogLoss()}))[0]["l_rows"] == 2


class Bad(LogLoss):
    def __init__(self, at):
        self.at = at

    def update(self, state, logits, labels):
        if self.at == "update":
            raise KeyError("broken")
        return super().update(state, logits, labels)

    def finish(self, state):
        return {"other": 1.0} if self.at == "finish" else super().finish(state)


@pytest.mark.parametrize(("at", "message"), [("update", "broken"), ("finish", "gave")])
def test_a_failing_metric_fails_the_job(spark, at, message):
    df, _ = scored(spark, 9)
    with pytest.raises(PythonException, match=message):
        evaluate_metrics(df, {"b": Bad(at)}).collect()


def test_arguments_are_checked(spark):
    df, _ = scored(spark, 3)
    for metrics, options in (({}, {}), ({"l": LogLoss()}, {"fan_in": 1}), ({"l": LogLoss()}, {"logits": "none"})):
        with pytest.raises(ValueError):
            evaluate_metrics(df, metrics, **options)


def with_logits(df):
    p = F.least(F.length("text") / 20.0, F.lit(0.99))
    return df.withColumn("toxic_prob", p).withColumn("logits", F.array(F.lit(0.0), F.log(p / (1 - p))))


def test_evaluation_reports_user_metrics(spark, tmp_path):
    corpus = spark.range(300).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("x"), (F.col("id") % 17 + 1).cast("int")).alias("text"),
        (F.col("id") % 17 > 9).cast("int").alias("toxicity"),
    )
    run = run_evaluation(corpus, with_logits, str(tmp_path), user_metrics={"log_loss": LogLoss()})
    stored = spark.read.json(run.reports["user_metrics_test.json"]).first()
    judged = [(r["toxic_prob"], r["labels"]) for r in rows(run.scored)]
    assert stored["log_loss_rows"] == len(judged)
    assert stored["log_loss_mean"] == pytest.approx(-np.mean([math.log(p if y else 1 - p) for p, y in judged]))
    assert current_reports(spark, str(tmp_path)) == run.reports
    with pytest.raises(ValueError, match="logits"):
        run_evaluation(corpus, lambda df: df.withColumn("toxic_prob", F.lit(0.5)), str(tmp_path),
                       user_metrics={"log_loss": LogLoss()})
