"""Scoring, training, evaluation and streaming, end to end on small corpora."""

from __future__ import annotations

import json
from pathlib import Path

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from veritally.plans.evaluate import run_evaluation
from veritally.plans.model import ModelScorer, load_model, save_model, train_classifier
from veritally.plans.scoring import PythonScorer, score_texts
from veritally.plans.train import run_training
from veritally.session import scratch_path, shared_folder
from veritally.streaming.scoring import (
    read_requests,
    score_stream,
    start_scoring,
    start_scoring_with_rejects,
)


def length_scorer(df):
    """Longer texts score higher; nothing to load."""
    return df.withColumn("toxic_prob", F.least(F.length("text") / 20.0, F.lit(0.99)))


def json_lines(path):
    return [json.loads(line) for f in sorted(Path(path).glob("part-*"))
            for line in f.read_text().splitlines()]


def test_score_texts_keeps_bad_rows_and_raw_texts(spark):
    texts = ["hello  there", "", None, " \t", "x" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = score_texts(df, length_scorer).orderBy("i").collect()
    assert [r.text for r in got] == texts
    assert [r.error_code for r in got] == [None, "EMPTY", "EMPTY", "EMPTY", None]
    assert got[0].toxic_prob == 11 / 20  # scored after normalisation
    assert [r.label for r in got] == ["toxic", None, None, None, "toxic"]
    assert got[1].toxic_prob is None and got[1].threshold is None
    limited = score_texts(df, length_scorer, max_chars=4096).orderBy("i").collect()
    assert limited[4].error_code == "TOO_LONG" and limited[4].label is None


def test_normalisation_can_be_turned_off(spark):
    df = spark.createDataFrame([("a   b",), ("a b",)], "text string")
    assert len({r.toxic_prob for r in score_texts(df, length_scorer).collect()}) == 1
    assert len({r.toxic_prob for r in score_texts(df, length_scorer, normalize=False).collect()}) == 2


def test_threshold_propagates(spark):
    df = spark.createDataFrame([("x" * 10,)], "text string")
    for threshold, label_id in ((0.4, 1), (0.5, 1), (0.51, 0)):
        row = score_texts(df, length_scorer, threshold).first()
        assert (row.label_id, row.threshold) == (label_id, threshold)
    with pytest.raises(ValueError):
        score_texts(df, length_scorer, 1.0)


def test_python_scorer_loads_once_per_task(spark, tmp_path):
    log = str(tmp_path / "loads")

    def load():
        with open(log, "a") as f:
            f.write("x")
        return lambda batch: pd.Series([len(t) / 100 for t in batch])

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, "10")
    try:
        df = spark.range(200).select(F.col("id").cast("string").alias("text")).coalesce(1)
        assert score_texts(df, PythonScorer(load)).where("toxic_prob > 0").count() == 200
    finally:
        spark.conf.unset(name)
    assert Path(log).read_text() == "x"


def toxic_corpus(spark, n=600):
    """Toxic texts hold one of two words that no other text has."""
    toxic = F.col("id") % 4 == 0
    word = F.when(toxic, F.when(F.col("id") % 8 == 0, "vile").otherwise("awful")).otherwise("kind")
    filler = F.concat_ws(" ", *[F.concat(F.lit("w"), (F.xxhash64("id", F.lit(k)) % 50).cast("string")) for k in range(6)])
    return spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.concat_ws("  ", filler, word).alias("text"),
        toxic.cast("int").alias("toxicity"),
    )


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    training = run_training(toxic_corpus(spark), str(root / "model"), str(root / "metrics"),
                            reg_params=(0.01, 10.0), n_features=4096)
    return training, str(root / "model"), str(root / "metrics")


def test_training_keeps_the_best_candidate(trained, spark):
    training, _, metrics = trained
    assert dict(training.candidates)[0.01] == 1.0
    assert training.best == 0.01 and dict(training.candidates)[10.0] < 1.0
    assert [r["selected"] for r in rows(training.table(spark))] == [True, False]
    stored = json_lines(f"{metrics}/train_metrics.json")
    assert stored == [{"accuracy": 1.0, "precision": 1.0, "recall": 1.0, "f1": 1.0, "roc_auc": 1.0}]


def test_equal_candidates_go_to_the_first(spark):
    prepared = toxic_corpus(spark, 200).select("text", F.col("toxicity").alias("labels")).withColumn(
        "split", F.when(F.xxhash64("text") % 5 == 0, "validation").otherwise("train"))
    training = train_classifier(prepared, reg_params=(0.02, 0.01), n_features=4096)
    assert training.best == 0.02


def test_missing_model(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_model(spark, str(tmp_path / "none"))


def test_saved_model_scores_alike(trained, spark):
    training, path, _ = trained
    df = toxic_corpus(spark, 40).select("doc_id", "text")
    a = score_texts(df, ModelScorer(training.model)).select("doc_id", "toxic_prob").orderBy("doc_id")
    b = score_texts(df, ModelScorer(load_model(spark, path))).select("doc_id", "toxic_prob").orderBy("doc_id")
    assert rows(a) == rows(b)
    with pytest.raises(ValueError, match="features"):
        ModelScorer(training.model)(df.withColumn("features", F.lit(0)))


def test_evaluation_writes_every_report(trained, spark, tmp_path):
    scorer = ModelScorer(load_model(spark, trained[1]))
    run = run_evaluation(toxic_corpus(spark), scorer, str(tmp_path / "out"), max_eval=30)
    assert run.scored.count() == 30
    assert "text" not in run.scored.columns
    report = {name: path for name, path in run.reports.items()}
    metrics = json_lines(report["eval_test_metrics.json"])[0]
    assert metrics["roc_auc"] == 1.0 and metrics["threshold_used"] == 0.5
    assert sum(metrics["confusion_matrix"].values()) == 30
    sweep = spark.read.csv(report["threshold_metrics_test.csv"], header=True)
    assert sweep.columns[0] == "threshold" and sweep.count() == 9
    summary = json_lines(report["threshold_summary_test.json"])[0]
    assert list(summary) == ["best_f1", "high_recall_threshold", "high_precision_threshold"]
    assert isinstance(summary["best_f1"]["tp"], int)
    slices = json_lines(report["error_slices_test.json"])[0]
    assert slices["long_text_gt200chars"] == {"n": 0, "n_correct": 0, "accuracy": None}
    mistakes = spark.read.csv(report["misclassified.csv"], header=True)
    assert mistakes.count() == 0 and "error_type" in mistakes.columns
    assert spark.read.csv(report["pr_curve_test.csv"], header=True).count() == run.scored.select("toxic_prob").distinct().count() + 1
    assert spark.read.csv(report["roc_curve_test.csv"], header=True).count() >= 2
    assert json_lines(report["average_precision_test.json"]) == [{"average_precision": 1.0}]


def test_summary_writes_null_for_an_unreached_point(spark, tmp_path):
    corpus = spark.range(200).select(
        F.col("id").alias("doc_id"), F.lit("same text here").alias("text"), (F.col("id") % 2).alias("toxicity"))
    run = run_evaluation(corpus, length_scorer, str(tmp_path))
    summary = json_lines(run.reports["threshold_summary_test.json"])[0]
    assert summary["high_precision_threshold"] is None and "high_precision_threshold" in summary


def test_evaluation_pairs_texts_and_labels_around_dropped_rows(spark, tmp_path):
    data = [(i, None if i % 3 == 0 else "x" * (15 if i % 2 else 2), i % 2) for i in range(300)]
    corpus = spark.createDataFrame(data, "doc_id bigint, text string, toxicity int")
    run = run_evaluation(corpus, length_scorer, str(tmp_path))
    assert json_lines(run.reports["eval_test_metrics.json"])[0]["accuracy"] == 1.0


def test_evaluation_refuses_the_train_split(spark, tmp_path):
    with pytest.raises(ValueError, match="train"):
        run_evaluation(toxic_corpus(spark), length_scorer, str(tmp_path), split="train")


REQUESTS = "id int, text string"


def arrive(spark, folder, data):
    spark.createDataFrame(data, REQUESTS).coalesce(1).write.mode("append").parquet(folder)


def test_stream_scores_each_request_once(spark, tmp_path, trained):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    scorer = ModelScorer(load_model(spark, trained[1]))

    def run():
        stream = score_stream(read_requests(spark, source, REQUESTS), scorer)
        start_scoring(stream, out, checkpoint).awaitTermination()
        return {r.id: r for r in spark.read.parquet(out).collect()}

    arrive(spark, source, [(0, "w1 vile"), (1, " "), (2, "x" * 4097), (3, None)])
    got = run()
    assert got[0].label == "toxic" and got[0].error_code is None
    assert [got[i].error_code for i in (1, 2, 3)] == ["EMPTY", "TOO_LONG", "EMPTY"]
    assert got[1].label is None and got[1].toxic_prob is None
    assert "threshold" not in got[0].asDict()
    # A restart from the same checkpoint takes only what is new.
    arrive(spark, source, [(4, "w2 kind")])
    again = run()
    assert set(again) == {0, 1, 2, 3, 4} and again[4].label == "non-toxic"
    assert spark.read.parquet(out).count() == 5


def test_stream_equals_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    data = [(i, "y" * i if i % 4 else None) for i in range(40)]
    arrive(spark, source, data)
    stream = score_stream(read_requests(spark, source, REQUESTS), length_scorer)
    start_scoring(stream, str(tmp_path / "out"), str(tmp_path / "offsets")).awaitTermination()
    batch = score_stream(spark.read.parquet(source), length_scorer)
    got = spark.read.schema(batch.schema).parquet(str(tmp_path / "out"))
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect()))


def test_rejects_go_to_their_own_table(spark, tmp_path):
    source, out, bad = (str(tmp_path / n) for n in ("in", "out", "bad"))
    arrive(spark, source, [(0, "fine"), (1, ""), (2, "good")])
    stream = score_stream(read_requests(spark, source, REQUESTS, files_per_batch=1), length_scorer)
    start_scoring_with_rejects(stream, out, bad, str(tmp_path / "offsets")).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [0, 2]
    assert [(r.id, r.error_code) for r in spark.read.parquet(bad).collect()] == [(1, "EMPTY")]


def test_scratch_paths_are_fresh_and_in_the_shared_folder(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(shared_folder(spark))
    assert spark.sparkContext.getCheckpointDir()
