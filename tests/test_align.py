"""Scores from another table, and what can be wrong with their keys."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from veritally.operators.align import ALIGNED, TableScorer, align_scores
from veritally.plans.evaluate import run_evaluation


def tables(spark, seed=1):
    pick = random.Random(seed)
    mine = [(k, f"t{k}", pick.randrange(2)) for k in range(200)] + [(7, "again", 0), (None, "no key", 1), (None, "nor here", 1)]
    theirs = [(k, k / 400) for k in range(0, 400, 2)] + [(8, 0.5), (8, 0.02), (301, 0.1), (None, 0.9)] + [(100, 0.25)] * 300
    rows_ = spark.createDataFrame(mine, "doc_id long, text string, labels int")
    scores = spark.createDataFrame(theirs, "doc_id long, toxic_prob double")
    return rows_.repartition(3), scores.repartition(4), mine, theirs


def status_by_hand(mine, theirs):
    a, b = Counter(r[0] for r in mine), Counter(s[0] for s in theirs)
    out = {}
    for k in {*a, *b}:
        wrong = "no_key" if k is None else "double" if a[k] > 1 or b[k] > 1 else None
        out[k] = wrong or ("missing" if not b[k] else "orphan" if not a[k] else ALIGNED), a[k], b[k]
    return out


def test_every_key_has_its_status(many_ranges, spark):
    df, scores, mine, theirs = tables(spark)
    found = align_scores(df, scores, allowed=("missing", "orphan", "double", "no_key"))
    expected = status_by_hand(mine, theirs)
    problems = {r["doc_id"]: (r["status"], r["n_rows"], r["n_scores"]) for r in rows(found.problems)}
    assert problems == {k: v for k, v in expected.items() if v[0] != ALIGNED}
    assert found.counts == Counter(v[0] for v in expected.values())
    score_of = {k: p for k, p in theirs}
    fine = {r["doc_id"]: r for r in rows(found.rows)}
    assert set(fine) == {k for k, v in expected.items() if v[0] == ALIGNED}
    assert all(r["toxic_prob"] == score_of[k] and r["text"] == f"t{k}" for k, r in fine.items())
    assert found.rows.columns == ["doc_id", "text", "labels", "toxic_prob"]


def test_problems_fail_unless_allowed(spark):
    df, scores, *_ = tables(spark)
    with pytest.raises(ValueError, match="don't align.*missing.*orphan.*double.*no_key"):
        align_scores(df, scores)
    with pytest.raises(ValueError, match=r"1 missing$"):
        align_scores(df.where("doc_id IN (2, 3, 4)"), scores.where("doc_id IN (2, 4, 6)"), allowed=("orphan",))
    clean = align_scores(df.where("doc_id IN (2, 4)"), scores.where("doc_id IN (2, 4)"))
    assert clean.counts == {ALIGNED: 2} and clean.problems.count() == 0


def test_one_shuffle(spark):
    df, scores, *_ = tables(spark)
    found = align_scores(df, scores, allowed=("missing", "orphan", "double", "no_key"))
    assert "Exchange" not in found.rows._jdf.queryExecution().toString()  # read from what was stored


def test_tables_without_rows_and_without_columns(spark):
    df, scores, *_ = tables(spark)
    assert align_scores(df.limit(0), scores.limit(0)).counts == {}
    keys = align_scores(spark.range(3).toDF("doc_id"), spark.range(3).toDF("doc_id"))
    assert sorted(r["doc_id"] for r in rows(keys.rows)) == [0, 1, 2]
    assert align_scores(df.where("doc_id = 3"), scores.limit(0), allowed=("missing",)).counts == {"missing": 1}


def test_arguments_are_checked(spark):
    df, scores, *_ = tables(spark)
    for a, b, options in (
        (df, scores.withColumn("text", F.lit("x")), {}),
        (df, scores.withColumn("doc_id", F.col("doc_id").cast("string")), {}),
        (df, scores, {"allowed": ("nothing",)}),
        (df, scores, {"key": "id"}),
    ):
        with pytest.raises(ValueError):
            align_scores(a, b, **options)


def test_evaluation_with_scores_from_a_table(spark, tmp_path):
    corpus = spark.range(300).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), (F.col("id") % 4 == 0).cast("int").alias("toxicity")
    )
    scores = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, 0.9).otherwise(0.2).alias("toxic_prob"))
    run = run_evaluation(corpus, TableScorer(scores.orderBy(F.rand(1))), str(tmp_path))
    stored = spark.read.json(run.reports["eval_test_metrics.json"]).first()
    assert stored["accuracy"] == 1.0 and stored["roc_auc"] == 1.0
    with pytest.raises(ValueError, match="missing"):
        run_evaluation(corpus, TableScorer(scores.where("doc_id % 3 = 0")), str(tmp_path))
