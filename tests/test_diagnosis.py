from __future__ import annotations

import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from veritally.operators import mistakes as M
from veritally.operators import predict as P
from veritally.operators import slices as S
from veritally.sinks.reports import slices_document


def test_prediction_record(scored):
    df = scored([(1, 0.8), (0, 0.3), (1, 0.5), (0, 0.6999)])
    got = rows(P.predict(df, 0.5).orderBy("doc_id"))
    assert [r["label_id"] for r in got] == [1, 0, 1, 1]
    assert [r["label"] for r in got] == ["toxic", "non-toxic", "toxic", "toxic"]
    assert [r["confidence"] for r in got] == [0.8, 0.7, 0.5, 0.6999]
    assert {r["threshold"] for r in got} == {0.5}


@pytest.mark.parametrize("bad", [0.0, 1.0, 1.5, -0.1, math.nan])
def test_threshold_must_be_inside_the_unit_interval(scored, bad):
    with pytest.raises(ValueError, match="threshold"):
        P.predict(scored([]), bad)


def test_softmax_and_argmax(spark):
    logits = [[0.0, 0.0], [1.0, 3.0], [1000.0, -1000.0], [-5.0, 700.0]]
    df = spark.createDataFrame([(i, z) for i, z in enumerate(logits)], "i int, logits array<double>")
    got = P.score_logits(df).orderBy("i").collect()
    assert [r.argmax_label for r in got] == [0, 1, 0, 1]
    assert [r.toxic_prob for r in got] == pytest.approx([0.5, 1 / (1 + math.exp(-2)), 0.0, 1.0])


def test_two_class_softmax_agrees_with_the_general_one(spark):
    from veritally.functions.scores import softmax, toxic_probability

    df = spark.range(-40, 41).select(
        F.array(F.col("id") / 3, F.lit(0.5).cast("double") - F.col("id")).alias("z")
    )
    for r in df.select(softmax(F.col("z"))[1].alias("a"), toxic_probability(F.col("z")).alias("b")).collect():
        assert r.a == pytest.approx(r.b, rel=1e-12)


def test_label_errors(scored):
    got = rows(P.label_errors(scored([(1, 0.9), (0, 0.9), (1, 0.1), (0, 0.1)])).orderBy("doc_id"))
    assert [r["error_type"] for r in got] == [None, "FP", "FN", None]
    assert [r["is_correct"] for r in got] == [True, False, False, True]


def test_top_mistakes_order_ties_and_limit(scored):
    pairs = [(0, 0.9), (0, 0.7), (0, 0.9), (1, 0.1), (1, 0.4), (1, 0.1), (1, 0.9), (0, 0.95)]
    df = scored(pairs).withColumn("text", F.concat(F.lit("t"), "doc_id"))
    got = M.top_mistakes(df, n_top=3).collect()
    assert [(r.error_type, r.doc_id) for r in got] == [
        ("FP", 7), ("FP", 0), ("FP", 2), ("FN", 3), ("FN", 5), ("FN", 4)]
    assert all(r.text == f"t{r.doc_id}" for r in got)
    assert [(r.true_label, r.predicted_label) for r in got] == [(0, 1)] * 3 + [(1, 0)] * 3


def test_top_mistakes_put_undefined_scores_last(scored):
    df = scored([(1, math.nan), (1, 0.2), (1, None), (0, 0.1)]).withColumn("text", F.lit("x"))
    got = [r.doc_id for r in M.top_mistakes(df).collect()]
    assert got[0] == 1 and sorted(got) == [0, 1, 2]


def test_no_mistakes_keep_the_columns(scored):
    got = M.top_mistakes(scored([(1, 0.9)]).withColumn("text", F.lit("x")))
    assert got.count() == 0
    assert got.columns == [
        "doc_id", "text", "true_label", "predicted_label", "toxic_prob", "error_type"]


def test_large_limit_does_not_broadcast(scored):
    df = scored([(0, 0.9), (1, 0.1)]).withColumn("text", F.lit("x"))
    assert M.top_mistakes(df, n_top=1_000_000).count() == 2


def slices_of(spark, texts, wrong=()):
    data = [(i, t, 1, 0.1 if i in wrong else 0.9) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "doc_id int, text string, labels int, toxic_prob double")
    return {r["slice"]: (r["n"], r["n_correct"], r["accuracy"]) for r in rows(S.error_slices(df))}


def test_slice_edges(spark):
    texts = ["a" * 49, "b" * 50, "c" * 199, "d" * 200, "\U0001f600" * 49, "e!" + "f" * 48]
    got = slices_of(spark, texts, wrong={1})
    assert got["short_text_lt50chars"] == (2, 2, 1.0)
    assert got["medium_text_50_200chars"] == (3, 2, 0.6667)
    assert got["long_text_gt200chars"] == (1, 1, 1.0)
    assert got["contains_exclamation_or_question"] == (1, 1, 1.0)
    assert got["no_exclamation_or_question"] == (5, 4, 0.8)
    assert got["contains_non_ascii"] == (1, 1, 1.0)
    assert got["ascii_only"] == (5, 4, 0.8)


def test_empty_slices_appear_with_null_accuracy(spark):
    got = slices_of(spark, ["short"])
    assert list(got) and set(got) == set(S.SLICES)
    assert got["long_text_gt200chars"] == (0, 0, None)
    assert slices_of(spark, [])["ascii_only"] == (0, 0, None)


def test_slices_use_the_raw_text(spark):
    # 60 characters of which 20 would be collapsed.
    assert slices_of(spark, ["a" * 40 + " " * 20])["medium_text_50_200chars"][0] == 1


def test_slices_from_facts_equal_slices_from_text(spark):
    data = [(1, "x" * n + m, 1, 0.9) for n, m in ((10, "?"), (60, "é"), (300, ""))]
    df = spark.createDataFrame(data, "doc_id int, text string, labels int, toxic_prob double")
    facts = df.select("labels", "toxic_prob", *S.text_facts(F.col("text")))
    assert rows(S.error_slices(facts)) == rows(S.error_slices(df))
    document = rows(slices_document(S.error_slices(df)))[0]
    assert list(document) == list(S.SLICES)
    assert document["ascii_only"] == {"n": 2, "n_correct": 2, "accuracy": 1.0}
