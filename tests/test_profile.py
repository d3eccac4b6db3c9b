from __future__ import annotations

import random
import statistics

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from veritally.operators import encode as E
from veritally.operators import profile as P


def labelled(spark):
    data = [("train", 0)] * 6 + [("train", 1)] * 2 + [("test", 0)] * 3 + [("val", 1)] + [("val", None)]
    return spark.createDataFrame(data, "split string, labels int")


def test_label_distribution(spark):
    got = {r["split"]: (r["n_toxic"], r["n_total"], r["pct_toxic"])
           for r in rows(P.label_distribution(labelled(spark)))}
    assert got == {"train": (2, 8, 25.0), "test": (0, 3, 0.0), "val": (1, 2, 50.0)}


def test_label_counts(spark):
    got = {(r["split"], r["labels"]): r["n"] for r in rows(P.label_counts(labelled(spark)))}
    assert got == {("train", 0): 6, ("train", 1): 2, ("test", 0): 3, ("val", 1): 1}


def test_class_imbalance(spark):
    got = {r["split"]: (r["pct_toxic"], r["imbalance_ratio"])
           for r in rows(P.class_imbalance(labelled(spark)))}
    assert got == {"train": (25.0, 3.0), "test": (0.0, None), "val": (100.0, 0.0)}


def test_text_lengths(spark):
    df = spark.createDataFrame([(None,), ("  ",), ("a b",)], "text string")
    assert [(r.char_len, r.word_len) for r in P.with_text_lengths(df).collect()] == [(0, 0), (2, 0), (3, 2)]


def lengths(spark, values):
    return spark.createDataFrame(values, "labels int, char_len bigint")


def test_length_stats_equal_pandas(spark):
    random.seed(5)
    data = [(int(random.random() < 0.2), int(random.expovariate(0.01))) for _ in range(501)]
    got = {r["labels"]: r for r in rows(P.length_stats(lengths(spark, data), measures=["char_len"]))}
    expected = pd.DataFrame(data, columns=["labels", "v"]).groupby("labels")["v"].describe().round(1)
    for label, want in expected.iterrows():
        have = got[label]
        assert [have[c] for c in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")] == (
            pytest.approx(list(want), abs=0.051))


def test_length_stats_of_one_row_has_no_deviation(spark):
    got = rows(P.length_stats(lengths(spark, [(0, 7)]), measures=["char_len"]))[0]
    assert got["std"] is None and got["mean"] == 7.0 and got["q50"] == 7.0


def test_length_stats_with_a_dominant_value(spark):
    df = spark.range(9000).select(
        F.lit(0).alias("labels"), F.when(F.col("id") % 3 == 0, 100).otherwise(F.col("id")).alias("char_len"))
    values = [100 if i % 3 == 0 else i for i in range(9000)]
    got = rows(P.length_stats(df, measures=["char_len"]))[0]
    assert got["std"] == pytest.approx(statistics.stdev(values), abs=0.06)
    assert got["q50"] == pytest.approx(np.percentile(values, 50), abs=0.06)


@pytest.mark.parametrize("values", [
    [0, 1, 2, 3, 10], [5, 5, 5], [7], list(range(101)), [1, 1000], [3, 4] * 7,
])
def test_histogram_equals_numpy(spark, values):
    df = lengths(spark, [(0, v) for v in values])
    got = sorted(rows(P.histogram(df, ["char_len"], 50, "labels")), key=lambda r: r["bin"])
    counts, edges = np.histogram(values, bins=50)
    assert [r["n"] for r in got] == list(counts)
    assert [r["bin_start"] for r in got] == pytest.approx(list(edges[:-1]), abs=1e-5)
    assert [r["bin_end"] for r in got] == pytest.approx(list(edges[1:]), abs=1e-5)


def test_histogram_ranges_are_per_label(spark):
    df = lengths(spark, [(0, 0), (0, 10), (1, 100), (1, 200)])
    got = rows(P.histogram(df, ["char_len"], 2, "labels"))
    assert {(r["labels"], r["bin"], r["bin_start"], r["n"]) for r in got} == {
        (0, 1, 0.0, 1), (0, 2, 5.0, 1), (1, 1, 100.0, 1), (1, 2, 150.0, 1)}
    assert "labels" not in P.histogram(df, ["char_len"], 2).columns


def test_token_coverage(spark):
    df = spark.createDataFrame([("a b",), ("a " * 200,), ("c",), (None,)], "text string")
    counted = E.with_token_counts(df)
    assert sorted(r.n_tokens for r in counted.where("text is not null").collect()) == [3, 4, 202]
    got = rows(P.token_coverage(counted))[0]
    assert (got["n_within"], got["n_texts"]) == (2, 3)
    assert got["pct_within"] == pytest.approx(200 / 3)
    assert rows(P.token_coverage(counted.limit(0)))[0]["pct_within"] is None


TEXTS = ["the cat", "The dog!", "the end", "", "zebra " * 100, None]


def encoded(spark, max_length=8, size=4):
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(TEXTS)], "doc_id int, text string, labels int")
    vocabulary = E.build_vocabulary(df, size)
    return vocabulary, E.encode_fixed_length(df, vocabulary, max_length).orderBy("doc_id").collect()


def test_vocabulary_order_and_ties(spark):
    vocabulary, _ = encoded(spark)
    assert [(r.token, r.n, r.id) for r in vocabulary.orderBy("id").collect()] == [
        ("zebra", 100, 4), ("the", 3, 5), ("!", 1, 6), ("cat", 1, 7)]


def test_encoding(spark):
    _, got = encoded(spark)
    assert [r.input_ids for r in got] == [
        [2, 5, 7, 3, 0, 0, 0, 0],
        [2, 5, 1, 6, 3, 0, 0, 0],
        [2, 5, 1, 3, 0, 0, 0, 0],
        [2, 3, 0, 0, 0, 0, 0, 0],
        [2, 4, 4, 4, 4, 4, 4, 3],
        [2, 3, 0, 0, 0, 0, 0, 0],
    ]
    for r in got:
        assert len(r.input_ids) == len(r.attention_mask) == 8
        assert r.attention_mask == [int(i > 0) for i in r.input_ids]


@pytest.mark.parametrize("max_length", [2, 3, 32])
def test_encoding_length_is_exact(spark, max_length):
    _, got = encoded(spark, max_length)
    assert {len(r.input_ids) for r in got} == {max_length}
    with pytest.raises(ValueError, match="max_length"):
        encoded(spark, 1)


def test_encoding_of_awkward_tokens(spark):
    texts = ['"', "\\", "日本", "'", "é"]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id int, text string, labels int")
    vocabulary = E.build_vocabulary(df, 10)
    ids = {r.token: r.id for r in vocabulary.collect()}
    got = E.encode_fixed_length(df, vocabulary, 3).orderBy("doc_id").collect()
    assert [r.input_ids[1] for r in got] == [ids[t] for t in texts]
