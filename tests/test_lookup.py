"""Vocabularies of any size: ranks in ranges, and ids by a join."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from veritally.operators import encode
from veritally.operators.encode import build_vocabulary, encode_fixed_length, lookup_ids


def texts(n=120, seed=1):
    pick = random.Random(seed)
    out = []
    for i in range(n):
        words = [f"w{pick.randrange(300)}" for _ in range(pick.randrange(12))]
        words += ["the"] * pick.randrange(9)  # about a third of all places
        pick.shuffle(words)
        out.append((i, " ".join(words) or None, i % 2))
    return out + [(n, "", 0), (n + 1, "İ ǅ 'quoted' \"x\" ß", 1), (0, "the same key again", 0)]


@pytest.fixture
def corpus(spark):
    return spark.createDataFrame(texts(), "doc_id long, text string, labels int").repartition(4)


def encoded(*args, **options):
    return sorted(map(str, rows(encode_fixed_length(*args, **options))))


@pytest.mark.parametrize("size", [1, 40, 5000])
@pytest.mark.parametrize("max_length", [2, 3, 12])
def test_join_equals_constant(many_ranges, corpus, size, max_length):
    vocabulary = build_vocabulary(corpus, size)
    by_table = encoded(corpus, vocabulary, max_length)
    assert by_table == encoded(corpus, vocabulary, max_length, largest_constant=0)


def test_a_vocabulary_beyond_the_constant_is_joined(spark, corpus):
    wide = spark.range(encode.LARGEST_VOCABULARY + 1).select(
        F.concat(F.lit("w"), "id").alias("token"), (F.col("id") + 4).cast("int").alias("id")
    )
    got = {r["doc_id"]: r["input_ids"] for r in rows(encode_fixed_length(corpus.where("doc_id > 0"), wide, 20))}
    for i, text, _ in texts()[1:120]:
        ids = [int(w[1:]) + 4 if w[0] == "w" else encode.UNKNOWN_ID for w in (text or "").split()][:18]
        assert got[i] == [encode.START_ID, *ids, encode.END_ID] + [0] * (18 - len(ids))


def test_hot_tokens_are_salted(many_ranges, spark):
    """One token on half of all places is dealt to many tasks, and no task holds most of it."""
    frame = spark.range(0, 4000, 1, 4).select(
        "id", F.array(F.lit("hot"), F.concat(F.lit("t"), "id"), F.lit("cold")).alias("_tokens")
    )
    vocabulary = spark.createDataFrame([("hot", 7), ("t5", 8)], "token string, id int")
    got = lookup_ids(frame, vocabulary, hot_tokens=50)
    assert {tuple(r["_ids"]) for r in rows(got.where("id <> 5"))} == {(7, 1, 1)}
    assert rows(got.where("id = 5"))[0]["_ids"] == [7, 8, 1]
    plan = got._jdf.queryExecution().toString()
    assert "_salt" in plan and "CartesianProduct" not in plan


def test_repeated_and_null_tokens_of_a_vocabulary(spark, corpus):
    odd = spark.createDataFrame([("the", 9), ("the", 5), (None, 6)], "token string, id int")
    one = spark.createDataFrame([("the", 5)], "token string, id int")
    assert encoded(corpus, odd, 6) == encoded(corpus, one, 6) == encoded(corpus, odd, 6, largest_constant=0)


def test_no_rows_and_no_vocabulary(spark, corpus):
    none = spark.createDataFrame([], "token string, id int")
    assert encode_fixed_length(corpus.limit(0), build_vocabulary(corpus, 9), 5, largest_constant=0).count() == 0
    assert encoded(corpus, none, 5) == encoded(corpus, none, 5, largest_constant=-1)


def test_missing_vocabulary_columns_are_named(spark, corpus):
    with pytest.raises(ValueError, match="token"):
        encode_fixed_length(corpus, spark.range(3), 5)


@pytest.mark.parametrize("size", [1, 17, 10_000])
def test_ranks_in_ranges_equal_ranks_in_one_task(many_ranges, corpus, monkeypatch, size):
    expected = sorted(map(str, rows(build_vocabulary(corpus, size))))
    monkeypatch.setattr(encode, "LARGEST_VOCABULARY", 0)
    assert sorted(map(str, rows(build_vocabulary(corpus, size)))) == expected


def test_ids_by_hand(corpus):
    count = Counter(w for _, t, _ in texts()[:120] for w in (t or "").split())
    got = [(r["token"], r["n"]) for r in rows(build_vocabulary(corpus.where("doc_id < 120 AND labels >= 0"), 3))]
    assert got[0][0] == "the" and count["the"] <= got[0][1] <= count["the"] + 1


def test_a_large_vocabulary_is_read_once_and_cut_before_it_is_grouped(spark, corpus):
    """Only entries that the rows hold are grouped, and none is needed to know that there are too many."""
    read = spark.sparkContext.accumulator(0)
    wide = spark.range(0, 20_000, 1, 4).select(F.concat(F.lit("w"), "id").alias("token"), "id")

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    counted = wide.mapInArrow(count, wide.schema)
    got = encode_fixed_length(corpus, counted, 9, largest_constant=50)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
    before = encoded(corpus, wide, 9)
    read.value = 0
    assert sorted(map(str, rows(got))) == before
    assert read.value == 20_000


def test_repeats_beyond_the_first_rows(spark, corpus):
    """A table with more rows than the constant holds but fewer tokens stays a constant."""
    few = spark.range(300).select(F.lit("the").alias("token"), (F.col("id") + 4).cast("int").alias("id"))
    found = encode_fixed_length(corpus, few, 6, largest_constant=5)
    assert "_row" not in found._jdf.queryExecution().toString()
    assert sorted(map(str, rows(found))) == encoded(corpus, few, 6, largest_constant=0)
