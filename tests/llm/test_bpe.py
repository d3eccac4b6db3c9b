"""BPE through a table of words: the cut of frequent ones, and long words that many texts hold."""

from __future__ import annotations

import struct
from collections import Counter

import pytest
from pyspark.sql import functions as F

from veritally.llm import bpe, queries

LONG = "k" * 100


@pytest.fixture(scope="module")
def texts():
    return [f"alpha beta {'gamma ' * (i % 3)}{LONG if i % 3 == 0 else ''} rare{i} {'x' * 70 if i % 5 else ''}" for i in range(60)]


@pytest.mark.parametrize("frequent", [0, 1, 2, 3, 100])
def test_long_and_frequent_words_equal_the_library(spark, texts, frequent):
    library = bpe.Tokenizer(queries.tokenizer_path()).library
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in bpe.encode_documents(df, queries.tokenizer_path(), frequent=frequent, decode=True).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text, add_special_tokens=False).ids
        assert bytes(got[i].ids) == struct.pack(f"<{len(ids)}I", *ids)
        assert got[i].decoded == library.decode(ids, skip_special_tokens=False)


def test_the_cut_keeps_no_more_than_allowed(spark, texts):
    tokenizer = bpe.Tokenizer(queries.tokenizer_path())
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    words = [w for t in texts for w in tokenizer.split(t) if isinstance(w, str)]
    count = Counter(w for w in words if len(w.encode()) <= bpe.LONGEST_FREQUENT)
    for most in (0, 1, 2, 4, 7, 50):
        found = bpe.frequent_words(df, tokenizer, most=most).collect()
        assert len(found) <= most
        kept = sorted((n for n in count.values() if sum(m >= n for m in count.values()) <= most), reverse=True)
        assert sorted((r.n for r in found), reverse=True) == [n for n in kept if n >= bpe.LEAST_IN_SLICE]


def test_places_of_a_long_word_are_dealt_to_several_tasks(many_ranges, texts):
    df = many_ranges.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = bpe.encode_documents(df, queries.tokenizer_path(), frequent=0)
    assert "pmod(xxhash64(name" in found._jdf.queryExecution().toString()
    assert found.where(F.col("n_tokens") == 0).count() == 0
