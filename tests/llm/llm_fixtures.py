from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs, with columns that clash with inner names."""

    def build(pairs, source="s", lang="en"):
        rows = [(i, t, lang, source, None if t is None else len(t), 1, 2, 3) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA + ", row int, size int, key int")

    return build


@pytest.fixture
def words():
    """Texts made of a small vocabulary, so that passages repeat."""

    def build(n, seed, vocabulary=400):
        pick = random.Random(seed)
        return [f"w{pick.randrange(vocabulary)}" for _ in range(n)]

    return build
