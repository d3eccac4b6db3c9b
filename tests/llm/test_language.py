"""Language identification: the whole vote by hand, and where training windows come from."""

from __future__ import annotations

import numpy as np
import pytest
from test_operators import spell

from veritally.llm import language as L


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, spell(f"v{i}", "abcdefgh" if i % 2 else "stuvwxyé", 5 + 40 * (i % 7)), "aa" if i % 2 else "zz") for i in range(90)]
    rows += [(900, "x" + "é" * 700, None), (901, None, "aa"), (902, "12", "aa"), (None, rows[0][1], "aa")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows


def forward(network, windows):
    """The network as it was trained, filter by filter, without tables."""
    embedded, pooled = network.embedding[windows], []
    for w, f in zip(L.WIDTHS, network.filters):
        n = windows.shape[1] - w + 1
        pooled.append(sum(embedded[:, j : j + n] @ f[j] for j in range(w)).max(axis=1))
    hidden = np.maximum(np.concatenate(pooled, axis=1) + network.bias, 0)
    return L._softmax(hidden @ network.output + network.output_bias)


def test_vote_and_score_by_hand(docs):
    df, rows = docs
    network = L.train_on(df)
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.lang_pred, r.score) for r in L.identify(df, network).collect()))
    expected = []
    for key, text, _ in rows:
        if not text or not any(c.isalpha() for c in text):
            expected.append((key is None, key or 0, "und", 1.0))
            continue
        body, total, size = text.encode(), 0, 0
        for at in range(0, len(body), L.WINDOW):
            part = body[at : at + L.WINDOW]
            window = np.frombuffer(part.ljust(L.WINDOW, b"\0"), np.uint8)[None]
            total = total + forward(network, window)[0] * len(part)
            size += len(part)
        mean = total / size
        expected.append((key is None, key or 0, network.languages[int(mean.argmax())], float(mean.max())))
    expected.sort()
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    assert np.allclose([g[3] for g in got], [e[3] for e in expected], atol=1e-4)


def test_windows_are_drawn_from_whole_texts(spark):
    body = " ".join(f"w{i}" for i in range(40_000))  # well beyond 64 KB
    df = spark.createDataFrame([(i, f"{i} {body}", "aa") for i in range(20)], "doc_id long, text string, lang string")
    sample = L.labelled_sample(df, "doc_id", "text", "lang")
    texts = {i: f"{i} {body}".encode() for i in range(20)}
    assert sample and len(sample) % L.SAMPLE_WINDOWS == 0
    places = [max(t.find(w) for t in texts.values()) for w, _ in sample]
    assert min(places) >= 0 and max(places) > 200_000 and np.median(places) > 65_536


def test_the_sample_follows_the_hash_of_the_key(spark):
    rows = [(i, f"text {i}", "aa" if i % 3 else "zz") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    few = L.labelled_sample(df.repartition(7), "doc_id", "text", "lang", per_language=25)
    assert few == L.labelled_sample(df.repartition(2), "doc_id", "text", "lang", per_language=25)
    more = L.labelled_sample(df, "doc_id", "text", "lang", per_language=60)
    assert len(few) == 50 and len(more) == 120 and set(few) <= set(more)


def test_a_null_key_neither_trains_nor_is_held_out(docs):
    df, _ = docs
    got = df.select("doc_id", L.is_held_out("doc_id").alias("h")).where("doc_id IS NULL").collect()
    assert [r.h for r in got] == [False]
    assert L.labelled_sample(df.where("doc_id IS NULL"), "doc_id", "text", "lang") == []
