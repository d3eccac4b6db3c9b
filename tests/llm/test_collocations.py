"""Phrase mining against counting by hand on small texts."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from llm_fixtures import documents  # noqa: F401

from veritally.llm import collocations as C


def ascii_lower(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t)


def mined_by_hand(rows, least, top):
    count, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", ascii_lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    count[lang, tuple(words[i : i + n])] += 1
    frequent = {p: f for p, f in count.items() if f >= least}
    out = []
    for lang in {k[0] for k in frequent}:
        phrases = []
        mine = {p: f for (x, p), f in frequent.items() if x == lang}
        for p, a in mine.items():
            longer = [
                f for q, f in mine.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
            ]
            if len(p) < 2 or any(100 * f >= 80 * a for f in longer):
                continue
            cuts = [(2_000_000 * a // (mine[p[:k]] + mine[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            phrases.append((-score, -a, " ".join(p).encode(), mine[p[:k]], mine[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(phrases)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def corpus(seed=2, n=90):
    pick = random.Random(seed)
    vocabulary = ["the", "The", "of", "é", "É", "a b", "New", "york", "city", "x1", "\U0001f600", "zz", "ab", "b"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(pick.randrange(40)):
            parts.append(pick.choice([*vocabulary, "new york city", "one two three four", "New York", f"r{i}"]))
            parts.append(pick.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "!", ";\x0b"]))
        rows.append(("".join(parts), pick.choice(["en", "de", None, ""])))
    return rows + [(None, "en"), ("", "fr"), (" ,;", "fr"), ("the the the the the the the", "it"), rows[0], rows[0]]


def mined(spark, rows, least, top, parts=3):
    docs = spark.createDataFrame(rows, "text string, lang string")
    docs = docs.selectExpr("*", "1 AS n", "2 AS rank", "'x' AS word", "3 AS f").repartition(parts)
    return sorted(tuple(r) for r in C.collocations(docs, least=least, top=top).collect())


def test_phrases_equal_counting_by_hand(spark):
    rows = corpus()
    for least, top in ((2, 2000), (3, 5), (12, 2000)):
        expected = mined_by_hand(rows, least, top)
        assert expected and mined(spark, rows, least, top) == expected


def test_und_is_one_language_with_null(spark):
    rows = [("a b", None), ("a b", "und")]
    assert mined(spark, rows, 2, 9) == [("und", 1, "a b", 2, 2, 2, 4, 1_000_000)]


def test_no_rows_and_no_words(spark):
    assert mined(spark, [("x", "en")], 2, 9) == []
    assert mined(spark, [(None, None), ("", "en"), (".,;", "en")], 1, 9) == []
    docs = spark.createDataFrame([], "text string, lang string")
    assert C.collocations(docs).collect() == []


def stripes_of(pairs, names, slots, buckets):
    return list(C._stripes([[np.array(c, np.int64) for c in zip(*pairs)]], 1, names, slots, buckets))


def entries_of(rows):
    return {(w, n): c for r in rows for w, n, c in zip(r["w1"], r["next1"], r["counts"])}


def test_heavy_prefixes_are_cut_in_slots_and_buckets_in_rows():
    pairs = [(7, i) for i in range(3000) for _ in range(1 + i % 2)] + [(8, 1), (8, 1), (9, 2)]
    heavy = C.gram_hashes([np.array([7], np.int64)])
    (batch,) = stripes_of(pairs, heavy, np.array([4], np.uint64), 10**6)
    rows = batch.to_pylist()
    assert max(len(r["counts"]) for r in rows) <= C.ROW_ENTRIES
    assert entries_of(rows) == Counter(pairs)
    of = {w: {r["bucket"] for r in rows if w in r["w1"]} for w in (7, 8, 9)}
    assert len(of[7]) == 4 and len(of[8]) == len(of[9]) == 1
    (one,) = stripes_of(pairs, heavy, np.array([4], np.uint64), 1)
    assert {r["bucket"] for r in one.to_pylist()} == {0} and entries_of(one.to_pylist()) == Counter(pairs)


def test_stripes_merge_across_batches():
    pick = random.Random(1)
    pairs = [(1 + pick.randrange(4), pick.randrange(1, 40)) for _ in range(900)]
    parts = [pairs[i::5] for i in range(5)]
    none = np.array([], np.uint64)
    rows = [r for p in parts for b in stripes_of(p, none, none, 3) for r in b.to_pylist()]
    rows.sort(key=lambda r: r["bucket"])
    kinds = {"bucket": pa.int64()} | {c: pa.list_(pa.int64()) for c in ("w1", "next1", "counts")}
    batches = [pa.RecordBatch.from_pylist(rows[i : i + 3], pa.schema(kinds)) for i in range(0, len(rows), 3)]
    found = [r for b in C._merge_task(1, (2,), 6)(iter(batches)) for r in b.to_pylist()]
    expected = {p: c for p, c in Counter(pairs).items() if c >= 6}
    assert {(r["w1"], r["w2"]): r["f"] for r in found} == expected and len(found) == len(expected)
    assert all(r["w3"] == r["w4"] == 0 for r in found)


def test_phrases_of_two_and_three_words_only(spark):
    docs = spark.createDataFrame([("a b c a b", "en")] * 2, "text string, lang string")
    found = C.collocations(docs, least=2, most_words=2).collect()
    assert sorted((r.phrase, r.a) for r in found) == [("a b", 4), ("b c", 2), ("c a", 2)]
    found = C.collocations(docs, least=2, most_words=3).collect()
    assert sorted((r.phrase, r.a) for r in found) == [("a b", 4), ("a b c", 2), ("b c a", 2), ("c a b", 2)]
