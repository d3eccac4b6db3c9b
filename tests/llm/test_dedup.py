"""Exact, line, substring and near dedup against brute force on small texts."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import documents, words  # noqa: F401
from pyspark.sql import functions as F

from veritally.llm import components, exact, lines, neardup, substring
from veritally.llm import words as W

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# Words ----------------------------------------------------------------------------


def slice_of(texts):
    import pyarrow as pa

    return list(W.slices(pa.array(texts, pa.string())))


def test_words_of_a_slice():
    texts = ["a bc\td", None, "", " x ", "é\x0bü", "end"]
    (part,) = slice_of(texts)
    found = W.find_words(part)
    got = [part.data[s:e].tobytes().decode() for s, e in zip(found.starts, found.ends)]
    assert got == ["a", "bc", "d", "x", "é", "ü", "end"]
    assert np.diff(found.edges).tolist() == [3, 0, 0, 1, 2, 1]


def test_hashes_depend_on_content_only():
    (part,) = slice_of(["ab cd ab", "cd ab", "abc"])
    found = W.find_words(part)
    h = W.hash_ranges(part.data, found.starts, found.ends)
    assert h[0] == h[2] == h[4] and h[1] == h[3] and len({h[0], h[1], h[5]}) == 3
    grams = W.Sequences(h).grams(2)
    assert grams[1] == grams[3] and grams[0] != grams[1]


def test_slices_hold_long_texts_whole():
    texts = ["a" * 50, "b" * 200, "", "c" * 30]
    import pyarrow as pa

    parts = list(W.slices(pa.array(texts), most_bytes=100))
    assert [list(p.rows) for p in parts] == [[0], [1, 2], [3]] or sum(len(p.rows) for p in parts) == 4
    assert b"".join(p.data.tobytes() for p in parts).decode() == "".join(texts)


def test_sliding_min():
    values = np.random.default_rng(1).integers(0, 99, 200).astype(np.uint64)
    for width in (1, 2, 5, 28, 200):
        expected = [values[i : i + width].min() for i in range(200 - width + 1)]
        assert W.sliding_min(values, width).tolist() == expected
    assert len(W.sliding_min(values, 201)) == 0


# Exact ----------------------------------------------------------------------------


def exact_by_hand(pairs):
    groups = defaultdict(list)
    for i, t in pairs:
        groups[t or ""].append(i)
    return {
        (i, max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""]),
         hashlib.sha256((t or "").encode()).hexdigest())
        for i, t in pairs
    }


@pytest.mark.parametrize("first_slice, growth", [(4, 2), (64, 32)])
def test_exact_groups(documents, first_slice, growth):
    stem = "shared beginning " * 9
    texts = [None, "", "a", "a", "ä", "aä", stem, stem, stem + "x", stem + "y", stem + "y", "x" * 70]
    pairs = list(enumerate(texts * 2 + ["a"]))
    got = exact.exact_duplicates(documents(pairs), first_slice=first_slice, growth=growth)
    assert {tuple(r) for r in got.collect()} == exact_by_hand(pairs)
    assert got.count() == len(pairs)


def test_exact_on_nothing_and_on_repeated_rows(documents):
    assert exact.exact_duplicates(documents([])).count() == 0
    got = exact.exact_duplicates(documents([(1, "t"), (1, "t"), (None, "t")])).collect()
    assert [(r.keep_id, r.group_size) for r in got] == [(1, 3)] * 3
    assert sorted(r.kept for r in got) == [False, True, True]


# Lines ----------------------------------------------------------------------------


def lines_by_hand(pairs, window):
    places, solid = [], {}
    for i, t in sorted(pairs):
        all_lines = t.split("\n") if t else []
        solid[i] = [(n, x) for n, x in enumerate(all_lines) if WORD.search(x)]
        for p in range(len(solid[i]) - window + 1):
            run = solid[i][p : p + window]
            places.append((tuple(x for _, x in run), i, [n for n, _ in run]))
    seen, gone = set(), defaultdict(set)
    for run, i, numbers in places:
        if run in seen:
            gone[i] |= set(numbers)
        seen.add(run)
    return {
        i: (len(t.split("\n")) if t else 0, len(gone[i]),
            "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i]) if t else "")
        for i, t in pairs
    }


@pytest.mark.parametrize("window", [1, 2, 3])
def test_lines(documents, window):
    pick = random.Random(window)
    pairs = [
        (i, "\n".join(pick.choice(["a", "b", "c", "", " ", "d e", "é"]) for _ in range(pick.randrange(9))))
        for i in range(60)
    ]
    pairs += [(60, None), (61, ""), (62, "\n\n"), (63, "a\na\na\na")]
    got = lines.remove_repeated_lines(documents(pairs), window=window).collect()
    assert {r._row.doc_id: (r.n_lines, r.n_removed, r.kept_text) for r in got} == lines_by_hand(pairs, window)


def test_lines_of_repeated_rows_and_of_nothing(documents):
    assert lines.remove_repeated_lines(documents([])).count() == 0
    got = lines.remove_repeated_lines(documents([(1, "a\nb"), (1, "a\nb")])).collect()
    assert [(r.n_removed, r.kept_text) for r in got] == [(0, "a\nb")] * 2
    got = lines.remove_repeated_lines(documents([(None, "a\nb"), (1, "a\nb\nc")])).collect()
    assert sum(r.n_removed for r in got) == 2


def test_a_long_line_is_a_run_by_itself(documents, words):
    long, edge, short = (" ".join(words(n, n)) for n in (60, 50, 49))
    pairs = [
        (1, f"a\n{long}\nb"), (2, f"c\n  \n{long}\nd"), (3, long), (4, f"{short}\ne"), (5, f"{short}\nf"),
        (6, f"{edge}\ng"), (7, f"h\n{edge}\n{edge}"), (8, f"{long} x"), (9, "y" * 500), (10, f"z\n{'y' * 500}\nz"),
    ]
    got = lines.remove_repeated_lines(documents(pairs)).collect()
    changed = {r._row.doc_id: (r.n_removed, r.kept_text) for r in got if r.n_removed}
    assert changed == {2: (1, "c\n  \nd"), 3: (1, ""), 7: (2, "h")}
    got = lines.remove_repeated_lines(documents(pairs), long_line=None).collect()
    assert {r._row.doc_id: (r.n_lines, r.n_removed, r.kept_text) for r in got} == lines_by_hand(pairs, 2)


# Substrings -----------------------------------------------------------------------


def substrings_by_hand(pairs, window):
    split = [WORD.findall(t or "") for _, t in pairs]
    count = Counter(tuple(w[p : p + window]) for w in split for p in range(len(w) - window + 1))
    result = []
    for (i, _), w in zip(pairs, split):
        gone = set()
        for p in range(len(w) - window + 1):
            if count[tuple(w[p : p + window])] > 1:
                gone |= set(range(p, p + window))
        result.append((i, len(w), len(gone), " ".join(x for n, x in enumerate(w) if n not in gone)))
    return sorted(result)


@pytest.mark.parametrize("window, anchor", [(6, 2), (6, 1), (12, 4)])
def test_substrings(documents, words, window, anchor):
    pick = random.Random(window + anchor)
    passages = [words(pick.randrange(window - 2, 3 * window), s) for s in range(8)]
    pairs = []
    for i in range(60):
        text = words(pick.randrange(0, 40), 1000 + i, 5000)
        for _ in range(pick.randrange(3)):
            at = pick.randrange(len(text) + 1)
            passage = pick.choice(passages)
            cut = pick.randrange(len(passage))
            text = text[:at] + passage[: max(cut, window - 1)] + text[at:]
        pairs.append((i, pick.choice([" ", "\t", "  \n"]).join(text)))
    pairs += [(100, None), (101, ""), (102, "x " * 50), (103, "p q " * 30), (104, "only " * window)]
    got = substring.remove_repeated(documents(pairs), window=window, anchor=anchor).collect()
    assert sorted(tuple(r) for r in got) == substrings_by_hand(pairs, window)


def test_substrings_of_copies_and_of_nothing(documents, words):
    assert substring.remove_repeated(documents([])).count() == 0
    text = " ".join(words(50, 5))
    got = substring.remove_repeated(documents([(1, text), (1, text), (2, "a b")])).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == [
        (1, 50, 50, ""), (1, 50, 50, ""), (2, 2, 0, "a b"),
    ]
    got = substring.remove_repeated(documents([(None, text), (3, text + " z")])).collect()
    assert sorted(r.n_removed for r in got) == [50, 50]


def test_factors_name_a_source(documents, words):
    text = " ".join(words(80, 6, 9999))
    spans = substring.repeated_spans(documents([(1, text), (2, text)])).collect()
    assert spans and all(r.source_row in (1, 2) and r.source_row != r.row for r in spans)
    assert all(r.source_start == r.start for r in spans)


# Near copies ----------------------------------------------------------------------


def shingles(text):
    w = WORD.findall(text or "")
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def slow_similarity(x, y):
    every = set(x) | set(y)
    return sum(1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in every) for d in set(x) & set(y))


def test_probability_jaccard():
    pick = random.Random(4)
    for _ in range(30):
        x = Counter({pick.randrange(30): pick.randrange(1, 5) for _ in range(pick.randrange(1, 20))})
        y = Counter({pick.randrange(30): pick.randrange(1, 5) for _ in range(pick.randrange(1, 20))})
        a, b = sorted(x), sorted(y)
        got = neardup.probability_jaccard(
            np.array(a, np.uint64), np.array([x[i] for i in a], np.uint32),
            np.array(b, np.uint64), np.array([y[i] for i in b], np.uint32),
        )
        assert got == pytest.approx(slow_similarity(x, y))


def test_registers_agree_as_often_as_the_similarity_says():
    x = {i: 1 + i % 3 for i in range(1, 60)}
    y = {i: 1 + i % 2 for i in range(20, 80)}
    text = np.repeat([0, 1], [len(x), len(y)])
    ids = W.mix(np.array([*x, *y], np.uint64))
    weights = np.array([*x.values(), *y.values()], float)
    registers = neardup.prob_minhash(text, ids, weights, 2, 4000)
    agree = (registers[0] == registers[1]).mean()
    assert agree == pytest.approx(slow_similarity(Counter(x), Counter(y)), abs=0.03)


def near_classes_by_hand(pairs):
    sets = {i: shingles(t) for i, t in pairs}
    texts = dict(pairs)
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and ((texts[a] or "") == (texts[b] or "") or slow_similarity(sets[a], sets[b]) >= 0.8):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: find(i) for i in sets}


def test_near_duplicates(documents, words):
    pick = random.Random(8)
    pairs = []
    for group in range(6):
        base = words(120, group, 3000)
        for _ in range(5):
            copy = list(base)
            for _ in range(pick.randrange(0, 4)):
                copy[pick.randrange(len(copy))] = f"new{pick.randrange(10**6)}"
            pairs.append((len(pairs), " ".join(copy)))
    pairs += [(100, None), (101, ""), (102, "a b"), (103, "a b"), (104, "a  b"), (105, "\n"), (106, "same " * 30)]
    got = neardup.near_duplicate_classes(documents(pairs)).collect()
    assert {r.doc_id: r.class_id for r in got} == near_classes_by_hand(pairs)


def test_near_duplicates_of_repeats_and_of_nothing(documents, words):
    assert neardup.near_duplicate_classes(documents([])).count() == 0
    text = " ".join(words(40, 3))
    got = neardup.near_duplicate_classes(documents([(5, text), (5, text), (None, text), (7, text)])).collect()
    assert len(got) == 4 and len({r.class_id for r in got}) == 1


@pytest.mark.parametrize("block_rows", [2, 256])
def test_a_hub_that_fails_does_not_lose_links(spark, documents, words, monkeypatch, block_rows):
    """Rows that their bucket's hub doesn't reach are compared with the others."""
    monkeypatch.setattr(neardup, "BLOCK_ROWS", block_rows)
    pairs = [(i, " ".join(words(60, i // 2, 3000) + [f"tail{i}"])) for i in range(8)]
    df = documents(pairs)
    texts = df.select(F.col("doc_id").alias("row"), "text")
    places = df.select(F.col("doc_id").alias("row"), F.lit(1).cast("long").alias("bucket"))
    links = neardup._links(texts, places, 5, 0.8)
    found = {tuple(sorted((r.a, r.b))) for r in links.collect()}
    assert found == {(0, 1), (2, 3), (4, 5), (6, 7)}


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = components.connected_components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
