"""Suffix sorting and byte dedup against brute force on small texts."""

from __future__ import annotations

import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import documents  # noqa: F401

from veritally.llm import suffixes as S


def ranges(seed, letters, n=3000, strings=400, longest=120):
    pick = random.Random(seed)
    data = np.frombuffer(bytes(pick.choice(letters) for _ in range(n)), np.uint8)
    starts = np.array([pick.randrange(n) for _ in range(strings)])
    ends = np.minimum(starts + np.array([pick.randrange(longest) for _ in range(strings)]), n)
    return S.Suffixes(data, starts, ends)


@pytest.mark.parametrize("letters", [b"ab", b"\x00a", b"\x00", b"\xfe\xffabcdefgh"])
@pytest.mark.parametrize("shallow", [0, 8, 16, 1000])
def test_order_equals_sorted(letters, shallow):
    given = ranges(str((letters, shallow)), letters)
    order = S.deep_shallow_order(given, shallow)
    assert sorted(order.tolist()) == list(range(len(given)))
    strings = [given.string(i) for i in order]
    assert strings == sorted(given.string(i) for i in range(len(given)))
    common = S.neighbour_prefixes(given, order)
    assert common[0] == 0
    assert common[1:].tolist() == [len(os.path.commonprefix(p)) for p in zip(strings, strings[1:])]


def test_equal_strings_have_one_digest():
    given = ranges(5, b"ab", strings=900, longest=14)
    names, by_name = S.digests(given), {}
    for i in range(len(given)):
        assert by_name.setdefault(int(names[i]), given.string(i)) == given.string(i)
    assert len(by_name) == len({given.string(i) for i in range(len(given))})


def test_order_of_none_and_one():
    data = np.frombuffer(b"abc", np.uint8)
    for n in (0, 1):
        at = np.zeros(n, np.int64)
        given = S.Suffixes(data, at, at + 2)
        assert S.deep_shallow_order(given).tolist() == list(range(n))
        assert len(S.digests(given)) == n
    assert S.blind_trie_order(given, []) == []


def removed_by_hand(texts, window):
    raw = [(t or "").encode() for t in texts]
    count = Counter(r[i : i + window] for r in raw for i in range(len(r) - window + 1))
    out = []
    for r in raw:
        gone = [False] * len(r)
        for i in range(len(r) - window + 1):
            if count[r[i : i + window]] > 1:
                gone[i : i + window] = [True] * window
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(r), sum(gone), spans, bytes(b for b, g in zip(r, gone) if not g)))
    return out


def passages(seed, n=60):
    """Texts of few letters with shared passages, cut anywhere, and near copies."""
    pick = random.Random(seed)
    pool = ["".join(pick.choice("abcdé ") for _ in range(pick.randrange(5, 90))) for _ in range(8)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(pick.randrange(1, 6)):
            own = "".join(pick.choice("abcdefghé ") for _ in range(pick.randrange(30)))
            shared = pick.choice(pool)
            cut = pick.randrange(len(shared))
            parts += [own, pick.choice([shared, shared[cut:], shared[:cut]])]
        texts.append("".join(parts))
    return texts + [None, "", "a", "a" * 70, "b" * 31, texts[0], "x" + texts[1], texts[2] + "y", "ab" * 40]


@pytest.mark.parametrize(("window", "head", "gram"), [(20, 14, 4), (31, 20, 8), (16, 16, 3)])
def test_removal_equals_brute_force(spark, documents, window, head, gram):
    texts = passages(window)
    found = S.remove_repeated_bytes(
        documents(list(enumerate(texts))).repartition(3), window=window, head=head, gram=gram
    )
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found.collect()}
    assert [got[i] for i in range(len(texts))] == removed_by_hand(texts, window)


@pytest.mark.parametrize("group", [1, 3])
def test_owners_with_many_stretches_are_dealt_to_groups(spark, documents, monkeypatch, group):
    pick = random.Random(group)
    shared = "".join(pick.choice("abcdef") for _ in range(60))
    texts = ["".join(pick.choice("ghijkl") for _ in range(30)) + shared + "".join(pick.choice("gh") for _ in range(9)) for _ in range(80)]
    texts += passages(group)
    monkeypatch.setattr(S, "GROUP", group)
    found = S.remove_repeated_bytes(documents(list(enumerate(texts))).repartition(3), window=20, head=14, gram=4)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found.collect()}
    assert [got[i] for i in range(len(texts))] == removed_by_hand(texts, 20)


def test_groups_are_sorted_whole(monkeypatch):
    """Whatever the batches and however many stretches at a time, the result is the same."""
    pick = random.Random(4)
    rows = []
    for owner in range(30):
        core = bytes(pick.choice(b"abc") for _ in range(12))
        for k in range(pick.randrange(2, 9)):
            left, right = (bytes(pick.choice(b"ab") for _ in range(5)) for _ in range(2))
            rows.append((owner, 0, 1, owner * 100 + k, 3, 3, True, left + core + right))
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
    names = ["owner", "salt", "salts", "row", "start", "n", "once", "bytes"]
    whole = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def spans(size, at_once):
        monkeypatch.setattr(S, "AT_ONCE", at_once)
        batches = [whole.slice(i, size) for i in range(0, len(whole), size)]
        return sorted((r["row"], r["start"], r["n"]) for b in S._border_task(20)(iter(batches)) for r in b.to_pylist())

    expected = spans(1000, 4096)
    assert expected and all(spans(size, at_once) == expected for size in (1, 7, 1000) for at_once in (1, 5, 40))


def test_default_window_is_200_bytes(spark, documents):
    pick = random.Random(3)
    shared = "".join(pick.choice("abcdefgh ") for _ in range(200))
    own = [f"{i}" + "".join(pick.choice("ijklmnop ") for _ in range(300)) + f"{i}" for i in range(6)]
    texts = [own[0] + shared + own[1], own[2] + shared, own[3] + shared[1:] + own[4], own[5]]
    got = {r.doc_id: r for r in S.remove_repeated_bytes(documents(list(enumerate(texts)))).collect()}
    assert [(got[i].n_removed, got[i].n_spans) for i in range(4)] == [(200, 1), (200, 1), (0, 0), (0, 0)]
    assert bytes(got[1].kept).decode() == own[2]


def test_rows_without_key_and_rows_that_repeat(spark, documents):
    text = "".join(random.Random(8).choice("abcd") for _ in range(60))
    pairs = [(None, text), (None, "other " * 3), (7, "q" + text), (9, "unlike"), (9, "unlike"), (4, "z" * 19)]
    found = S.remove_repeated_bytes(documents(pairs), window=20, head=14, gram=4).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed) for r in found)
    assert got == [(False, 4, 19, 0), (False, 7, 61, 60), (False, 9, 6, 0), (False, 9, 6, 0), (True, 0, 18, 0), (True, 0, 60, 60)]


def test_no_rows(spark, documents):
    found = S.remove_repeated_bytes(documents([(1, "a")]).limit(0))
    assert found.collect() == [] and found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]


def test_chunks_of_a_long_text_have_all_windows(monkeypatch):
    text = passages(2)[3] * 3
    (part,) = [p for _, p in S._chunks(pa.array([text]), 20)]
    whole = S.stretches(part, 20, 14, 4)
    places = {(int(o), int(f) + i) for o, f, n in zip(whole[0], whole[2], whole[3]) for i in range(n)}
    monkeypatch.setattr(S, "CHUNK", 50)
    cut = set()
    for base, piece in S._chunks(pa.array([text]), 20):
        owner, _, first, count = S.stretches(piece, 20, 14, 4)
        cut |= {(int(o), base + int(f) + i) for o, f, n in zip(owner, first, count) for i in range(n)}
    assert cut == places and len(places) == len(text.encode()) - 19
