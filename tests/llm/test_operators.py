"""Language, archive, neighbours, BPE, mixing and licences on small tables."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import struct
from collections import defaultdict

import numpy as np
import pytest
from llm_fixtures import documents  # noqa: F401
from pyspark.sql import functions as F

from veritally.llm import bpe, language, licenses, mixing, neighbours, queries, warc

# Language -------------------------------------------------------------------------


def spell(seed, letters, n):
    pick = random.Random(str(seed))
    return " ".join("".join(pick.choice(letters) for _ in range(pick.randrange(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, spell(i, "abcdefgh" if i % 2 else "stuvwxyé", 30), "aa" if i % 2 else "zz") for i in range(200)]
    rows += [(200, None, "aa"), (201, "", "zz"), (202, "123 !?", "aa"), (203, "abc abc", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_of_unseen_texts(labelled):
    found = language.identify(labelled, language.train_on(labelled))
    got = {r.doc_id: r for r in found.collect()}
    assert len(got) == 204
    assert all(got[i].lang_pred == ("aa" if i % 2 else "zz") for i in range(200))
    assert [got[i].lang_pred for i in (200, 201, 202)] == ["und"] * 3
    assert got[203].lang_pred == "aa" and all(0 <= r.score <= 1 for r in got.values())


def test_held_out_labels_are_never_learned(labelled):
    picked = language.labelled_sample(labelled.where(language.is_held_out("doc_id")), "doc_id", "text", "lang")
    assert picked == []
    bounded = language.labelled_sample(labelled, "doc_id", "text", "lang", per_language=7)
    assert len(bounded) == 14


def test_language_without_labels_and_without_rows(labelled):
    nobody = labelled.withColumn("lang", F.lit(None).cast("string"))
    assert language.train_on(nobody) is None
    assert {r.lang_pred for r in language.identify(nobody, None).collect()} == {"und"}
    assert language.identify(labelled.limit(0), language.train_on(labelled)).count() == 0


def test_tables_equal_the_network():
    network = language.train([b"abc abd aab", b"xyz xxy zzy"], ["aa", "zz"], steps=3)
    windows, _, _ = language.cut_windows(np.frombuffer(b"abc xyz", np.uint8), np.array([0, 7]))
    embedded = network.embedding[windows]
    pooled = []
    for w, f in zip(language.WIDTHS, network.filters):
        n = windows.shape[1] - w + 1
        pooled.append(sum(embedded[:, j : j + n] @ f[j] for j in range(w)).max(axis=1))
    hidden = np.maximum(np.concatenate(pooled, axis=1) + network.bias, 0)
    expected = language._softmax(hidden @ network.output + network.output_bias)
    assert np.allclose(network.tables().probabilities(windows), expected, atol=1e-5)


def test_windows_cover_whole_texts():
    data = np.frombuffer(bytes(range(1, 251)) * 3, np.uint8)
    windows, text, used = language.cut_windows(data, np.array([0, 0, 300, 750]))
    assert text.tolist() == [1, 1, 2, 2] and used.tolist() == [256, 44, 256, 194]
    whole = np.concatenate([w[:u] for w, u in zip(windows, used)])
    assert whole.tolist() == data.tolist()


# Archive --------------------------------------------------------------------------

PAGES = [
    (1, "http://a/", "same"), (2, "http://b/", "same"), (3, None, "ü\r\n\r\nx"), (4, "http://c/\r\nX-Page: 9", None),
    (5, "http://d/", ""), (6, "http://e/", "same"), (7, "http://f/", "WARC/1.1\r\nX-Page: 1\r\n"),
]


@pytest.fixture(scope="module")
def archive(spark):
    pages = spark.createDataFrame([(*p, "x", 0) for p in PAGES], "page_id long, url string, html string, key string, size int")
    return warc.write_archive(pages)


def test_archive_reads_back(spark, archive):
    got = {r.page_id: r for r in warc.read_archive(spark, archive).collect()}
    by_text = defaultdict(list)
    for i, _, t in PAGES:
        by_text[t or ""].append(i)
    assert sorted(got) == [i for i, _, _ in PAGES]
    for i, _, t in PAGES:
        body, best = (t or "").encode(), max(by_text[t or ""])
        assert got[i].payload_bytes == len(body)
        assert got[i].payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert (got[i].record_type, got[i].refers_to) == (("response", None) if i == best else ("revisit", best))


def test_payloads_are_stored_once(spark, archive):
    assert spark.read.parquet(archive.payloads).count() == len({t or "" for _, _, t in PAGES})


def test_records_are_restored_byte_for_byte(spark, archive):
    headers = {r.page_id: r.headers for r in warc.read_records(spark, archive).collect()}
    for r in warc.restore_records(spark, archive).collect():
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        assert (head + b"\r\n\r\n").decode() == headers[r.page_id]
        length = int(dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])["Content-Length"])
        assert rest == (bytes(r.payload) if length else b"") + b"\r\n\r\n"
        assert bytes(r.payload) == (dict((i, t) for i, _, t in PAGES)[r.page_id] or "").encode()


def test_warc_files_hold_the_records(spark, archive, tmp_path):
    records = warc.restore_records(spark, archive)
    warc.write_warc_files(records, str(tmp_path / "w"))
    files = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*")))
    assert len(files) == sum(len(r.record) for r in records.collect())
    assert all(bytes(r.record) in files for r in records.collect())


def test_a_damaged_payload_fails(spark, archive, tmp_path):
    stored = spark.read.parquet(archive.payloads)
    wrong = warc.Archive(archive.records, str(tmp_path / "p"))
    stored.withColumn("payload", F.concat("payload", F.lit(b"!"))).write.parquet(wrong.payloads)
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_archive(spark, wrong).collect()


def test_short_payloads_are_all_responses_and_nothing_is_fine(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    got = warc.read_archive(spark, warc.write_archive(pages, min_revisit_bytes=4)).collect()
    assert {r.page_id for r in got if r.record_type == "revisit"} == {1, 2}
    assert warc.read_archive(spark, warc.write_archive(pages.limit(0))).count() == 0


# Neighbours -----------------------------------------------------------------------


def neighbours_by_hand(rows, is_query, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = v
    result = set()
    for q in filter(is_query, good):
        scored = sorted((-sum_in_order(good[q], good[o]), o) for o in good if o != q)
        result |= {(q, n + 1, o, -s) for n, (s, o) in enumerate(scored[:k])}
    return result


def sum_in_order(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


@pytest.mark.parametrize("shard_rows", [16, 4096])
def test_exact_neighbours(spark, shard_rows):
    random_ = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in random_.normal(size=6)]) for i in range(150)]
    rows += [(i, rows[0][1]) for i in range(150, 200)]
    rows += [(200, None), (201, []), (202, [0.0] * 6), (203, [1.0, None] + [0.0] * 4),
             (204, [float("nan")] + [1.0] * 5), (205, [float("inf")] + [1.0] * 5), (210, [9.0] * 6)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, key int, v int")
    got = neighbours.nearest_neighbours(df, F.col("vec_id") % 5 == 0, k=7, factor=1.0, shard_rows=shard_rows)
    assert {tuple(r) for r in got.collect()} == neighbours_by_hand(rows, lambda i: i % 5 == 0, 7)


def test_recall_of_the_production_factor(spark):
    random_ = np.random.default_rng(5)
    centres = random_.normal(size=(20, 32))
    x = centres[random_.integers(0, 20, 3000)] + 0.4 * random_.normal(size=(3000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = neighbours.nearest_neighbours(df, F.col("vec_id") % 20 == 0, shard_rows=256).collect()
    found = defaultdict(set)
    for r in got:
        found[r.query_id].add(r.vec_id)
    hits = 0
    for q in range(0, 3000, 20):
        scores = x @ x[q]
        scores[q] = -9
        hits += len(found[q] & set(np.argsort(-scores)[:20].tolist()))
    assert hits / (150 * 20) >= 0.9


def test_few_candidates_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [1.0, 2.0, 3.0])], "vec_id long, embedding array<double>")
    got = neighbours.nearest_neighbours(df, F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 0.5)]
    assert neighbours.nearest_neighbours(df.where("vec_id = 0"), F.lit(True)).count() == 0
    assert neighbours.nearest_neighbours(df.limit(0), F.lit(True)).count() == 0


# BPE ------------------------------------------------------------------------------

ODD_TEXTS = [
    None, "", " ", "Hello, World! it's 3.14 don't", "ÄÖÜ ß straße × ÷ É", "a<|endoftext|>b <|startoftext|>",
    "<|endoftext|>", "日本語 テキスト", "é ﬁ ΑΣ Σ İ", "x\x00y\x1cz\x85w\xa0v u", "!!!???...", "'s 'S ''re",
    "tab\tline\nfeed\r\n", "emoji 😀👍🏽 done", "1234567890", "²³¼ ½", "a|b<c <|x|>", "longword" * 40, "ZWJ‍x﻿",
]


@pytest.mark.parametrize("frequent", [0, 5, 1000])
def test_bpe_equals_the_library(spark, frequent):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(queries.tokenizer_path())
    texts = ODD_TEXTS + [spell(i, "abcdefghijk", 60) + " the of and" * 3 for i in range(20)]
    rows = [(i, t, 1, 2) for i, t in enumerate(texts)] + [(None, "null key", 1, 2), (0, "again", 1, 2), (4, ODD_TEXTS[4], 1, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, name int, mark int")
    got = bpe.encode_documents(df, queries.tokenizer_path(), frequent=frequent, decode=True)
    expected = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((i, len(ids), struct.pack(f"<{len(ids)}I", *ids), library.decode(ids, skip_special_tokens=False)))
    found = [(r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in got.collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_decoding_a_stored_table(spark):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(queries.tokenizer_path())
    ids = library.encode("decode me, please", add_special_tokens=False).ids
    df = spark.createDataFrame([(1, bytearray(struct.pack(f"<{len(ids)}I", *ids))), (2, bytearray()), (3, None)], "k int, ids binary")
    got = {r.k: r.decoded for r in bpe.decode_documents(df, queries.tokenizer_path()).collect()}
    assert got == {1: library.decode(ids, skip_special_tokens=False), 2: "", 3: None}


def test_bpe_of_no_rows(documents):
    assert bpe.encode_documents(documents([]), queries.tokenizer_path()).count() == 0


# Mixing ---------------------------------------------------------------------------


def targets_by_hand(sizes):
    """Reshare until no source is above twice its size."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, target, open_ = 1.5 * sum(sizes.values()), {}, list(order)
    while open_:
        share = (total - sum(target.values())) / sum(weight[s] for s in open_)
        over = [s for s in open_ if share * weight[s] > 2 * sizes[s]]
        for s in over or open_:
            target[s] = 2.0 * sizes[s] if over else share * weight[s]
        open_ = [s for s in open_ if s not in target]
    return target


@pytest.fixture(scope="module")
def sources(spark):
    pick = random.Random(2)
    rows = []
    for i in range(3000):
        s = pick.choice(["a"] * 30 + ["b"] * 10 + ["c"] * 3 + ["ä", None, "Z", "empty"])
        rows.append((i, " ".join(["w"] * (0 if s == "empty" else pick.randrange(1, 200))), s, 1, 2))
    rows += [(5000, None, "a", 1, 2), (None, "x y", "b", 1, 2), (7, "w w", "c", 1, 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size int, target int")


def test_mixing_meets_its_targets(sources):
    rows = {}
    for r in mixing.draw_copies(sources, keep=("doc_id", "source", "text")).collect():
        rows.setdefault(r._row.source, []).append(r)
    sizes = {s: sum(len((r._row.text or "").split()) for r in rs) for s, rs in rows.items()}
    target = targets_by_hand(sizes)
    for s, rs in rows.items():
        assert {r.source_size for r in rs} == {sizes[s]}
        assert rs[0].target == pytest.approx(target[s])
        taken = sum(r.copies * r.size for r in rs)
        assert abs(taken - target[s]) <= max(0.02 * target[s], 400)
        assert all(0 <= r.copies <= 2 for r in rs)


def test_mixing_again_gives_the_same(sources):
    once = sorted(map(tuple, mixing.mix_counts(sources).collect()), key=str)
    again = sorted(map(tuple, mixing.mix_counts(sources.repartition(7)).collect()), key=str)
    assert once == again


def test_the_mix_holds_the_copies(sources):
    drawn = mixing.mix_counts(sources).agg(F.sum("copies").alias("n"), F.sum("taken").alias("w")).first()
    mix = mixing.mix_documents(sources)
    assert mix.columns == sources.columns and mix.count() == drawn.n
    assert mix.agg(F.sum(mixing.word_count(F.col("text"))).alias("w")).first().w == drawn.w
    assert mixing.mix_documents(sources.limit(0)).count() == 0


@pytest.mark.parametrize("text, n", [(None, 0), ("", 0), (" \n", 0), ("a", 1), (" a\x0bb  c ", 3), ("é\xa0x", 1)])
def test_word_count(spark, text, n):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(mixing.word_count(F.col("t")).alias("n")).first().n == n


# Licences -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def license_model(spark):
    plain = [(i, spell(i, "abcdefghi", 20)) for i in range(60)]
    return licenses.train_licenses(spark.createDataFrame(plain, "doc_id long, text string"))


def test_notices_are_found(spark, license_model):
    rows = [
        (1, "intro\nReleased under the MIT License.\nrest"),
        (2, "Licensed under CC BY-NC 4.0."),
        (3, "This work is licensed under the GNU General Public License, version 2."),
        (4, "a\nb\nLicensed under the Apache License, Version 2.0."),
        (5, "He renewed his driving license last week."),
        (6, "the copyright page of the old book is lost and the permission too"),
        (7, None), (8, ""), (None, "Released under the MIT License."), (1, "Released under the MIT License."),
        (9, "abc def ghi"),
    ]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, words int, label int")
    got = {(r.doc_id, r.paragraph, r.family) for r in licenses.scan_licenses(df, license_model).collect()}
    assert got == {
        (1, 1, "mit"), (1, 0, "mit"), (2, 0, "cc-by-nc"), (3, 0, "gpl"), (4, 2, "apache-2.0"), (None, 0, "mit"),
    }
    assert licenses.scan_licenses(df.limit(0), license_model).count() == 0


def test_wrapped_notices_are_found(spark, license_model):
    mpl = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at http://mozilla.org/MPL/2.0/. */"""
    lgpl = """# This library is free software; you can redistribute it and/or
# modify it under the terms of the GNU Lesser General Public
# License as published by the Free Software Foundation; either
# version 2.1 of the License, or (at your option) any later version."""
    narrow = "// Permission is hereby\n// granted, free of\n// charge, to any\n// person obtaining a\n// copy of this\n// software and"
    rows = [
        (1, f"abc def\n{mpl}\nabc"), (2, f"abc\n\n{lgpl}\n"), (3, narrow), (4, "Dedicated to the public\n  domain under\tCC0"),
        (5, "Released under\n\nthe MIT License"), (6, "Released under\nthe MIT License\nReleased under the MIT License"),
        (7, "Ask for\npermission before you\nleave the room"),
    ]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), license_model).collect()
    found = {i: {(r.paragraph, r.family) for r in got if r.doc_id == i} for i, _ in rows}
    assert found[1] and {p for p, _ in found[1]} <= {1, 2} and {f for _, f in found[1]} == {"mpl-2.0"}
    assert (3, "lgpl") in found[2] and {f for _, f in found[2]} <= {"lgpl", "gpl"}
    assert found[3] and {f for _, f in found[3]} == {"mit"}
    assert found[4] == {(0, "cc0")}
    assert found[6] >= {(2, "mit")} and {f for _, f in found[6]} == {"mit"}
    assert not found[7]
    assert len(got) == len({(r.doc_id, r.paragraph, r.family) for r in got})


def test_every_plain_line_counts(spark):
    """Lines after the first, and of more texts than a draw would hold, settle what may be named."""
    near = "you may not use this file except in compliance with the"
    texts = [f"{spell(i % 500, 'abcdefghi', 9)}\n\n{near}" for i in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = licenses.train_licenses(df)
    lines = spark.createDataFrame([(licenses.re.findall(licenses._WORD, near),)], "words array<string>")
    chances = model.stages.transform(lines).first()["probability"].toArray()[1:]
    assert chances.max() < model.threshold


def test_scan_equals_brute_force(spark, license_model):
    """The score of every paragraph from the coefficients, without Spark."""
    vocabulary = {t: i for i, t in enumerate(license_model.stages.stages[2].vocabulary)}
    fitted = license_model.stages.stages[3]
    weights, bias = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    import re

    texts = [t for ts in licenses.TEMPLATES.values() for t in ts] + list(licenses.UNRELATED)
    texts += [" ".join(t.split()[:-2]) for t in texts] + [spell(i, "abc", 5) for i in range(5)]
    expected = set()
    for i, t in enumerate(texts):
        words = re.findall(licenses._WORD, t.lower())
        terms = set(words) | {f"{a} {b}" for a, b in zip(words, words[1:])}
        x = np.zeros(len(vocabulary))
        x[[vocabulary[w] for w in terms if w in vocabulary]] = 1
        p = language._softmax((weights @ x + bias)[None])[0][1:]
        family = license_model.families[1 + int(p.argmax())]
        plain = {re.sub(licenses._NUMBER, "0", w) for w in terms}
        like = max(
            len(plain & set(ts)) / len(ts) for ts in map(licenses.template_terms, licenses.TEMPLATES[family])
        )
        if re.search("(?i)" + "|".join(licenses.CUES), t) and p.max() >= license_model.threshold and like >= 0.6:
            expected.add((i, family))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.family) for r in licenses.scan_licenses(df, license_model).collect()}
    assert got == expected
    assert len(got) >= sum(map(len, licenses.TEMPLATES.values()))
