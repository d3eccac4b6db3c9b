from __future__ import annotations

import re
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from veritally.functions import text as T

CODE_POINTS = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]


def apply(spark, fn, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    out = df.select("i", fn(F.col("t")).alias("v")).collect()
    return [r.v for r in sorted(out, key=lambda r: r.i)]


def python_normalize(s):
    return re.sub(r"\s+", " ", unicodedata.normalize("NFKC", s)).strip()


CASES = [
    ("  padded  ", "padded"),
    ("two  inner   gaps", "two inner gaps"),
    ("a\tb", "a b"),
    ("a\nb\r\nc", "a b c"),
    (" \t mixed \n gaps ", "mixed gaps"),
    ("ＡＢＣ１２３", "ABC123"),
    ("eﬃcient", "efficient"),
    ("Wait... what?!", "Wait... what?!"),
    ("MiXeD Case", "MiXeD Case"),
    ("", ""),
    (" \n\t ", ""),
    ("plain", "plain"),
    ("café", "café"),
    ("한", "한"),
    ("x 　y", "x y"),
    ("\x1cends\x85", "ends"),
    ("\U0001f600 smile", "\U0001f600 smile"),
]


@pytest.mark.parametrize("chunk", [CASES])
def test_normalize_cases(spark, chunk):
    assert apply(spark, T.normalize_text, [c[0] for c in chunk]) == [c[1] for c in chunk]


def test_normalize_equals_python_on_every_code_point(spark):
    # Each code point on its own, between letters and after a base letter.
    values = [f" {chr(c)}a{chr(c)}  b{chr(c)}" for c in CODE_POINTS if c not in (0,)]
    lines = [values[i : i + 500] for i in range(0, len(values), 500)]
    texts = ["x".join(part) for part in lines]
    assert apply(spark, T.normalize_text, texts) == [python_normalize(t) for t in texts]


def test_whitespace_is_replaced_without_a_lookup_for_each_character(spark):
    df = spark.createDataFrame([("a",)], "t string").select(T.collapse_whitespace(F.col("t")))
    assert "translate(" not in df._jdf.queryExecution().toString()
    values = [f"{chr(a)}x{chr(b)}{chr(a)}y{chr(b)} " for a in (0x20, 0x0A, 0x85, 0x3000) for b in CODE_POINTS[:0x3100]]
    assert apply(spark, T.collapse_whitespace, values) == [" ".join(v.split()) for v in values]


def test_null_text_stays_null(spark):
    assert apply(spark, T.normalize_text, [None, "a"]) == [None, "a"]


def test_stable_code_points_are_stable(spark):
    """No code point that skips Python may be changed by NFKC, alone or in company."""
    flagged = apply(spark, lambda t: t.rlike(T.NFKC_UNSTABLE), [chr(c) for c in CODE_POINTS])
    stable = [c for c, f in zip(CODE_POINTS, flagged) if not f]
    assert len(stable) > 20_000
    composing = set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3))
    for c in CODE_POINTS:
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            composing.add(int(parts[1], 16))
    for c in stable:
        assert unicodedata.normalize("NFKC", chr(c)) == chr(c), hex(c)
        assert unicodedata.combining(chr(c)) == 0, hex(c)
        assert c not in composing, hex(c)


def test_whitespace_is_python_whitespace(spark):
    texts = [chr(c) for c in CODE_POINTS]
    content = apply(spark, T.has_content, texts)
    assert [bool(t.strip()) for t in texts] == content


def test_lengths(spark):
    texts = [None, "", "  ", "one", " two words ", "a　b\x1cc", "\U0001f600\U0001f600"]
    assert apply(spark, T.char_length, texts) == [len(t or "") for t in texts]
    assert apply(spark, T.word_length, texts) == [len((t or "").split()) for t in texts]


def test_character_classes(spark):
    texts = ["hm", "hm!", "why?", "café", "~\x7f", "\x80"]
    assert apply(spark, T.has_exclamation_or_question, texts) == [
        any(c in t for c in "!?") for t in texts
    ]
    assert apply(spark, T.has_non_ascii, texts) == [any(ord(c) > 127 for c in t) for t in texts]


def test_tokens(spark):
    assert apply(spark, T.tokens, ["Don't STOP, ok_1!", "Été 日本", "", "  "]) == [
        ["don", "'", "t", "stop", ",", "ok_1", "!"],
        ["été", "日本"],
        [],
        [],
    ]
    assert apply(spark, T.token_count, ["Don't STOP, ok_1!", ""]) == [9, 2]


def test_tokens_equal_possessive_ones_on_every_code_point(spark):
    possessive = T.TOKEN.replace("]+|", "]++|")
    assert "++" not in T.TOKEN and possessive != T.TOKEN
    values = [f"a{chr(c)}b{chr(c)}{chr(c)} 1{chr(c)}_" for c in CODE_POINTS]
    texts = [" ".join(values[i : i + 500]) for i in range(0, len(values), 500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    again = F.regexp_extract_all(F.lower("t"), F.lit(possessive), F.lit(0))
    assert df.where(T.tokens(F.col("t")) != again).count() == 0
