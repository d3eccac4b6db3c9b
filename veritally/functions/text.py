"""Text expressions. Everything here runs inside the JVM except full NFKC."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The 29 code points that Python treats as whitespace. Java's own \s
# knows six of them.
_SPACE_RANGES = [
    (0x09, 0x0D),
    (0x1C, 0x20),
    (0x85, 0x85),
    (0xA0, 0xA0),
    (0x1680, 0x1680),
    (0x2000, 0x200A),
    (0x2028, 0x2029),
    (0x202F, 0x202F),
    (0x205F, 0x205F),
    (0x3000, 0x3000),
]
# The same as the body of a Java character class, and as a class without the plain
# space. Visible ASCII characters leave that class at its first ranges.
WHITESPACE = "".join(rf"\x{{{lo:x}}}-\x{{{hi:x}}}" for lo, hi in _SPACE_RANGES)
ODD_SPACE = rf"[\x{{0}}-\x{{1f}}\x{{7f}}-\x{{10ffff}}&&[{WHITESPACE}]]"

# Ranges whose code points NFKC never changes, alone or next to each other. Text
# made only of these and of ASCII is already normalised, so it need not leave the
# JVM. The list may be incomplete (the rest is normalised in Python) but must
# never hold an unstable code point; tests/test_text.py checks every member.
NFKC_STABLE = (
    r"\x{80}-\x{9f}\xa1-\xa7\xa9\xab-\xae\xb0\xb1\xb6\xb7\xbb"  # Latin-1 signs
    r"\xbf-\x{131}\x{134}-\x{13e}\x{141}-\x{148}\x{14a}-\x{17e}\x{180}-\x{1c3}\x{1cd}-\x{1f0}"  # Latin
    r"\x{388}-\x{38a}\x{38e}-\x{3a1}\x{3a3}-\x{3cf}"  # Greek
    r"\x{400}-\x{482}\x{48a}-\x{52f}"  # Cyrillic
    r"\x{5d0}-\x{5ea}\x{621}-\x{64a}\x{660}-\x{66f}"  # Hebrew, Arabic
    r"\x{905}-\x{928}\x{e01}-\x{e32}\x{10d0}-\x{10fb}"  # Devanagari, Thai, Georgian
    r"\x{2010}\x{2012}-\x{2016}\x{2018}-\x{2023}"  # dashes and quotes
    r"\x{3001}-\x{3020}\x{3041}-\x{3096}\x{30a1}-\x{30fe}"  # Japanese
    r"\x{4e00}-\x{9fff}\x{ac00}-\x{d7a3}"  # Han, Hangul syllables
    r"\x{1f300}-\x{1f64f}\x{1f680}-\x{1f6d7}"  # emoji
)

# Testing for non-ASCII first spares plain characters the walk through all ranges.
NFKC_UNSTABLE = rf"[\x{{80}}-\x{{10ffff}}&&[^{NFKC_STABLE}]]"

# A run of letters, digits and underscores, or one other visible character. Nothing
# follows the run, so the plain quantifier takes all of it as a possessive one would,
# and Java walks it in a loop of its own instead of a match per character.
TOKEN = rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{WHITESPACE}]"


def _python_nfkc(text: Column) -> Column:
    # A local function is shipped by value, so workers need not have this package.
    @F.pandas_udf(StringType())
    def normalize(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda s: unicodedata.normalize("NFKC", s), na_action="ignore")

    return normalize(text)


def nfkc(text: Column) -> Column:
    """Unicode NFKC. Python sees only the rows that NFKC could change.

    ``when(unstable, udf(text))`` would still send every text across, so the
    condition sits inside the argument and stable rows travel as nulls.
    """
    unstable = F.when(text.rlike(NFKC_UNSTABLE), text)
    return F.coalesce(_python_nfkc(unstable), text)


def _plain_spaces(text: Column) -> Column:
    return F.regexp_replace(text, ODD_SPACE, " ")


def collapse_whitespace(text: Column) -> Column:
    """One space for each whitespace run, none at the ends.

    One pattern for odd whitespace and one for two plain spaces cost less than one
    over all kinds, and less than a character map, which looks up each character.
    """
    return F.trim(F.regexp_replace(_plain_spaces(text), "  +", " "))


def normalize_text(text: Column) -> Column:
    """NFKC, then whitespace collapse. Case and punctuation stay."""
    return collapse_whitespace(nfkc(text))


def has_content(text: Column) -> Column:
    """True when some character is not whitespace; stops at the first one."""
    return text.rlike(f"[^{WHITESPACE}]")


def char_length(text: Column) -> Column:
    """Code points, with null as empty."""
    return F.length(F.coalesce(text, F.lit(""))).cast("bigint")


def word_length(text: Column) -> Column:
    """Whitespace-separated words, with null and blank as zero."""
    words = collapse_whitespace(F.coalesce(text, F.lit("")))
    gaps = F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit("")))
    return (gaps + (words != "").cast("int")).cast("bigint")


def has_exclamation_or_question(text: Column) -> Column:
    return text.rlike("[!?]")


def has_non_ascii(text: Column) -> Column:
    return text.rlike(r"[^\x00-\x7F]")


def tokens(text: Column) -> Column:
    """Lower-cased word and punctuation tokens of the whole text."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def token_count(text: Column) -> Column:
    """Untruncated token count, with the two boundary tokens."""
    return (F.regexp_count(F.lower(text), F.lit(TOKEN)) + 2).cast("bigint")
