"""How the filters of a corpus act on each other, in every order they could be applied in.

A document's failures are a mask of one bit per filter. Whatever the order, its fate at every
step follows from the mask alone, so each mask is mapped to one wide integer that holds, side
by side, a field for each outcome of each step of each order. Adding such integers adds all
fields at once. Fields are as wide as a count can get, so none runs over into the next.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritally.session import store_table

FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_CAPITALS_PERCENT = 10
SYMBOLS = r"[#$%&*|]"

#: What is counted per step; each has a field of its own in a packed integer.
OUTCOMES = ("kept", "removed", "redundant", "unique_fails")
#: Counts are longs, so a sum of outcomes is below 2^63.
FIELD_BYTES = 8

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def text_failures(text: Column) -> list[Column]:
    """Whether a text (not null) fails the filters A to D, which look at nothing else."""
    spaced = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    words = F.array_remove(F.split(spaced, " "), "")
    n = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, _CAPITALS, ""))
    return [
        n < LEAST_WORDS,
        F.size(F.array_distinct(words)) * 100 < n * LEAST_DISTINCT_PERCENT,
        capitals * 100 > F.length(text) * MOST_CAPITALS_PERCENT,
        text.rlike(SYMBOLS),
    ]


def filter_masks(docs: DataFrame, *, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Per row of ``docs``: key, part and mask, whose bit i is set if the row fails filter i.

    Filters: A fewer than 100 words, B distinct words below 80 % of all, C capitals A-Z above 10 %
    of the code points, D any of ``#$%&*|``, E a text that a row with a smaller key has too.
    Null texts count as empty and a null part as the empty string. A null key is neither smaller
    nor larger than another; rows that share key and text don't fail E on each other's account.
    Other columns are ignored, whatever their names.

    Only digests move: their least keys are counted on the map side and come back by a merge
    join, which Spark splits where a text has many copies.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    bits = [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(text_failures(whole))]
    facts = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(part), F.lit("")).alias("part"),
        sum(bits[1:], bits[0]).cast("int").alias("mask"),
        F.unhex(F.sha2(whole, 256)).alias("digest"),
    )
    facts = store_table(facts, "filter_facts")
    first = facts.groupBy("digest").agg(F.min("key").alias("first"))
    later = F.coalesce(F.col("key") > F.col("first"), F.lit(False))
    mask = F.col("mask") + F.when(later, 1 << len(bits)).otherwise(0)
    return facts.join(first.hint("merge"), "digest").select("key", "part", mask.cast("int").alias("mask"))


def audit_filters(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    part: str = "lang",
    label_key: str = "doc_id",
    quality: str = "quality",
    toxic: str = "toxic",
) -> DataFrame:
    """One row per part, order of the filters and step; see :func:`filter_masks` for the filters.

    kept, removed and redundant (fails, but was removed before) count the part's documents at
    this step; unique_fails those that fail this step's filter only; good_lost and toxic_lost
    those removed here that a label calls good or toxic; shapley is what the filter removes, summed
    over all orders. Every part of ``docs`` has all rows, zeros included; no documents give
    no rows. A key with several labels is good if any says so, likewise toxic; documents
    without label and labels without document count for neither.
    """
    masks = filter_masks(docs, key=key, text=text, part=part)
    named = labels.select(
        F.col(label_key).alias("key"), (F.col(quality) == 1).alias("good"), (F.col(toxic) == 1).alias("toxic")
    )
    named = named.where("key IS NOT NULL").groupBy("key")
    judged = named.agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    flags = [F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")]
    rows = masks.join(judged.hint("merge"), "key", "left").select("part", "mask", *flags)
    counts = rows.groupBy("part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("part").applyInArrow(_audit, _SCHEMA)


# Packed integers ------------------------------------------------------------------


@lru_cache
def orders(filters: str = FILTERS) -> tuple[str, ...]:
    return tuple("".join(p) for p in permutations(filters))


def outcomes(mask: int, order: str, filters: str = FILTERS) -> list[tuple[int, int, int, int]]:
    """Per step of an order: kept, removed, redundant, unique_fails of a document with this mask."""
    found, gone = [], False
    for letter in order:
        fails = bool(mask >> filters.index(letter) & 1)
        alone = mask == 1 << filters.index(letter)
        found.append((int(not gone and not fails), int(fails and not gone), int(fails and gone), int(alone)))
        gone = gone or fails
    return found


@lru_cache
def packed(mask: int, filters: str = FILTERS) -> int:
    """One integer with a field per order, step and outcome, the first in the lowest bits."""
    fields = [x for order in orders(filters) for step in outcomes(mask, order, filters) for x in step]
    return int.from_bytes(np.array(fields, f"<u{FIELD_BYTES}").tobytes(), "little")


def unpacked(total: int, filters: str = FILTERS) -> np.ndarray:
    """Counts by order, step and outcome out of a sum of packed integers."""
    shape = (len(orders(filters)), len(filters), len(OUTCOMES))
    raw = total.to_bytes(int(np.prod(shape)) * FIELD_BYTES, "little")
    return np.frombuffer(raw, f"<u{FIELD_BYTES}").reshape(shape).astype(np.int64)


def _audit(counts: pa.Table) -> pa.Table:
    """All rows of one part; its group has one row per mask and label at most."""
    total = good = toxic = 0
    for row in counts.to_pylist():
        fields = row["n"] * packed(row["mask"])
        total += fields
        good += fields if row["good"] else 0
        toxic += fields if row["toxic"] else 0
    every = unpacked(total)
    removed = OUTCOMES.index("removed")
    lost = [unpacked(x)[..., removed].ravel() for x in (good, toxic)]
    letters = np.array([list(order) for order in orders()])
    share = {f: int(every[..., removed][letters == f].sum()) for f in FILTERS}
    n, steps = letters.size, len(FILTERS)
    columns = {
        "part": pa.array([counts["part"][0].as_py()] * n, pa.string()),
        "filter_order": pa.array(np.repeat(orders(), steps).tolist(), pa.string()),
        "step": pa.array(np.tile(np.arange(1, steps + 1, dtype=np.int32), len(letters))),
    }
    columns |= {name: pa.array(every[..., i].ravel()) for i, name in enumerate(OUTCOMES)}
    columns |= {"good_lost": pa.array(lost[0]), "toxic_lost": pa.array(lost[1])}
    columns["shapley"] = pa.array([share[f] for f in letters.ravel()], pa.int64())
    return pa.table(columns)
