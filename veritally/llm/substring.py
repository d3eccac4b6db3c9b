"""Substring dedup by relative Lempel-Ziv parsing.

The reference is the corpus itself, indexed in blocks: a block holds all places where the
same anchor stands. Anchors are word n-grams picked by content (the least hash in a window),
so every window of ``window`` words has exactly one and equal windows have the same.
The windows of one anchor place form a reach: a stretch of at most ``2 * window`` words.

Parsing goes from anchor to anchor. A whole reach that also stands elsewhere is
taken at once, and neighbouring ones with the same source join into factors. Where
the parse breaks, at a reach whose anchor stands elsewhere but not the whole of it, every
window is checked against all reaches of its block. Both steps compare hashes of word
sequences and are counted on the map side, so a passage that a third of the
corpus shares is no larger than any other after it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritally.llm.words import (
    SPACE,
    Sequences,
    Slice,
    Words,
    find_words,
    hash_ranges,
    slices,
    sliding_min,
)
from veritally.session import store_table

WINDOW = 35
ANCHOR = 8
_POSITION_BITS = 24
_REACH = "anchor long, reach long, row long, start int, n int"
_WINDOWS = "anchor long, words long, row long, start int, once boolean"


def repeated_spans(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    anchor: int = ANCHOR,
) -> DataFrame:
    """Spans of words covered by repeated windows: row, start, n (words), source_row, source_start.

    ``row`` is the key, or a hash of the text where the key is null. Spans of a row
    may overlap. ``source_*`` is another place with the same words, null for spans that were
    checked window by window. A key belongs to one text; rows that repeat as a whole are copies
    of each other. Null, empty and short texts have no spans, and other columns are ignored.
    """
    rows = _rows(docs, key, text)
    reaches = rows.mapInArrow(_reach_task(window, anchor), _REACH)
    known = reaches.groupBy("anchor").agg(F.count(F.lit(1)).alias("places")).where("places > 1")
    shared = store_table(reaches.join(known.select("anchor").hint("merge"), "anchor"), "reaches")
    place = F.struct("row", "start")
    texts = shared.groupBy("anchor", "reach").agg(
        F.count(F.lit(1)).alias("places"),
        F.min(place).alias("first"),
        F.max(place).alias("last"),
        F.first("n").alias("n"),
    )
    texts = store_table(texts, "reach_texts")
    whole = shared.join(
        texts.where("places > 1").select("anchor", "reach", "first", "last"), ["anchor", "reach"]
    )
    source = F.when(F.col("first") == place, F.col("last")).otherwise(F.col("first"))
    factors = whole.select(
        "row",
        "start",
        (F.col("n") + (window - 1)).alias("n"),
        source["row"].alias("source_row"),
        source["start"].alias("source_start"),
    )
    checked = _boundary_windows(rows, texts, window).select(
        "row",
        "start",
        F.lit(window).alias("n"),
        F.lit(None).cast("long").alias("source_row"),
        F.lit(None).cast("int").alias("source_start"),
    )
    return factors.unionByName(checked)


def _boundary_windows(rows: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """Repeated windows of reaches that stand once, in blocks with several reaches."""
    blocks = texts.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("kinds"), F.min("places").alias("fewest")
    )
    open_blocks = blocks.where("kinds > 1 AND fewest = 1").select("anchor")
    probes = texts.join(open_blocks, "anchor").select(
        F.col("first.row").alias("row"),
        F.struct("first.start", "n", "anchor", (F.col("places") == 1).alias("once")).alias("probe"),
    )
    lists = probes.groupBy("row").agg(F.collect_list("probe").alias("probes"))
    hashed = store_table(
        rows.join(lists.hint("merge"), "row").mapInArrow(_window_task(window), _WINDOWS), "reach_windows"
    )
    counted = hashed.groupBy("anchor", "words").agg(F.count(F.lit(1)).alias("places"))
    repeated = counted.where("places > 1").select("anchor", "words")
    return hashed.where("once").join(repeated, ["anchor", "words"]).select("row", "start")


def remove_repeated(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    anchor: int = ANCHOR,
) -> DataFrame:
    """Per row of ``docs``: key, n_words, n_removed, kept_text (words joined by one space).

    Words are runs of characters other than ASCII white space. Each word covered by a
    window of ``window`` words that also starts elsewhere, in the same text or another, is
    removed; all windows are judged on the input. See :func:`repeated_spans` for odd rows;
    a null text gives 0 words and an empty text.
    """
    spans = repeated_spans(docs, key=key, text=text, window=window, anchor=anchor)
    lists = spans.groupBy("row").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    rows = _rows(docs, key, text, keep=True).join(lists.hint("merge"), "row", "left")
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(
        _removal_task(), f"key {kind}, n_words long, n_removed long, kept_text string"
    ).withColumnRenamed("key", key)


def _rows(docs: DataFrame, key: str, text: str, keep: bool = False) -> DataFrame:
    row = F.coalesce(F.col(key).cast("long"), F.xxhash64(F.col(text)))
    kept = [F.col(key).alias("key")] if keep else []
    return docs.select(row.alias("row"), *kept, F.col(text).alias("text"))


# Tasks --------------------------------------------------------------------------


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _hashed(part: Slice) -> tuple[Words, np.ndarray]:
    words = find_words(part)
    return words, hash_ranges(part.data, words.starts, words.ends)


def _reach_task(window: int, anchor: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _column(batch, "row").to_numpy()
            for part in slices(_column(batch, "text")):
                words, hashes = _hashed(part)
                found = reaches_of(words, hashes, window, anchor)
                if len(found[0]):
                    yield _batch(keys[part.rows.start : part.rows.stop], *found)

    return task


def reaches_of(
    words: Words, hashes: np.ndarray, window: int, anchor: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Reaches of a slice: anchor, hash of all words, text, first word in it, windows.

    The anchor of a window is its least n-gram, the last of equals. Gram hash and
    position share one number, so one sliding minimum finds both.
    """
    sequences = Sequences(hashes)
    grams = sequences.grams(anchor)
    low = np.uint64((1 << _POSITION_BITS) - 1)
    position = np.arange(len(grams), dtype=np.uint64)
    least = sliding_min((grams & ~low) | (low - (position & low)), window - anchor + 1)
    valid = np.zeros(len(least), bool)
    for i in np.flatnonzero(np.diff(words.edges) >= window):
        valid[words.edges[i] : words.edges[i + 1] - window + 1] = True
    at = np.flatnonzero(valid)
    if len(at) == 0:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty, empty
    mine = least[at]
    begins = np.flatnonzero(np.r_[True, (mine[1:] != mine[:-1]) | (at[1:] != at[:-1] + 1)])
    first = at[begins]
    count = np.diff(np.r_[begins, len(at)])
    offset = (low - (mine[begins] & low)).astype(np.int64)
    gram = first + ((offset - first) & int(low))
    reach = sequences.of(first, first + count + window - 1)
    doc = np.searchsorted(words.edges, first, "right") - 1
    return grams[gram].view(np.int64), reach.view(np.int64), doc, first - words.edges[doc], count


def _batch(keys, anchors, reaches, doc, start, count) -> pa.RecordBatch:
    return pa.record_batch(
        {
            "anchor": anchors,
            "reach": reaches,
            "row": keys[doc],
            "start": start.astype(np.int32),
            "n": count.astype(np.int32),
        }
    )


def _window_task(window: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _column(batch, "row").to_numpy()
            lists = _column(batch, "probes")
            for part in slices(_column(batch, "text")):
                words, hashes = _hashed(part)
                mine = lists.slice(part.rows.start, len(part.rows))
                doc = np.repeat(np.arange(len(mine)), mine.value_lengths().to_numpy())
                probes = mine.flatten()
                start, n, anchor, once = (probes.field(i).to_numpy(False) for i in range(4))
                which = np.repeat(np.arange(len(n)), n)
                step = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
                local = start[which] + step
                at = words.edges[doc[which]] + local
                fits = at + window <= words.edges[doc[which] + 1]
                which, local, at = which[fits], local[fits], at[fits]
                yield pa.record_batch(
                    {
                        "anchor": anchor[which],
                        "words": Sequences(hashes).of(at, at + window).view(np.int64),
                        "row": keys[part.rows.start : part.rows.stop][doc[which]],
                        "start": local.astype(np.int32),
                        "once": once[which].astype(bool),
                    }
                )

    return task


def _removal_task():
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lists = _column(batch, "key"), _column(batch, "spans")
            for part in slices(_column(batch, "text")):
                words = find_words(part)
                mine = lists.slice(part.rows.start, len(part.rows))
                lengths = mine.value_lengths().fill_null(0).to_numpy()
                doc = np.repeat(np.arange(len(mine)), lengths)
                spans = mine.flatten()
                start, n = spans.field(0).to_numpy(), spans.field(1).to_numpy()
                base, limit = words.edges[doc], words.edges[doc + 1]
                change = np.zeros(len(words.starts) + 1, np.int64)
                np.add.at(change, np.minimum(base + start, limit), 1)
                np.add.at(change, np.minimum(base + start + n, limit), -1)
                removed = np.cumsum(change[:-1]) > 0
                count = np.r_[0, np.cumsum(removed)]
                yield pa.record_batch(
                    {
                        "key": keys.slice(part.rows.start, len(part.rows)),
                        "n_words": np.diff(words.edges),
                        "n_removed": count[words.edges[1:]] - count[words.edges[:-1]],
                        "kept_text": pa.array(
                            kept_texts(part, words, ~removed), pa.string()
                        ),
                    }
                )

    return task


def kept_texts(part: Slice, words: Words, kept: np.ndarray) -> list[bytes]:
    """Per text the kept words, joined by one space."""
    inside = np.zeros(len(part.data) + 1, np.int8)
    starts, ends = words.starts[kept], words.ends[kept]
    inside[starts] += 1
    inside[ends] -= 1
    body = np.cumsum(inside[:-1]).astype(bool)
    tail = ends[ends < len(part.data)]
    tail = tail[SPACE[part.data[tail]]]
    body[tail] = True
    data = np.where(SPACE[part.data], np.uint8(0x20), part.data)[body]
    length = np.r_[0, np.cumsum(body)][part.edges]
    joined = data.tobytes()
    return [joined[a:b].rstrip(b" ") for a, b in zip(length[:-1], length[1:])]
