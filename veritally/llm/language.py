"""Language identification by a byte convolutional network.

Bytes of a fixed-length window are embedded, filters of several widths slide over them, each
filter keeps its maximum, and a softmax tells the language. The network is
trained in numpy on a bounded sample of labelled texts. To apply it, embedding and filters
are multiplied out into tables per byte pair, so a window costs a few lookups per byte.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritally.llm.words import Slice, slices
from veritally.session import store_table

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
UNKNOWN = "und"
SAMPLE_PER_LANGUAGE = 400
SAMPLE_WINDOWS = 6
BUCKET_BITS = 16
STEPS = 500
BATCH = 64
WINDOWS_AT_ONCE = 64


@dataclass
class ByteNetwork:
    """Weights: embedding (256, d), per width filters (w, d, f), output (all f, languages)."""

    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    output: np.ndarray
    output_bias: np.ndarray

    def tables(self) -> PairTables:
        by_byte = [np.einsum("bd,wdf->wbf", self.embedding, f) for f in self.filters]
        pair = [
            (t[0][:, None, :] + t[1][None, :, :]).reshape(65536, -1) for t in by_byte
        ]
        tail = (by_byte[2][2][:, None, :] + by_byte[2][3][None, :, :]).reshape(65536, -1)
        return PairTables(
            self.languages,
            np.concatenate(pair, axis=1).astype(np.float32),
            by_byte[1][2].astype(np.float32),
            tail.astype(np.float32),
            self.bias,
            self.output,
            self.output_bias,
        )


@dataclass
class PairTables:
    """The network multiplied out: what a byte pair adds to each filter."""

    languages: list[str]
    head: np.ndarray
    third: np.ndarray
    tail: np.ndarray
    bias: np.ndarray
    output: np.ndarray
    output_bias: np.ndarray

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Softmax per window; windows is (n, WINDOW) of bytes, zero where the text has ended."""
        n, f = len(windows), self.third.shape[1]
        found = np.empty((n, 3 * f), np.float32)
        for at in range(0, n, WINDOWS_AT_ONCE):
            part = windows[at : at + WINDOWS_AT_ONCE]
            pairs = part[:, :-1].astype(np.uint16) << 8 | part[:, 1:]
            head = self.head[pairs]
            here = found[at : at + len(part)]
            head[:, :, :f].max(axis=1, out=here[:, :f])
            (head[:, :-1, f : 2 * f] + self.third[part[:, 2:]]).max(axis=1, out=here[:, f : 2 * f])
            (head[:, :-2, 2 * f :] + self.tail[pairs[:, 2:]]).max(axis=1, out=here[:, 2 * f :])
        return _softmax(np.maximum(found + self.bias, 0) @ self.output + self.output_bias)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: list[bytes], labels: list[str], seed: int = 7, steps: int = STEPS) -> ByteNetwork:
    """Train on labelled windows of at most WINDOW bytes; languages are drawn equally often."""
    languages = sorted(set(labels))
    random = np.random.default_rng(seed)
    x = np.frombuffer(b"".join(w.ljust(WINDOW, b"\0") for w in windows), np.uint8).reshape(-1, WINDOW)
    y = np.array([languages.index(label) for label in labels])
    by_language = [np.flatnonzero(y == i) for i in range(len(languages))]
    f, d = FILTERS, EMBEDDING
    weights = {
        "embedding": random.normal(0, 0.5, (256, d)),
        "bias": np.zeros(f * len(WIDTHS)),
        "output": random.normal(0, 0.1, (f * len(WIDTHS), len(languages))),
        "output_bias": np.zeros(len(languages)),
    } | {f"filter{w}": random.normal(0, (w * d) ** -0.5, (w, d, f)) for w in WIDTHS}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in weights.items()}
    for step in range(1, steps + 1):
        turn = random.integers(0, len(languages), BATCH)
        rows = np.array([by_language[i][random.integers(len(by_language[i]))] for i in turn])
        grads = _gradients(weights, x[rows], y[rows])
        rate = 0.01 * (1 - 0.9 * step / steps)
        for name, g in grads.items():
            m, v = moments[name]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            weights[name] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return ByteNetwork(
        languages,
        weights["embedding"],
        [weights[f"filter{w}"] for w in WIDTHS],
        weights["bias"],
        weights["output"],
        weights["output_bias"],
    )


def _gradients(weights: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Cross-entropy gradients; of a filter only the place of its maximum has one."""
    n, f = len(x), FILTERS
    embedded = weights["embedding"][x]
    places, pooled = [], []
    for w in WIDTHS:
        length = x.shape[1] - w + 1
        score = sum(embedded[:, j : j + length] @ weights[f"filter{w}"][j] for j in range(w))
        places.append(score.argmax(axis=1))
        pooled.append(score.max(axis=1))
    before = np.concatenate(pooled, axis=1) + weights["bias"]
    hidden = np.maximum(before, 0)
    error = _softmax(hidden @ weights["output"] + weights["output_bias"])
    error[np.arange(n), y] -= 1
    error /= n
    back = (error @ weights["output"].T) * (before > 0)
    grads = {
        "output": hidden.T @ error,
        "output_bias": error.sum(axis=0),
        "bias": back.sum(axis=0),
        "embedding": np.zeros_like(weights["embedding"]),
    }
    for i, w in enumerate(WIDTHS):
        mine = back[:, i * f : (i + 1) * f]
        grad = np.empty_like(weights[f"filter{w}"])
        for j in range(w):
            seen = x[np.arange(n)[:, None], places[i] + j]
            grad[j] = np.einsum("nfd,nf->df", weights["embedding"][seen], mine)
            np.add.at(
                grads["embedding"], seen, mine[:, :, None] * weights[f"filter{w}"][j].T[None]
            )
        grads[f"filter{w}"] = grad
    return grads


def cut_windows(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in windows of WINDOW bytes, the last padded with zeros: windows, text, bytes used."""
    size = np.diff(edges)
    count = -(-size // WINDOW)
    text = np.repeat(np.arange(len(size)), count)
    begin = (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * WINDOW
    used = np.minimum(size[text] - begin, WINDOW)
    index = (edges[:-1][text] + begin)[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < used[:, None]
    windows = np.where(inside, data[np.minimum(index, max(len(data) - 1, 0))], 0) if len(data) else None
    if windows is None:
        windows = np.zeros((0, WINDOW), np.uint8)
    return windows.astype(np.uint8), text, used


def is_held_out(key) -> F.Column:
    """Whether a key is kept from training; a null key, which never trains, isn't held out."""
    return F.coalesce((F.crc32(F.col(key).cast("string").cast("binary")) % 5) == 0, F.lit(False))


def labelled_sample(
    docs: DataFrame, key: str, text: str, label: str, per_language: int = SAMPLE_PER_LANGUAGE
) -> list[tuple[bytes, str]]:
    """Windows of at most ``per_language`` labelled texts of each language, with the language.

    Of each text at most SAMPLE_WINDOWS windows are drawn, from the whole of it, where it is read; only
    windows reach the driver. Held-out keys, null keys, null labels and texts without
    letters are never picked. Which rows are picked follows a hash of the key, so it doesn't
    depend on the order of rows: rows are counted in buckets of the hash, and only the
    buckets that hold the first ``per_language`` are ranked.
    """
    usable = F.col(key).isNotNull() & F.col(label).isNotNull() & ~is_held_out(key) & F.col(text).rlike(r"\p{L}")
    fit = docs.where(usable).select(
        F.col(key).alias("key"), F.col(label).cast("string").alias("label"), F.col(text).alias("text")
    )
    draw = F.xxhash64(F.lit("sample"), F.col("key"))
    drawn = fit.select("key", "label", draw.alias("draw"), F.shiftrightunsigned(draw, 64 - BUCKET_BITS).alias("bucket"))
    upto = Window.partitionBy("label").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = drawn.groupBy("label", "bucket").agg(F.count(F.lit(1)).alias("n"))
    first = counts.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    last = first.where(F.col("before") < per_language).groupBy("label").agg(F.max("bucket").alias("last"))
    turn = F.row_number().over(Window.partitionBy("label").orderBy("draw", "key"))
    # One row per language, each of which is an output of the network anyway. What lies beyond the
    # last bucket is left out where it is read, so that few rows of a language meet to be ranked.
    near = drawn.join(F.broadcast(last), "label").where(F.col("bucket") <= F.col("last")).withColumn("turn", turn)
    picked = store_table(near.where(F.col("turn") <= per_language).select("key", "label").distinct(), "language_sample")
    # As many rows as languages times the sample of one, all of which the driver holds anyway.
    rows = fit.join(F.broadcast(picked), ["key", "label"])
    sample = rows.mapInArrow(_sample_task, "key string, label string, windows array<binary>")
    found = sample.orderBy("label", "key", "windows").collect()
    return [(bytes(w), r.label) for r in found for w in r.windows]


def _sample_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of a text, picked by a random sequence of its own bytes."""
    for batch in batches:
        texts, picked = batch.column("text"), []
        for part in slices(texts):
            windows, text, used = cut_windows(part.data, part.edges)
            first = np.searchsorted(text, np.arange(len(part.rows) + 1))
            for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
                body = part.data[part.edges[i] : part.edges[i + 1]].tobytes()
                random = np.random.default_rng(zlib.crc32(body))
                at = np.sort(random.choice(b - a, min(SAMPLE_WINDOWS, b - a), replace=False)) + a
                picked.append([windows[j, : used[j]].tobytes() for j in at])
        yield pa.record_batch(
            {
                "key": batch.column("key").cast(pa.string()),
                "label": batch.column("label"),
                "windows": pa.array(picked, pa.list_(pa.binary())),
            }
        )


def train_on(docs: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "lang") -> ByteNetwork | None:
    """The network for the languages of the documents that aren't held out; None without any."""
    sample = labelled_sample(docs, key, text, label)
    if not sample:
        return None
    return train([window for window, _ in sample], [label for _, label in sample])


def identify(
    docs: DataFrame, network: ByteNetwork | None, *, key: str = "doc_id", text: str = "text", keep: bool = False
) -> DataFrame:
    """Per row of ``docs``: key (or, with ``keep``, the row as ``row``), lang_pred and score.

    All windows of a text vote with their probabilities, weighted by the bytes they hold; the
    score is the mean for the winner, ties go to the first language by code point. A
    null text, one without letters, and any text without a network are ``und`` with score 1.
    Only the text decides. Null and repeated keys are passed through, and so are other columns
    if they are kept, whatever their names.
    """
    row = F.struct(*docs.columns).alias("row") if keep else F.struct(key).alias("row")
    known = F.col(text).rlike(r"\p{L}") if network else F.lit(False)
    rows = docs.select(row, F.when(known, F.col(text)).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    tables = docs.sparkSession.sparkContext.broadcast(network.tables() if network else None)
    found = rows.mapInArrow(_identify_task(tables), f"row {kind}, lang_pred string, score double")
    return found if keep else found.select(f"row.{key}", "lang_pred", "score")


def _identify_task(tables):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts = batch.column(0), batch.column(1)
            for part in slices(texts):
                mine = rows.slice(part.rows.start, len(part.rows))
                yield pa.record_batch([mine, *_vote(part, tables.value)], ["row", "lang_pred", "score"])

    return task


def _vote(part: Slice, tables: PairTables | None) -> tuple[pa.Array, pa.Array]:
    n = len(part.rows)
    windows, text, used = cut_windows(part.data, part.edges)
    if len(windows) == 0 or tables is None:
        return pa.array([UNKNOWN] * n, pa.string()), pa.array([1.0] * n, pa.float64())
    votes = tables.probabilities(windows) * used[:, None]
    first = np.searchsorted(text, np.arange(n))
    full = np.diff(part.edges) > 0
    mean = np.zeros((n, votes.shape[1]))
    mean[full] = np.add.reduceat(votes, first[full], axis=0) / np.diff(part.edges)[full][:, None]
    best = mean.argmax(axis=1)
    names = [tables.languages[b] if f else UNKNOWN for b, f in zip(best, full)]
    score = np.where(full, np.clip(mean[np.arange(n), best], 0.0, 1.0), 1.0)
    return pa.array(names, pa.string()), pa.array(score, pa.float64())
