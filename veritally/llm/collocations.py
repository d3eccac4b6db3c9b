"""Phrases whose words stand together more often than apart, by stripes.

A stripe belongs to a prefix and counts what comes next. Tasks build the stripes of their
texts, equal prefixes meet by a shuffle and their stripes are merged element by element. First come
prefixes of one word with the next word, then pairs with the next word and the next two: an
entry is the count of a phrase, which is also the total of a longer prefix, and the largest
entry that a phrase has as a prefix or as an ending decides whether a longer phrase subsumes it.

Words travel as 64-bit numbers that are checked to be different for all different words. A
phrase can't be frequent unless its words are and each two neighbours are, so tasks leave out what
a bit table of the frequent words, and then of the frequent pairs, rules out. That table has a fixed
size; where it is too small for a corpus, more goes through the shuffle and nothing is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritally.llm.words import Slice, mix, slices
from veritally.session import store_table

MOST_WORDS = 4
LEAST = 30
TOP = 2000
SCALE = 2_000_000
#: A phrase goes if a longer one that holds it is at least this frequent, in percent of it.
SUBSUMED_PERCENT = 80
UNKNOWN = "und"

SLICE = 1 << 20
#: Entries that a task gathers before it merges and sends them.
GATHERED = 1 << 20
#: Entries of one row. Stripes travel packed, those of a bucket of prefixes together.
ROW_ENTRIES = 64
#: Words of the corpus for each bucket, so that buckets have a size that doesn't grow with it.
BUCKET_WORDS = 1 << 16
#: Prefixes with this share of all words have their stripe cut in slots, which go to buckets of their
#: own; such words and such pairs are 1,000 at most.
HEAVY = 1000
#: The bit table of frequent phrases: 8 MB.
TABLE_BITS = 1 << 26
PROBES = 3

_U = np.uint64
_W = [f"w{i}" for i in range(1, MOST_WORDS + 1)]
_PHRASE = ", ".join(f"{c} long" for c in [*_W, "f"])

BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def collocations(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    top: int = TOP,
    most_words: int = MOST_WORDS,
) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its weakest cut, ``n`` all words of the
    language; the score is floor(2000000 a / (l + r)). Phrases of 2 to ``most_words`` words that
    occur ``least`` times are candidates; one that a longer candidate holds at 80 % of its
    count or more is dropped. Order: score and count descending, then the phrase by bytes.

    Null texts are empty and a null language is ``und``. Texts without words add nothing, rows
    that repeat count each time, other columns are ignored, and no texts give no rows.
    """
    words, levels = frequent_phrases(docs, text=text, lang=lang, least=least, most_words=most_words)
    candidates = weakest_cuts(levels)
    kept = not_subsumed(candidates, levels)
    named = spelled(kept, words)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("f").cast("long").alias("n"))
    rank = F.col("rank").cast("long").alias("rank")
    return first.join(totals.hint("merge"), "lang").select("lang", rank, "phrase", "a", "l", "r", "n", "score")


def frequent_phrases(
    docs: DataFrame, *, text: str, lang: str, least: int, most_words: int
) -> tuple[DataFrame, DataFrame]:
    """All words (lang, word, w1, f), and frequent phrases of 1 to ``most_words`` words (w1 ... , f)."""
    rows = docs.select(
        F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    words, seed = _word_table(rows)
    total = words.agg(F.sum("f")).first()[0] or 0
    level = words.where(F.col("f") >= least).select("w1", *_none(_W[1:]), "f")
    levels = [store_table(level, "phrases")]
    # Pairs, sifted by their words; then all longer phrases at once, sifted by their pairs.
    for known, sizes in ((1, (2,)), (2, tuple(range(3, most_words + 1)))):
        if known < most_words and sizes:
            shorter = levels[-1]
            table = (_bit_table(shorter, known), _heavy(shorter, known, total))
            shared = rows.sparkSession.sparkContext.broadcast(table)
            buckets = total // BUCKET_WORDS + 1
            stripes = rows.mapInArrow(_stripe_task(shared, known, sizes, seed, buckets), _stripe_schema(known, sizes))
            merged = stripes.repartition("bucket").sortWithinPartitions("bucket")
            levels.append(store_table(merged.mapInArrow(_merge_task(known, sizes, least), _PHRASE), "phrases"))
            shared.unpersist()
    return words, reduce(DataFrame.unionByName, levels)


def weakest_cuts(levels: DataFrame) -> DataFrame:
    """Per phrase of two words or more: w1 ..., a, and score, l and r of the lowest-scoring cut."""
    size = sum((F.col(w) != 0).cast("int") for w in _W)
    phrases = levels.where("w2 <> 0").withColumnRenamed("f", "a").withColumn("size", size)
    cut = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    zero = F.lit(0).cast("long")
    left = [F.when(F.col("k") > i, F.col(w)).otherwise(zero).alias(f"l{i}") for i, w in enumerate(_W)]
    padded = F.concat(F.array(*_W), F.array_repeat(zero, len(_W)))
    right = [F.element_at(padded, F.col("k") + 1 + i).alias(f"r{i}") for i in range(len(_W))]
    cut = cut.select(*_W, "a", "k", *left, *right)
    for side in "lr":
        part = levels.select(*[F.col(w).alias(f"{side}{i}") for i, w in enumerate(_W)], F.col("f").alias(side))
        cut = cut.join(part.hint("merge"), [f"{side}{i}" for i in range(len(_W))])
    wide = "cast({} as decimal(20, 0))"
    score = F.expr(f"({SCALE}BD * {wide.format('a')}) div ({wide.format('l')} + {wide.format('r')})")
    weakest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return cut.groupBy(*_W, "a").agg(weakest).select(*_W, "a", "cut.score", "cut.l", "cut.r")


def not_subsumed(candidates: DataFrame, levels: DataFrame) -> DataFrame:
    """Candidates without a longer phrase that holds them and is nearly as frequent.

    The phrases longer by one word are enough: whatever holds a phrase also holds one of
    these, which is at least as frequent.
    """
    longer = levels.where("w3 <> 0")
    last = [F.when(_next(i) != 0, F.col(w)).otherwise(0).cast("long").alias(w) for i, w in enumerate(_W)]
    shifted = [_next(i).cast("long").alias(w) for i, w in enumerate(_W)]
    inside = longer.select(*last, "f").unionByName(longer.select(*shifted, "f"))
    largest = inside.groupBy(*_W).agg(F.max("f").alias("longer"))
    wide = "cast({} as decimal(20, 0))"
    gone = F.expr(f"coalesce(100BD * {wide.format('longer')} >= {SUBSUMED_PERCENT}BD * {wide.format('a')}, false)")
    return candidates.join(largest.hint("merge"), _W, "left").where(~gone).drop("longer")


def spelled(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """Phrases with lang and phrase, their words joined by a space, instead of numbers."""
    at = F.posexplode(F.filter(F.array(*_W), lambda w: w != 0)).alias("at", "w")
    named = words.select(F.col("w1").alias("w"), "lang", "word")
    found = phrases.select(*_W, at).join(named.hint("merge"), "w")
    text = F.array_join(F.array_sort(F.collect_list(F.struct("at", "word")))["word"], " ")
    texts = found.groupBy(*_W).agg(F.first("lang").alias("lang"), text.alias("phrase"))
    return phrases.join(texts.hint("merge"), _W).drop(*_W)


def _next(i: int) -> Column:
    return F.col(_W[i + 1]) if i + 1 < len(_W) else F.lit(0)


def _none(names: list[str]) -> list[Column]:
    return [F.lit(0).cast("long").alias(n) for n in names]


def _word_table(rows: DataFrame) -> tuple[DataFrame, int]:
    """All words with their numbers and counts, and the seed under which no two share a number."""
    seed = 0
    while True:
        counted = rows.mapInArrow(_word_task(seed), "lang string, word string, w1 long, f long")
        words = store_table(counted.groupBy("lang", "word", "w1").agg(F.sum("f").alias("f")), "words")
        if words.groupBy("w1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            return words, seed
        seed += 1


def _bit_table(level: DataFrame, size: int) -> np.ndarray:
    """Bits of all phrases of a level. At most ``TABLE_BITS`` of them come to the driver."""
    bits = level.mapInArrow(_bit_task(size), "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    table = np.zeros(TABLE_BITS // 64, _U)
    found = bits.toArrow()
    table[found["at"].to_numpy()] = found["bits"].to_numpy().view(_U)
    return table


def _heavy(level: DataFrame, size: int, total: int) -> dict[int, int]:
    """Slots of the prefixes that have a share of all words; there are ``HEAVY`` at most."""
    rows = level.where(F.col("f") * HEAVY >= F.lit(total)).select(*_W[:size], "f").toArrow()
    hashed = gram_hashes([rows[w].to_numpy() for w in _W[:size]])
    return {int(h): f * HEAVY // max(total, 1) + 1 for h, f in zip(hashed, rows["f"].to_pylist())}


# Tasks --------------------------------------------------------------------------


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


@lru_cache
def _powers(n: int, inverse: bool) -> np.ndarray:
    base = 0x9E3779B97F4A7C15
    with np.errstate(over="ignore"):
        found = np.full(n, pow(base, -1, 1 << 64) if inverse else base, _U)
        found[:1] = 1
        return np.multiply.accumulate(found)


def _range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of byte ranges; another seed gives another value to each byte."""
    size = max(SLICE, 1 << len(data).bit_length())
    values = mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93) + _U(seed * 0x2545F4914F6CDD1D % (1 << 64)))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, _U)
        np.cumsum(values[data] * _powers(size, False)[: len(data)], out=sums[1:])
        h = (sums[ends] - sums[starts]) * _powers(size, True)[starts]
        return mix(h + (ends - starts).astype(_U) * _U(0xA0761D6478BD642F))


def _language_numbers(langs: pa.Array, seed: int) -> np.ndarray:
    names = [hashlib.blake2b(f"{seed}:{x}".encode(), digest_size=8).digest() for x in langs.to_pylist()]
    return np.frombuffer(b"".join(names), _U)


class Words:
    """Words of a slice: byte ranges, text, number, and whether the next one is in the same piece."""

    def __init__(self, part: Slice, langs: pa.Array, seed: int):
        self.data = LOWER[part.data]
        breaks = BREAK[self.data]
        solid = ~(breaks | BLANK[self.data])
        edge = np.zeros(len(solid) + 1, bool)
        edge[part.edges] = True
        first, last = solid.copy(), solid.copy()
        first[1:] &= ~solid[:-1] | edge[1:-1]
        last[:-1] &= ~solid[1:] | edge[1:-1]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.text = np.searchsorted(part.edges, self.starts, "right") - 1
        before = np.r_[0, np.cumsum(breaks)]
        self.follows = np.zeros(len(self.starts), bool)
        if len(self.starts):
            same = self.text[1:] == self.text[:-1]
            self.follows[:-1] = same & (before[self.starts[1:]] == before[self.ends[:-1]])
        named = langs.dictionary_encode()
        mine = named.indices.to_numpy()[self.text]
        numbers = _language_numbers(named.dictionary, seed)
        self.lang, self.names = mine, named.dictionary.to_pylist()
        with np.errstate(over="ignore"):
            here = _range_hashes(self.data, self.starts, self.ends, seed)
            self.numbers = mix(here ^ numbers[mine]) if len(mine) else here
        self.numbers[self.numbers == 0] = 1


def gram_hashes(columns: list[np.ndarray]) -> np.ndarray:
    """One hash per row of several columns of word numbers."""
    with np.errstate(over="ignore"):
        found = mix(columns[0].view(_U))
        for column in columns[1:]:
            found = mix(found * _U(0xC2B2AE3D27D4EB4F) + column.view(_U))
    return found


def _probes(hashed: np.ndarray) -> Iterator[np.ndarray]:
    step = mix(hashed ^ _U(0x5851F42D4C957F2D)) | _U(1)
    for i in range(PROBES):
        with np.errstate(over="ignore"):
            yield (hashed + _U(i) * step) % _U(TABLE_BITS)


def _holds(table: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    found = np.ones(len(hashed), bool)
    for bit in _probes(hashed):
        found &= (table[bit >> _U(6)] >> (bit & _U(63)) & _U(1)).astype(bool)
    return found


def _bit_task(size: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashed = gram_hashes([_column(batch, w).to_numpy() for w in _W[:size]])
            bits = np.unique(np.concatenate(list(_probes(hashed)) or [np.empty(0, _U)]))
            at, first = np.unique(bits >> _U(6), return_index=True)
            if len(at):
                joined = np.bitwise_or.reduceat(_U(1) << (bits & _U(63)), first)
                yield pa.record_batch({"at": at.view(np.int64), "bits": joined.view(np.int64)})

    return task


def _word_task(seed: int):
    """Distinct words of a slice. A second number tells words apart that share the first."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = _column(batch, "lang")
            for part in slices(_column(batch, "text"), SLICE):
                found = Words(part, langs.slice(part.rows.start, len(part.rows)), seed)
                if len(found.starts) == 0:
                    continue
                other = _range_hashes(found.data, found.starts, found.ends, seed + (1 << 32))
                order = np.lexsort((other, found.lang, found.numbers))
                (heads,) = _heads(found.numbers[order], found.lang[order], other[order])
                first = order[heads]
                raw = found.data.tobytes()
                words = [raw[a:b] for a, b in zip(found.starts[first].tolist(), found.ends[first].tolist())]
                yield pa.record_batch(
                    {
                        "lang": pa.array([found.names[i] for i in found.lang[first].tolist()], pa.string()),
                        "word": pa.array(words, pa.binary()).cast(pa.string()),
                        "w1": found.numbers[first].view(np.int64),
                        "f": np.diff(np.r_[heads, len(order)]),
                    }
                )

    return task


def _heads(*columns: np.ndarray) -> tuple[np.ndarray]:
    """First rows of the runs of equal rows."""
    n = len(columns[0])
    new = np.ones(n, bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return (np.flatnonzero(new),)


def _summed(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows in order, and the sums of their counts."""
    if len(counts) == 0:
        return columns, counts
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    (heads,) = _heads(*columns)
    return [c[heads] for c in columns], np.add.reduceat(counts[order], heads)


def _next_columns(known: int, sizes: tuple[int, ...]) -> list[str]:
    """What comes after a prefix, word by word; 0 behind the last word of a phrase."""
    return [f"next{i + 1}" for i in range(max(sizes) - known)]


def _stripe_schema(known: int, sizes: tuple[int, ...]) -> str:
    """The bucket, and per entry of its stripes the prefix, what comes next, and the count."""
    entries = [*_W[:known], *_next_columns(known, sizes), "counts"]
    return ", ".join(["bucket long"] + [f"{c} array<long>" for c in entries])


def _stripe_task(shared, known: int, sizes: tuple[int, ...], seed: int, buckets: int):
    """Stripes of the phrases of these sizes, merged over the slices of a task in portions.

    Prefixes have ``known`` words, and so have the phrases of the bit table. All parts of a phrase
    of that length must be in it.
    """

    def phrases(found: Words, table: np.ndarray) -> list[np.ndarray]:
        n, numbers = len(found.starts), found.numbers.view(np.int64)
        at = np.arange(max(0, n - known + 1))
        sifted = np.zeros(n + max(sizes), bool)
        sifted[: len(at)] = _holds(table, gram_hashes([numbers[at + i] for i in range(known)]))
        rows = []
        for size in sizes:
            at = np.arange(max(0, n - size + 1))
            for i in range(size - 1):
                at = at[found.follows[at + i]]
            for i in range(size - known + 1):
                at = at[sifted[at + i]]
            rows.append([numbers[at + i] if i < size else np.zeros(len(at), np.int64) for i in range(max(sizes))])
        return [np.concatenate(c) for c in zip(*rows)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, heavy = shared.value
        names = np.array(sorted(heavy), _U)
        slots = np.array([heavy[h] for h in sorted(heavy)], _U)
        gathered: list[list[np.ndarray]] = []
        for batch in batches:
            langs = _column(batch, "lang")
            for part in slices(_column(batch, "text"), SLICE):
                mine = langs.slice(part.rows.start, len(part.rows))
                gathered.append(phrases(Words(part, mine, seed), table))
                if sum(len(g[0]) for g in gathered) >= GATHERED:
                    yield from _stripes(gathered, known, names, slots, buckets)
                    gathered = []
        if gathered:
            yield from _stripes(gathered, known, names, slots, buckets)

    return task


def _stripes(
    gathered: list, known: int, names: np.ndarray, slots: np.ndarray, buckets: int
) -> Iterator[pa.RecordBatch]:
    """Stripes of gathered phrases, packed by bucket. Slots of heavy prefixes follow from the next word."""
    columns = [np.concatenate(c) for c in zip(*gathered)]
    if len(columns[0]) == 0:
        return
    hashed = gram_hashes(columns[:known])
    if len(names):
        at = np.minimum(np.searchsorted(names, hashed), len(names) - 1)
        cut = names[at] == hashed
        slot = mix(columns[known][cut].view(_U)) % slots[at[cut]]
        with np.errstate(over="ignore"):
            hashed[cut] = mix(hashed[cut] + slot * _U(0x9E3779B97F4A7C15))
    bucket = (hashed % _U(buckets)).astype(np.int64)
    (bucket, *entries), counts = _summed([bucket, *columns], np.ones(len(bucket), np.int64))
    (heads,) = _heads(bucket)
    place = np.arange(len(counts)) - np.repeat(heads, np.diff(np.r_[heads, len(counts)]))
    rows = np.flatnonzero(place % ROW_ENTRIES == 0)
    offsets = pa.array(np.r_[rows, len(counts)].astype(np.int32))
    batch = {"bucket": bucket[rows]}
    for i, values in enumerate([*entries, counts]):
        name = _W[i] if i < known else f"next{i - known + 1}" if i < len(entries) else "counts"
        batch[name] = pa.ListArray.from_arrays(offsets, pa.array(values))
    yield pa.record_batch(batch)


def _merge_task(known: int, sizes: tuple[int, ...], least: int):
    """Elementwise sums of the stripes of a bucket, which come one after another; frequent entries."""
    names = [*_W[:known], *_next_columns(known, sizes)]

    def frequent(keys: list[np.ndarray], counts: np.ndarray) -> pa.RecordBatch:
        kept = counts >= least
        words = [k[kept] for k in keys[1:]]
        words += [np.zeros(int(kept.sum()), np.int64)] * (len(_W) - len(words))
        return pa.record_batch(dict(zip(_W, words)) | {"f": counts[kept]})

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            lengths = _column(batch, "counts").value_lengths().to_numpy()
            keys = [np.repeat(_column(batch, "bucket").to_numpy(), lengths)]
            keys += [_column(batch, c).flatten().to_numpy() for c in names]
            sums = _column(batch, "counts").flatten().to_numpy()
            if held:
                keys = [np.concatenate(pair) for pair in zip(held[0], keys)]
                sums = np.concatenate([held[1], sums])
            done = keys[0] != keys[0][-1]
            if done.any():
                yield frequent(*_summed([k[done] for k in keys], sums[done]))
            held = _summed([k[~done] for k in keys], sums[~done])
        if held:
            yield frequent(*held)

    return task
