"""BPE encoding through a table of distinct words, and decoding through a table of pieces.

Words are split and counted in Spark. The most frequent ones, a fixed number, are encoded
once and broadcast. Every other distinct word meets its other places in one partition (a long word
in several), is encoded once there, and its ids go back to the document and the position. Texts
themselves are never shuffled: documents travel as compressed word codes with holes.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritally.llm.words import Slice, hash_ranges, slices
from veritally.session import store_table

FREQUENT = 1 << 19
LONGEST_FREQUENT = 64
LEAST_IN_SLICE = 2

# Byte classes of the fast path: ASCII and the letters of U+00C0..U+00FF.
_BLANK, _LETTER, _DIGIT, _OTHER = range(4)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = _BLANK
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = _CLASS[0x80:] = _LETTER
_CLASS[0x30:0x3A] = _DIGIT
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_RARE_BYTE = np.zeros(256, bool)
_RARE_BYTE[0xC0:] = True
_RARE_BYTE[0xC3] = False
_RARE_BYTE[0x27] = True

_HOLE = np.uint32(0xFFFFFFFF)


@dataclass
class Tokenizer:
    """A tokenizer file, opened once per process; only its path is sent to tasks."""

    path: str
    _opened: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {"path": self.path, "_opened": None}

    @property
    def library(self):
        if self._opened is None:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores
            from tokenizers import Tokenizer as Library

            self._opened = Library.from_file(self.path)
            self._opened.no_truncation()
            self._opened.no_padding()
        return self._opened

    @property
    def special(self) -> dict[str, int]:
        tokens = self.library.get_added_tokens_decoder()
        return {token.content: number for number, token in tokens.items()}

    def encode_words(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch(words, add_special_tokens=False)]

    def split(self, text: str) -> list[str | int]:
        """Words of any text, as the library itself splits it; special tokens as ids."""
        special = self.special
        parts = re.split("(" + "|".join(map(re.escape, special)) + ")", text) if special else [text]
        found: list[str | int] = []
        for i, part in enumerate(parts):
            if i % 2:
                found.append(special[part])
            elif part:
                plain = self.library.normalizer.normalize_str(part)
                places = self.library.pre_tokenizer.pre_tokenize_str(plain)
                found += [plain[a:b] for _, (a, b) in places]
        return found

    def pieces(self) -> list[str]:
        """Piece of each id; the file must join pieces by a space, having no decoder."""
        if self.library.decoder is not None:
            raise ValueError("only tokenizer files without a decoder can be decoded by pieces")
        n = self.library.get_vocab_size(with_added_tokens=True)
        return [self.library.id_to_token(i) or "" for i in range(n)]


@dataclass
class Split:
    """Words of a slice: byte ranges in ``data``, hashes, word ranges of texts.

    ``slow`` holds the words of texts that the fast path can't split, by text.
    """

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    edges: np.ndarray
    hashes: np.ndarray
    slow: dict[int, list[str | int]]

    def word(self, i: int) -> str:
        return self.data[self.starts[i] : self.ends[i]].tobytes().decode()


def split_slice(part: Slice, tokenizer: Tokenizer) -> Split:
    """Split all texts of a slice at once where bytes tell the classes of characters.

    A text with an apostrophe, a special token, or a character outside ASCII and the letters
    up to U+00FF goes the slow way: the library normalises and splits it.
    """
    raw, edges = part.data, part.edges
    after = np.r_[np.uint8(0), raw[:-1]] if len(raw) else raw
    odd = _RARE_BYTE[raw]
    odd |= (after == 0xC3) & ((raw == 0x97) | (raw == 0xB7))
    odd |= (after == 0x3C) & (raw == 0x7C)
    counted = np.r_[0, np.cumsum(odd)]
    slow_texts = np.flatnonzero(counted[edges[1:]] > counted[edges[:-1]])
    low = _LOWER[raw]
    low[(after == 0xC3) & (raw >= 0x80) & (raw <= 0x9E)] += 0x20
    kinds = _CLASS[raw]
    slow = {}
    for i in slow_texts:
        kinds[edges[i] : edges[i + 1]] = _BLANK
        slow[int(i)] = tokenizer.split(raw[edges[i] : edges[i + 1]].tobytes().decode("utf-8", "replace"))
    change = np.ones(len(raw) + 1, bool)
    if len(raw):
        change[1:-1] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT)
    change[edges] = True
    cuts = np.flatnonzero(change)
    starts, ends = cuts[:-1], cuts[1:]
    solid = kinds[starts] != _BLANK
    starts, ends = starts[solid], ends[solid]
    return Split(low, starts, ends, np.searchsorted(starts, edges), hash_ranges(low, starts, ends), slow)


def _hash_words(words: list[str]) -> np.ndarray:
    """The same hashes as those of words found in texts."""
    encoded = [w.encode() for w in words]
    data = np.frombuffer(b"".join(encoded), np.uint8)
    cuts = np.cumsum([0] + [len(w) for w in encoded])
    return hash_ranges(data, cuts[:-1], cuts[1:])


@dataclass
class FrequentWords:
    """Codes of frequent words, by falling count, and the ids of each code.

    After the words come one code for a hole and one for each special token.
    """

    hashes: np.ndarray
    codes: np.ndarray
    cuts: np.ndarray
    ids: np.ndarray
    special: dict[int, int]

    @staticmethod
    def of(encoded: pa.Table, tokenizer: Tokenizer) -> FrequentWords:
        """From the rows of :func:`frequent_words`."""
        hashes = encoded["hash"].to_numpy().view(np.uint64)
        falling = np.lexsort((hashes, -encoded["n"].to_numpy()))  # small codes for frequent words
        encoded, hashes = encoded.take(falling), hashes[falling]
        order = np.argsort(hashes)
        special = sorted(tokenizer.special.values())
        length = pc.binary_length(encoded["ids"]).to_numpy() // 4
        ids = np.frombuffer(b"".join(encoded["ids"].to_pylist()), "<u4")
        return FrequentWords(
            hashes[order],
            order,
            np.cumsum(np.r_[0, length, np.ones(1 + len(special), np.int64)]),
            np.r_[ids, _HOLE, special].astype(np.uint32),
            {number: len(hashes) + 1 + i for i, number in enumerate(special)},
        )

    @property
    def hole(self) -> int:
        return len(self.hashes)

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """The code of each word; the hole for words that aren't frequent."""
        if len(self.hashes) == 0 or len(hashes) == 0:
            return np.full(len(hashes), self.hole)
        different, where = np.unique(hashes, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, different), len(self.hashes) - 1)
        return np.where(self.hashes[at] == different, self.codes[at], self.hole)[where]

    def spread(self, codes: np.ndarray) -> np.ndarray:
        """Ids of a row of codes."""
        length = self.cuts[codes + 1] - self.cuts[codes]
        ends = np.cumsum(length)
        return self.ids[np.repeat(self.cuts[codes] - (ends - length), length) + np.arange(length.sum())]


def frequent_words(
    docs: DataFrame, tokenizer: Tokenizer, text: str = "text", most: int = FREQUENT
) -> DataFrame:
    """Hash, ids and count n of at most ``most`` words, those with the largest counts over all documents.

    The least count that still fits is found from the number of words with each count; words
    with that count or more are taken, so none is sorted. Words above 64 bytes are left out, so the
    table has a bound on its size. It is encoded in tasks; what the driver takes to
    broadcast are hashes, ids and counts.

    A slice of a megabyte passes on what stands there twice or more. That only decides which
    words are broadcast, never how one is encoded.
    """
    counts = docs.select(F.col(text).alias("text")).mapInArrow(
        _count_task(tokenizer), "word string, n long"
    )
    totals = store_table(counts.groupBy("word").agg(F.sum("n").alias("n")), "word_counts")
    # One row per count that occurs: few, since their sum is the number of words.
    alike = totals.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    upto = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
    fitting = alike.withColumn("upto", F.sum("words").over(upto)).where(F.col("upto") <= most)
    least = fitting.agg(F.min("n")).first()[0]
    top = totals.where(F.col("n") >= F.lit(least) if least else F.lit(False))
    return top.mapInArrow(_frequent_task(tokenizer), "hash long, ids binary, n long")


def encode_documents(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    frequent: int = FREQUENT,
    decode: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: key, n_tokens, ids (little-endian unsigned 32-bit).

    Ids are those of the library without added special tokens, truncation or padding; the
    strings of special tokens in a text become their ids. With ``decode`` there is also
    ``decoded``, as from :func:`decode_documents`, in the same pass. Null and empty texts have no
    tokens. Rows are told apart by key and text, so keys may be null or repeat. Other columns
    are ignored.
    """
    tokenizer = Tokenizer(tokenizer_path)
    top = frequent_words(docs, tokenizer, text, frequent).toArrow()
    known = docs.sparkSession.sparkContext.broadcast(FrequentWords.of(top, tokenizer))
    del top
    kind = docs.schema[key].dataType.simpleString()
    named = F.coalesce(F.col(key), F.lit(0).cast(kind))
    rows = docs.select(
        F.col(key).alias("key"), named.alias("name"), F.hash(text).alias("mark"), F.col(text).alias("text")
    )
    codes = rows.mapInArrow(
        _codes_task(tokenizer, known),
        f"key {kind}, name {kind}, mark int, n int, n_holes int, packed binary",
    )
    rare = rows.select("name", "mark", "text").mapInArrow(
        _rare_task(tokenizer, known), f"name {kind}, mark int, slot int, word string"
    )
    # A long word is never frequent, however often it stands; its places are dealt to all tasks.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.when(F.octet_length("word") > LONGEST_FREQUENT, F.pmod(F.xxhash64("name"), F.lit(parts))).otherwise(0)
    together = rare.repartition("word", salt).sortWithinPartitions("word")
    encoded = together.mapInArrow(
        _word_task(tokenizer), f"name {kind}, mark int, slot_ids binary"
    )
    filling = encoded.groupBy("name", "mark").agg(F.collect_list("slot_ids").alias("filling"))
    pieces = docs.sparkSession.sparkContext.broadcast(tokenizer.pieces()) if decode else None
    schema = f"key {kind}, n_tokens long, ids binary" + ", decoded string" * decode
    return (
        codes.join(filling.hint("merge"), ["name", "mark"], "left")
        .select("key", "n", "n_holes", "packed", "filling")
        .mapInArrow(_fill_task(known, pieces), schema)
        .withColumnRenamed("key", key)
    )


def decode_documents(encoded: DataFrame, tokenizer_path: str, *, ids: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``: the pieces of its ids, joined by a space.

    The id-to-piece table has one row per id of the vocabulary and is the inner side of the
    join in every task. Null ids give a null, no ids an empty text; an unknown id fails.
    """
    tokenizer = Tokenizer(tokenizer_path)
    pieces = encoded.sparkSession.sparkContext.broadcast(tokenizer.pieces())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(_piece_task(pieces, ids), f"{schema}, decoded string")


# Tasks --------------------------------------------------------------------------


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _count_task(tokenizer: Tokenizer):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(_column(batch, "text")):
                found = split_slice(part, tokenizer)
                _, first, n = np.unique(found.hashes, return_index=True, return_counts=True)
                short = found.ends[first] - found.starts[first] <= LONGEST_FREQUENT
                often = np.flatnonzero((n >= LEAST_IN_SLICE) & short)
                words = [found.word(i) for i in first[often]]
                counts = n[often].tolist()
                slow: dict[str, int] = {}
                for word in (w for ws in found.slow.values() for w in ws if isinstance(w, str)):
                    slow[word] = slow.get(word, 0) + 1
                for word, m in slow.items():
                    if m >= LEAST_IN_SLICE and len(word.encode()) <= LONGEST_FREQUENT:
                        words.append(word)
                        counts.append(m)
                yield pa.record_batch(
                    {"word": pa.array(words, pa.string()), "n": pa.array(counts, pa.int64())}
                )

    return task


def _frequent_task(tokenizer: Tokenizer):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            ids = [np.array(e, "<u4").tobytes() for e in tokenizer.encode_words(words)]
            hashes = _hash_words(words).view(np.int64) if words else np.empty(0, np.int64)
            yield pa.record_batch({"hash": pa.array(hashes), "ids": pa.array(ids, pa.binary()), "n": batch.column(1)})

    return task


def _rare_of(found: Split, i: int, rare: np.ndarray, known: FrequentWords) -> tuple[dict[str, int], list[int]]:
    """Rare words of one text with their slots, and the slot of each place in turn."""
    slots: dict[str, int] = {}
    if i in found.slow:
        words = [w for w in found.slow[i] if isinstance(w, str)]
        codes = known.lookup(_hash_words(words)) if words else []
        turn = [slots.setdefault(w, len(slots)) for w, c in zip(words, codes) if c == known.hole]
    else:
        data, starts, ends = found.data, found.starts, found.ends
        a, b = np.searchsorted(rare, found.edges[i : i + 2])
        places = rare[a:b]
        low = int(starts[places[0]]) if len(places) else 0
        body = data[low : int(ends[places[-1]])].tobytes() if len(places) else b""
        words = [
            body[s:e].decode()
            for s, e in zip((starts[places] - low).tolist(), (ends[places] - low).tolist())
        ]
        turn = [slots.setdefault(w, len(slots)) for w in words]
    return slots, turn


def _rare_task(tokenizer: Tokenizer, known):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, marks = _column(batch, "name"), _column(batch, "mark")
            for part in slices(_column(batch, "text")):
                found = split_slice(part, tokenizer)
                rare = np.flatnonzero(known.value.lookup(found.hashes) == known.value.hole)
                words, slots, rows = [], [], []
                for i, row in enumerate(part.rows):
                    mine = _rare_of(found, i, rare, known.value)[0]
                    words += mine
                    slots += mine.values()
                    rows += [row] * len(mine)
                yield pa.record_batch(
                    {
                        "name": names.take(pa.array(rows, pa.int64())),
                        "mark": marks.take(pa.array(rows, pa.int64())),
                        "slot": pa.array(slots, pa.int32()),
                        "word": pa.array(words, pa.string()),
                    }
                )

    return task


def _codes_task(tokenizer: Tokenizer, known):
    """Codes of frequent words; a hole and the slot for each other word."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = known.value
        for batch in batches:
            names = ["key", "name", "mark"]
            for part in slices(_column(batch, "text")):
                mine_rows = batch.slice(part.rows.start, len(part.rows))
                found = split_slice(part, tokenizer)
                codes = table.lookup(found.hashes)
                rare = np.flatnonzero(codes == table.hole)
                n, holes, packed = [], [], []
                for i in range(len(part.rows)):
                    turn = _rare_of(found, i, rare, table)[1]
                    mine = (
                        _slow_codes(found.slow[i], table)
                        if i in found.slow
                        else codes[found.edges[i] : found.edges[i + 1]]
                    )
                    n.append(len(mine))
                    holes.append(len(turn))
                    packed.append(_pack(mine, turn))
                yield pa.record_batch(
                    {name: _column(mine_rows, name) for name in names}
                    | {
                        "n": pa.array(n, pa.int32()),
                        "n_holes": pa.array(holes, pa.int32()),
                        "packed": pa.array(packed, pa.binary()),
                    }
                )

    return task


def _slow_codes(words: list[str | int], known: FrequentWords) -> np.ndarray:
    plain = [w for w in words if isinstance(w, str)]
    codes = iter(known.lookup(_hash_words(plain)) if plain else ())
    return np.array([next(codes) if isinstance(w, str) else known.special[w] for w in words], np.int64)


def _pack(codes: np.ndarray, turn: list[int]) -> bytes:
    """Codes and slots, each split into planes of bytes, compressed."""
    planes = [
        np.asarray(values, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for values in (codes, turn)
    ]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _unpack(packed: bytes, n: int, holes: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes, and the slots of the holes in turn."""
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    body = pa.decompress(packed, decompressed_size=4 * (n + holes), codec="zstd", asbytes=True)
    planes = np.frombuffer(body, np.uint8)
    parts = planes[: 4 * n].reshape(4, n), planes[4 * n :].reshape(4, holes)
    codes, turn = (np.ascontiguousarray(p.T).view("<u4")[:, 0].astype(np.int64) for p in parts)
    return codes, turn


def _word_task(tokenizer: Tokenizer):
    """Rows come sorted by word: each distinct one is encoded once, in its first batch.

    Slot and ids leave as one value of 32-bit numbers.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_word, last_ids = None, b""
        for batch in batches:
            column = _column(batch, "word").dictionary_encode()
            words = column.dictionary.to_pylist()
            fresh = [w for w in words if w != last_word]
            ids = {
                w: np.array(e, "<u4").tobytes() for w, e in zip(fresh, tokenizer.encode_words(fresh))
            }
            if last_word is not None:
                ids.setdefault(last_word, last_ids)
            if words:
                last_word, last_ids = words[-1], ids[words[-1]]
            slots = _column(batch, "slot").to_numpy().astype("<u4")
            values = [s.tobytes() + ids[words[i]] for s, i in zip(slots, column.indices.to_pylist())]
            yield pa.record_batch(
                {
                    "name": _column(batch, "name"),
                    "mark": _column(batch, "mark"),
                    "slot_ids": pa.array(values, pa.binary()),
                }
            )

    return task


def _fill_task(known, pieces):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                rows = batch.slice(at, 128)
                names = ["n", "n_holes", "packed"]
                n, holes, packed = (_column(rows, name).to_pylist() for name in names)
                filling = _column(rows, "filling")
                full = [
                    _fill(*_unpack(packed[i], n[i], holes[i]), filling[i], known.value)
                    for i in range(len(n))
                ]
                columns = {
                    "key": _column(rows, "key"),
                    "n_tokens": pa.array([len(f) for f in full], pa.int64()),
                    "ids": pa.array([f.astype("<u4").tobytes() for f in full], pa.binary()),
                }
                if pieces is not None:
                    decoded = [_join_pieces(f, pieces.value) for f in full]
                    columns["decoded"] = pa.array(decoded, pa.string())
                yield pa.record_batch(columns)

    return task


def _fill(codes: np.ndarray, turn: np.ndarray, filling: pa.Scalar, known: FrequentWords) -> np.ndarray:
    """Ids of all codes, with the ids of rare words where their holes are."""
    ids = known.spread(codes)
    if len(turn) == 0:
        return ids
    words = [np.frombuffer(value, "<u4") for value in filling.as_py()]
    by_slot = {int(word[0]): word[1:] for word in words}
    rare = [by_slot[s] for s in turn.tolist()]
    lengths = np.ones(len(ids), np.int64)
    lengths[ids == _HOLE] = [len(r) for r in rare]
    full = np.repeat(ids, lengths)
    full[full == _HOLE] = np.concatenate(rare)
    return full


def _join_pieces(ids: np.ndarray, pieces: list[str]) -> str:
    return " ".join([pieces[i] for i in ids.tolist()])


def _piece_task(pieces, ids: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pieces.value
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                decoded = [
                    None if packed is None else _join_pieces(np.frombuffer(packed, "<u4"), table)
                    for packed in _column(rows, ids).to_pylist()
                ]
                columns = [*rows.columns, pa.array(decoded, pa.string())]
                yield pa.record_batch(columns, [*rows.schema.names, "decoded"])

    return task
