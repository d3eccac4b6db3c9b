"""Substring dedup by suffix arrays, sorted deep-shallow.

Suffixes are sorted by multikey quicksort down to a shallow depth; groups that still agree
there go through a blind trie, which compares each suffix with one other only. Neighbours in that
order show by their common prefix which strings are equal, and one digest per string lets the
arrays of different tasks meet.

Not every suffix has to be sorted. Every window of ``window`` bytes has an owner: the place of
the least n-gram in its first ``head`` bytes, so equal windows have owners in the same place. The
windows of one owner form a stretch, which begins at a suffix of the array. A stretch that
stands elsewhere as a whole settles all its windows. Where owners have equal surroundings but
different stretches, at the borders of a repeated passage, the stretches of an owner are brought
together and the suffixes of all their windows are sorted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.llm.words import Slice, hash_ranges, slices, sliding_min
from veritally.session import store_table

WINDOW = 200
HEAD = 150
GRAM = 16
#: Depth in bytes at which multikey quicksort leaves a group to the blind trie.
SHALLOW = 48

#: Windows of a text that are looked at together; their places fit in the low bits of a hash.
CHUNK = 1 << 23
_PLACE = np.uint64((1 << 24) - 1)
#: Stretches of one owner that are sorted together; more are dealt to several groups.
GROUP = 1 << 14
#: Stretches of small groups that a task sorts at a time.
AT_ONCE = 4096
_STRETCH = "owner long, stretch long, row long, start int, n int"
_SNIPPET = "owner long, salt int, salts int, row long, start int, n int, once boolean, bytes binary"
_FOUND = "owner long, string long, row long, start int, n int, open boolean"


def repeated_byte_spans(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    head: int = HEAD,
    gram: int = GRAM,
) -> DataFrame:
    """Spans of bytes covered by repeated windows: row, start, n; those of a row may overlap.

    ``row`` is the key, or a hash of the text where the key is null. A window is repeated if its
    bytes also start anywhere else, in the same text or another. A key belongs to one text;
    rows that repeat as a whole are copies of each other. Null, empty and short texts have no
    spans, and other columns are ignored.

    Strings of different tasks are equal if two 64-bit digests agree: that of the string and that
    of the bytes around its owner. Owners are counted on the map side, so a passage
    that a third of the corpus shares is no larger than any other after it.
    """
    rows = _rows(docs, key, text)
    owners = rows.mapInArrow(_owner_task(window, head, gram), "owner long")
    known = owners.groupBy("owner").agg(F.count(F.lit(1)).alias("places")).where("places > 1")
    # Stored, so that both sides of the join come from a shuffle and Spark may split a hot owner.
    known = store_table(known, "owners")
    found = rows.mapInArrow(_stretch_task(window, head, gram), _STRETCH)
    shared = store_table(found.join(known.select("owner").hint("merge"), "owner"), "stretches")
    place = F.min(F.struct("row", "start", "n")).alias("place")
    texts = shared.groupBy("owner", "stretch").agg(F.count(F.lit(1)).alias("places"), place)
    texts = store_table(texts, "stretch_texts")
    several = texts.where("places > 1").select("owner", "stretch")
    whole = shared.join(several.hint("merge"), ["owner", "stretch"])
    checked = _border_spans(rows, texts, window)
    return whole.select("row", "start", (F.col("n") + (window - 1)).alias("n")).unionByName(checked)


def _border_spans(rows: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """Repeated windows of stretches that stand once, where their owner has several.

    One stretch of each kind is cut out, and those of an owner are sorted together. An owner
    with more than ``GROUP`` kinds has several groups, dealt by digest. What a group alone doesn't
    settle there, a window that is single in its group, is looked up among the distinct windows
    of the owner's other groups.
    """
    owners = texts.groupBy("owner").agg(F.count(F.lit(1)).alias("kinds"), F.min("places").alias("fewest"))
    unclear = owners.where("kinds > 1 AND fewest = 1")
    unclear = unclear.select("owner", F.ceil(F.col("kinds") / GROUP).cast("int").alias("salts"))
    probe = F.struct(
        "place.start",
        "place.n",
        "owner",
        (F.col("places") == 1).alias("once"),
        F.pmod("stretch", "salts").cast("int").alias("salt"),
        "salts",
    )
    probes = texts.join(unclear.hint("merge"), "owner").select(F.col("place.row").alias("row"), probe.alias("probe"))
    lists = probes.groupBy("row").agg(F.collect_list("probe").alias("probes"))
    snippets = rows.join(lists.hint("merge"), "row").mapInArrow(_snippet_task(window), _SNIPPET)
    groups = snippets.repartition("owner", "salt").sortWithinPartitions("owner", "salt")
    found = store_table(groups.mapInArrow(_border_task(window), _FOUND), "border_windows")
    settled = found.where("open IS NULL").select("row", "start", "n")
    shared = found.where("open IS NOT NULL").groupBy("owner", "string").agg(F.count(F.lit(1)).alias("groups"))
    shared = shared.where("groups > 1").select("owner", "string")
    across = found.where("open").join(shared.hint("merge"), ["owner", "string"]).select("row", "start", "n")
    return settled.unionByName(across)


def remove_repeated_bytes(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    head: int = HEAD,
    gram: int = GRAM,
) -> DataFrame:
    """Per row of ``docs``: key, n_bytes, n_removed, n_spans (maximal removed runs), kept (binary).

    Each byte of the UTF-8 text that a repeated window covers is removed; all windows are judged
    on the input. What is left may end inside a character, so it is bytes. See
    :func:`repeated_byte_spans` for odd rows; a null text has 0 bytes and keeps none.
    """
    spans = repeated_byte_spans(docs, key=key, text=text, window=window, head=head, gram=gram)
    lists = spans.groupBy("row").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    rows = _rows(docs, key, text, keep=True).join(lists.hint("merge"), "row", "left")
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(
        _removal_task, f"key {kind}, n_bytes long, n_removed long, n_spans long, kept binary"
    ).withColumnRenamed("key", key)


def _rows(docs: DataFrame, key: str, text: str, keep: bool = False) -> DataFrame:
    row = F.coalesce(F.col(key).cast("long"), F.xxhash64(F.col(text)))
    kept = [F.col(key).alias("key")] if keep else []
    return docs.select(row.alias("row"), *kept, F.col(text).alias("text"))


# Sorting --------------------------------------------------------------------------


class Suffixes:
    """Byte ranges of a slice, compared eight bytes at a time; what ends first is less."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.raw = np.r_[data, np.zeros(8, np.uint8)].tobytes()
        self.starts, self.ends = starts, ends
        self._eights = np.ndarray((len(data) + 1,), ">u8", self.raw, strides=(1,))
        self._masks = np.array([0] + [(1 << 64) - (1 << 8 * (8 - i)) for i in range(1, 9)], np.uint64)

    def __len__(self) -> int:
        return len(self.starts)

    def string(self, i: int) -> bytes:
        return self.raw[self.starts[i] : self.ends[i]]

    def letters(self, which: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next eight bytes and how many of them there are."""
        at = self.starts[which] + depth
        left = np.clip(self.ends[which] - at, 0, 8)
        return self._eights[np.minimum(at, len(self._eights) - 1)].astype(np.uint64) & self._masks[left], left


def deep_shallow_order(suffixes: Suffixes, shallow: int = SHALLOW) -> np.ndarray:
    """Positions of the suffixes in sorted order; equal ones keep theirs."""
    order, deep = multikey_quicksort(suffixes, shallow)
    for begin, end in deep:
        order[begin:end] = blind_trie_order(suffixes, order[begin:end].tolist())
    return order


def multikey_quicksort(suffixes: Suffixes, shallow: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Order down to ``shallow`` bytes, and the ranges of it that agree so far.

    All open groups are parted in one step: each takes the letter of its middle member as pivot,
    and members fall below, beside or above it. Those beside it go on eight bytes deeper, those
    whose bytes ended there are equal.
    """
    order = np.arange(len(suffixes))
    begins, ends = np.array([0]), np.array([len(suffixes)])
    depths = np.array([0])
    deep: list[tuple[int, int]] = []
    while True:
        open_ = ends - begins > 1
        ready = open_ & (depths >= shallow)
        deep += zip(begins[ready].tolist(), ends[ready].tolist())
        open_ &= ~ready
        begins, ends, depths = begins[open_], ends[open_], depths[open_]
        if len(begins) == 0:
            return order, deep
        sizes = ends - begins
        group = np.repeat(np.arange(len(sizes)), sizes)
        heads = np.cumsum(sizes) - sizes
        place = begins[group] + np.arange(len(group)) - heads[group]
        members = order[place]
        letter, left = suffixes.letters(members, depths[group])
        middle = (heads + sizes // 2)[group]
        pivot, pivot_left = letter[middle], left[middle]
        above = (letter > pivot) | (letter == pivot) & (left > pivot_left)
        beside = (letter == pivot) & (left == pivot_left)
        part = group * 3 + np.where(above, 2, np.where(beside, 1, 0))
        moved = np.argsort(part, kind="stable")
        order[place] = members[moved]
        parts, firsts = np.unique(part[moved], return_index=True)
        lengths = np.diff(np.r_[firsts, len(part)])
        begins = place[firsts]
        ends = begins + lengths
        same = parts % 3 == 1
        depths = depths[parts // 3] + 8 * same
        going = ~(same & (left[moved][firsts] < 8))
        begins, ends, depths = begins[going], ends[going], depths[going]


def blind_trie_order(suffixes: Suffixes, members: list[int]) -> list[int]:
    """Members in sorted order, by a trie that knows branching depths and bytes only.

    A member goes down by the bytes at branching depths to some leaf, whatever lies between. Its
    common prefix with that leaf, the only comparison, tells where it branches off.
    """
    strings = {i: suffixes.string(i) for i in members}
    top: list = [None]  # a node is (depth, children by byte), a leaf is a list of equal members
    for i in members:
        mine = strings[i]
        node = top[0]
        if node is None:
            top[0] = [i]
            continue
        while type(node) is tuple:
            depth, children = node
            node = children.get(mine[depth] if depth < len(mine) else -1) or next(iter(children.values()))
        other = strings[node[0]]
        common = common_prefix(mine, other)
        if common == len(mine) == len(other):
            node.append(i)
            continue
        byte = mine[common] if common < len(mine) else -1
        hold, slot = top, 0
        while type(hold[slot]) is tuple and hold[slot][0] < common:
            depth, children = hold[slot]
            hold, slot = children, mine[depth]
        node = hold[slot]
        if type(node) is tuple and node[0] == common:
            node[1][byte] = [i]
        else:
            theirs = other[common] if common < len(other) else -1
            hold[slot] = (common, {theirs: node, byte: [i]})
    found: list[int] = []
    stack = [top[0]] if members else []
    while stack:
        node = stack.pop()
        if type(node) is tuple:
            stack += [node[1][byte] for byte in sorted(node[1], reverse=True)]
        else:
            found += node
    return found


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - (differ.bit_length() + 7) // 8


def neighbour_prefixes(suffixes: Suffixes, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix in order and the one before; 0 for the first."""
    found = np.zeros(len(order), np.int64)
    at = np.arange(1, len(order))
    while len(at):
        mine, mine_left = suffixes.letters(order[at], found[at])
        theirs, theirs_left = suffixes.letters(order[at - 1], found[at])
        differ = mine ^ theirs
        # the float is never below the power of two it stands for, so leading zero bytes are exact
        bits = np.frexp((differ >> np.uint64(32)).astype(float))[1] + 32
        bits = np.where(differ >> np.uint64(32) > 0, bits, np.frexp((differ & np.uint64(2**32 - 1)).astype(float))[1])
        same = np.minimum(8 - (bits + 7) // 8, np.minimum(mine_left, theirs_left))
        found[at] += same
        at = at[same == 8]
    return found


def equal_classes(suffixes: Suffixes) -> np.ndarray:
    """Per suffix the first of those equal to it, by the neighbours' common prefixes."""
    order = deep_shallow_order(suffixes)
    common = neighbour_prefixes(suffixes, order)
    length = (suffixes.ends - suffixes.starts)[order]
    new = np.ones(len(order), bool)
    new[1:] = (common[1:] < length[1:]) | (length[1:] != length[:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0)) if len(order) else order
    found = np.empty(len(order), np.int64)
    found[order] = order[head]
    return found


def _equal_among(suffixes: Suffixes) -> np.ndarray:
    """:func:`equal_classes`, without sorting what a hash shows to be unlike all others."""
    data = np.frombuffer(suffixes.raw, np.uint8)
    _, which, times = np.unique(hash_ranges(data, suffixes.starts, suffixes.ends), return_inverse=True, return_counts=True)
    some = np.flatnonzero(times[which] > 1)
    first = np.arange(len(suffixes))
    first[some] = some[equal_classes(Suffixes(data[:-8], suffixes.starts[some], suffixes.ends[some]))]
    return first


def digests(suffixes: Suffixes) -> np.ndarray:
    """64-bit digests of the suffixes, each distinct one taken once."""
    first = equal_classes(suffixes)
    names = np.zeros(len(first), np.int64)
    for i in np.unique(first).tolist():
        names[i] = int.from_bytes(hashlib.blake2b(suffixes.string(i), digest_size=8).digest(), signed=True)
    return names[first]


# Tasks --------------------------------------------------------------------------


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _chunks(texts: pa.Array, window: int) -> Iterator[tuple[int, Slice]]:
    """Slices, and the place in the text where they begin: 0 unless a text is longer than a chunk."""
    for part in slices(texts):
        size = len(part.data)
        if size <= CHUNK:
            yield 0, part
            continue
        for at in range(0, size - window + 1, CHUNK):
            end = min(size, at + CHUNK + window - 1)
            yield at, Slice(part.rows, part.data[at:end], np.array([0, end - at]))


def stretches(part: Slice, window: int, head: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of a slice: hash around the owner, text, first byte in the slice, number of windows."""
    sizes = np.diff(part.edges)
    long_ = np.flatnonzero(sizes >= window)
    if len(long_) == 0:
        none = np.empty(0, np.int64)
        return none, none, none, none
    n = len(part.data)
    at = np.arange(n - gram + 1)
    hashes = hash_ranges(part.data, at, at + gram)
    least = sliding_min((hashes & ~_PLACE) | at.view(np.uint64), head - gram + 1)
    valid = np.zeros(n + 1, np.int8)
    valid[part.edges[long_]] += 1
    valid[part.edges[long_ + 1] - window + 1] -= 1
    at = np.flatnonzero(np.cumsum(valid[:n]))
    mine = least[at]
    begins = np.flatnonzero(np.r_[True, (mine[1:] != mine[:-1]) | (at[1:] != at[:-1] + 1)])
    first, count = at[begins], np.diff(np.r_[begins, len(at)])
    owner = (mine[begins] & _PLACE).astype(np.int64)
    around = hash_ranges(part.data, owner, owner + (window - head + gram))
    text = np.searchsorted(part.edges, first, "right") - 1
    return around.view(np.int64), text, first, count


def _owner_task(window: int, head: int, gram: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in _chunks(_column(batch, "text"), window):
                yield pa.record_batch({"owner": stretches(part, window, head, gram)[0]})

    return task


def _stretch_task(window: int, head: int, gram: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _column(batch, "row").to_numpy()
            for base, part in _chunks(_column(batch, "text"), window):
                owner, text, first, count = stretches(part, window, head, gram)
                if len(owner) == 0:
                    continue
                yield pa.record_batch(
                    {
                        "owner": owner,
                        "stretch": digests(Suffixes(part.data, first, first + count + window - 1)),
                        "row": keys[part.rows.start : part.rows.stop][text],
                        "start": (base + first - part.edges[text]).astype(np.int32),
                        "n": count.astype(np.int32),
                    }
                )

    return task


def _snippet_task(window: int):
    """The bytes of the stretches that are asked for."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _column(batch, "row").to_numpy()
            lists = _column(batch, "probes")
            for part in slices(_column(batch, "text")):
                mine = lists.slice(part.rows.start, len(part.rows))
                text = np.repeat(np.arange(len(mine)), mine.value_lengths().to_numpy())
                probes = mine.flatten()
                start, n, owner, once, salt, salts = (probes.field(i) for i in range(6))
                first = part.edges[text] + start.to_numpy()
                last = first + n.to_numpy() + window - 1
                raw = part.data.tobytes()
                yield pa.record_batch(
                    {
                        "owner": owner,
                        "salt": salt,
                        "salts": salts,
                        "row": keys[part.rows.start : part.rows.stop][text],
                        "start": start,
                        "n": n,
                        "once": once,
                        "bytes": pa.array([raw[a:b] for a, b in zip(first.tolist(), last.tolist())], pa.binary()),
                    }
                )

    return task


def _border_task(window: int):
    """Sorts the windows of whole groups, which come one after another, some groups at a time."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            owner, salt = held["owner"].to_numpy(), held["salt"].to_numpy()
            heads = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (salt[1:] != salt[:-1])])
            done = 0
            while heads[-1] - done >= AT_ONCE or (done < heads[-1] and len(held) - done > 2 * AT_ONCE):
                end = int(heads[max(np.searchsorted(heads, done + AT_ONCE, "right") - 1, np.searchsorted(heads, done) + 1)])
                yield _border_windows(held.slice(done, end - done).combine_chunks(), window)
                done = end
            held = held.slice(done)
        if held is not None and len(held):
            yield _border_windows(held.combine_chunks(), window)

    return task


def _border_windows(group: pa.Table, window: int) -> pa.RecordBatch:
    """Runs of repeated windows (open is null), and the distinct windows of owners with more groups.

    The latter are open if they are neither settled here nor by their stretch.
    """
    owner, row, start, n, salts = (group[c].to_numpy() for c in ("owner", "row", "start", "n", "salts"))
    once = group["once"].to_numpy(zero_copy_only=False).astype(bool)
    strings = group["bytes"].combine_chunks() if isinstance(group["bytes"], pa.ChunkedArray) else group["bytes"]
    strings = strings.chunk(0) if isinstance(strings, pa.ChunkedArray) else strings
    edges = np.r_[0, np.cumsum(n.astype(np.int64) + window - 1)]
    data = np.frombuffer(b"".join(strings.to_pylist()), np.uint8)
    which = np.repeat(np.arange(len(n)), n)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    at = edges[which] + offset
    suffixes = Suffixes(data, at, at + window)
    first = _equal_among(suffixes)
    repeated = np.bincount(first, minlength=len(first))[first] > 1
    hit = repeated & once[which]
    begins = np.flatnonzero(hit & ~np.r_[False, hit[:-1] & (which[1:] == which[:-1])])
    ends = np.flatnonzero(hit & ~np.r_[hit[1:] & (which[1:] == which[:-1]), False])
    single = np.flatnonzero((first == np.arange(len(first))) & (salts[which] > 1))
    names = [int.from_bytes(hashlib.blake2b(suffixes.string(i), digest_size=8).digest(), signed=True) for i in single.tolist()]
    both = np.r_[begins, single]
    return pa.record_batch(
        {
            "owner": owner[which[both]],
            "string": np.r_[np.zeros(len(begins), np.int64), np.array(names, np.int64)],
            "row": row[which[both]],
            "start": (start[which[both]] + offset[both]).astype(np.int32),
            "n": np.r_[ends - begins + window, np.full(len(single), window)].astype(np.int32),
            "open": pa.array(
                [None] * len(begins) + (once[which[single]] & ~repeated[single]).tolist(), pa.bool_()
            ),
        }
    )


def _removal_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, lists = _column(batch, "key"), _column(batch, "spans")
        for part in slices(_column(batch, "text")):
            mine = lists.slice(part.rows.start, len(part.rows))
            text = np.repeat(np.arange(len(mine)), mine.value_lengths().fill_null(0).to_numpy())
            spans = mine.flatten()
            start, n = spans.field(0).to_numpy(), spans.field(1).to_numpy()
            size = len(part.data)
            change = np.bincount(part.edges[text] + start, minlength=size + 1)
            change -= np.bincount(part.edges[text] + start + n, minlength=size + 1)
            removed = np.cumsum(change[:-1]) > 0
            begins = removed.copy()
            begins[1:] &= ~removed[:-1]
            fresh = part.edges[:-1][np.diff(part.edges) > 0]
            begins[fresh] = removed[fresh]
            data, kept = part.data[~removed].tobytes(), np.r_[0, np.cumsum(~removed)][part.edges]
            counts = [np.r_[0, np.cumsum(x)][part.edges] for x in (removed, begins)]
            yield pa.record_batch(
                {
                    "key": keys.slice(part.rows.start, len(part.rows)),
                    "n_bytes": np.diff(part.edges),
                    "n_removed": np.diff(counts[0]),
                    "n_spans": np.diff(counts[1]),
                    "kept": pa.array([data[a:b] for a, b in zip(kept[:-1], kept[1:])], pa.binary()),
                }
            )
