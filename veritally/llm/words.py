"""Words of many texts at once, as numpy arrays.

Texts of an Arrow batch are taken in slices of about a megabyte, so memory depends on the
slice (or on one very long text), never on the batch. Inside a slice all words are
found and hashed together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_U = np.uint64
_POWER = {"byte": _U(0x9E3779B97F4A7C15), "word": _U(0xC2B2AE3D27D4EB4F)}
_powers: dict[tuple[str, bool], np.ndarray] = {}

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64 bits over each other (the finaliser of splitmix64)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93))


def _power(kind: str, inverse: bool, n: int) -> np.ndarray:
    """Powers 0..n-1 of an odd number or of its inverse, modulo 2^64."""
    have = _powers.get((kind, inverse))
    if have is None or len(have) < n:
        base = int(_POWER[kind])
        base = pow(base, -1, 1 << 64) if inverse else base
        size = max(n, SLICE_BYTES + 1)
        with np.errstate(over="ignore"):
            have = np.full(size, _U(base), _U)
            have[0] = _U(1)
            np.multiply.accumulate(have, out=have)
        _powers[kind, inverse] = have
    return have[:n]


@dataclass
class Slice:
    """Some texts of a batch. ``edges`` are byte offsets, text i is edges[i]:edges[i + 1]."""

    rows: range
    data: np.ndarray
    edges: np.ndarray


@dataclass
class Words:
    """Words of a slice: byte ranges, and for each text the range of its words."""

    starts: np.ndarray
    ends: np.ndarray
    edges: np.ndarray


def slices(texts: pa.Array, most_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """Slices of an Arrow column of strings; null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if n == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.empty(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + most_bytes, "right")) - 1
        end = min(n, max(end, at + 1))
        yield Slice(range(at, end), data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at])
        at = end


def find_words(part: Slice) -> Words:
    """Maximal runs of bytes other than ASCII white space, never across two texts."""
    solid = ~SPACE[part.data]
    edge = np.zeros(len(solid) + 1, bool)
    edge[part.edges] = True
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last[:-1] &= ~solid[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return Words(starts, np.flatnonzero(last) + 1, np.searchsorted(starts, part.edges))


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, out of one running sum over the slice."""
    if len(starts) == 0:
        return np.empty(0, _U)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, _U)
        np.cumsum(_BYTE_VALUE[data] * _power("byte", False, len(data)), out=sums[1:])
        h = (sums[ends] - sums[starts]) * _power("byte", True, len(data) + 1)[starts]
        return mix(h + (ends - starts).astype(_U) * _U(0xA0761D6478BD642F))


class Sequences:
    """Hashes of runs of consecutive words of a slice."""

    def __init__(self, hashes: np.ndarray, salt: int = 0):
        with np.errstate(over="ignore"):
            values = mix(hashes + _U(salt)) if salt else hashes
            self._sums = np.zeros(len(hashes) + 1, _U)
            np.cumsum(values * _power("word", False, len(hashes)), out=self._sums[1:])
            self._inverse = _power("word", True, len(hashes) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (self._sums[ends] - self._sums[starts]) * self._inverse[starts]
            return mix(h + (ends - starts).astype(_U) * _U(0xE7037ED1A0B428DB))

    def grams(self, n: int) -> np.ndarray:
        """All runs of n words of the slice, also those that cross texts."""
        at = np.arange(max(0, len(self._sums) - n))
        return self.of(at, at + n)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    if len(values) < width:
        return values[:0]
    span, least = 1, values
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    n, rest = len(values) - width + 1, width - span
    return np.minimum(least[:n], least[rest : rest + n])
