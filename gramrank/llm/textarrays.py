"""Texts of an Arrow batch as numpy arrays: words, their hashes, windows of words.

Work is done over the UTF-8 bytes of many texts at once. White space is U+0020 and
U+0009 to U+000D, and a word is a longest run of anything else within a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at a time; a longer text is worked on by itself.
CHUNK_BYTES = 1 << 20

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True

_FACTOR = 0xD1342543DE82EF95  # odd, and 5 modulo 8
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_draw = np.random.default_rng(20_240_501)
BYTE_VALUES = _draw.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FOLDED_VALUES = BYTE_VALUES.copy()
FOLDED_VALUES[65:91] = BYTE_VALUES[97:123]
_PLACES = _draw.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to ``n`` of the factor and of its inverse."""
    size = max(CHUNK_BYTES + 1, 1 << n.bit_length())
    if size not in _powers:
        _powers.clear()
        tables = []
        for base in (_FACTOR, _INVERSE):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers[size] = (tables[0], tables[1])
    return _powers[size]


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Texts:
    """``data`` bytes of some texts, text i from ``bounds[i]`` to ``bounds[i + 1]``."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def sums(self, per_byte: np.ndarray) -> np.ndarray:
        """Sum per text of a number or truth value per byte."""
        total = np.concatenate(([0], np.cumsum(per_byte, dtype=np.int64)))
        return total[self.bounds[1:]] - total[self.bounds[:-1]]

    def words(self) -> Words:
        body = ~IS_SPACE[self.data]
        before = np.empty(len(body) + 1, dtype=bool)
        before[1:] = body
        before[self.bounds] = False
        after = before[1:].copy()
        starts = np.flatnonzero(body & ~before[:-1])
        # a word ends before white space and before the next text
        after[:-1] = body[1:]
        after[-1:] = False
        inner = self.bounds[1:-1]
        after[inner[(inner > 0) & (inner <= len(body))] - 1] = False
        ends = np.flatnonzero(body & ~after) + 1
        return Words(self, starts, ends, np.searchsorted(starts, self.bounds))


@dataclass
class Words:
    """``bounds[i]`` to ``bounds[i + 1]`` are the words of text i."""

    texts: Texts
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def hashes(self, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
        """64-bit hashes of the words; ``FOLDED_VALUES`` takes A-Z for a-z."""
        power, inverse = _power_tables(len(self.texts.data) + 1)
        terms = values[self.texts.data] * power[: len(self.texts.data)]
        sums = np.empty(len(terms) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(terms, out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * inverse[self.starts])


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the windows of ``k`` words in one text's word hashes; a shorter text is
    one window, no words give none."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(k, n)
    total = np.full(n - width + 1, width, dtype=np.uint64)
    for j in range(width):
        total += mix(hashes[j : n - width + 1 + j] + _PLACES[j]) * _PLACES[32 + j % 32]
        total = mix(total)
    return total


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The texts of a column in runs of some ``limit`` bytes; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    content = np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, np.uint8)
    low = 0
    while low < n:
        high = int(np.searchsorted(bounds, bounds[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield Texts(
            low, content[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low]
        )
        low = high
