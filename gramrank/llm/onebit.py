"""Rotated one-bit codes of integer vectors, and intervals for inner products.

A vector is rotated by sign flips and Hadamard butterflies, which keep whole numbers whole
and are the same on every machine. Its code is the sign of each rotated component; stored
beside it is its alignment with the code vector (all components of one size, length 1) and
the length of what is left of it. For a query ``q`` and a row ``o`` with code vector ``c``

    o . q = (o . c) (c . q) + (rest of o) . (rest of q),

and the last term is at most the product of both lengths (Cauchy-Schwarz), so the interval
around the first one holds the inner product without fail. ``c . q`` comes from popcounts
of the code with the bit planes of the query, rounded to eight bits; what rounding may
change is added to the interval.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PLANES = 8
ROUNDS = 2
#: Relative and absolute widening for floating-point rounding.
SLACK = 1e-9, 1e-3


def code_length(dimensions: int) -> int:
    """Components of a rotated vector: a power of two, whole 64-bit words."""
    return max(64, 1 << max(dimensions - 1, 0).bit_length())


def rotate(vectors: np.ndarray, seed: int) -> np.ndarray:
    """Rows of whole numbers, padded and rotated; lengths and inner products stay."""
    n, dimensions = vectors.shape
    size = code_length(dimensions)
    turned = np.zeros((n, size))
    turned[:, :dimensions] = vectors
    chance = np.random.Generator(np.random.PCG64(seed))
    for _ in range(ROUNDS):
        turned *= chance.integers(0, 2, size) * 2 - 1
        step = 1
        while step < size:
            pairs = turned.reshape(n, size // (2 * step), 2, step)
            pairs[:, :, 0], pairs[:, :, 1] = (
                pairs[:, :, 0] + pairs[:, :, 1],
                pairs[:, :, 0] - pairs[:, :, 1],
            )
            step *= 2
    return turned / size ** (ROUNDS / 2)


def _packed(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=-1, bitorder="little").view("<u8")


@dataclass
class Codes:
    """``words`` are the sign bits; ``alignment`` and ``rest`` are lengths along the code
    vector and across it."""

    words: np.ndarray
    alignment: np.ndarray
    rest: np.ndarray

    def part(self, low: int, high: int) -> Codes:
        return Codes(self.words[low:high], self.alignment[low:high], self.rest[low:high])


def encode(vectors: np.ndarray, seed: int) -> Codes:
    turned = rotate(vectors, seed)
    along = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
    across = np.maximum((turned * turned).sum(axis=1) - along * along, 0.0)
    return Codes(_packed(turned >= 0), along, np.sqrt(across))


class Queries:
    """Rotated vectors as bit planes of their components, rounded to eight bits."""

    def __init__(self, vectors: np.ndarray, seed: int):
        turned = rotate(vectors, seed)
        self.length = np.sqrt((turned * turned).sum(axis=1))
        self.low = turned.min(axis=1)
        step = (turned.max(axis=1) - self.low) / ((1 << PLANES) - 1)
        self.step = np.where(step > 0, step, 1.0)
        levels = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        rounded = self.low[:, None] + self.step[:, None] * levels
        self.total = rounded.sum(axis=1)
        self.error = np.sqrt(((turned - rounded) ** 2).sum(axis=1))
        self.root = np.sqrt(turned.shape[1])
        self.planes = np.stack([_packed(levels >> j & 1 == 1) for j in range(PLANES)])

    def intervals(self, low: int, high: int, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the inner products of queries ``low`` to ``high`` with all rows."""
        sums = np.zeros((high - low, len(codes.alignment)), dtype=np.int64)
        ones = np.bitwise_count(codes.words).sum(axis=1, dtype=np.int64)
        for word in range(codes.words.shape[1]):
            row_bits = codes.words[None, :, word]
            for j in range(PLANES):
                met = np.bitwise_count(self.planes[j, low:high, word, None] & row_bits)
                sums += met.astype(np.int64) << j
        one = lambda values: values[low:high, None]
        positive = one(self.low) * ones + one(self.step) * sums
        along = (2.0 * positive - one(self.total)) / self.root
        error, length = one(self.error), one(self.length)
        least = np.maximum(np.abs(along) - error, 0.0)
        across = np.sqrt(np.maximum(length * length - least * least, 0.0))
        width = codes.alignment * error + codes.rest * across
        width += SLACK[0] * length * (codes.alignment + codes.rest) + SLACK[1]
        middle = codes.alignment * along
        return middle - width, middle + width
