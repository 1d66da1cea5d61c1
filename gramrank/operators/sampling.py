"""Random draws of rows.

The order rows are drawn in is that of a hash of the seed and the row's key, so a seed
gives the same rows however the table is partitioned. Rows with equal keys are in no
particular order among each other.
"""

from __future__ import annotations

import hashlib
import random

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


def shuffled(seed: int, key: list[str]) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]))


def _seeded(seed: int | None) -> int:
    return random.randrange(1 << 31) if seed is None else seed


def _drawn_number(seed: int, draw: int) -> int:
    """The first 15 hexadecimal digits of the MD5 of seed and draw."""
    return int(hashlib.md5(f"{seed}|draw|{draw}".encode()).hexdigest()[:15], 16)


def sample_one(df: DataFrame, seed: int | None = None, key: list[str] | None = None) -> DataFrame:
    """One row, each key with the same chance; ``key`` is all columns if not given."""
    key = key or df.columns
    return df.orderBy(shuffled(_seeded(seed), key), *key).limit(1)


def draw_rows(
    df: DataFrame, draws: int, seed: int | None = None, key: list[str] | None = None
) -> list[Row]:
    """``draws`` independent draws of one row each (a row may come up again).

    One pass brings at most ``draws`` rows in random order to the driver. Going
    through them, a draw repeats one of the ``d`` rows seen so far with chance
    ``d / N`` and takes the next fresh row otherwise, which is what independent
    draws from all ``N`` rows give. The chance of draw ``i`` is a hash of the seed and
    ``i``, so a seed gives the same draws anywhere.
    """
    total = df.count()
    if total == 0:
        raise ValueError("cannot draw from an empty table")
    seed, key = _seeded(seed), key or df.columns
    fresh = df.orderBy(shuffled(seed, key), *key).limit(min(draws, total)).collect()
    seen = 0
    drawn = []
    for draw in range(draws):
        position = _drawn_number(seed, draw) % total
        if position >= seen:
            position = seen
            seen += 1
        drawn.append(fresh[position])
    return drawn
