"""Equi-joins in which one key may hold a large share of the left rows.

The right side has one row per key and knows how many left rows the key has. A key with
more rows than one piece may have is cut: its left rows get a salt, its right row is
repeated once per piece. All other keys have the single salt 0. A piece has
``piece_rows`` rows, or one ``PIECES``-th of all rows if that is more. So fewer than
``PIECES`` keys can be cut, however many rows there are, and the list of them may be
broadcast; every key above a piece's rows is on it, and a key may have any number of
pieces. Adaptive skew handling does not reach these joins, since the right side comes
straight out of an aggregation on the join key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES = 100_000
PIECE_ROWS = 1_000_000


def hot_keys(
    sizes: DataFrame, key: str, rows: str, piece_rows: int = PIECE_ROWS
) -> DataFrame:
    """``[_hash, _pieces]`` of all keys of ``sizes`` with more rows than a piece.

    Keys are kept as hashes: a key text has no size bound, and two keys with one
    hash only get cut alike.
    """
    total = sizes.agg(F.sum(rows)).scalar()
    piece = F.greatest(F.lit(piece_rows), F.ceil(total / PIECES))
    return (
        sizes.where(F.col(rows) > piece)
        .groupBy(F.xxhash64(key).alias("_hash"))
        .agg(F.max(F.ceil(F.col(rows) / piece)).alias("_pieces"))
    )


def add_salt(left: DataFrame, hot: DataFrame, key: str, spread_by: list[str]) -> DataFrame:
    """``left`` with ``_salt``; rows of a hot key are spread by ``spread_by``."""
    joined = left.withColumn("_hash", F.xxhash64(key)).join(F.broadcast(hot), "_hash", "left")
    salt = F.pmod(F.xxhash64(*spread_by), F.coalesce("_pieces", F.lit(1)))
    return joined.withColumn("_salt", salt).drop("_hash", "_pieces")


def repeat_per_salt(right: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """``right`` with ``_salt``, one row per piece of its key."""
    joined = right.withColumn("_hash", F.xxhash64(key)).join(F.broadcast(hot), "_hash", "left")
    salts = F.sequence(F.lit(0).cast("long"), F.coalesce("_pieces", F.lit(1)).cast("long") - 1)
    return joined.withColumn("_salt", F.explode(salts)).drop("_hash", "_pieces")


def spread_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    rows: str,
    spread_by: list[str],
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Inner join of ``left`` with ``right``, unique by ``key``, whose column
    ``rows`` is the number of left rows of the key. Both sides are placed by key and
    piece; ``right`` lies by key alone, which must not decide where ``left`` goes. A
    partition of ``right``, a row a key and piece, is hashed, so ``left`` is not sorted."""
    hot = hot_keys(right, key, rows, piece_rows)
    keys = [key, "_salt"]
    salted = add_salt(left, hot, key, spread_by).repartition(*keys)
    placed = repeat_per_salt(right, hot, key).repartition(*keys)
    return salted.join(placed.hint("shuffle_hash"), keys).drop("_salt")
