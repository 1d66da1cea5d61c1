"""Packing token ids into as few sequences as can be: best two fit.

A sequence is filled greedily, the longest unpacked piece that fits first. Then its
smallest piece is taken out again if two unpacked pieces fill the larger gap better, and
of all such pairs the best one goes in. Only lengths decide, so a group's unpacked pieces
are a count for each length and one bit for each length that is left: the longest that
fits is the highest bit below the room, and all pairs with a given total are the bits
that meet their own mirror image.

Pieces are written once, each with a key. Groups are drawn by a hash of that key, so
they are of bounded size whatever the texts are, equal ones included. Pieces as long as a
sequence need no packing and are not shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramrank.llm import wordbpe
from gramrank.llm.packing import tokenize_pieces
from gramrank.session import new_shared_path

#: Ids and pieces of a group, on the average. A group wastes less than one sequence on
#: having an end, a thousandth of it.
GROUP_IDS = 2 << 20
GROUP_PIECES = 200_000

PACKED = (
    "doc_id {id}, piece int, start long, length long, doc_tokens long,"
    " sequence_id long, offset long, token_ids binary"
)


class Unpacked:
    """A bag of lengths from 1 to ``capacity``.

    ``_there`` has bit ``l`` set while the bag holds a length ``l``, ``_mirror`` has bit
    ``capacity - l`` set then."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        if len(lengths) and not (0 < lengths.min() and lengths.max() <= capacity):
            raise ValueError(f"a piece has 1 to {capacity} ids")
        self.capacity = capacity
        self.left = len(lengths)
        self._count = np.bincount(lengths, minlength=capacity + 1).tolist()
        self._there = sum(1 << length for length, n in enumerate(self._count) if n)
        self._mirror = sum(1 << capacity - length for length, n in enumerate(self._count) if n)

    def longest(self, room: int) -> int:
        """The longest length of at most ``room``, 0 if there is none."""
        return max((self._there & ((2 << room) - 1)).bit_length() - 1, 0)

    def best_pair(self, least: int, room: int) -> tuple[int, int] | None:
        """Two lengths with the largest total above ``least`` and up to ``room``; of
        equal totals the pair with the longest one."""
        for total in range(room, max(least, 1), -1):
            pairs = self._there & (self._mirror >> (self.capacity - total))
            if total % 2 == 0 and pairs >> total // 2 & 1 and self._count[total // 2] < 2:
                pairs &= ~(1 << total // 2)
            if pairs:
                longer = pairs.bit_length() - 1
                return longer, total - longer
        return None

    def take(self, length: int) -> None:
        self.left -= 1
        self._count[length] -= 1
        if not self._count[length]:
            self._there ^= 1 << length
            self._mirror ^= 1 << self.capacity - length

    def give_back(self, length: int) -> None:
        self.left += 1
        self._count[length] += 1
        if self._count[length] == 1:
            self._there ^= 1 << length
            self._mirror ^= 1 << self.capacity - length


def fill_sequence(bag: Unpacked) -> list[int]:
    """Lengths of the next sequence, taken out of the bag."""
    chosen: list[int] = []
    room = bag.capacity
    while length := bag.longest(room):
        bag.take(length)
        chosen.append(length)
        room -= length
    if room and len(chosen) > 1:
        smallest = chosen[-1]
        pair = bag.best_pair(smallest, room + smallest)
        if pair:
            chosen.pop()
            for length in pair:
                bag.take(length)
                chosen.append(length)
            bag.give_back(smallest)
    return chosen


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece. Pieces of one length are used in their order."""
    bag = Unpacked(lengths, capacity)
    sequence, offset, placed = [], [], []
    filled = 0
    while bag.left:
        at = 0
        for length in fill_sequence(bag):
            sequence.append(filled)
            offset.append(at)
            placed.append(length)
            at += length
        filled += 1
    slots = np.argsort(np.array(placed, dtype=np.int64), kind="stable")
    pieces = np.argsort(lengths, kind="stable")
    found = np.empty((2, len(lengths)), dtype=np.int64)
    found[:, pieces] = np.array([sequence, offset], dtype=np.int64)[:, slots]
    return found[0], found[1]


def _widened(ids: pa.Array, width: int) -> pa.Array:
    """Ids of ``width`` bytes as ids of four, little-endian."""
    blob = b"".join(piece.as_py() for piece in ids)
    ends = np.cumsum([0, *(len(piece.as_buffer()) for piece in ids)]) * 4 // width
    wide = np.frombuffer(blob, dtype=f"<u{width}").astype("<u4").tobytes()
    offsets = pa.py_buffer(ends.astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(ids), [None, offsets, pa.py_buffer(wide)])


def _placed(table: pa.Table, capacity: int, width: int, sequence, offset) -> pa.Table:
    start = table["start"].to_numpy()
    chunks = [_widened(chunk, width) for chunk in table["ids"].chunks]
    return pa.table(
        {
            "doc_id": table["doc_id"],
            "piece": pa.array((start // capacity).astype(np.int32)),
            "start": table["start"],
            "length": table["length"],
            "doc_tokens": table["doc_tokens"],
            "sequence_id": pa.array(sequence, pa.int64()),
            "offset": pa.array(offset, pa.int64()),
            "token_ids": pa.chunked_array(chunks, pa.binary()),
        }
    )


def _pack_group(capacity: int, width: int) -> Callable[[pa.Table], pa.Table]:
    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("piece_key")
        sequence, offset = best_two_fit(table["length"].to_numpy(), capacity)
        group = table["group"][0].as_py()
        return _placed(table, capacity, width, (group << 32) + sequence, offset)

    return pack


def _pack_alone(capacity: int, width: int) -> Callable:
    """Every piece fills a sequence of its own; their numbers are negative."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                table = pa.Table.from_batches([batch.slice(low, 1024)])
                own = -1 - table["piece_key"].to_numpy()
                yield from _placed(table, capacity, width, own, np.zeros_like(own)).to_batches()

    return pack


def pack_tightly(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    end_id: int = 0,
    group_ids: int = GROUP_IDS,
    group_pieces: int = GROUP_PIECES,
    seed: int = 11,
) -> DataFrame:
    """Pieces of all documents, each with its place in a sequence of ``capacity`` ids.

    ``docs`` has ``doc_id`` and ``text``; further columns are ignored. A null text is an
    empty one, whose only id is the end id. A document longer than a sequence is cut into
    full sequences and a rest; no other is cut. Rows that repeat an id are separate
    documents, null ids are kept. An empty table gives no rows.

    Result: ``doc_id, piece, start, length, doc_tokens, sequence_id, offset`` and
    ``token_ids`` (little-endian, four bytes an id); a sequence is its pieces in order of
    ``offset``, gapless from 0. Runs when called: pieces are written to the shared folder,
    so a lost executor costs no tokenizing that was done.
    """
    spark = docs.sparkSession
    path = new_shared_path(spark, "packing-pieces")
    keyed = tokenize_pieces(docs, tokenizer_path, capacity, end_id).withColumn(
        "piece_key", F.monotonically_increasing_id()
    )
    keyed.write.option("compression", "zstd").parquet(path)
    pieces = spark.read.parquet(path)
    whole = F.col("length") == capacity
    n_ids, n_pieces = pieces.where(~whole).agg(F.sum("length"), F.count(F.lit(1))).first()
    groups = max(-(-(n_ids or 0) // group_ids), -(-n_pieces // group_pieces), 1)
    width = np.dtype(wordbpe.load(tokenizer_path).dtype).itemsize
    schema = PACKED.format(id=docs.schema["doc_id"].dataType.simpleString())
    packed = (
        pieces.where(~whole)
        .withColumn("group", F.pmod(F.xxhash64("piece_key", F.lit(seed)), F.lit(groups)))
        .groupBy("group")
        .applyInArrow(_pack_group(capacity, width), schema)
    )
    return pieces.where(whole).mapInArrow(_pack_alone(capacity, width), schema).union(packed)
