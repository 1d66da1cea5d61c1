"""Packing token ids into sequences of equal length.

First-fit decreasing: within a group the longest piece comes first and goes into the
first sequence with room for it. A tournament tree over the room left in the
sequences finds that one in logarithmic time. Pieces are written once, each with a key,
and groups are drawn by a hash of it, so they are packed independently of each other, in
parallel, and each is of bounded size, whatever the texts are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramrank.llm import wordbpe
from gramrank.session import new_shared_path

PIECES = "doc_id {id}, start long, length long, doc_tokens long, ids binary"
PACKED = (
    "doc_id {id}, start long, length long, doc_tokens long, sequence_id long,"
    " offset long, token_ids binary"
)
#: Ids and pieces of a group, on the average.
GROUP_IDS = 2 << 20
GROUP_PIECES = 200_000


class FirstFit:
    """Sequences of ``capacity`` and the room left in each, as a tournament tree:
    a parent holds the larger room of its two children."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.used: list[int] = []
        self._leaves = 1
        self._room = [0, capacity]

    def place(self, length: int) -> tuple[int, int]:
        """Sequence and offset of a piece: the first sequence it fits into."""
        if not 0 < length <= self.capacity:
            raise ValueError(f"a piece has 1 to {self.capacity} ids, not {length}")
        if self._room[1] < length:
            self._grow()
        node = 1
        while node < self._leaves:
            node *= 2
            if self._room[node] < length:
                node += 1
        sequence = node - self._leaves
        while sequence >= len(self.used):
            self.used.append(0)
        offset = self.used[sequence]
        self.used[sequence] = offset + length
        self._room[node] -= length
        while node > 1:
            node //= 2
            self._room[node] = max(self._room[2 * node], self._room[2 * node + 1])
        return sequence, offset

    def _grow(self) -> None:
        """Twice the leaves, the new ones empty sequences."""
        leaves = self._room[self._leaves :] + [self.capacity] * self._leaves
        self._leaves *= 2
        self._room = [0] * self._leaves + leaves
        for node in range(self._leaves - 1, 0, -1):
            self._room[node] = max(self._room[2 * node], self._room[2 * node + 1])


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece. Equal lengths keep their order."""
    fit = FirstFit(capacity)
    sequence = np.empty(len(lengths), dtype=np.int64)
    offset = np.empty(len(lengths), dtype=np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        sequence[i], offset[i] = fit.place(int(lengths[i]))
    return sequence, offset


def tokenize_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int
) -> DataFrame:
    """``[doc_id, start, length, doc_tokens, ids]``: every document's ids with the
    end id, cut into pieces of at most ``capacity`` ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = wordbpe.load(tokenizer_path)
        width = np.dtype(bpe.dtype).itemsize
        end, step = np.array([end_id], dtype=bpe.dtype).tobytes(), capacity * width
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                row, start, length, total, ids = [], [], [], [], []
                for i, text in enumerate(part.column(1)):
                    whole = bpe.encode(text.as_py() or "") + end
                    for at in range(0, len(whole), step):
                        piece = whole[at : at + step]
                        row.append(i)
                        start.append(at // width)
                        length.append(len(piece) // width)
                        total.append(len(whole) // width)
                        ids.append(piece)
                yield pa.record_batch(
                    [
                        part.column(0).take(pa.array(row, pa.int64())),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(total, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["doc_id", "start", "length", "doc_tokens", "ids"],
                )

    plain = docs.select("doc_id", "text")
    schema = PIECES.format(id=plain.schema["doc_id"].dataType.simpleString())
    return plain.mapInArrow(cut, schema)


def _pack_group(capacity: int, width: int) -> Callable:
    def pack(table: pa.Table) -> pa.Table:
        by_place = [("doc_id", "ascending"), ("start", "ascending"), ("ids", "ascending")]
        table = table.sort_by(by_place)
        sequence, offset = first_fit_decreasing(table["length"].to_numpy(), capacity)
        group = table["group"][0].as_py()
        ids = [
            np.frombuffer(piece.as_buffer(), dtype=f"<u{width}").astype("<u4").tobytes()
            for chunk in table["ids"].chunks
            for piece in chunk
        ]
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "start": table["start"],
                "length": table["length"],
                "doc_tokens": table["doc_tokens"],
                "sequence_id": pa.array((group << 32) + sequence),
                "offset": pa.array(offset),
                "token_ids": pa.array(ids, pa.binary()),
            }
        )

    return pack


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    end_id: int = 2,
    group_ids: int = GROUP_IDS,
    group_pieces: int = GROUP_PIECES,
    seed: int = 11,
) -> DataFrame:
    """Pieces of all documents, each with its place in a sequence of ``capacity`` ids.

    ``docs`` has ``doc_id`` and ``text``; further columns are ignored. A null text is
    an empty one, whose only id is the end id. A document longer than a sequence is
    cut into full sequences and a rest. Rows that repeat an id are separate documents.
    An empty table gives no rows.

    Result: ``doc_id, start, length, doc_tokens, sequence_id, offset`` and
    ``token_ids`` (little-endian, four bytes an id); a sequence is its pieces in order
    of ``offset``, gapless from 0. Runs when called: pieces are written to the shared folder.
    """
    spark = docs.sparkSession
    path = new_shared_path(spark, "packing-pieces")
    keyed = tokenize_pieces(docs, tokenizer_path, capacity, end_id).withColumn(
        "piece_key", F.monotonically_increasing_id()
    )
    keyed.write.option("compression", "zstd").parquet(path)
    pieces = spark.read.parquet(path)
    n_ids, n_pieces = pieces.agg(F.sum("length"), F.count(F.lit(1))).first()
    groups = max(-(-(n_ids or 0) // group_ids), -(-n_pieces // group_pieces), 1)
    drawn = F.pmod(F.xxhash64("piece_key", F.lit(seed)), F.lit(groups))
    schema = PACKED.format(id=pieces.schema["doc_id"].dataType.simpleString())
    width = np.dtype(wordbpe.load(tokenizer_path).dtype).itemsize
    return (
        pieces.withColumn("group", drawn)
        .groupBy("group")
        .applyInArrow(_pack_group(capacity, width), schema)
    )


def sequences(packed: DataFrame) -> DataFrame:
    """``[sequence_id, n_ids, token_ids]``: the ids of each sequence in order."""
    in_order = F.array_sort(F.collect_list(F.struct("offset", "token_ids")))
    joined = F.aggregate(
        in_order, F.lit(b""), lambda all_ids, piece: F.concat(all_ids, piece["token_ids"])
    )
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_ids"), joined.alias("token_ids")
    )
