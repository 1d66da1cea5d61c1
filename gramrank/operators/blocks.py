"""Words of documents, counted and looked up a block of documents at a time.

Texts are placed by id and sorted by it, so documents of a partition follow each other in
the same order whenever they are read. A block is a run of them; it is known by the id of
its first document, and sends each of its different words once, with the number of its
documents that have it. What is found for the words comes back to that id: it is joined to
the first document, and holds for those after it up to the first one of the next block.

An id with several rows is one document. Its rows follow each other, and it is no part of a
block: its words are sent under its own id with their counts, and come back to all its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramrank.operators.counts import in_slices, row_words

#: Bytes of text whose words are sent together, at least, if a partition has as many.
BLOCK_BYTES = 32 << 20
#: Parts of a block after which its words are added up.
PARTS = 32
#: Rows of words handed on at a time.
OUT_ROWS = 1 << 16
#: Stands for any word: sent by all that have one, so it is found in every document.
ANY = ""

NAMES = ["doc_id", "word", "n"]


class _Words:
    """Words with their counts, added up part by part."""

    def __init__(self) -> None:
        self.id: object = None
        self.bytes = 0
        self.words: list[pa.Array] = []
        self.counts: list[np.ndarray] = []

    def add(self, words: pa.Array, counts: np.ndarray) -> None:
        self.words.append(words)
        self.counts.append(counts)
        if len(self.words) == PARTS:
            self._add_up()

    def _add_up(self) -> None:
        encoded = pa.concat_arrays(self.words).dictionary_encode()
        weights = np.concatenate(self.counts)
        codes = encoded.indices.to_numpy(zero_copy_only=False)
        self.words = [encoded.dictionary]
        self.counts = [np.bincount(codes, weights, len(encoded.dictionary)).astype(np.int64)]

    def rows(self, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        """The words under the id."""
        if sum(map(len, self.words)):
            self._add_up()
            words, counts = self.words[0], pa.array(self.counts[0])
            ids = pa.repeat(pa.scalar(self.id, id_type), len(words))
            yield pa.record_batch([ids, words, counts], names=NAMES)


class _Document(_Words):
    """The words of a document of several rows; counts are negative but for ``ANY``."""

    def rows(self, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        for batch in super().rows(id_type):
            yield pa.record_batch([batch[0], batch[1], pc.negate(batch[2])], names=NAMES)
            yield pa.record_batch([batch[0][:1], pa.array([ANY]), pa.array([1])], names=NAMES)


def _shared(ids: pa.Array, before: object, after: object) -> np.ndarray:
    """Whether a row beside the row has its id, those ``before`` and ``after`` included."""
    ends = [pa.array([one], ids.type) for one in (before, after)]
    around = pa.concat_arrays([ends[0], ids, ends[1]])
    same = pc.equal(around.slice(0, len(ids) + 1), around.slice(1)).fill_null(False)
    same = same.to_numpy(zero_copy_only=False)
    return same[:-1] | same[1:]


def _with_shared(
    parts: Iterator[pa.RecordBatch],
) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    before, held = None, None
    for part in parts:
        if held is not None:
            yield held, _shared(held.column(0), before, part.column(0)[0].as_py())
            before = held.column(0)[-1].as_py()
        held = part
    if held is not None:
        yield held, _shared(held.column(0), before, None)


def _count_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block, own, ids = _Words(), _Document(), None
    parts = (part for batch in batches for part in in_slices(batch, 1))
    for part, shared in _with_shared(parts):
        ids = part.column(0)
        row, word, n, dictionary = row_words(part.column(1))
        if not shared.all() and block.id is None:
            block.id = ids[int(np.argmin(shared))].as_py()
        alone = ~shared[row]
        if alone.any():
            docs = np.bincount(word[alone], minlength=len(dictionary))
            there = np.flatnonzero(docs)
            block.add(dictionary.take(pa.array(there)), docs[there])
            block.add(pa.array([ANY]), np.array([len(np.unique(row[alone]))]))
        for at in np.flatnonzero(shared):
            one = ids[int(at)].as_py()
            if one != own.id:
                yield from own.rows(ids.type)
                own = _Document()
                own.id = one
            low, high = np.searchsorted(row, [at, at + 1])
            own.add(dictionary.take(pa.array(word[low:high])), n[low:high])
        block.bytes += part.column(1).nbytes
        if block.bytes >= BLOCK_BYTES:
            yield from block.rows(ids.type)
            block = _Words()
    if ids is not None:
        yield from own.rows(ids.type)
        yield from block.rows(ids.type)


def _together(batches: Iterator[pa.RecordBatch], rows: int = OUT_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``rows`` at least, but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= rows:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def block_words(texts: DataFrame) -> DataFrame:
    """``[doc_id, word, n]`` of ``[doc_id, body]``, placed by id: each word of a block under
    the id of the block's first document, with the number of its documents that have it. Of a
    document of several rows ``n`` is how often it has the word, negative. All have ``ANY``
    too, if they have words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _together(_count_blocks(batches))

    id_type = texts.schema["doc_id"].dataType.simpleString()
    in_order = texts.select("doc_id", "body").sortWithinPartitions("doc_id")
    return in_order.mapInArrow(count, f"doc_id {id_type}, word string not null, n bigint")


def _pack(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows in order of their ids as lists, a row an id."""
    ids, word, n, df = batch.columns
    changed = pc.not_equal(ids.slice(1), ids.slice(0, len(ids) - 1))
    starts = np.concatenate([[0], np.flatnonzero(changed.to_numpy(zero_copy_only=False)) + 1])
    offsets = pa.array(np.append(starts, len(ids)).astype(np.int32))
    n, any_word = n.to_numpy(), pc.equal(word, ANY).to_numpy(zero_copy_only=False)
    # counts of a document; words of a block have none, nor has a list with a part without
    is_block = pa.array(np.maximum.reduceat(np.where(any_word, -1, n), starts) > 0)
    ns = pa.ListArray.from_arrays(offsets, pa.array(np.abs(n)), mask=is_block)
    total = np.add.reduceat(np.where(any_word, df.to_numpy(), 0), starts)
    return pa.record_batch(
        [
            ids.take(pa.array(starts)),
            pa.ListArray.from_arrays(offsets, word),
            pa.ListArray.from_arrays(offsets, df),
            ns,
            pa.array(total),
        ],
        names=["doc_id", "words", "dfs", "ns", "n_docs"],
    )


def one_row_a_block(found: DataFrame) -> DataFrame:
    """``[doc_id, words, dfs, ns, n_docs]``: rows ``[doc_id, word, n, df]`` of a block's words
    as arrays, ``ns`` if it is a document of several rows, and the ``df`` of ``ANY``. Tasks
    put together what they have of a block before it crosses the network."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _together(batch for batch in batches if batch.num_rows):
            yield _pack(batch)

    id_type = found.schema["doc_id"].dataType.simpleString()
    lists = "words array<string>, dfs array<bigint>, ns array<bigint>"
    packed = (
        found.select("doc_id", "word", "n", "df")
        .sortWithinPartitions("doc_id")
        .mapInArrow(pack, f"doc_id {id_type}, {lists}, n_docs bigint")
        .groupBy("doc_id")
        .agg(
            F.collect_list(F.struct("words", "dfs", "ns")).alias("parts"),
            F.max("n_docs").alias("n_docs"),
        )
    )
    flat = [F.flatten(F.col(f"parts.{name}")).alias(name) for name in ("words", "dfs", "ns")]
    return packed.select("doc_id", *flat, "n_docs")


def _row_ids(lists: pa.Array) -> np.ndarray:
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists), dtype=np.int64), sizes)


#: Words of some rows: row, count and value of each, and the words themselves.
Terms = tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]


def listed_terms(words: pa.Array, ns: pa.Array, values: pa.Array) -> Terms:
    """Of rows that have lists of their own."""
    counts, found = (x.flatten().to_numpy(zero_copy_only=False) for x in (ns, values))
    return _row_ids(words), counts, found, words.flatten()


def looked_up_terms(texts: pa.Array, known: pa.Array, values: np.ndarray) -> Terms:
    """Of rows whose texts (lists of parts) have no other words than those ``known``."""
    row, word, n, dictionary = row_words(texts.flatten(), _row_ids(texts))
    at = pc.index_in(dictionary, known)
    if at.null_count and pc.any(pc.not_equal(dictionary.filter(at.is_null()), "")).as_py():
        raise RuntimeError("a block has words that it had not when they were counted")
    at = at.fill_null(0).to_numpy(zero_copy_only=False)
    return row, n, values[at[word]] if len(known) else np.zeros(0), dictionary.take(pa.array(word))


def with_values(
    batches: Iterator[pa.RecordBatch], first_list: int
) -> Iterator[tuple[pa.RecordBatch, pa.Array | None, np.ndarray | None]]:
    """Rows in order of their ids, of which column ``first_list`` and the next two have a
    block's words, values and counts, in runs. A run's rows have lists of their own, or come
    with the words and values that hold for all of them."""
    known, values = pa.array([], pa.string()), np.zeros(0)
    for batch in batches:
        own = batch.column(first_list + 2).is_valid().to_numpy(zero_copy_only=False)
        first = batch.column(first_list).is_valid().to_numpy(zero_copy_only=False) & ~own
        bounds = np.unique([0, *np.flatnonzero(first), batch.num_rows])
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            part, listed = batch.slice(low, high - low), pa.array(own[low:high])
            if first[low]:
                known, values = (part.column(first_list + i)[0].values for i in (0, 1))
                values = values.to_numpy(zero_copy_only=False)
            if not own[low:high].any():
                yield part, known, values
                continue
            yield part.filter(listed), None, None
            if not own[low:high].all():
                yield part.filter(pc.invert(listed)), known, values
