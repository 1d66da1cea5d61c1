"""Best values of many groups, without sorting or holding a group's values."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def best_values(df: DataFrame, keys: list[str], value: str, k: int) -> DataFrame:
    """``[*keys, best]``: the ``k`` largest values of each group, largest first, as an array
    of doubles. Equal values count separately, nulls do not; ``value`` is no NaN, and keys are
    no floating-point numbers.

    Each task hands on at most ``k`` values of a group from a batch, so a group is never
    brought together. After one shuffle the arrays are sorted by key, once, and merged in
    passing: no aggregate holds the groups of a task, or sorts them on both sides.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(len(keys)).is_valid())
            if batch.num_rows:
                yield _best_of_batch(batch, len(keys), k)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                batch = pa.concat_batches([*held, batch])
                # the last group may go on in the next batch
                last = _last_group(batch, len(keys))
                if last:
                    yield _merged(batch.slice(0, last), len(keys), k)
                held = [_merged(batch.slice(last), len(keys), k)]
        yield from held

    schema = ", ".join(
        f"`{name}` {df.schema[name].dataType.simpleString()}" for name in keys
    )
    rows = df.select(*keys, F.col(value).cast("double"))
    schema = f"{schema}, best array<double>"
    arrays = rows.mapInArrow(partial, schema).repartition(*keys)
    return arrays.sortWithinPartitions(*keys).mapInArrow(merge, schema)


def _last_group(batch: pa.RecordBatch, n_keys: int) -> int:
    """First row of the last group of a batch in order of its keys."""
    other = np.zeros(batch.num_rows, dtype=bool)
    for column in batch.columns[:n_keys]:
        codes = column.dictionary_encode("encode").indices.to_numpy()
        other |= codes != codes[-1]
    return batch.num_rows - int(np.argmax(other[::-1])) if other.any() else 0


def _merged(batch: pa.RecordBatch, n_keys: int, k: int) -> pa.RecordBatch:
    """``_best_of_batch`` of rows that have arrays of values."""
    best = batch.column(n_keys)
    rows = np.repeat(np.arange(len(best)), best.value_lengths().to_numpy())
    columns = [column.take(pa.array(rows)) for column in batch.columns[:n_keys]]
    values = pa.record_batch([*columns, best.flatten()], names=batch.schema.names)
    return _best_of_batch(values, n_keys, k)


def _best_of_batch(batch: pa.RecordBatch, n_keys: int, k: int) -> pa.RecordBatch:
    codes = [
        column.dictionary_encode("encode").indices.to_numpy() for column in batch.columns[:n_keys]
    ]
    values = batch.column(n_keys).to_numpy()
    order = np.lexsort((-values, *codes))
    changed = np.zeros(len(order), dtype=bool)
    changed[0] = True
    for code in codes:
        changed[1:] |= np.diff(code[order]) != 0
    starts = np.flatnonzero(changed)
    sizes = np.diff(starts, append=len(order))
    kept = np.arange(len(order)) - np.repeat(starts, sizes) < k
    offsets = np.concatenate([[0], np.cumsum(np.minimum(sizes, k))]).astype(np.int32)
    heads = pa.array(order[starts])
    return pa.record_batch(
        [
            *[column.take(heads) for column in batch.columns[:n_keys]],
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[order[kept]])),
        ],
        names=[*batch.schema.names[:n_keys], "best"],
    )
