"""Hard negatives: rows of other labels that are nearly as near as an anchor's positives.

All anchors meet all rows, in blocks. Rows are spread over blocks of bounded size by a
hash, so a hot label is no hot block, and a task holds one block of rows and one of
anchors. Within a task, one-bit codes give an interval for every inner product; only rows
whose interval reaches what an anchor still looks for are scored, in whole numbers. Each
block hands on its few best rows of an anchor, which are merged by Spark.

Two passes: the positives of an anchor, by way of rows of its label, and then the rows of
other labels whose scores lie in the window below a positive's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gramrank.llm import onebit
from gramrank.session import cut_lineage, new_shared_path

#: Bytes of vectors, and rows at most, in a block of rows or anchors.
BLOCK_BYTES = 32 << 20
BLOCK_ROWS = 65_536
#: Rows of a block below which there is no use in having more blocks.
FEW_ROWS = 1024
#: Anchors and rows whose intervals are computed at a time; after each, the bar rises.
TILE = 64, 1024
#: Share of a tile from which scoring all of it is faster than picking rows.
DENSE = 0.2
#: Stands for a null id, which comes last among equal scores.
NO_ID = (1 << 63) - 1

CODED = (
    "key long, id long, label long, anchor boolean,"
    " vector binary, code binary, alignment double, rest double"
)
FOUND = "anchor_key long, place int, key long, id long, score long"


def _encoded(dimensions: int, seed: int) -> Callable:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                vectors = np.zeros((part.num_rows, dimensions), dtype="<i4")
                for i, vector in enumerate(part.column(4)):
                    vectors[i, : len(vector)] = vector.values.to_numpy()
                codes = onebit.encode(vectors, seed)
                blob = lambda rows: pa.array([row.tobytes() for row in rows], pa.binary())
                yield pa.record_batch(
                    [
                        *part.columns[:4],
                        blob(vectors),
                        blob(codes.words),
                        pa.array(codes.alignment),
                        pa.array(codes.rest),
                    ],
                    names=["key", "id", "label", "anchor", "vector", "code", "alignment", "rest"],
                )

    return encode


class _Block:
    """Rows of an Arrow table as arrays, sorted by label."""

    def __init__(self, table: pa.Table):
        table = table.sort_by([("label", "ascending"), ("key", "ascending")]).combine_chunks()
        self.table = table
        self.key = table["key"].to_numpy()
        self.id = table["id"].fill_null(NO_ID).to_numpy()
        self.label = table["label"].to_numpy()
        self.vector = self._matrix("vector", "<i4")
        self.codes = onebit.Codes(
            self._matrix("code", "<u8"), table["alignment"].to_numpy(), table["rest"].to_numpy()
        )
        self.length = np.sqrt((self.vector.astype(np.float64) ** 2).sum(axis=1))

    def _matrix(self, name: str, kind: str) -> np.ndarray:
        blob = b"".join(value.as_py() for value in self.table[name])
        return np.frombuffer(blob, dtype=kind).reshape(len(self.table), -1)


def _scores(
    anchors: _Block, low: int, high: int, rows: _Block, first: int, wanted: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place among the tile's anchors, row and whole-number score of the wanted pairs."""
    a, r = np.nonzero(wanted)
    if not len(a):
        return a, r + first, np.empty(0, dtype=np.int64)
    queries = anchors.vector[low:high]
    tile = rows.vector[first : first + wanted.shape[1]]
    most = anchors.length[low:high].max() * rows.length[first : first + wanted.shape[1]].max()
    if most >= 1 << 62:
        raise ValueError("inner products exceed 64 bits")
    # below 2 ** 53 sums of whole numbers are exact in doubles
    kind = np.float64 if most * 2 < 1 << 53 else np.int64
    if len(a) > DENSE * wanted.size:
        score = (queries.astype(kind) @ tile.astype(kind).T)[a, r]
    else:
        score = np.empty(len(a), dtype=kind)
        at_once = max(1, (1 << 20) // queries.shape[1])
        for i in range(0, len(a), at_once):
            some = slice(i, i + at_once)
            score[some] = np.einsum(
                "ij,ij->i", queries[a[some]].astype(kind), tile[r[some]].astype(kind)
            )
    return a, r + first, score.astype(np.int64)


class _Best:
    """The ``k`` best rows of each group: highest score, then smallest id, then key."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.group, self.row, self.score = (np.empty(0, dtype=np.int64) for _ in range(3))
        self.bar = np.full(groups, -np.inf)

    def add(self, group: np.ndarray, row: np.ndarray, score: np.ndarray, rows: _Block) -> None:
        reached = score >= self.bar[group]
        group = np.concatenate([self.group, group[reached]])
        row = np.concatenate([self.row, row[reached]])
        score = np.concatenate([self.score, score[reached]])
        order = np.lexsort((rows.key[row], rows.id[row], -score, group))
        group, row, score = group[order], row[order], score[order]
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        place = np.arange(len(group)) - np.repeat(starts, np.diff(starts, append=len(group)))
        kept = place < self.k
        last = place == self.k - 1
        self.bar[group[last]] = score[last]
        self.group, self.row, self.score = group[kept], row[kept], score[kept]


def _result(anchors: _Block, rows: _Block, found: list[tuple[int, int, _Best]]) -> pa.Table:
    """``found`` has, for each tile of anchors, its first anchor and its places."""
    group = [low + best.group // places for low, places, best in found]
    place = [best.group % places for _, places, best in found]
    empty = [np.empty(0, dtype=np.int64)]
    row = np.concatenate(empty + [best.row for *_, best in found])
    return pa.table(
        {
            "anchor_key": pa.array(anchors.key[np.concatenate(empty + group)]),
            "place": pa.array(np.concatenate(empty + place).astype(np.int32)),
            "key": pa.array(rows.key[row]),
            "id": rows.table["id"].take(pa.array(row)),
            "score": pa.array(np.concatenate(empty + [best.score for *_, best in found])),
        }
    )


def find_positives(k: int, seed: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The ``k`` best rows of each anchor's label in a block, without the anchor itself."""

    def find(row_table: pa.Table, anchor_table: pa.Table) -> pa.Table:
        rows, anchors = _Block(row_table), _Block(anchor_table)
        queries = onebit.Queries(anchors.vector, seed)
        found = []
        for label in np.unique(anchors.label):
            mine = [np.searchsorted(anchors.label, label, side) for side in ("left", "right")]
            theirs = [np.searchsorted(rows.label, label, side) for side in ("left", "right")]
            for low in range(mine[0], mine[1], TILE[0]):
                high = min(low + TILE[0], mine[1])
                best = _Best(high - low, k)
                for first in range(theirs[0], theirs[1], TILE[1]):
                    end = min(first + TILE[1], theirs[1])
                    least, most = queries.intervals(low, high, rows.codes.part(first, end))
                    other = anchors.key[low:high, None] != rows.key[None, first:end]
                    bar = best.bar
                    if end - first > k:
                        sure = np.where(other, least, -np.inf)
                        bar = np.maximum(bar, np.partition(sure, -k, axis=1)[:, -k])
                    wanted = other & (most >= bar[:, None])
                    a, r, score = _scores(anchors, low, high, rows, first, wanted)
                    best.add(a, r, score, rows)
                found.append((low, 1, best))
        return _result(anchors, rows, found)

    return find


def find_negatives(k: int, low_at: int, high_at: int, per: int, seed: int) -> Callable:
    """For each positive of an anchor (``positive_scores``), the ``k`` best rows of a block
    with another label and a score in the positive's window."""

    def find(row_table: pa.Table, anchor_table: pa.Table) -> pa.Table:
        rows, anchors = _Block(row_table), _Block(anchor_table)
        queries = onebit.Queries(anchors.vector, seed)
        lists = anchors.table["positive_scores"].to_pylist()
        places = max(map(len, lists))
        found = []
        for low in range(0, len(lists), TILE[0]):
            high = min(low + TILE[0], len(lists))
            # a place without a positive has a window that nothing lies in
            floor = np.ones((high - low, places), dtype=np.int64)
            ceiling = np.zeros_like(floor)
            for i, scores in enumerate(lists[low:high]):
                for place, score in enumerate(scores):
                    floor[i, place] = -(-low_at * score // per)
                    ceiling[i, place] = high_at * score // per
            is_open = floor <= ceiling
            top = np.where(is_open, ceiling, -np.inf).max(axis=1)
            best = _Best((high - low) * places, k)
            for first in range(0, len(rows.key), TILE[1]):
                end = min(first + TILE[1], len(rows.key))
                least, most = queries.intervals(low, high, rows.codes.part(first, end))
                bar = np.maximum(best.bar.reshape(-1, places), floor)
                bar = np.where(is_open, bar, np.inf).min(axis=1)
                wanted = (most >= bar[:, None]) & (least <= top[:, None])
                wanted &= anchors.label[low:high, None] != rows.label[None, first:end]
                a, r, score = _scores(anchors, low, high, rows, first, wanted)
                inside = (floor[a] <= score[:, None]) & (score[:, None] <= ceiling[a])
                pair, place = np.nonzero(inside)
                best.add(a[pair] * places + place, r[pair], score[pair], rows)
            found.append((low, places, best))
        return _result(anchors, rows, found)

    return find


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best over all blocks, with ``rank`` from 1."""
    order = W.partitionBy("anchor_key", "place").orderBy(
        F.desc("score"), F.asc_nulls_last("id"), "key"
    )
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocks(rows: int, per_block: int, tasks: int) -> int:
    """Blocks of at most ``per_block`` rows on the average; more for all cores to work."""
    return max(-(-rows // per_block), min(tasks, -(-rows // FEW_ROWS)), 1)


def mine_hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    per: int = 100,
    seed: int = 7,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``[anchor_id, positive_id, rank, negative_id, positive_score, negative_score]``.

    ``vectors`` is ``[id long, label long, vector array<int>]``; scores are inner products.
    Rows for which ``anchor`` holds are anchors. An anchor's positives are its first
    ``positives`` other rows of the same label, highest scores first and then smallest ids;
    its hard negatives for a positive the first ``negatives`` rows of other labels with
    ``low * positive_score <= per * score <= high * positive_score``. Fewer are returned
    where there are no more; a window below a negative score is empty.

    Rows with a null label or vector take no part. Rows that repeat an id are separate rows,
    and an anchor's copy is one of its positives; a null id is no anchor unless ``anchor``
    says so, and comes last among equal scores. Shorter vectors count as filled up with
    zeros. An empty table gives no rows. Runs when called: rows are written with their
    codes, so that both passes and every retry see the same ones.
    """
    spark = vectors.sparkSession
    usable = vectors.where("label is not null and vector is not null")
    dimensions = usable.agg(F.max(F.size("vector"))).first()[0] or 1
    keyed = usable.select(
        F.monotonically_increasing_id().alias("key"),
        F.col("id").cast("long"),
        F.col("label").cast("long"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col("vector").cast("array<int>"),
    )
    path = new_shared_path(spark, "negatives-rows")
    keyed.mapInArrow(_encoded(dimensions, seed), CODED).write.parquet(path)
    rows = spark.read.parquet(path)
    n_rows, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if("anchor")).first()
    per_block = max(1, min(block_rows, BLOCK_BYTES // (4 * dimensions)))
    row_blocks = _blocks(n_rows, per_block, 2 * spark.sparkContext.defaultParallelism)
    anchor_blocks = max(-(-n_anchors // per_block), 1)

    def drawn(blocks: int) -> Column:
        return F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(blocks)).cast("int")

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    def met(anchors: DataFrame, find: Callable) -> DataFrame:
        """Every block of rows with every block of anchors."""
        keys = ["row_block", "anchor_block"]
        left = rows.withColumn("row_block", drawn(row_blocks))
        left = left.withColumn("anchor_block", every(anchor_blocks))
        right = anchors.withColumn("anchor_block", drawn(anchor_blocks))
        right = right.withColumn("row_block", every(row_blocks))
        return (
            left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_without_keys(find), FOUND)
        )

    # read anew: Spark tells the two sides of a block apart by their columns' origin
    anchors = spark.read.parquet(path).where("anchor")
    best = _merged(met(anchors, find_positives(positives, seed)), positives)
    chosen = cut_lineage(
        best.groupBy("anchor_key").agg(
            F.array_sort(F.collect_list(F.struct("rank", "score", "id"))).alias("positives")
        )
    )
    with_scores = anchors.join(
        chosen.select(F.col("anchor_key").alias("key"), "positives.score"), "key"
    ).withColumnRenamed("score", "positive_scores")
    find = find_negatives(negatives, low, high, per, seed)
    ranked = _merged(met(with_scores, find), negatives)
    places = chosen.select("anchor_key", F.posexplode("positives").alias("place", "positive"))
    names = anchors.select(F.col("key").alias("anchor_key"), F.col("id").alias("anchor_id"))
    return (
        ranked.join(places, ["anchor_key", "place"])
        .join(names, "anchor_key")
        .select(
            "anchor_id",
            F.col("positive.id").alias("positive_id"),
            "rank",
            F.col("id").alias("negative_id"),
            F.col("positive.score").alias("positive_score"),
            F.col("score").alias("negative_score"),
        )
    )


def _without_keys(find: Callable) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A block without rows or without anchors finds nothing."""

    def guarded(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if rows.num_rows and anchors.num_rows:
            return find(rows, anchors)
        kinds = {"place": pa.int32()}
        names = ("anchor_key", "place", "key", "id", "score")
        return pa.table({name: pa.array([], kinds.get(name, pa.int64())) for name in names})

    return guarded
