"""k-means in the plane with a fixed number of rounds, and the elbow curve.

Centroids (k per run) live on the driver between rounds; points stay where they are. A
round is one pass in Arrow batches for all runs, and only k partial sums per task are
shuffled. Points without coordinates take no part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramrank import schemas
from gramrank.functions.geometry import with_nearest
from gramrank.functions.nearest import CentreTree
from gramrank.operators.sampling import draw_rows

Centroids = list[tuple[int, float, float]]

#: Points a task takes through a run's tree at a time.
POINTS_AT_ONCE = 20_000


def assign(points: DataFrame, centroids: Sequence[tuple[int, float, float]]) -> DataFrame:
    """``[centroid_id, cx, cy, name, x, y, d]``: points with their nearest centroid
    and the distance to it."""
    return with_nearest(points.select("name", "x", "y"), centroids).select(
        "centroid_id", "cx", "cy", "name", "x", "y", "d"
    )


def centroid_means(assigned: DataFrame) -> DataFrame:
    """``[centroid_id, cx, cy, members]``: mean point of each cluster."""
    return assigned.groupBy("centroid_id").agg(
        F.avg("x").alias("cx"), F.avg("y").alias("cy"), F.count("*").alias("members")
    )


def cluster_sse(assigned: DataFrame) -> DataFrame:
    """``[centroid_id, sse]``: sum of squared distances of each cluster."""
    return assigned.groupBy("centroid_id").agg(F.sum(F.col("d") * F.col("d")).alias("sse"))


def draw_centroids(
    points: DataFrame,
    ks: Sequence[int],
    seed: int | None = None,
    key: list[str] | None = None,
) -> list[Centroids]:
    """Random starts, one list of k centroids for each k asked for. The x and the y
    of a centroid are drawn separately. ``key`` tells points apart, all columns if not
    given."""
    wanted = sum(ks)
    drawn = draw_rows(points, 2 * wanted, seed, key)
    xs = iter([row["x"] for row in drawn[:wanted]])
    ys = iter([row["y"] for row in drawn[wanted:]])
    return [[(cid, next(xs), next(ys)) for cid in range(k)] for k in ks]


def _move(points: DataFrame, centroids: Centroids) -> Centroids:
    """One round: the mean points of the clusters around the given centroids. At most
    k rows come back; a centroid without points is gone."""
    return _move_all(points, [centroids])[0][0]


def _move_all(points: DataFrame, runs: list[Centroids]) -> tuple[list[Centroids], list[float]]:
    """One round for several runs in one pass over the points: the new centroids of
    each run, and the squared distances to the old ones summed up per run.

    A task keeps three sums and a count per centroid and hands on one row for each. The
    centroids of a run are held in a tree, so a point meets few of them. Points are taken
    in slices, so that what is held at a time is bounded whatever comes in a batch.
    """
    trees = [CentreTree([cx for _, cx, _ in run], [cy for _, _, cy in run]) for run in runs]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((4, len(tree.x))) for tree in trees]
        for batch in batches:
            for low in range(0, batch.num_rows, POINTS_AT_ONCE):
                part = batch.slice(low, POINTS_AT_ONCE)
                x, y = part.column(0).to_numpy(), part.column(1).to_numpy()
                for tree, total in zip(trees, totals):
                    place, near = tree.nearest(x, y)
                    for row, weights in zip(total, (None, x, y, near * near)):
                        row += np.bincount(place, weights, len(tree.x))
        sizes = [len(tree.x) for tree in trees]
        yield pa.RecordBatch.from_pydict(
            {
                "run": np.repeat(np.arange(len(sizes), dtype=np.int32), sizes),
                "place": np.concatenate([np.arange(size, dtype=np.int32) for size in sizes]),
                **{
                    name: np.concatenate([total[row] for total in totals])
                    for row, name in enumerate(("n", "x", "y", "sse"))
                },
            }
        )

    rows = (
        points.select("x", "y")
        .mapInArrow(sums, "run int, place int, n double, x double, y double, sse double")
        .groupBy("run", "place")
        .agg(*[F.sum(name).alias(name) for name in ("n", "x", "y", "sse")])
        .where("n > 0")
        .collect()
    )
    moved: list[Centroids] = [[] for _ in runs]
    sse = [0.0 for _ in runs]
    for row in sorted(rows, key=lambda row: (row["run"], row["place"])):
        cid = runs[row["run"]][row["place"]][0]
        moved[row["run"]].append((cid, row["x"] / row["n"], row["y"] / row["n"]))
        sse[row["run"]] += row["sse"]
    return moved, sse


def _cached(points: DataFrame, drawn: bool = False) -> tuple[DataFrame, bool]:
    """The coordinates, kept for the rounds, and whether they are ours to release; all
    columns if centroids are to be drawn. They are dealt out evenly first: a file that is
    read by one task, or splits of very different sizes, would leave the rounds to a few."""
    level = points.storageLevel
    places = points.dropna(subset=["x", "y"])
    if not drawn:
        places = places.select("x", "y")
    if level.useMemory or level.useDisk:
        return places, False
    cores = points.sparkSession.sparkContext.defaultParallelism
    return places.repartition(cores).persist(), True


def kmeans_centroids(
    points: DataFrame,
    k: int,
    max_iter: int,
    seed: int | None = None,
    init: Sequence[tuple[float, float]] | None = None,
) -> Centroids:
    """The centroids that round ``max_iter`` assigns points to."""
    kept, ours = _cached(points, drawn=init is None)
    try:
        if init is not None:
            current: Centroids = [(cid, x, y) for cid, (x, y) in enumerate(init)]
        else:
            current = draw_centroids(kept, [k], seed)[0]
        for _ in range(max_iter - 1):
            current = _move(kept, current)
    finally:
        if ours:
            kept.unpersist()
    return current


def kmeans(
    points: DataFrame,
    k: int,
    max_iter: int,
    seed: int | None = None,
    init: Sequence[tuple[float, float]] | None = None,
) -> DataFrame:
    """``[centroid_id, cx, cy, name, x, y]``: the assignment of the last of
    ``max_iter`` rounds, with the centroids used for it. Clusters that run empty
    are not refilled. ``init`` gives the first k centroids, else they are drawn."""
    centroids = kmeans_centroids(points, k, max_iter, seed, init)
    return assign(points, centroids).drop("d")


def elbow(
    points: DataFrame,
    max_k: int,
    max_iter: int,
    restarts: int = 1,
    seed: int | None = None,
    init: Sequence[tuple[float, float]] | None = None,
    starts: Sequence[Sequence[tuple[float, float]]] | None = None,
    key: list[str] | None = None,
) -> DataFrame:
    """``[k, sse]`` for k = 1..max_k: squared distances of the last round summed
    over clusters and restarts, divided by k.

    All runs of all k share each pass, so the points are read ``max_iter`` times in
    total. With ``init`` run k starts from its first k entries; ``starts`` gives such a
    list for each restart. Else centroids are drawn, from points told apart by ``key``.
    """
    if starts is None and init is not None:
        starts = [init] * restarts
    restarts = restarts if starts is None else len(starts)
    ks = [k for k in range(1, max_k + 1) for _ in range(restarts)]
    kept, ours = _cached(points, drawn=starts is None)
    try:
        if starts is not None:
            current = [
                [(cid, *start[cid]) for cid in range(k)]
                for k in range(1, max_k + 1)
                for start in starts
            ]
        else:
            current = draw_centroids(kept, ks, seed, key)
        sse: list[float] = [0.0 for _ in ks]
        for _ in range(max_iter):
            current, sse = _move_all(kept, current)
    finally:
        if ours:
            kept.unpersist()
    totals = {k: 0.0 for k in range(1, max_k + 1)}
    for k, value in zip(ks, sse):
        totals[k] += value
    return points.sparkSession.createDataFrame(
        [(k, total / k) for k, total in totals.items()], schemas.ELBOW
    )
