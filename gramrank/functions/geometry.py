"""Distances between points of the plane."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramrank.functions.nearest import CentreTree


def distance(x: Column, y: Column, cx: Column | float, cy: Column | float) -> Column:
    dx, dy = x - cx, y - cy
    return F.sqrt(dx * dx + dy * dy)


def with_nearest(
    points: DataFrame, centroids: Sequence[tuple[int, float, float]]
) -> DataFrame:
    """``points`` with ``[centroid_id, cx, cy, d]`` of the nearest centroid; the first
    one listed wins a tie. Points without coordinates are left out.

    Centroids are held in a tree (``CentreTree``), so a point meets few of them however
    many there are. Only the coordinates go to Python, in Arrow batches; neither a join nor
    a shuffle is needed, and the plan does not grow with the number of centroids.
    """
    own = points.columns
    ids, xs, ys = zip(*[(int(cid), float(cx), float(cy)) for cid, cx, cy in centroids])
    tree, ids = CentreTree(xs, ys), np.array(ids, dtype=np.int32)

    @F.arrow_udf("struct<centroid_id: int, cx: double, cy: double, d: double>")
    def nearest(x: pa.Array, y: pa.Array) -> pa.Array:
        place, far = tree.nearest(x.to_numpy(), y.to_numpy())
        found = {
            "centroid_id": ids[place], "cx": tree.x[place], "cy": tree.y[place], "d": far
        }
        return pa.StructArray.from_arrays(list(map(pa.array, found.values())), list(found))

    return (
        points.dropna(subset=["x", "y"])
        .withColumn("_nearest", nearest("x", "y"))
        .select(*own, "_nearest.*")
    )
