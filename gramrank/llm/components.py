"""Connected components of a graph given as edges, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramrank.session import new_shared_path


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = new_shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _is_done(forest: DataFrame) -> bool:
    """Whether every child has one parent and no parent is a child."""
    roles = forest.select(F.col("child").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    roles = roles.unionByName(
        forest.select(F.col("parent").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = roles.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(edges: DataFrame, low: str, high: str) -> DataFrame:
    """``[node, component]`` of the nodes that edges ``low``, ``high`` touch; the component
    is its smallest node, which has no row of its own.

    Every round hangs the neighbours of each node on the smallest of them, first the
    larger neighbours, then the smaller ones, until all hang on roots. Least
    neighbours are aggregated before any shuffle, so a node with very many edges is not
    gathered anywhere. Each round is written to the shared folder."""
    a, b = F.col(low), F.col(high)
    forest = _stored(
        edges.where(a != b)
        .select(F.greatest(a, b).alias("child"), F.least(a, b).alias("parent"))
        .distinct(),
        "edges",
    )
    while not _is_done(forest):
        both = forest.unionByName(
            forest.select(F.col("parent").alias("child"), F.col("child").alias("parent"))
        ).toDF("node", "other")
        # written, so that Spark can split the rows of a node with very many edges
        least = _stored(
            both.groupBy("node")
            .agg(F.min("other").alias("other"))
            .select("node", F.least("node", "other").alias("least")),
            "least",
        )
        large = (
            both.where("other > node")
            .join(least, "node")
            .select(F.col("other").alias("child"), F.col("least").alias("parent"))
            .distinct()
        )
        smallest = large.groupBy("child").agg(F.min("parent").alias("least"))
        hung = (
            large.join(smallest, "child")
            .where("parent <> least")
            .select(F.col("parent").alias("child"), F.col("least").alias("parent"))
        )
        forest = _stored(
            hung.unionByName(smallest.withColumnRenamed("least", "parent")).distinct(), "edges"
        )
    return forest.select(F.col("child").alias("node"), F.col("parent").alias("component"))
