"""Reading saved point, cluster and elbow text back into typed rows.

A name may itself contain ", ", so coordinates are taken from the end of the
entry and the name is everything before them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gramrank import schemas

_NUMBER = r"[-+0-9.eE]+"
_ENTRY = rf"^[(]?(.*), ({_NUMBER}), ({_NUMBER})[)]*$"


def _entry_fields(entry: Column, prefix: str = "") -> list[Column]:
    return [
        F.regexp_extract(entry, _ENTRY, 1).alias(f"{prefix}name"),
        F.regexp_extract(entry, _ENTRY, 2).try_cast("double").alias(f"{prefix}x"),
        F.regexp_extract(entry, _ENTRY, 3).try_cast("double").alias(f"{prefix}y"),
    ]


def parse_points(lines: DataFrame) -> DataFrame:
    """``[name, x, y]`` from ``(name, x, y)`` lines."""
    found = lines.where(F.col("value").rlike(_ENTRY)).select(*_entry_fields(F.col("value")))
    return found.to(schemas.POINTS)


def parse_assignments(lines: DataFrame) -> DataFrame:
    """``[centroid_id, cx, cy, name, x, y]`` from ``(centroid_id, cx, cy, name, x, y)``
    lines, as the clusters job writes them."""
    head = rf"^[(]([0-9]+), ({_NUMBER}), ({_NUMBER}), (.*), ({_NUMBER}), ({_NUMBER})[)]$"
    part = lambda i: F.regexp_extract("value", head, i)
    return (
        lines.where(F.col("value").rlike(head))
        .select(
            part(1).try_cast("int").alias("centroid_id"),
            part(2).try_cast("double").alias("cx"),
            part(3).try_cast("double").alias("cy"),
            part(4).alias("name"),
            part(5).try_cast("double").alias("x"),
            part(6).try_cast("double").alias("y"),
        )
        .to(schemas.ASSIGNMENTS)
    )


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Results written by ``write_table``, with the schema they must have."""
    return spark.read.parquet(path).to(schema)


def parse_elbow(lines: DataFrame) -> DataFrame:
    """``[k, sse]`` from ``(k,sse)`` lines."""
    pair = F.split(F.regexp_replace("value", "^[(]|[)]$", ""), ",")
    return lines.select(
        F.get(pair, 0).try_cast("int").alias("k"), F.get(pair, 1).try_cast("double").alias("sse")
    ).to(schemas.ELBOW)


def _cluster_fields(rows: DataFrame) -> DataFrame:
    """Typed columns of ``[centroid, member]`` texts."""
    centroid_name, cx, cy = _entry_fields(F.col("centroid"), "c")
    return rows.select(
        F.regexp_extract(centroid_name, "([0-9]+)$", 1).try_cast("int").alias("centroid_id"),
        cx.alias("cx"),
        cy.alias("cy"),
        *_entry_fields(F.col("member")),
    )


def parse_clusters(lines: DataFrame) -> DataFrame:
    """``[centroid_id, cx, cy, name, x, y]`` from saved clusters, one per line:
    ``((centroid, x, y),[(name, x, y), (name, x, y)])``. A line is a row here; clusters in
    files, which may be of any size, are read by ``read_clusters``."""
    halves = F.split("value", r",\[", 2)
    centroid = F.regexp_replace(F.get(halves, 0), r"^[(]{2}", "(")
    members = F.split(F.regexp_replace(F.get(halves, 1), r"[)]?\]?[)]?$", ""), r"[)], [(]")
    return _cluster_fields(lines.select(centroid.alias("centroid"), F.explode(members).alias("member")))


#: What stands between two members of a saved cluster, and between its head and its list.
MEMBER_GAP = "), ("
HEAD_GAP = "),["

CARRIED = "split long, centroid string, member string, file string, start long"


def _carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of one task with the centroid that stands before them in their split, null
    where the split has none yet. Each split ends with a row without a member, which has
    the last centroid in it and where the split lies.

    A record is what lies between two member gaps. Where a cluster ends, its last member is
    followed by the next clusters, a line each, up to the first gap in one of them."""
    split, centroid, place = None, None, (None, None)
    for batch in batches:
        rows: list[tuple] = []
        for value, number, *here in zip(*[column.to_pylist() for column in batch.columns]):
            if number != split:
                if split is not None:
                    rows.append((split, centroid, None, *place))
                split, centroid, place = number, None, here
            for line in value.split("\n"):
                member = line.rstrip("\r")
                head, gap, first = member.partition(HEAD_GAP)
                if gap and head.startswith("(("):
                    centroid, member = head[1:], first.removeprefix("(")
                member = member.removesuffix(")])")
                if member not in ("", "])"):
                    rows.append((split, centroid, member, None, None))
        yield _carried_batch(rows)
    if split is not None:
        yield _carried_batch([(split, centroid, None, *place)])


def _carried_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64())
    return pa.record_batch(
        [pa.array(column, kind) for column, kind in zip(columns, kinds)],
        names=["split", "centroid", "member", "file", "start"],
    )


def read_clusters(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``[centroid_id, cx, cy, name, x, y]`` of saved clusters, read member by member.

    A cluster of any size is cut like any other file: the reader's line separator is what
    stands between two members, so a member is a row, and only the centroid has to be
    carried forward. Within an input split that is done by the task that reads it. Members
    in front of a split's first centroid get the last one of the splits before it in the
    file; that takes a row per split, found in a pass of its own. A cluster without members
    gives no rows.
    """
    file, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    records = spark.read.schema(schemas.LINES).option("lineSep", MEMBER_GAP).text(path)
    placed = records.select("value", F.xxhash64(file, start).alias("split"), file, start)
    carried = placed.mapInArrow(_carried, CARRIED)
    earlier = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    before = carried.where("member is null").select(
        "split", F.last("centroid", ignorenulls=True).over(earlier).alias("before")
    )
    members = carried.where("member is not null").join(before, "split", "left")
    return _cluster_fields(
        members.select(
            F.coalesce("centroid", "before").alias("centroid"),
            F.concat(F.lit("("), "member").alias("member"),
        )
    ).to(schemas.ASSIGNMENTS)
