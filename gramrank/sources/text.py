"""Text readers and parsers from lines to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gramrank import schemas
from gramrank.functions.text import DELIMITER
from gramrank.session import cut_lineage


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of a file, a folder or several of them as ``[value]``."""
    return spark.read.schema(schemas.LINES).text(path)


def parse_kv(lines: DataFrame) -> DataFrame:
    """``[key, value]`` split at the first tab; the value is empty without a tab."""
    parts = F.split("value", "\t", 2)
    return lines.select(
        F.get(parts, 0).alias("key"), F.coalesce(F.get(parts, 1), F.lit("")).alias("value")
    ).to(schemas.KEY_VALUES)


def read_kv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_kv(read_lines(spark, path))


def parse_fields(lines: DataFrame) -> DataFrame:
    """``[fields]``: the line split at runs of white space; white space at the end
    adds no field, white space in front adds an empty one."""
    body = F.regexp_replace("value", r"\s+$", "")
    return lines.select(F.split(body, r"\s+").alias("fields"))


def read_fields(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_fields(read_lines(spark, path))


def parse_articles(lines: DataFrame) -> DataFrame:
    """``[title, doc_id, body]`` from ``title<====>id<====>body`` lines.

    The id is what stands between the first two delimiters, the body what follows
    the last one. With fewer than two delimiters the id is null; without any the
    whole line is the body.
    """
    head = F.split("value", DELIMITER, 3)
    return lines.select(
        F.when(F.size(head) >= 2, F.get(head, 0)).alias("title"),
        F.when(F.size(head) == 3, F.get(head, 1)).alias("doc_id"),
        F.substring_index("value", DELIMITER, -1).alias("body"),
    ).to(schemas.ARTICLES)


def with_doc_id(articles: DataFrame) -> DataFrame:
    """Articles that have an id; the document level jobs work on these."""
    return articles.where(F.col("doc_id") != "")


def first_per_id(articles: DataFrame) -> DataFrame:
    """One article per id, for inputs in which ids occur more than once: the one whose
    body comes first in byte order, then by its other columns."""
    others = [name for name in articles.columns if name not in ("doc_id", "body")]
    first = articles.groupBy("doc_id").agg(F.min(F.struct("body", *others)).alias("first"))
    return first.select(
        *[F.col(c if c == "doc_id" else f"first.{c}").alias(c) for c in articles.columns]
    )


def parse_links(lines: DataFrame) -> DataFrame:
    """Distinct edges ``[src, dst]`` from ``id: n1 n2 ...`` lines.

    A line without neighbours gives one edge to the empty id.
    """
    parts = F.split(F.regexp_replace("value", r"\s+$", ""), r":\s+")
    lone = F.size(parts) < 2
    src = F.when(lone, F.regexp_replace(F.get(parts, 0), ":$", "")).otherwise(F.get(parts, 0))
    neighbours = F.split(F.when(lone, "").otherwise(F.get(parts, 1)), r"\s+")
    edges = lines.select(src.alias("src"), F.explode(neighbours).alias("dst"))
    return edges.to(schemas.EDGES).distinct()


#: Ranges that the splits of an input are dealt to when their rows are added up.
SPLIT_RANGES = 32


def with_line_ids(lines: DataFrame, value: str = "value") -> DataFrame:
    """``[id, value]`` with the 1-based line number as a string id.

    ``lines`` must come straight from a file scan. Rows of one input split are
    read in order by one task, so the number is the split's offset plus the
    position in the split. Offsets come from one counting pass, made when called, that
    yields a row per split; more than one file is numbered in path order. A split is
    known by a hash of its file and position; how the offsets reach the lines is left to
    Spark.
    """
    tagged = lines.select(
        F.col(value).alias("value"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.xxhash64("_metadata.file_path", "_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_position"),
    )
    splits = tagged.groupBy("_split", "_file", "_start").agg(
        F.count("*").alias("_rows"), F.min("_position").alias("_first")
    )
    offsets = rows_before(splits, ["_file", "_start"], "_rows").select(
        "_split", "_first", "_before"
    )
    line_number = F.col("_before") + F.col("_position") - F.col("_first") + 1
    return tagged.join(offsets, "_split").select(
        line_number.cast("string").alias("id"), "value"
    )


def rows_before(sizes: DataFrame, order: list[str], rows: str) -> DataFrame:
    """``sizes`` with ``_before``: the sum of ``rows`` over all rows that come before in
    the (unique) ``order``. Runs when called.

    In two steps, so that no task sees all of them: rows are dealt to ``SPLIT_RANGES``
    ranges of the order and added up within each; the totals of the ranges are one small
    array, in which each gets the sum of those before it.
    """
    ranged = cut_lineage(
        cut_lineage(sizes)
        .repartitionByRange(SPLIT_RANGES, *order)
        .withColumn("_range", F.spark_partition_id())
    )
    zero = F.lit(0).cast("long")

    def earlier(part: Column) -> Column:
        before = F.filter("parts", lambda other: other["_range"] < part["_range"])
        total = F.aggregate(before, zero, lambda total, other: total + other["total"])
        return F.struct(part["_range"].alias("_range"), total.alias("_earlier"))

    ranges = (
        ranged.groupBy("_range")
        .agg(F.sum(rows).alias("total"))
        .agg(F.collect_list(F.struct("_range", "total")).alias("parts"))
        .select(F.inline(F.transform("parts", earlier)))
    )
    within = W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum(rows).over(within), zero) + F.col("_earlier")
    found = ranged.join(ranges, "_range").withColumn("_before", before)
    return found.select(*sizes.columns, "_before")


def parse_titles(lines: DataFrame) -> DataFrame:
    """``[id, title]``: one title per line, the id is the line number."""
    return with_line_ids(lines).withColumnRenamed("value", "title").to(schemas.TITLES)


def _finite(field: Column) -> Column:
    number = field.try_cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def parse_businesses(lines: DataFrame) -> DataFrame:
    """``[name, state, code, second, stars, reviews, n_parts, n_fields]`` of
    listing lines ``name: ST zip stars reviews categories``.

    ``code`` is the first part of the postal code and ``second`` the field after
    it, which is the second part for codes of three or four characters. Numbers
    that cannot be read, or are not finite, are null. Nothing is filtered here.
    """
    parts = F.split(F.regexp_replace("value", r"(:\s+)+$", ""), r":\s+")
    fields = F.split(F.regexp_replace(F.get("parts", F.lit(1)), r"\s+$", ""), r"\s+")
    split_code = F.length("code").isin(3, 4)
    # One-row explodes keep the split results as columns: filters set on the fields
    # later would otherwise be pushed below and split the line once per condition.
    return (
        lines.select(F.explode(F.array(parts)).alias("parts"))
        .select("parts", F.explode(F.array(fields)).alias("fields"))
        .select(
            F.get("parts", F.lit(0)).alias("name"),
            F.get("fields", F.lit(0)).alias("state"),
            F.get("fields", F.lit(1)).alias("code"),
            F.get("fields", F.lit(2)).alias("second"),
            "fields",
            F.size("parts").alias("n_parts"),
            F.size("fields").alias("n_fields"),
        )
        .select(
            "name",
            "state",
            "code",
            "second",
            _finite(F.get("fields", F.when(split_code, 3).otherwise(2))).alias("stars"),
            _finite(F.get("fields", F.when(split_code, 4).otherwise(3))).alias("reviews"),
            "n_parts",
            "n_fields",
        )
    )
