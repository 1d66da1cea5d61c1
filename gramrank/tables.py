"""Inputs of the registered queries, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Business listing lines, in SQL that means the same to Spark and to the checking
# engine: five-digit codes, codes in two parts, and lines that must be rejected.
LISTING_SQL = """
    c_name || case when c_custkey % 7 = 0 then ', Inc.' else '' end
    || case when c_custkey % 100 = 9 then ': branch' else '' end
    || ': ' || substring(c_mktsegment, 1, 2) || chr(9)
    || case
        when c_custkey % 100 = 8 then '12' || chr(9)
        when c_custkey % 100 = 18 then '12-45' || chr(9)
        when c_custkey % 100 = 28 then '12A45' || chr(9)
        when c_custkey % 100 = 38 then 'T2E' || chr(9) || '6L' || chr(9)
        when c_custkey % 100 = 48 then 'T2E' || chr(9) || '6l6' || chr(9)
        when c_custkey % 100 = 58 then '123456' || chr(9)
        when c_custkey % 10 in (5, 6) then
            chr(cast(65 + c_custkey % 26 as int)) || cast(c_custkey % 10 as string)
            || chr(cast(65 + (c_custkey * 3) % 26 as int)) || ' '
            || cast((c_custkey * 7) % 10 as string)
            || chr(cast(65 + (c_custkey * 11) % 26 as int))
            || cast((c_custkey * 13) % 10 as string) || chr(9)
        when c_custkey % 10 = 7 then
            chr(cast(65 + c_custkey % 26 as int)) || cast((c_custkey * 3) % 10 as string)
            || chr(cast(65 + (c_custkey * 5) % 26 as int))
            || cast((c_custkey * 9) % 10 as string) || ' 1'
            || chr(cast(65 + (c_custkey * 7) % 26 as int)) || '2' || chr(9)
        else lpad(cast((c_custkey * 7919) % 100000 as string), 5, '0') || chr(9)
    end
    || case when c_custkey % 100 = 19 then 'many'
        when c_custkey % 100 = 39 then 'NaN'
        when c_custkey % 100 = 49 then 'Infinity'
        else cast(1 + (c_custkey % 9) * 0.5 as string) end || chr(9)
    || case when c_custkey % 100 = 59 then 'NaN'
        when c_custkey % 100 = 69 then 'Infinity'
        else cast(cast(floor(abs(c_acctbal)) as bigint) % 400 as string) end
    || case when c_custkey % 100 = 29 then '' else chr(9) || 'Food, Coffee & Tea' end
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as ``[doc_id, body]``."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("text").alias("body")
    )


def line_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as ``[doc_id, body]`` with the body on one line, as article
    records have it."""
    return articles(spark, sf_dir).withColumn("body", one_line("body"))


def one_line(column: str):
    unwrapped = F.replace(F.col(column), F.lit("\n"), F.lit(" "))
    return F.replace(unwrapped, F.lit("\r"), F.lit(" "))


def article_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article records; some with one delimiter or none."""
    text, doc_id = one_line("text"), F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        F.when(doc_id % 5 == 0, text)
        .when(doc_id % 5 == 1, F.concat_ws("<====>", "source", text))
        .otherwise(F.concat_ws("<====>", "source", doc_id.cast("string"), text))
        .alias("value")
    )


def repeated_article_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article records of which three at a time have one id and different bodies."""
    doc_id = F.floor(F.col("doc_id") / 3).cast("string")
    return table(spark, sf_dir, "documents").select(
        F.concat_ws("<====>", "source", doc_id, one_line("text")).alias("value")
    )


def kv_source_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-separated lines with no, one or two tabs in front of the text."""
    text, doc_id = one_line("text"), F.col("doc_id")
    key = doc_id.cast("string")
    return table(spark, sf_dir, "documents").select(
        F.when(doc_id % 3 == 0, text)
        .when(doc_id % 3 == 1, F.concat_ws("\t", key, text))
        .otherwise(F.concat_ws("\t", key, "source", text))
        .alias("value")
    )


def part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page titles: the part names in file order, page id = line number."""
    return table(spark, sf_dir, "part")


def _page(column: str):
    return (F.col(column) + 1).cast("string")


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between pages: each line item links its part's page to its supplier's
    page and back; page ids are line numbers in the title list."""
    part, supplier = _page("l_partkey"), _page("l_suppkey")
    both = F.array(
        F.struct(part.alias("src"), supplier.alias("dst")),
        F.struct(supplier.alias("src"), part.alias("dst")),
    )
    items = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    return items.select(F.inline(both))


def link_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjacency lines, one per line item; some have no neighbour."""
    neighbours = F.when(F.col("l_linenumber") == 7, "").otherwise(
        F.concat_ws(" ", _page("l_suppkey"), F.col("l_linenumber").cast("string"))
    )
    return table(spark, sf_dir, "lineitem").select(
        F.concat(_page("l_partkey"), F.lit(": "), neighbours).alias("value")
    )


def listing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return customers.selectExpr(f"{LISTING_SQL} as value")


def cluster_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved clusters, one per customer with two members."""
    return table(spark, sf_dir, "customer").selectExpr(
        "concat('((centroid', c_nationkey, ', ', c_acctbal, ', ', c_custkey, '),[(',"
        " c_name, ', ', c_custkey, ', ', c_acctbal, '), (', c_name, ', Sons, Inc., ',"
        " c_acctbal, ', ', c_nationkey, ')])') as value"
    )


def elbow_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "concat('(', c_custkey, ',', c_acctbal, ')') as value"
    )
