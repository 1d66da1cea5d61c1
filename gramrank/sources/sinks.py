"""Sinks. A path that exists is an error unless ``mode`` says otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gramrank.functions.text import letter_bucket


def kv_lines(df: DataFrame) -> DataFrame:
    """One tab-separated line per row; nulls are written as empty fields."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    return df.select(F.concat_ws("\t", *fields).alias("value"))


def tuple_lines(df: DataFrame, separator: str = ",") -> DataFrame:
    """One ``(a,b)`` line per row."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    return df.select(
        F.concat(F.lit("("), F.concat_ws(separator, *fields), F.lit(")")).alias("value")
    )


def write_kv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    kv_lines(df).write.mode(mode).text(path)


def write_tuples(
    df: DataFrame, path: str, separator: str = ",", mode: str = "errorifexists"
) -> None:
    tuple_lines(df, separator).write.mode(mode).text(path)


def write_table(
    df: DataFrame, path: str, schema: StructType, mode: str = "errorifexists"
) -> None:
    """Typed results as Parquet; rows that do not fit the schema are an error."""
    df.to(schema).write.mode(mode).parquet(path)


def write_by_letter(
    df: DataFrame, path: str, word: str = "word", mode: str = "errorifexists"
) -> None:
    """Tab-separated lines, one folder per first-letter bucket, sorted by word.

    Rows are range partitioned by bucket and word, so that a letter range with
    most of the words is written by many tasks and a task writes few folders.
    """
    columns = df.columns
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    (
        df.withColumn("bucket", letter_bucket(F.col(word)))
        .repartitionByRange("bucket", word)
        .sortWithinPartitions("bucket", word)
        .select("bucket", F.concat_ws("\t", *fields).alias("value"))
        .write.mode(mode)
        .partitionBy("bucket")
        .text(path)
    )
