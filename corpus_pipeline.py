"""From raw documents to packed sequences, stage by stage.

Each stage reads what the one before it wrote, all of it, and its decisions take effect.
Stages take and return the columns of ``documents``; the last returns packed pieces. An
empty table goes through all stages. Rows that repeat an id are separate documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramrank.llm import exact_dedup, jaccard, packing, pii, pu_quality
from gramrank.llm.queries import WORD_TOKENIZER
from gramrank.session import new_shared_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return pu_quality.classify(docs, labels).where("predicted = 1").select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that with the largest id."""
    found = exact_dedup.deduplicate(docs, exact_dedup.parquet_locator())
    return found.where("kept").select("row.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that with the smallest id: five
    words to a shingle, a Jaccard similarity of 0.8 or more."""
    return jaccard.one_of_each_class(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind. The text goes to the tasks and
    comes back once, not a second time in the row."""
    found = pii.find_personal_data(docs, [c for c in docs.columns if c != "text"])
    redacted = {
        "text": F.col("redacted"),
        "n_chars": F.when(F.col("spans") == "", F.col("row.n_chars")).otherwise(
            F.length("redacted").cast("long")
        ),
    }
    return found.select(
        *[redacted.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their ids and places in sequences of 4096."""
    return packing.pack_documents(docs, WORD_TOKENIZER)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("exact", exact),
    ("near", near),
    ("private", private),
    ("packed", packed),
]

#: SQL cannot express the classifier, the tagger or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
