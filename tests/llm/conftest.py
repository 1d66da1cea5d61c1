import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def docs(spark, tmp_path):
    """Rows as a Parquet table of ``documents`` with one more column whose name clashes
    with the operators' own."""

    def make(rows, files=2, schema="doc_id long, text string, lang string"):
        width = len(schema.split(","))
        full = [tuple(r) + ("en",) * (width - len(r)) for r in rows]
        df = spark.createDataFrame(full, schema).selectExpr("*", "doc_id as kept", "text as row")
        path = str(tmp_path / f"documents-{len(os.listdir(tmp_path))}.parquet")
        df.repartition(files).write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.fixture
def odd_rows():
    """Null and empty texts, blanks only, ties, repeated rows and ids, a very long text."""
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "same text here and more of it"),
        (5, "same text here and more of it"),
        (5, "same text here and more of it"),
        (5, "another text under the same id"),
        (None, "a text without an id"),
        (6, "word " * 60_000),
        (7, "x" * 200_000),
        (8, "é ü 你好   \x1f \x00 end"),
    ]
