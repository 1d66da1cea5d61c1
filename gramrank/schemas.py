"""Schemas of the public inputs and results."""

from pyspark.sql import types as T

LINES = T.StructType([T.StructField("value", T.StringType())])

KEY_VALUES = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]
)

ARTICLES = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("doc_id", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)

EDGES = T.StructType(
    [T.StructField("src", T.StringType()), T.StructField("dst", T.StringType())]
)

TITLES = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("title", T.StringType())]
)

RANKS = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("rank", T.DoubleType())]
)

POINTS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
    ]
)

ASSIGNMENTS = T.StructType(
    [
        T.StructField("centroid_id", T.IntegerType()),
        T.StructField("cx", T.DoubleType()),
        T.StructField("cy", T.DoubleType()),
        T.StructField("name", T.StringType()),
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
    ]
)

ELBOW = T.StructType(
    [T.StructField("k", T.IntegerType()), T.StructField("sse", T.DoubleType())]
)
