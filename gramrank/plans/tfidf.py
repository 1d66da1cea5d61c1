"""TF-IDF of article words.

``tf = 0.5 + 0.5 * n / max(n)`` per document, ``tfidf = tf * log10(N / df)`` with
``df`` the number of documents that have the word and ``N`` the number of
documents that have any word.

Words are counted within the rows of texts. What only one row has an id for is a whole
document: its counts and their highest are at hand, and its terms cross the network once, to
their word. Rows that share an id are added up by id and word; of those, figures of
documents are aggregated first and joined back, documents with very many terms in pieces.
Very frequent words are joined in pieces too.

Counts are used in several places of one plan. Conditions that hold for every row make each
use need the same columns, so that Spark finds the shuffles equal and texts are read, split
and counted once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramrank.operators.blocks import block_words, one_row_a_block
from gramrank.operators.counts import text_counts
from gramrank.operators.skew import PIECE_ROWS, spread_join


def document_stats(counts: DataFrame) -> DataFrame:
    """``[doc_id, max_n, words]``: highest term count and number of distinct words."""
    return (
        counts.where("n > 0")
        .groupBy("doc_id")
        .agg(F.max("n").alias("max_n"), F.count("*").alias("words"))
        .where("max_n > 0 and words > 0")
    )


def document_frequency(counts: DataFrame) -> DataFrame:
    """``[word, df]``: number of documents that have the word."""
    return counts.where("n > 0 and word is not null").groupBy("word").agg(F.count("*").alias("df"))


def document_total(counts: DataFrame) -> DataFrame:
    """``[n_docs]``: number of documents that have any word."""
    return document_stats(counts).agg(F.count("*").alias("n_docs"))


def _tf() -> Column:
    return F.lit(0.5) + F.lit(0.5) * (F.col("n") / F.col("max_n"))


def _with_highest(terms: DataFrame, counts: DataFrame, piece_rows: int) -> DataFrame:
    """``terms`` with ``max_n``, the highest count of the document. Tasks find it for their
    terms first; terms of a document that has very many are not brought together."""
    highest = document_stats(counts)
    return spread_join(terms, highest, "doc_id", "words", ["word"], piece_rows).drop("words")


def term_frequency(counts: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``[doc_id, word, n, max_n, tf]``."""
    found = _with_highest(counts.where("n > 0"), counts, piece_rows)
    return found.select("doc_id", "word", "n", "max_n", _tf().alias("tf"))


def _terms(rows: DataFrame, *more: Column) -> DataFrame:
    """``[doc_id, word, n]`` and ``more`` columns of rows of counted texts."""
    pairs = F.arrays_zip(F.col("words").alias("word"), F.col("ns").alias("n"))
    return rows.select("doc_id", *more, F.inline(pairs).alias("word", "n")).where("n > 0")


def _added_up(terms: DataFrame) -> DataFrame:
    return terms.groupBy("doc_id", "word").agg(F.sum("n").alias("n"))


def _by_rows_of_id(articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``[doc_id, words, ns]``, a row a text: those whose id no other row has, and those
    that share one. Both come of one shuffle."""
    has_id = "doc_id is not null"
    known = articles.where(has_id)
    shared = known.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1")
    shared = shared.select("doc_id").hint("shuffle_hash")
    # the condition that one of the joins would add by itself, on both
    rows = text_counts(known).where(has_id)
    return rows.join(shared, "doc_id", "left_anti"), rows.join(shared, "doc_id", "left_semi")


def _total(single: DataFrame, counts: DataFrame) -> Column:
    """Number of documents: rows by themselves, and ids among the counts of others."""
    alone = single.agg(F.count_if(F.size("words") == F.size("ns")).alias("n_docs"))
    return alone.scalar() + document_total(counts).scalar()


def _counted(articles: DataFrame, piece_rows: int) -> tuple[DataFrame, DataFrame, Column]:
    """``[doc_id, word, n, max_n]`` of all articles with an id, ``[doc_id, word, n]`` of the
    same, and the number of documents."""
    single, several = _by_rows_of_id(articles)
    # dealt by word too, so that the terms of a hot id are not brought together
    counts = _added_up(_terms(several).repartition("doc_id", "word"))
    merged = _with_highest(counts.where("n > 0"), counts, piece_rows)
    whole = _terms(single, F.get("ns", F.lit(0)).alias("max_n"))
    terms = whole.unionByName(merged.select("doc_id", "max_n", "word", "n"))
    return terms, _terms(single).unionByName(counts), _total(single, counts)


def article_term_frequency(articles: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``[doc_id, word, n, max_n, tf]`` of articles with an id, as ``term_frequency`` has it
    of their counts."""
    terms, _, _ = _counted(articles, piece_rows)
    return terms.select("doc_id", "word", "n", "max_n", _tf().alias("tf"))


def with_frequency(
    terms: DataFrame, counts: DataFrame, piece_rows: int = PIECE_ROWS
) -> DataFrame:
    """``terms`` with ``df``, found in ``counts``."""
    frequency = document_frequency(counts)
    return spread_join(terms, frequency, "word", "df", ["doc_id"], piece_rows)


def tf_idf(articles: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``[doc_id, word, tf, df, tfidf]`` of articles with an id."""
    terms, counts, n_docs = _counted(articles, piece_rows)
    found = with_frequency(terms, counts, piece_rows)
    return found.select(
        "doc_id",
        "word",
        _tf().alias("tf"),
        "df",
        (_tf() * F.log10(n_docs / F.col("df"))).alias("tfidf"),
    )


def block_weights(texts: DataFrame) -> DataFrame:
    """``[doc_id, words, idfs, ns]`` of ``[doc_id, body]``, placed by id: the words of each
    block of documents, and their ``log10(N / df)``, as arrays in a row of the block's first
    document; see :mod:`gramrank.operators.blocks`."""
    # placed by word once for all uses: each needs all columns and demands what a join with
    # texts that have an id would
    has_id = "not (doc_id = '') and doc_id is not null"
    words = block_words(texts).where(has_id).repartition("word")
    documents = F.when(F.expr(has_id), F.greatest(F.col("n"), F.lit(1)))
    frequency = words.groupBy("word").agg(F.sum(documents).alias("df"))
    found = spread_join(words, frequency, "word", "df", ["doc_id"])
    idfs = F.transform("dfs", lambda df: F.log10(F.col("n_docs") / df))
    return one_row_a_block(found).select("doc_id", "words", idfs.alias("idfs"), "ns")
