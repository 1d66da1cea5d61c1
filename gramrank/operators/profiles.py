"""Top-n reports. ``orderBy`` with ``limit`` keeps n rows per task and merges them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramrank.functions.text import STRIPPED, TOKEN_GAP, cleaned_text
from gramrank.operators.counts import corpus_counts, in_slices, term_counts


def first_per_task(texts: DataFrame, n: int) -> DataFrame:
    """``[word]``: of the words in each task's cleaned texts (one column, ``cleaned_text``
    with ``keep_empty``) the first ``n`` distinct ones in byte order.

    A task holds a sorted set of at most ``n`` words. Once it is full, words behind its
    last one are sorted out by a comparison. Texts are split in slices, so that the words
    held at a time are bounded whatever comes in a batch."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.array([], pa.string())
        for batch in batches:
            for part in in_slices(batch, 0):
                tokens = pc.split_pattern_regex(part.column(0).drop_null(), TOKEN_GAP).flatten()
                words = pc.unique(tokens)
                words = words.filter(pc.not_equal(words, ""))
                words = pc.replace_substring(words, STRIPPED, "")
                if len(held) == n:
                    words = words.filter(pc.less(words, held[-1]))
                held = pc.unique(pa.concat_arrays([held, words])).sort()[:n]
        yield pa.record_batch([held], names=["word"])

    if n <= 0:
        return texts.select(F.lit("").alias("word")).limit(0)
    return texts.mapInArrow(first, "word string")


def profile_vocabulary(articles: DataFrame, n: int = 500) -> DataFrame:
    """First ``n`` distinct words in byte order, the empty word included. At most ``n``
    words a task are shuffled, however large the vocabulary is."""
    texts = articles.select(cleaned_text(F.col("body"), keep_empty=True).alias("text"))
    return first_per_task(texts, n).distinct().orderBy("word").limit(n)


def profile_doc_terms(articles: DataFrame, n: int = 500) -> DataFrame:
    """Top ``n`` of ``[doc_id, word, n]`` by id, count and word, all descending;
    ids compare as strings, ids with white space are left out.

    Every document with a word gives at least one row, so the report lies within
    the ``n`` largest ids. Those are found first, and only their texts are counted.
    """
    usable = articles.where(
        F.col("doc_id").isNotNull()
        & ~F.col("doc_id").rlike(r"\s")
        & F.lower("body").rlike("[a-z0-9]")
    )
    last_ids = usable.select("doc_id").distinct().orderBy(F.desc("doc_id")).limit(n)
    counted = term_counts(usable.join(last_ids, "doc_id", "left_semi"))
    return counted.orderBy(F.desc("doc_id"), F.desc("n"), F.desc("word")).limit(n)


def profile_corpus(articles: DataFrame, n: int = 500) -> DataFrame:
    """Top ``n`` words by corpus count; equal counts in word order."""
    return corpus_counts(articles).orderBy(F.desc("n"), "word").limit(n)
