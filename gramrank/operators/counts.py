"""Word counts and vocabulary. Every group is pre-aggregated before its shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramrank.functions.text import letter_bucket, raw_words, strip_mark

#: Bytes of text a task splits at a time; a longer text is split by itself.
SPLIT_BYTES = 1 << 21

# Cleaning byte by byte: beyond ASCII only two letters have an ASCII one in lower case.
_WORD_BYTES = b"abcdefghijklmnopqrstuvwxyz0123456789"
_LOWER = bytes(range(256)).lower()
_LOWER_TO_ASCII = {"\u212a": "k", "\u0130": "i"}


def cleaned_rows(texts: pa.Array, gaps: bytes = b" \t\n\r\f") -> pa.Array:
    """As ``cleaned_text`` has it, over the bytes of all rows at once; null is empty.
    ``gaps`` are the separators that stay."""
    texts = texts.fill_null("").cast(pa.large_string())
    for letter, lower in _LOWER_TO_ASCII.items():
        texts = pc.replace_substring(texts, letter, lower)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset :][: len(texts) + 1]
    raw = memoryview(data or b"")[bounds[0] : bounds[-1]]
    stays = np.array([b in _WORD_BYTES or b in gaps for b in _LOWER])
    kept = np.concatenate([[0], np.cumsum(stays[np.frombuffer(raw, dtype=np.uint8)])])
    clean = bytes(raw).translate(_LOWER, np.flatnonzero(~stays).astype(np.uint8).tobytes())
    ends = kept[bounds - bounds[0]].astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(ends), pa.py_buffer(clean))


def explode_words(
    df: DataFrame, text: str, keep: tuple[str, ...] = (), keep_empty: bool = False
) -> DataFrame:
    """One row per word of ``text`` with the ``keep`` columns."""
    rows = df.select(*keep, F.explode(raw_words(F.col(text), keep_empty)).alias("word")).where(
        F.col("word") != ""
    )
    return rows.withColumn("word", strip_mark(F.col("word"))) if keep_empty else rows


def word_count(lines: DataFrame, text: str = "value", keep_empty: bool = True) -> DataFrame:
    """``[word, n]`` over whole lines."""
    return explode_words(lines, text, (), keep_empty).groupBy("word").agg(F.count("*").alias("n"))


def vocabulary(articles: DataFrame, keep_empty: bool = True) -> DataFrame:
    """Distinct words of the bodies."""
    return explode_words(articles, "body", (), keep_empty).distinct()


def term_counts(articles: DataFrame) -> DataFrame:
    """``[doc_id, word, n]``; articles with the same id are counted together."""
    return (
        explode_words(articles, "body", ("doc_id",))
        .groupBy("doc_id", "word")
        .agg(F.count("*").alias("n"))
    )


def in_slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Runs of the batch's rows with some ``SPLIT_BYTES`` bytes in column ``text``."""
    sizes = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
    yield from slices_of(batch, sizes)


def slices_of(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Runs of the batch's rows with some ``SPLIT_BYTES`` bytes by the ``sizes`` of rows."""
    ends = np.cumsum(sizes, dtype=np.int64)
    low = 0
    while low < batch.num_rows:
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + SPLIT_BYTES, side="right")))
        yield batch.slice(low, high - low)
        low = high


def text_counts(articles: DataFrame) -> DataFrame:
    """``[doc_id, words, ns]``: the distinct words of each row's body and how often each
    stands there, as two arrays, a most frequent word first. A row without words is left
    out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_slices(batch, 1):
                yield _count_rows(part)

    texts = articles.select("doc_id", F.col("body").alias("text"))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(count, f"doc_id {id_type}, words array<string>, ns array<bigint>")


def row_words(
    texts: pa.Array, row_of_text: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Row, place of the word in the array given last, and count of each distinct word of a
    row, by row. Every text is a row, or a part of that in ``row_of_text``."""
    split = pc.ascii_split_whitespace(cleaned_rows(texts))
    sizes = split.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    tokens = split.flatten().dictionary_encode()
    if row_of_text is None:
        row_of_text = np.arange(len(sizes), dtype=np.int64)
    # a row and a word in one whole number
    span = len(tokens.dictionary) + 1
    keys = np.repeat(row_of_text, sizes) * span
    keys += tokens.indices.to_numpy(zero_copy_only=False)
    empty = pc.index(tokens.dictionary, "").as_py()
    keys, ns = np.unique(keys[keys % span != empty], return_counts=True)
    row, word = np.divmod(keys, span)
    return row, word, ns, tokens.dictionary.cast(pa.string())


def _count_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    row, word, ns, dictionary = row_words(batch.column(1))
    order = np.lexsort((-ns, row))
    word, ns = word[order], ns[order]
    rows, sizes = np.unique(row, return_counts=True)
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    words = dictionary.take(pa.array(word))
    return pa.record_batch(
        [
            batch.column(0).take(pa.array(rows)),
            pa.ListArray.from_arrays(offsets, words),
            pa.ListArray.from_arrays(offsets, pa.array(ns, pa.int64())),
        ],
        names=["doc_id", "words", "ns"],
    )


def corpus_counts(articles: DataFrame) -> DataFrame:
    """``[word, n]`` over all bodies, words without letters and digits left out."""
    return word_count(articles, "body", keep_empty=False)


def letter_buckets(counts: DataFrame) -> DataFrame:
    """``[bucket, word, ...]`` with the first-letter bucket in front."""
    return counts.select(letter_bucket(F.col("word")).alias("bucket"), *counts.columns)
