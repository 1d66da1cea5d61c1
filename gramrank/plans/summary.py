"""Extractive summaries: sentences scored by their best TF-IDF words.

Ids must be unique here (``first_per_id`` makes them so): a sentence number means
something within one body only. Texts are placed by id once. Document frequencies come to
the same place with the words of whole blocks of documents, each word once a block, and
sentence words are looked up there: words are counted and weighed, and sentences scored and
picked, within the row. Words of documents, sentence words and sentences are never shuffled,
sorted or joined on their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramrank.functions.text import join_sentences, sentence_array, sentence_word_array
from gramrank.operators.blocks import Terms, listed_terms, looked_up_terms, with_values
from gramrank.operators.counts import cleaned_rows, slices_of
from gramrank.operators.topk import best_values
from gramrank.plans.tfidf import block_weights
from gramrank.sources.text import with_doc_id


def placed_by_id(articles: DataFrame) -> DataFrame:
    """``[doc_id, body]`` of articles with an id, shuffled by it; words counted, numbered
    or joined per document from here on stay where they are. The number of partitions is
    given, so that adaptive execution leaves them as they are."""
    partitions = int(articles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return with_doc_id(articles).select("doc_id", "body").repartition(partitions, "doc_id")


def sentences(articles: DataFrame) -> DataFrame:
    """``[doc_id, sid, sentence]``, numbered from 0 without gaps."""
    return with_doc_id(articles).select(
        "doc_id", F.posexplode(sentence_array(F.col("body"))).alias("sid", "sentence")
    )


def sentence_words(articles: DataFrame) -> DataFrame:
    """Distinct ``[doc_id, sid, word]``. A sentence lies within one row, so its
    words are made distinct there, without a shuffle."""
    return (
        sentences(articles)
        .select("doc_id", "sid", F.explode(sentence_word_array(F.col("sentence"))).alias("word"))
        .where(F.col("word") != "")
    )


def _offsets(lists: pa.Array) -> np.ndarray:
    sizes = lists.value_lengths().fill_null(0).to_numpy()
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)


def words_of(sentences: pa.Array) -> pa.Array:
    """Distinct words of each sentence in lists of sentences, as ``sentence_word_array`` has
    them but for the empty string, over the bytes of all sentences at once."""
    split = pc.split_pattern(cleaned_rows(sentences.flatten(), b" "), " ")
    sizes = split.value_lengths().to_numpy(zero_copy_only=False)
    tokens = split.flatten().dictionary_encode()
    codes = tokens.indices.to_numpy(zero_copy_only=False)
    # a sentence and a word in one whole number
    span = len(tokens.dictionary) + 1
    keys = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes) * span + codes
    keys = np.unique(keys[codes != pc.index(tokens.dictionary, "").as_py()])
    sentence, word = np.divmod(keys, span)
    by_sentence = np.concatenate([[0], np.cumsum(np.bincount(sentence, minlength=len(sizes)))])
    words = tokens.dictionary.take(pa.array(word)).cast(pa.string())
    lines = pa.ListArray.from_arrays(pa.array(by_sentence.astype(np.int32)), words)
    return pa.ListArray.from_arrays(pa.array(_offsets(sentences)), lines)


class Weighed:
    """Sentences (lists of words) of a batch of rows, with the weights their words have
    among the row's own ``words`` and ``weights``; ``known`` says which are there."""

    def __init__(self, sentences: pa.Array, words: pa.Array, weights: pa.Array):
        lines = sentences.flatten()
        self.by_row, self.by_sentence = _offsets(sentences), _offsets(lines)
        rows = np.arange(len(sentences))
        self.row_of_sentence = np.repeat(rows, np.diff(self.by_row))
        self.sentence_of_word = np.repeat(np.arange(len(lines)), np.diff(self.by_sentence))
        row_of_known = np.repeat(rows, np.diff(_offsets(words)))
        listed, asked = words.flatten(), lines.flatten()
        self.asked = asked
        codes = pa.concat_arrays([listed, asked]).dictionary_encode().indices.to_numpy()
        # a row and a word in one whole number
        span = int(codes.max(initial=0)) + 1
        keys = row_of_known * span + codes[: len(listed)]
        wanted = self.row_of_sentence[self.sentence_of_word] * span + codes[len(listed) :]
        order = np.argsort(keys, kind="stable")
        if len(keys):
            keys = keys[order]
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            self.known = keys[at] == wanted
            self.values = weights.flatten().to_numpy(zero_copy_only=False)[order][at]
        else:
            self.known, self.values = np.zeros(len(wanted), dtype=bool), np.zeros(len(wanted))

    def lists(self) -> pa.Array:
        """The weights as lists of the sentences' shape, null for unknown words."""
        flat = pa.array(self.values, pa.float64(), mask=~self.known)
        lines = pa.ListArray.from_arrays(pa.array(self.by_sentence), flat)
        return pa.ListArray.from_arrays(pa.array(self.by_row), lines)

    def pairs(self) -> pa.Array:
        """Known words with their weights, as lists of the sentences' shape."""
        words = pc.filter(self.asked, pa.array(self.known))
        pairs = pa.StructArray.from_arrays(
            [words, pa.array(self.values[self.known])], ["word", "tfidf"]
        )
        before = np.concatenate([[0], np.cumsum(self.known)]).astype(np.int32)
        lines = pa.ListArray.from_arrays(pa.array(before[self.by_sentence]), pairs)
        return pa.ListArray.from_arrays(pa.array(self.by_row), lines)

    def scores(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the ``k`` best weights of each sentence, and whether it has any. Added up
        from the largest down, so sentences with the same values have the same score to the
        last bit and the tie rule applies to them."""
        sentence, value = self.sentence_of_word[self.known], self.values[self.known]
        order = np.lexsort((-value, sentence))
        sentence, value = sentence[order], value[order]
        place = np.arange(len(sentence)) - np.searchsorted(sentence, sentence)
        score = np.zeros(len(self.row_of_sentence))
        for i in range(k):
            score[sentence[place == i]] += value[place == i]
        scored = np.zeros(len(score), dtype=bool)
        scored[sentence] = True
        return score, scored

    def best(self, k: int, n: int) -> pa.Array:
        """Numbers of the ``n`` best sentences of each row, in text order; of equal scores
        the later sentences."""
        score, scored = self.scores(k)
        row = self.row_of_sentence
        number = np.arange(len(row)) - self.by_row[row]
        order = np.lexsort((-number, -score, row))
        order = order[scored[order]]
        place = np.arange(len(order)) - np.searchsorted(row[order], row[order])
        chosen = np.sort(order[place < n])
        sizes = np.bincount(row[chosen], minlength=len(self.by_row) - 1)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.ListArray.from_arrays(
            pa.array(offsets), pa.array(number[chosen].astype(np.int32))
        )


def _sentence_bytes(sentences: pa.Array) -> np.ndarray:
    """Bytes of the sentences of each row."""
    sizes = pc.binary_length(sentences.flatten()).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    return np.diff(ends[_offsets(sentences)])


def _weights(terms: Terms, rows: int) -> tuple[pa.Array, pa.Array]:
    """Words of each row and their TF-IDF values, of counted words with their IDF."""
    row, n, idf, words = terms
    most = np.zeros(rows, dtype=np.int64)
    np.maximum.at(most, row, n)
    weights = (0.5 + 0.5 * (n / most[row])) * idf
    sizes = np.bincount(row, minlength=rows)
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    return (
        pa.ListArray.from_arrays(offsets, words),
        pa.ListArray.from_arrays(offsets, pa.array(weights, pa.float64())),
    )


def _weighed_rows(
    articles: DataFrame, kind: str, pick: Callable[[pa.Array, Weighed], pa.Array]
) -> DataFrame:
    """``[doc_id, found]``, a row a document: what ``pick`` makes of its sentences and the
    TF-IDF values of their words.

    Texts go through one shuffle, for both uses, with as many partitions in both. Words of a
    block come back to its first document, and the join leaves rows in order of their ids.
    Texts are many times larger than the files they come from, so their size is not to be
    judged by that: the merge hint rules out that they are broadcast, and keeps the order."""
    placed = placed_by_id(articles)
    joined = placed.hint("merge").join(block_weights(placed), "doc_id", "left")
    rows = joined.select(
        "doc_id", sentence_array(F.col("body")).alias("sentences"), "words", "idfs", "ns"
    )

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run, known, idfs in with_values(batches, 2):
            for part in slices_of(run, _sentence_bytes(run.column(1))):
                ids, sentences, words, values, ns = part.columns
                if known is None:
                    terms = listed_terms(words, ns, values)
                else:
                    terms = looked_up_terms(sentences, known, idfs)
                weighed = Weighed(words_of(sentences), *_weights(terms, len(ids)))
                yield pa.record_batch([ids, pick(sentences, weighed)], names=["doc_id", "found"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(weigh, f"doc_id {id_type}, found {kind}")


def sentence_weights(articles: DataFrame) -> DataFrame:
    """``[doc_id, sid, word, tfidf]`` of sentence words that are document words."""
    kind = "array<array<struct<word:string,tfidf:double>>>"
    lines = _weighed_rows(articles, kind, lambda _, weighed: weighed.pairs())
    listed = lines.select("doc_id", F.posexplode("found").alias("sid", "line"))
    return listed.select("doc_id", "sid", F.inline("line").alias("word", "tfidf"))


def top_weights(weights: DataFrame, k: int = 5) -> DataFrame:
    """``[doc_id, sid, place, tfidf]``: the ``k`` best values of each sentence; equal
    values count separately."""
    best = best_values(weights, ["doc_id", "sid"], "tfidf", k)
    places = best.select("doc_id", "sid", F.posexplode("best").alias("place", "tfidf"))
    return places.withColumn("place", F.col("place") + 1)


def score_sentences(weights: DataFrame, k: int = 5) -> DataFrame:
    """``[doc_id, sid, score]``: sum of the ``k`` best values of each sentence, added up
    from the largest down."""
    best = best_values(weights, ["doc_id", "sid"], "tfidf", k)
    total = F.aggregate("best", F.lit(0.0), lambda total, value: total + value)
    return best.select("doc_id", "sid", total.alias("score"))


def sentence_scores(articles: DataFrame, k: int = 5) -> DataFrame:
    """``[doc_id, sid, score]``: as ``score_sentences``, within the rows of documents."""

    def scores(_: pa.Array, weighed: Weighed) -> pa.Array:
        score, scored = weighed.scores(k)
        flat = pa.array(score, pa.float64(), mask=~scored)
        return pa.ListArray.from_arrays(pa.array(weighed.by_row), flat)

    lists = _weighed_rows(articles, "array<double>", scores)
    listed = lists.select("doc_id", F.posexplode("found").alias("sid", "score"))
    return listed.where("score is not null")


def top_sentences(scores: DataFrame, n: int = 3) -> DataFrame:
    """``[doc_id, sid, score]`` of the ``n`` best sentences of each document; of equal scores
    the later sentence is kept. Each task hands on at most ``n`` sentences of a document from
    a batch, and those without a number or score."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _best_sentences(batch, n)

    rows = scores.select("doc_id", "sid", "score")
    schema = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    few = rows.mapInArrow(partial, schema)
    listed = few.groupBy("doc_id").agg(F.collect_list(F.struct("score", "sid")).alias("all"))
    best = F.slice(F.sort_array("all", asc=False), 1, n)
    return listed.select("doc_id", F.inline(best)).select("doc_id", "sid", "score")


def _best_sentences(batch: pa.RecordBatch, n: int) -> pa.RecordBatch:
    """Rows of a batch ``[doc_id, sid, score]`` that may be among the best."""
    doc = batch.column(0).dictionary_encode("encode").indices.to_numpy()
    sid = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False)
    score = batch.column(2).cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    sure = batch.column(1).is_valid().to_numpy(zero_copy_only=False) & ~np.isnan(score)
    order = np.lexsort((-sid, -score, doc))
    order = order[sure[order]]
    place = np.arange(len(order)) - np.searchsorted(doc[order], doc[order])
    kept = np.sort(np.concatenate([order[place < n], np.flatnonzero(~sure)]))
    return batch.take(pa.array(kept))


def summarize(articles: DataFrame, n: int = 3, k: int = 5) -> DataFrame:
    """``[doc_id, summary]``: the ``n`` best sentences in text order.

    Documents without a scored sentence keep an empty summary.
    """

    def best(sentences: pa.Array, weighed: Weighed) -> pa.Array:
        numbers = weighed.best(k, n)
        before = np.repeat(weighed.by_row[:-1], np.diff(_offsets(numbers)))
        chosen = sentences.flatten().take(pa.array(before + numbers.flatten().to_numpy()))
        return pa.ListArray.from_arrays(numbers.offsets, chosen)

    chosen = _weighed_rows(articles, "array<string>", best)
    return chosen.select("doc_id", F.coalesce(join_sentences("found"), F.lit("")).alias("summary"))
