"""Quality rules: plain counts per text and the perplexity of an n-gram model.

The model is over code points, one a language, and grows with the corpus
(``language_model.py``). Documents whose perplexity lies outside a band of their language
are rejected; the bands come from the quartiles of all documents that pass the plain rules.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramrank.llm import language_model as L
from gramrank.llm import textarrays as T
from gramrank.session import new_shared_path

#: Languages up to which their bands are broadcast, so that a language of very many
#: documents is not one task. With more, none of which can have all documents, they are
#: joined by a shuffle.
FEW_LANGUAGES = 10_000

IS_SYMBOL = np.zeros(256, dtype=bool)
IS_SYMBOL[list(b"#*$%&|<>")] = True
IS_LEAD = np.array([b & 0xC0 != 0x80 for b in range(256)])

STATS = (
    "doc_id {id}, lang string, n_words long, word_chars long, n_symbols long,"
    " n_dup_lines long, n_repeat_words long, n_grams long, log_p double"
)


def repeat_words(hashes: np.ndarray, k: int = 3) -> int:
    """Words within windows of ``k`` words that are found twice or more."""
    if len(hashes) <= k:
        return 0
    found = T.windows(hashes, k)
    in_order = np.sort(found)
    twice = in_order[1:][in_order[1:] == in_order[:-1]]
    if not len(twice):
        return 0
    place = np.minimum(np.searchsorted(twice, found), len(twice) - 1)
    hit = twice[place] == found
    covered = np.zeros(len(hashes), dtype=bool)
    for j in range(k):
        covered[j : j + len(hit)] |= hit
    return int(covered.sum())


def dup_lines(text: bytes) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def score_documents(blocks: DataFrame, answers: DataFrame, id_type: str) -> DataFrame:
    """Plain counts of each text and the sum of its log probabilities, block by block."""

    def score(answered: pa.Table, docs: pa.Table) -> pa.Table:
        known = L.Answered(answered)
        found = [score_part(part, known) for part in L.documents_of(docs)]
        return pa.Table.from_batches([batch for part in found for batch in part])

    texts = blocks.where("docs is not null").select(F.col("block").alias("of_block"), "docs")
    return (
        answers.groupBy("block")
        .cogroup(texts.groupBy("of_block"))
        .applyInArrow(score, STATS.format(id=id_type))
    )


def score_part(batch: pa.RecordBatch, known: L.Answered) -> Iterator[pa.RecordBatch]:
    langs = batch["lang_key"].to_numpy(zero_copy_only=False)
    for texts in T.chunks(batch["text"]):
        low, n = texts.first, len(texts)
        words = texts.words()
        hashes = words.hashes()
        body = ~T.IS_SPACE[texts.data]
        keys, bounds, _, _ = L.gram_keys(texts, langs[low : low + n])
        total = np.concatenate(([0.0], np.cumsum(known.look_up(keys))))
        by_word = words.bounds
        yield pa.record_batch(
            [
                batch["doc_id"].slice(low, n),
                batch["lang"].slice(low, n),
                pa.array(np.diff(by_word)),
                pa.array(texts.sums(body & IS_LEAD[texts.data])),
                pa.array(texts.sums(IS_SYMBOL[texts.data])),
                pa.array(
                    [
                        dup_lines(texts.data[a:b].tobytes())
                        for a, b in zip(texts.bounds[:-1], texts.bounds[1:], strict=True)
                    ],
                    pa.int64(),
                ),
                pa.array(
                    [
                        repeat_words(hashes[a:b])
                        for a, b in zip(by_word[:-1], by_word[1:], strict=True)
                    ],
                    pa.int64(),
                ),
                pa.array(np.diff(bounds)),
                pa.array(total[bounds[1:]] - total[bounds[:-1]]),
            ],
            names=[part.split()[0] for part in STATS.split(", ")],
        )


def judged_plainly(scored: DataFrame) -> DataFrame:
    return scored.withColumns(
        {
            "log_perplexity": -F.col("log_p") / F.col("n_grams"),
            "base_failed": (F.col("n_words") < 50)
            | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        }
    )


def bands_of(judged: DataFrame, width: float) -> DataFrame:
    """``[lang, low, high]``: ``width`` quartile ranges beyond the quartiles of log
    perplexity, taken over the documents of a language that pass the plain rules."""
    quartiles = F.percentile_approx("log_perplexity", [0.25, 0.75], 10_000)
    spread = F.col("q")[1] - F.col("q")[0]
    return (
        judged.where(~F.col("base_failed"))
        .groupBy("lang")
        .agg(quartiles.alias("q"))
        .select(
            "lang",
            (F.col("q")[0] - width * spread).alias("low"),
            (F.col("q")[1] + width * spread).alias("high"),
        )
    )


def with_verdicts(judged: DataFrame, bands: DataFrame) -> DataFrame:
    if bands.count() <= FEW_LANGUAGES:
        bands = F.broadcast(bands)
    inside = F.col("log_perplexity").between(F.col("low"), F.col("high"))
    return judged.join(bands, "lang", "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(True))).alias("kept"),
        F.exp("log_perplexity").alias("perplexity"),
        F.exp("low").alias("band_low"),
        F.exp("high").alias("band_high"),
    )


def judge_quality(docs: DataFrame, width: float = 3.0) -> DataFrame:
    """Counts, perplexity and verdict of each of ``docs`` (``doc_id, text, lang``; other
    columns are ignored).

    A null text is an empty one: no words, so it fails the plain rules. A null language
    is the language ''. Repeated rows are judged each for itself and counted each in the
    model; an empty table gives no rows. Word windows are compared by 64-bit hashes."""
    spark = docs.sparkSession

    def kept(frame: DataFrame, label: str) -> DataFrame:
        path = new_shared_path(spark, label)
        frame.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    lang = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    plain = docs.select("doc_id", lang.alias("lang"), L.lang_key(lang).alias("lang_key"), "text")
    # in buckets by block, so that the texts, written once, are not shuffled as well
    blocks_path = new_shared_path(spark, "ngram-blocks")
    name = blocks_path.rsplit("/", 1)[1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = L.read_blocks(plain).write.bucketBy(buckets, "block").format("parquet")
    writer.option("compression", "zstd").option("path", blocks_path).saveAsTable(name)
    blocks = spark.table(name)
    counts = kept(L.count_grams(blocks), "ngram-counts")
    model = L.fit(counts)
    model = kept(model.repartition("key").sortWithinPartitions("key"), "ngram-model")
    id_type = plain.schema["doc_id"].dataType.simpleString()
    scored = score_documents(blocks, L.answers(blocks, model), id_type)
    scored = kept(scored, "ngram-scores")
    spark.sql(f"drop table {name}")  # its files stay
    judged = judged_plainly(scored)
    return with_verdicts(judged, kept(bands_of(judged, width), "ngram-bands"))
