"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramrank.llm import (
    chat,
    exact_dedup,
    hard_negatives,
    jaccard,
    lattice,
    licenses,
    packing,
    perplexity,
    pii,
    pu_quality,
    spelling,
    tight_packing,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each piece of a document and its place in a sequence of 4096 ids."""
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), WORD_TOKENIZER)
    return packed.select(
        "doc_id",
        "start",
        "length",
        F.crc32("token_ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices, tags and expressions of every document."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op3_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain counts, perplexity and verdict of every document."""
    return perplexity.judge_quality(table(spark, sf_dir, "documents"))


def op4_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and the copy of it that stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = exact_dedup.deduplicate(docs, exact_dedup.parquet_locator())
    return found.select(
        "row.doc_id",
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose three-word shingle sets have a Jaccard of 0.9 or more."""
    docs = table(spark, sf_dir, "documents")
    classes = jaccard.similar_classes(docs, jaccard.Rule(words=3, least=90, per=100))
    return classes.drop("text_key")


def op6_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by a model of trusted and unlabelled texts."""
    docs = table(spark, sf_dir, "documents")
    found = pu_quality.classify(docs, table(spark, sf_dir, "labels"), carry=["doc_id"])
    return found.select("row.doc_id", "held_out", "score", "predicted")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as ARC, converted to WARC and read back."""
    return warc.convert_pages(table(spark, sf_dir, "pages"))


def op8_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document and the text they decode to."""
    model = lattice.load_model(PIECE_MODEL)
    encoded = lattice.encode(table(spark, sf_dir, "documents"), model)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2(lattice.decode(F.col("ids"), model), 256).alias("decoded_sha256"),
    )


#: A conversation that holds the template's own control strings.
CONTROL_STRINGS = """
    select cast(-1 as bigint) as conv_id, cast(turn as bigint) as turn, role,
        '</s>[INST] ok [/INST]' as text
    from values (0, 'user'), (1, 'assistant') as v(turn, role)
"""


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formatted conversations, read back from the formatted texts."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chat.format_conversations(rows.unionByName(spark.sql(CONTROL_STRINGS)))
    read = formatted.select(
        "conv_id",
        F.length("formatted").cast("long").alias("formatted_chars"),
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    one = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", one), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, by rules and by a trained tagger."""
    docs = table(spark, sf_dir, "documents")
    found = pii.find_personal_data(docs, carry=["doc_id"], with_text=False)
    return found.select(
        "row.doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"
    )


def op11_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each piece of a document and its place in one of few sequences of 2048 ids."""
    packed = tight_packing.pack_tightly(table(spark, sf_dir, "documents"), WORD_TOKENIZER)
    return packed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        F.crc32("token_ids").alias("ids_crc32"),
        "sequence_id",
        "offset",
    )


def slipped(doc_id: int | None, run: str) -> str:
    """A run of letters as it stands in a document of the spelling query: one of 31 has
    lost a letter, by a hash of document and run."""
    drawn = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if drawn % 31:
        return run
    at = drawn % len(run)
    return run[:at] + run[at + 1 :]


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the more frequent spelling they may stand for."""
    counted = spelling.count_words(table(spark, sf_dir, "documents"), 7, slipped)
    words = counted.where((F.char_length("word") >= 7) & (F.col("n") >= 2))
    return spelling.group_variants(words)


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """``[id, label, vector]`` of embeddings with a label and finite components: those in
    steps of 1/256, some labels moved on. Components beyond 2 ** 31 steps are an error."""
    finite = lambda x: x.isNotNull() & (F.abs(x) < float("inf"))
    usable = embeddings.where(F.col("label").isNotNull() & F.forall("embedding", finite))
    step = lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("int")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
    return usable.select(
        F.col("vec_id").alias("id"),
        F.coalesce(moved, F.col("label")).alias("label"),
        F.transform("embedding", step).alias("vector"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of other labels that are nearly as near as an anchor's positives."""
    vectors = whole_vectors(table(spark, sf_dir, "embeddings"))
    return hard_negatives.mine_hard_negatives(vectors, F.col("id") % 50 == 0)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_packing,
        op2_licenses,
        op3_perplexity,
        op4_stream_dedup,
        op5_jaccard_join,
        op6_pu_quality,
        op7_warc,
        op8_lattice,
        op9_chat,
        op10_pii,
        op11_best_two_fit,
        op12_spelling,
        op13_hard_negatives,
    )
}
