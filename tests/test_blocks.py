import random

import numpy as np
import plain
import pyarrow as pa
import pytest

from gramrank.operators import blocks
from gramrank.plans import summary as S
from gramrank.plans import tfidf as T


@pytest.mark.parametrize("block_bytes", [1, 60, 1 << 20])
def test_blocks_of_documents_weigh_as_documents_do(spark, monkeypatch, block_bytes):
    """Blocks of one document and of many; ids with several rows are one document."""
    monkeypatch.setattr(blocks, "BLOCK_BYTES", block_bytes)
    chance = random.Random(3)
    rows = [
        (str(i), ". ".join(" ".join(chance.choices("abcdefgh", k=4)) + f" own{i}" for _ in range(4)))
        for i in range(40)
    ]
    df = spark.createDataFrame(rows + [("", "a b"), (None, "a b"), ("97", None), ("98", "--"), ("99", "")],
                               "doc_id string, body string")
    found = {(r["doc_id"], r["sid"]): r["score"] for r in S.sentence_scores(df).collect()}
    assert found == pytest.approx(plain.scores(rows), abs=1e-12)
    twice = [(i, body, j) for i, body in rows for j in range(1 + int(i) % 3)]
    df = spark.createDataFrame([(i, body + " more" * j) for i, body, j in twice], "doc_id string, body string")
    weights = {(r["doc_id"], r["word"]): r["tfidf"] for r in T.tf_idf(df).collect()}
    listed = S.sentence_weights(df).collect()
    assert {(r["doc_id"], r["word"]) for r in listed} == set(weights)
    assert [r["tfidf"] for r in listed] == pytest.approx([weights[r["doc_id"], r["word"]] for r in listed], abs=1e-12)


def test_words_of_a_block_are_sent_once(spark):
    rows = [(f"{i:03}", f"same words here. And one{i}") for i in range(100)] + [("050", "same")]
    df = spark.createDataFrame(rows, "doc_id string, body string").repartition(1, "doc_id")
    sent = {(r["doc_id"], r["word"]): r["n"] for r in blocks.block_words(df).collect()}
    assert len(sent) == 5 + 99 + 6
    assert sent["000", "same"] == sent["000", blocks.ANY] == 99
    assert (sent["050", "same"], sent["050", "words"], sent["050", blocks.ANY]) == (-2, -1, 1)


def test_words_that_were_not_counted_are_an_error():
    with pytest.raises(RuntimeError):
        blocks.looked_up_terms(pa.array([["a b"]]), pa.array(["a"]), np.zeros(1))


def test_best_sentences_of_a_batch_are_handed_on():
    nan = float("nan")
    rows = [("1", 0, 0.5), ("1", 1, 0.5), ("1", 2, 0.25), ("2", 0, None), ("2", 1, nan), ("2", 2, 0.0), ("2", 3, -0.0), ("1", 3, 0.5)]
    columns = [pa.array(column) for column in zip(*rows, strict=True)]
    kept = S._best_sentences(pa.record_batch(columns, names=["doc_id", "sid", "score"]), 2).to_pydict()
    assert list(zip(kept["doc_id"], kept["sid"])) == [("1", 1), ("2", 0), ("2", 1), ("2", 2), ("2", 3), ("1", 3)]


def test_sentences_without_a_score_come_last(spark):
    rows = [("1", 0, None), ("1", 1, 0.5), ("1", 2, float("nan")), ("1", 3, 0.5), ("2", 0, None), (None, 0, 1.0)]
    df = spark.createDataFrame(rows, "doc_id string, sid int, score double")
    found = [(r["doc_id"], r["sid"]) for r in S.top_sentences(df, 2).collect()]
    assert sorted(found, key=repr) == [("1", 2), ("1", 3), ("2", 0), (None, 0)]
