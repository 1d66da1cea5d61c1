import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gramrank.llm import pu_quality as Q
from gramrank.llm import textarrays as T


def gauss(n, shift, seed):
    return np.random.default_rng(seed).normal(shift, 1, (n, 5)).astype(np.float32)


@pytest.mark.parametrize("prior", [0.3, 0.6, 0.9])
def test_prior_and_classes_of_a_known_mixture(prior):
    n = 4000
    good = int(prior * n)
    unlabelled = np.vstack([gauss(good, 1.5, 1), gauss(n - good, -1.5, 2)])
    model = Q.fit(gauss(1500, 1.5, 3), unlabelled[np.random.default_rng(4).permutation(n)])
    assert model.prior == pytest.approx(prior, abs=0.08)
    assert (model.score(gauss(500, 1.5, 5)) >= 0.5).mean() > 0.95
    assert (model.score(gauss(500, -1.5, 6)) < 0.5).mean() > 0.95


def test_without_positives_nothing_is_known():
    model = Q.fit(np.zeros((0, 5), np.float32), gauss(10, 0, 1))
    assert (model.score(gauss(3, 0, 2)) == 0.5).all()


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["One. two two|three", "", None, "É! 12 <b>\nline\nline", "x" * 3000, "a b c a b c"]
    whole = np.vstack([Q.features(c) for c in T.chunks(pa.array(texts))])
    alone = np.vstack([Q.features(next(T.chunks(pa.array([t], pa.string())))) for t in texts])
    assert np.allclose(whole, alone)
    assert not whole[1].any() and not whole[2].any()
    assert whole.shape == (6, Q.FEATURES)


def prose(draw):
    words = ["river", "stone", "and", "the", "walked", "slowly", "over", "green", "hills"]
    return ". ".join(" ".join(draw.choices(words, k=9)).capitalize() for _ in range(8))


def junk(draw):
    return " ".join(draw.choices(["BUY!!", "NOW!!", "$$$", "CLICK|", "###"], k=60))


def test_learned_from_positives_and_unlabelled(docs, spark):
    draw = random.Random(3)
    rows = [(i, prose(draw) if i % 4 else junk(draw)) for i in range(600)]
    # negatives carry labels that must not matter
    labels = [(i, int(i % 4 != 0), 0) for i in range(0, 600, 3)] + [(0, None, None)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = Q.classify(docs(rows), labels).select("row.doc_id", "held_out", "score", "predicted")
    found = found.collect()
    assert len(found) == 600
    assert all(0 <= r["score"] <= 1 for r in found)
    right = [r["predicted"] == int(r["doc_id"] % 4 != 0) for r in found if r["held_out"]]
    assert np.mean(right) > 0.97


def test_held_out_rows_are_a_fifth_by_checksum(spark):
    import zlib

    df = spark.range(200).select("id", Q.held_out(F.col("id")).alias("held"))
    assert all(r["held"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in df.collect())


def test_odd_rows_and_empty_tables(docs, odd_rows, spark):
    labels = spark.createDataFrame([(4, 1), (5, 1), (None, 1), (6, 0)], "doc_id long, quality int")
    found = Q.classify(docs(odd_rows), labels)
    assert found.count() == len(odd_rows)
    assert found.select("row.*").columns == docs(odd_rows).columns
    assert Q.classify(docs([]), labels.limit(0)).count() == 0


def test_rows_of_a_repeated_id_are_bounded(docs, spark):
    """A third of all rows share an id: no more than the limit comes to the driver, and
    equal rows count once."""
    rows = [(1, f"text number {i} of the hot id") for i in range(300)] + [(1, "copy")] * 300
    texts = docs(rows).selectExpr("doc_id as key", "text")
    assert Q._feature_rows(texts, 50).shape == (50, Q.FEATURES)
    assert Q._feature_rows(texts, 1000).shape == (301, Q.FEATURES)
    assert (Q._feature_rows(texts.repartition(5), 50) == Q._feature_rows(texts, 50)).all()
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert Q.train(docs(rows), labels, positives=20, unlabelled=30).weights.shape == (Q.FEATURES,)


def test_risk_equals_a_plain_computation():
    """Steps of the fit lessen the non-negative risk as it is written down."""
    positive, unlabelled, prior = gauss(400, 1.0, 1), np.vstack([gauss(300, 1.0, 2), gauss(300, -1.0, 3)]), 0.5

    def risk(w, b):
        loss = lambda z: float(np.mean([math.log1p(math.exp(-v)) for v in z]))
        zp, zu = positive @ w + b, unlabelled @ w + b
        return prior * loss(zp) + max(0.0, loss(-zu) - prior * loss(-zp))

    start = risk(np.zeros(5), 0.0)
    risks = [risk(*Q._descend(positive.astype(float), unlabelled.astype(float), prior, epochs, 3)) for epochs in (1, 5, 30)]
    assert start > risks[0] > risks[1] >= risks[2] - 1e-3
    # the first step, of one batch, goes against the risk's slope in every direction
    slope = [(risk(np.eye(5)[i] * 1e-4, 0.0) - risk(np.eye(5)[i] * -1e-4, 0.0)) / 2e-4 for i in range(5)]
    few = np.vstack([unlabelled[:200], unlabelled[300:500]])
    w, _ = Q._descend(positive.astype(float), few.astype(float), prior, 1, 3)
    assert (np.sign(w) == -np.sign(slope)).all()
    assert w == pytest.approx(-0.01 * np.sign(slope), rel=1e-4)
