import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gramrank.llm import hard_negatives as H
from gramrank.llm import onebit, queries

VECTORS = "id long, label long, vector array<int>"


def plain(rows, is_anchor, positives=5, negatives=3, low=50, high=95):
    rows = [r for r in rows if r[1] is not None and r[2] is not None]
    last = lambda i: (i is None, i)
    found = []
    for at, (anchor, label, q) in enumerate(rows):
        if anchor is None or not is_anchor(anchor):
            continue
        scored = [(-sum(a * b for a, b in zip(q, v)), last(i), k, lab, i) for k, (i, lab, v) in enumerate(rows)]
        mine = sorted(s for s in scored if s[3] == label and s[2] != at)[:positives]
        for score, *_, positive in mine:
            inside = sorted(
                s for s in scored if s[3] != label and low * -score <= 100 * -s[0] <= high * -score
            )
            for rank, s in enumerate(inside[:negatives], 1):
                found.append((anchor, positive, rank, s[4], -score, -s[0]))
    return sorted(found, key=repr)


def mined(spark, rows, every, **options):
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "id as key", "label as score")
    found = H.mine_hard_negatives(df, F.col("id") % every == 0, **options)
    assert found.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ]
    return sorted(map(tuple, found.collect()), key=repr)


def clustered(seed, size, dimensions, labels=4, spread=25):
    chance = np.random.default_rng(seed)
    centres = chance.normal(0, 40, (labels, dimensions))
    rows = []
    for i in range(size):
        label = int(chance.integers(labels))
        near = centres[label if chance.random() < 0.7 else chance.integers(labels)]
        rows.append((i, label, np.floor(near + chance.normal(0, spread, dimensions)).astype(int).tolist()))
    return rows


@pytest.mark.parametrize("block_rows", [40, 65_536])
@pytest.mark.parametrize("dimensions", [1, 3, 64, 70])
def test_mined_equal_all_pairs(spark, dimensions, block_rows):
    rows = clustered(dimensions, 400, dimensions)
    want = plain(rows, lambda i: i % 5 == 0)
    assert want
    assert mined(spark, rows, 5, block_rows=block_rows) == want


def test_ties_repeated_rows_and_a_hot_label(spark):
    chance = np.random.default_rng(9)
    rows = [(i, 0 if i % 3 else i % 7, chance.integers(-2, 3, 4).tolist()) for i in range(300)]
    rows += [(i, 1, [2, 2, 2, 2]) for i in range(300, 400)]
    rows += [(400, 2, [1, 1, 1, 1])] * 4 + [(403, 3, [1, 1, 1, 0])] * 2
    assert mined(spark, rows, 20, block_rows=64) == plain(rows, lambda i: i % 20 == 0)


def test_odd_rows(spark):
    rows = [
        (0, 1, [10, 0, 0]),
        (1, 1, [10]),
        (2, 2, [8, 5, 5]),
        (3, None, [10, 0, 0]),
        (4, 2, None),
        (None, 2, [8, 0, 1]),
        (5, 3, []),
        (10, 4, [0, 0, 0]),
        (11, 4, [0, 1, 0]),
        (20, 5, [-1, -1, 0]),
        (21, 5, [1, 1, 0]),
    ]
    assert mined(spark, rows, 10) == plain(rows, lambda i: i % 10 == 0)
    assert mined(spark, [], 10) == []
    assert mined(spark, [(7, 1, [1]), (8, 2, [1])], 10) == []


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 80), st.sampled_from([1, 50, 30_000]))
def test_intervals_hold_the_inner_product(seed, dimensions, size):
    chance = np.random.default_rng(seed)
    rows = chance.integers(-size, size + 1, (40, dimensions))
    anchors = np.concatenate([rows[:5], chance.integers(-size, size + 1, (5, dimensions)), rows[:1] * 0])
    least, most = onebit.Queries(anchors, 3).intervals(0, len(anchors), onebit.encode(rows, 3))
    exact = anchors @ rows.T
    assert (least <= exact).all() and (exact <= most).all()


def test_a_rotation_keeps_lengths_and_products():
    rows = np.random.default_rng(1).integers(-99, 99, (20, 70))
    turned = onebit.rotate(rows, 5)
    assert turned.shape == (20, 128)
    assert np.allclose(turned @ turned.T, rows @ rows.T)
    assert not np.allclose(turned[:, :70], rows)


def test_most_rows_are_never_scored(monkeypatch):
    """Once an anchor has met rows that are very like it, few others are scored."""
    scored = []
    plain_scores = H._scores

    def noted(anchors, low, high, rows, first, wanted):
        scored.append((wanted.sum(), wanted.size))
        return plain_scores(anchors, low, high, rows, first, wanted)

    monkeypatch.setattr(H, "_scores", noted)
    chance = np.random.default_rng(4)
    centres = chance.normal(0, 40, (20, 64))
    vectors = np.concatenate([np.repeat(centres, 10, 0), chance.normal(0, 40, (8000, 64))])
    vectors = np.rint(vectors + chance.normal(0, 4, vectors.shape)).astype("<i4")
    codes = onebit.encode(vectors, 7)
    table = pa.table(
        {
            "key": pa.array(range(len(vectors))),
            "id": pa.array(range(len(vectors))),
            "label": pa.array([1] * len(vectors)),
            "vector": [v.tobytes() for v in vectors],
            "code": [c.tobytes() for c in codes.words],
            "alignment": codes.alignment,
            "rest": codes.rest,
        }
    )
    found = H.find_positives(5, 7)(table, table.slice(0, 200))
    assert found.num_rows == 1000
    kept, seen = map(sum, zip(*scored))
    assert kept < 0.2 * seen


def test_too_large_products_are_an_error(spark):
    big = [2**31 - 1] * 4
    with pytest.raises(Exception, match="64 bits"):
        mined(spark, [(0, 1, big), (1, 1, big)], 10)


def test_components_in_steps(spark):
    rows = [
        (1, [0.5, -0.001], 3),
        (7, [1.0, 0.0], 9),
        (2, [float("nan"), 0.0], 1),
        (3, [float("inf"), 0.0], 1),
        (4, [None, 0.0], 1),
        (5, None, 1),
        (6, [1.0, 1.0], None),
        (None, [], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert sorted(map(tuple, queries.whole_vectors(df).collect()), key=repr) == [
        (1, 3, [128, -1]), (7, 0, [256, 0]), (None, 1, [])
    ]
