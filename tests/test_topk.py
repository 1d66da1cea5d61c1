import random

import numpy as np
import pyarrow as pa
import pytest

from gramrank.operators import topk
from gramrank.plans import summary as S


def _batch(rows):
    return pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], names=["doc_id", "sid", "best"])


def test_a_group_that_goes_on_in_the_next_batch_is_the_last():
    rows = [("1", 0, [1.0]), ("1", 1, [1.0]), ("1", 1, [2.0])]
    assert topk._last_group(_batch(rows), 2) == 1
    assert topk._last_group(_batch(rows[1:]), 2) == 0
    assert topk._last_group(_batch([*rows, (None, 1, [2.0])]), 2) == 3
    assert topk._merged(_batch(rows).slice(1), 2, 1).to_pylist() == [{"doc_id": "1", "sid": 1, "best": [2.0]}]


@pytest.mark.parametrize("batch_rows", ["1", "3", "10000"])
def test_arrays_of_a_group_are_merged_across_batches(spark, batch_rows):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    chance = random.Random(8)
    rows = [(chance.choice("ab"), chance.randrange(4), chance.random()) for _ in range(200)]
    spark.conf.set(name, batch_rows)
    try:
        df = spark.createDataFrame(rows, "key string, part int, v double").repartition(3)
        found = {(r["key"], r["part"]): r["best"] for r in topk.best_values(df, ["key", "part"], "v", 5).collect()}
    finally:
        spark.conf.set(name, before)
    groups = {}
    for key, part, v in rows:
        groups.setdefault((key, part), []).append(v)
    assert found == {g: sorted(v, reverse=True)[:5] for g, v in groups.items()}


def test_best_weights_are_sorted_once(spark):
    """Neither task holds or sorts its groups for an aggregate."""
    weights = spark.createDataFrame([("1", 0, "a", 0.5)], "doc_id string, sid int, word string, tfidf double")
    plan = S.top_weights(weights)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan
    assert plan.count("Sort [") == 1
    assert np.allclose([r["tfidf"] for r in S.top_weights(weights).collect()], [0.5])
