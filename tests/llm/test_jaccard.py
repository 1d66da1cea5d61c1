import random

import llm_plain
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gramrank.llm import jaccard as J
from gramrank.llm.components import components


def family(draw, base, n, edits):
    """Near copies of ``base``, each with up to ``edits`` words replaced."""
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(draw.randrange(edits + 1)):
            words[draw.randrange(len(words))] = f"w{draw.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(7)
    word = lambda: f"v{draw.randrange(400)}"
    texts = []
    kinds = ((90, 45, 3), (60, 30, 2), (200, 20, 8), (1500, 8, 60), (40, 12, 2), (12, 10, 1))
    for size, n, edits in kinds:
        texts += family(draw, [word() for _ in range(size)], n, edits)
    passage = " ".join(word() for _ in range(50))
    for _ in range(40):  # a passage many texts share, at several lengths
        texts.append(passage + " " + " ".join(word() for _ in range(draw.randrange(5, 60))))
    texts += [" ".join(word() for _ in range(draw.randrange(1, 9))) for _ in range(20)]
    texts += ["One two THREE", "one two three", "one two", "", None, "  \n", "a", "A"]
    draw.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("words, least", [(3, 90), (5, 80)])
def test_classes_equal_all_pairs(docs, corpus, words, least):
    found = J.similar_classes(docs(corpus), J.Rule(words, least)).collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found}
    assert got == llm_plain.classes(corpus, words, least)
    assert len(found) == len(corpus)


def test_one_of_each_class(docs, corpus):
    frame = docs(corpus)
    kept = J.one_of_each_class(frame)
    assert kept.columns == frame.columns
    want = {c for _, c in llm_plain.classes(corpus, 5, 80).values()}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 60), max_size=40), st.sets(st.integers(0, 60), max_size=40))
def test_bitmaps_bound_the_difference(a, b):
    x, y = (J.T.mix(np.array(sorted(s), dtype=np.uint64)) for s in (a, b))
    for words in (1, 4, 8):
        bits = np.bitwise_xor(J.bitmap(x, words), J.bitmap(y, words)).view(np.uint64)
        assert sum(int(v).bit_count() for v in bits) <= len(a ^ b)


def test_wide_bitmaps_fold(spark):
    tokens = J.T.mix(np.arange(3000, dtype=np.uint64))
    wide = J.wide_bitmap(tokens)
    assert len(wide) * 64 >= len(tokens)
    df = spark.createDataFrame([(wide.tolist(),)], "wide array<long>")
    for words in (1, 8, 32, len(wide)):
        folded = df.select(J._folded(J.F.col("wide"), J.F.lit(words))).first()[0]
        assert folded == J.bitmap(tokens, words).tolist()


def test_odd_rows_and_empty_tables(docs, odd_rows):
    found = J.similar_classes(docs(odd_rows)).collect()
    assert len(found) == len(odd_rows)
    blank = {r["doc_id"]: r for r in found if r["doc_id"] in (1, 2, 3)}
    assert {(r["n_shingles"], r["component_id"]) for r in blank.values()} == {(0, 1), (0, 2), (0, 3)}
    assert {r["component_id"] for r in found if r["doc_id"] == 4} == {4}
    assert J.similar_classes(docs([])).count() == 0
    # of the rows under id 5 the copy of 4 goes, the other text stays
    kept = [tuple(r)[:2] for r in J.one_of_each_class(docs(odd_rows)).collect()]
    assert (5, odd_rows[6][1]) in kept and (5, odd_rows[5][1]) not in kept
    assert (None, "a text without an id") in kept


def test_components(spark):
    draw = random.Random(1)
    edges = [(draw.randrange(80), draw.randrange(80)) for _ in range(60)]
    edges += [(i, i + 1) for i in range(100, 130)] + [(200, i) for i in range(201, 260)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r["node"]: r["component"] for r in components(df, "a", "b").collect()}
    assert found == {x: root(x) for x in parent if root(x) != x}
    assert components(df.limit(0), "a", "b").count() == 0


def test_few_words_are_hashed_at_a_time(spark):
    """Texts of a batch go through in slices, and give the same sets."""
    texts = [" ".join(f"w{(i * j) % 97}" for j in range(2000)) for i in range(80)]
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.record_batch([ids, ids, pa.array(texts)], names=["doc_id", "text_key", "text"])

    class Docs:
        sparkSession = spark
        schema = spark.createDataFrame([], "doc_id long, text_key long, text string").schema

        def select(self, *columns):
            return self

        def mapInArrow(self, index, schema):
            return list(index([batch]))

    found = J.index_sets(Docs(), J.Rule(), np.zeros(1 << J.COUNTER_BITS, dtype=np.int64))
    assert sum(map(len, texts)) < 1 << 20 and len(found) > 1
    rows = pa.Table.from_batches(found)
    assert rows["doc_id"].to_pylist() == ids.to_pylist()
    assert rows["n"].to_pylist() == [len({tuple(t.split()[k : k + 5]) for k in range(1996)}) for t in texts]
