import random
import re

import plain
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gramrank.operators import counts, skew, topk
from gramrank.functions import text as X
from gramrank.operators.counts import term_counts, text_counts
from gramrank.plans import summary as S
from gramrank.plans import tfidf as T
from gramrank.sources.text import first_per_id

ARTICLES = [
    ("1", "Alpha beta. Beta gamma? Gamma delta! Delta alpha. Everything common"),
    ("2", "Common words here. One two three four five six seven eight. Common one two"),
    ("3", "Tab\there is fused. . Common tab. End with a stop."),
    ("4", "Same pair. Same pair. Same pair. Same pair. Same pair"),
    ("5", "–––. ???"),
    ("6", "word"),
]


@pytest.fixture
def articles(spark):
    return spark.createDataFrame(ARTICLES, "doc_id string, body string")


def test_tf_idf(articles):
    found = {(r["doc_id"], r["word"]): r["tfidf"] for r in T.tf_idf(articles).collect()}
    assert found == pytest.approx(plain.tf_idf(ARTICLES), abs=1e-12)


def test_word_in_every_document_weighs_nothing(spark):
    pair = spark.createDataFrame([("1", "a b"), ("2", "a c")], "doc_id string, body string")
    found = {(r["doc_id"], r["word"]): r["tfidf"] for r in T.tf_idf(pair).collect()}
    assert found["1", "a"] == found["2", "a"] == 0.0


def test_counts_of_a_repeated_id_are_merged(spark):
    rows = [("1", "a b"), ("1", "a c"), ("2", "a")]
    df = spark.createDataFrame(rows, "doc_id string, body string")
    found = {(r["doc_id"], r["word"]): r["tfidf"] for r in T.tf_idf(df).collect()}
    assert found == pytest.approx(plain.tf_idf(rows), abs=1e-12)
    assert first_per_id(df).count() == 2


def test_sentence_scores(articles):
    found = {(r["doc_id"], r["sid"]): r["score"] for r in S.sentence_scores(articles).collect()}
    assert found == pytest.approx(plain.scores(ARTICLES), abs=1e-12)


def test_of_equal_scores_the_later_sentences_stay(articles):
    top = S.top_sentences(S.sentence_scores(articles)).where("doc_id = '4'")
    assert sorted(r["sid"] for r in top.collect()) == [2, 3, 4]


def test_more_than_five_equal_values_add_up_five(spark):
    weights = spark.createDataFrame(
        [("1", 0, f"w{i}", 0.25) for i in range(7)], "doc_id string, sid int, word string, tfidf double"
    )
    assert S.score_sentences(weights).first()["score"] == 1.25


def test_summaries(articles):
    found = {r["doc_id"]: r["summary"] for r in S.summarize(articles).collect()}
    assert found == plain.summaries(ARTICLES)
    assert found["5"] == ""


@pytest.mark.parametrize("piece_rows", [1, 3, 1000])
def test_spread_join_equals_plain_join(spark, piece_rows):
    left = spark.range(300).select(
        F.when(F.col("id") < 200, "hot").otherwise((F.col("id") % 7).cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    right = left.groupBy("k").agg(F.count("*").alias("rows"), F.min("v").alias("low"))
    found = skew.spread_join(left, right, "k", "rows", ["v"], piece_rows)
    expected = left.join(right, "k")
    assert found.columns == expected.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


def test_a_hot_key_is_really_spread(spark):
    left = spark.range(1000).select(F.lit("hot").alias("k"), "id")
    sizes = left.groupBy("k").agg(F.count("*").alias("rows"))
    hot = skew.hot_keys(sizes, "k", "rows", piece_rows=100)
    salts = skew.add_salt(left, hot, "k", ["id"]).groupBy("_salt").count().collect()
    assert len(salts) == 10
    assert max(r["count"] for r in salts) < 200


def test_every_key_above_a_piece_is_cut(spark):
    """More hot keys than any fixed list would hold."""
    left = spark.range(20_000).select((F.col("id") % 5000).alias("k"), "id")
    sizes = left.groupBy("k").agg(F.count("*").alias("rows"))
    hot = skew.hot_keys(sizes, "k", "rows", piece_rows=2)
    assert hot.count() == 5000
    assert hot.agg(F.min("_pieces"), F.max("_pieces")).first() == (2, 2)


def test_a_piece_grows_with_the_table(spark, monkeypatch):
    """So the list of cut keys is bounded by arithmetic."""
    monkeypatch.setattr(skew, "PIECES", 4)
    left = spark.range(1000).select(F.when(F.col("id") < 500, 0).otherwise(F.col("id")).alias("k"))
    sizes = left.groupBy("k").agg(F.count("*").alias("rows"))
    assert [r["_pieces"] for r in skew.hot_keys(sizes, "k", "rows", piece_rows=1).collect()] == [2]


def test_weights_with_cut_keys(articles):
    found = {
        (r["doc_id"], r["word"]): r["tfidf"] for r in T.tf_idf(articles, piece_rows=2).collect()
    }
    assert found == pytest.approx(plain.tf_idf(ARTICLES), abs=1e-12)


def test_texts_are_read_once(articles, spark):
    """All uses of the counts in the TF-IDF plan share one shuffle."""
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def noted(body):
        reads.add(1)
        return body

    T.tf_idf(articles.withColumn("body", noted("body"))).collect()
    assert reads.value == len(ARTICLES)


@pytest.mark.parametrize("partitions", [1, 2, 5])
def test_of_repeated_ids_one_body_is_kept_everywhere(spark, partitions):
    rows = [("1", f"Body {i} of one. Word{i} here", f"T{i}") for i in range(9)]
    rows += [("2", "Only one. Here", "T")]
    df = spark.createDataFrame(rows, "doc_id string, body string, title string")
    first = first_per_id(df.repartition(partitions))
    assert first.columns == df.columns
    found = {r["doc_id"]: r["summary"] for r in S.summarize(first).collect()}
    assert found == plain.summaries([("1", rows[0][1]), ("2", "Only one. Here")])


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((.*?), [0-9]+\)", plan)


def test_terms_cross_the_network_twice_after_counting(articles):
    """To their word and back to their document; from there on nothing moves but the
    pre-aggregated figures of words and documents."""
    tf_idf = _shuffle_keys(T.tf_idf(articles))
    cut = ("_groupingexpression",)
    assert set(tf_idf) == {
        ("doc_id", "word"), ("word",), ("word", "_salt"), ("doc_id",), ("doc_id", "_salt"), cut
    }
    # the texts lie by id, so that terms are counted in place
    summaries = _shuffle_keys(S.summarize(articles))
    assert set(summaries) == {("word",), ("word", "_salt"), ("doc_id",), cut}


def _shuffle_keys(df):
    return [
        tuple(re.sub(r"#\d+L?", "", key).strip() for key in keys.split(","))
        for keys in _exchanges(df)
    ]


def test_no_window_over_words_or_documents(articles):
    for df in (T.tf_idf(articles), S.summarize(articles), S.sentence_scores(articles),
               S.top_weights(S.sentence_weights(articles))):
        plan = df._jdf.queryExecution().toString()
        assert "Window" not in plan
        assert "Cartesian" not in plan


def test_sentence_words_are_looked_up_in_the_row(articles):
    """Nothing is joined by document and word, and no sentence word is sorted."""
    for df in (S.sentence_weights(articles), S.summarize(articles)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        joins = re.findall(r"(?:SortMerge|ShuffledHash|BroadcastHash)Join \[(.*?)\]", plan)
        keys = {re.sub(r"#\d+L?", "", key) for key in joins}
        assert keys and "doc_id, word" not in keys and keys <= {"doc_id", "word, _salt", "_hash"}
        assert "sid" not in "".join(re.findall(r"Sort \[(.*?)\]", plan))


@settings(max_examples=100, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.lists(st.lists(st.sampled_from("abcdé"), max_size=4), max_size=4),
            st.dictionaries(st.sampled_from("abcxé"), st.floats(-1, 1), max_size=4),
        ),
        max_size=6,
    )
)
def test_look_up_equals_dictionaries(rows):
    lines = pa.array([line for line, _ in rows], pa.list_(pa.list_(pa.string())))
    words = pa.array([list(d) for _, d in rows], pa.list_(pa.string()))
    weights = pa.array([list(d.values()) for _, d in rows], pa.list_(pa.float64()))
    want = [[[d.get(w) for w in line] for line in sent] for sent, d in rows]
    assert S.Weighed(lines, words, weights).lists().to_pylist() == want
    cut = [x.slice(1) for x in (lines, words, weights)]
    assert S.Weighed(*cut).lists().to_pylist() == want[1:]
    for row, numbers in zip(want, S.Weighed(lines, words, weights).best(2, 2).to_pylist(), strict=True):
        values = [sorted((v for v in line if v is not None), reverse=True)[:2] for line in row]
        scores = [(0.0 + sum(v), i) for i, v in enumerate(values) if v]
        assert numbers == sorted(i for _, i in sorted(scores)[-2:])


@pytest.mark.parametrize("partitions", [1, 4])
def test_best_values_equal_sorted_lists(spark, partitions):
    chance = random.Random(6)
    rows = [(chance.choice(["a", "b", None, "c"]), chance.randrange(3), chance.choice([0.5, 0.25, None, 1.0]))
            for _ in range(400)]
    df = spark.createDataFrame(rows, "key string, part int, v double").repartition(partitions)
    found = {(r["key"], r["part"]): r["best"] for r in topk.best_values(df, ["key", "part"], "v", 4).collect()}
    groups = {}
    for key, part, v in rows:
        if v is not None:
            groups.setdefault((key, part), []).append(v)
    assert found == {g: sorted(v, reverse=True)[:4] for g, v in groups.items()}


def test_a_task_hands_on_at_most_k_values_of_a_group(spark):
    df = spark.range(10_000, numPartitions=2).selectExpr("id % 2 as key", "cast(id as double) as v")
    best = topk.best_values(df, ["key"], "v", 3)
    assert sorted(map(tuple, best.collect())) == [(0, [9998.0, 9996.0, 9994.0]), (1, [9999.0, 9997.0, 9995.0])]
    batch = pa.record_batch([pa.array([1, 0, 1, 1, 1]), pa.array([0.5, 2.0, 4.0, 1.0, 3.0])], names=["key", "v"])
    assert topk._best_of_batch(batch, 1, 2).to_pylist() == [
        {"key": 1, "best": [4.0, 3.0]}, {"key": 0, "best": [2.0]}
    ]


def test_a_document_of_very_many_terms_is_cut(spark):
    """A hot id, repeated in many rows: its terms lie in many tasks."""
    rows = [("hot", " ".join(f"w{j}" for j in range(i, i + 50)) + " w1") for i in range(0, 1000, 50)]
    rows += [(str(i), "w1 w2 w2") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id string, body string")
    counts = term_counts(df)
    found = T.term_frequency(counts, piece_rows=100)
    assert {(r["doc_id"], r["word"]): r["tf"] for r in found.collect()} == pytest.approx(
        {(r["doc_id"], r["word"]): r["tf"] for r in T.term_frequency(counts).collect()}
    )
    weights = {(r["doc_id"], r["word"]): r["tfidf"] for r in T.tf_idf(df, piece_rows=100).collect()}
    assert weights == pytest.approx(plain.tf_idf(rows), abs=1e-12)
    hot = skew.hot_keys(T.document_stats(counts), "doc_id", "words", 100)
    spread = skew.add_salt(counts.where("n > 0"), hot, "doc_id", ["word"]).where("doc_id = 'hot'")
    sizes = [r["count"] for r in spread.groupBy("_salt").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 200


def test_terms_of_a_document_in_one_row_are_not_moved_to_it(spark):
    """The counts and their highest are found in the row; rows sharing an id are added up."""
    rows = [("1", "b a a. A"), ("2", "x y"), ("2", "y Y z"), ("3", " \t--"), ("4", None), (None, "a")]
    df = spark.createDataFrame(rows, "doc_id string, body string")
    counted = {r["doc_id"]: list(zip(r["words"], r["ns"])) for r in text_counts(df.where("doc_id != '2'")).collect()}
    assert counted == {"1": [("a", 3), ("b", 1)]}
    found = {tuple(r)[:4] for r in T.article_term_frequency(df).collect()}
    assert found == {("1", "a", 3, 3), ("1", "b", 1, 3), ("2", "y", 3, 3), ("2", "x", 1, 3), ("2", "z", 1, 3)}
    by_counts = T.term_frequency(term_counts(df))
    assert sorted(by_counts.collect()) == sorted(T.article_term_frequency(df).select(by_counts.columns).collect())


def test_term_frequency_reads_texts_once(spark):
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def noted(body):
        reads.add(1)
        return body

    df = spark.createDataFrame(ARTICLES + ARTICLES[:1], "doc_id string, body string")
    T.article_term_frequency(df.withColumn("body", noted("body"))).collect()
    assert reads.value == len(ARTICLES) + 1


def test_texts_are_split_in_slices(monkeypatch):
    """A text of any length whole, several as long as they are short."""
    monkeypatch.setattr(counts, "SPLIT_BYTES", 10)
    texts = ["aa bb", None, "", "a" * 50, "b b", "c", "dd ee ff gg"]
    batch = pa.record_batch([pa.array(range(7)), pa.array(texts)], names=["doc_id", "text"])
    slices = list(counts.in_slices(batch, 1))
    assert [part.num_rows for part in slices] == [3, 1, 2, 1]
    assert pa.Table.from_batches(slices).to_pydict() == batch.to_pydict()
    whole = [row for part in slices for row in counts._count_rows(part).to_pylist()]
    assert [row["doc_id"] for row in whole] == [0, 3, 4, 5, 6]
    assert whole[2] == {"doc_id": 4, "words": ["b"], "ns": [2]}


ODD_TEXTS = [
    "Al\u212avin \u0130stanbul É ß\x0b x\x1cy\x7f\x00", None, "", "  ", "a\tb\nc\rd\fe f", "a b a. B-b!", "你 好1",
]


def test_cleaning_over_bytes_equals_the_expressions(spark):
    df = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "doc_id int, body string")
    rows = df.select("doc_id", X.cleaned_text(F.col("body")).alias("t")).orderBy("doc_id").collect()
    texts = pa.array(["skipped", *ODD_TEXTS])[1:]
    assert counts.cleaned_rows(texts).to_pylist() == [r["t"] or "" for r in rows]
    plan = text_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert "regexp_replace" not in plan
    listed = df.select("doc_id", F.transform(F.array("body", "body"), X.sentence_word_array).alias("w"))
    want = [[sorted(set(line or []) - {""}) for line in r["w"]] for r in listed.orderBy("doc_id").collect()]
    sentences = pa.array([["skipped"], *([t, t] for t in ODD_TEXTS), []])[1:]
    found = S.words_of(sentences).to_pylist()
    assert [[sorted(line) for line in row] for row in found] == [*want, []]


def test_sentence_words_are_split_where_they_are_looked_up(articles):
    """Sentences go to the look-up whole; no regular expression runs over each of them."""
    for df in (S.sentence_weights(articles), S.sentence_scores(articles), S.summarize(articles)):
        assert "regexp_replace" not in df._jdf.queryExecution().executedPlan().toString()


def test_counts_of_summaries_share_one_shuffle(articles):
    """All uses of the counted texts filter them alike, or each would count them anew."""
    plan = S.summarize(articles)._jdf.queryExecution().executedPlan().toString()
    found = re.findall(r"Filter ([^\n]*)\n[^\n]*MapInArrow", plan)
    assert len(found) > 2 and len({re.sub(r"#\d+L?", "", one) for one in found}) == 1
