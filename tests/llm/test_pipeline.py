"""The pipeline on small tables: each stage does what its operator says."""

import random

import llm_plain
import pytest

import corpus_pipeline as C


@pytest.fixture
def tables(spark, tmp_path):
    def make(rows, labels):
        path = str(tmp_path / f"tables-{len(rows)}")
        docs = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        spark.createDataFrame(docs, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
            f"{path}/labels.parquet"
        )
        return path

    return make


def corpus():
    draw = random.Random(11)
    words = [f"{a}{b}" for a in ("ri", "sto", "wal", "gre", "hil") for b in ("ver", "ne", "ked", "en")]
    prose = lambda: ". ".join(" ".join(draw.choices(words, k=9)).capitalize() for _ in range(6))
    rows = [(i, prose()) for i in range(300)]
    rows += [(300 + i, " ".join(draw.choices(["BUY!!", "$$$", "NOW!!", "###"], k=70))) for i in range(60)]
    rows += [(400 + i, rows[i % 5][1]) for i in range(25)]  # exact copies
    rows += [(500 + i, f"{rows[10][1]} also{i}") for i in range(20)]  # near copies
    rows += [(600 + i, f"{prose()}. Write to kim.{i}@mail.example.com today") for i in range(30)]
    labels = [(i, int(i < 300 or i >= 400), 0) for i, _ in rows[::2]]
    return rows, labels


def test_stages(spark, tables):
    rows, labels = corpus()
    path = tables(rows, labels)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in C.STAGES:
        out = f"{path}/{name}"
        stage(spark, docs, path).write.parquet(out)
        docs = spark.read.parquet(out)
        kept[name] = docs.collect()
        if name != "packed":
            assert docs.columns == columns
    text = dict(rows)
    good = {r["doc_id"] for r in kept["quality"]}
    assert len(good & set(range(300, 360))) <= 2
    assert len(set(text) - set(range(300, 360)) - good) <= 8
    exact = {r["doc_id"] for r in kept["exact"]}
    assert exact == {k for k, _ in llm_plain.copies([(i, text[i]) for i in good]).values()}
    near = {r["doc_id"] for r in kept["near"]}
    classes = llm_plain.classes([(i, text[i]) for i in exact], 5, 80)
    assert near == {c for _, c in classes.values()}
    private = {r["doc_id"]: r for r in kept["private"]}
    assert set(private) == near
    for i, row in private.items():
        assert "@" not in row["text"] and row["n_chars"] == len(row["text"])
        if "@" not in text[i]:
            assert row["text"] == text[i]
        else:
            assert "[EMAIL]" in row["text"]
    assert {r["doc_id"] for r in kept["packed"]} == near
    assert all(r["start"] == 0 for r in kept["packed"])


def test_run_on_empty_tables(spark, tables):
    assert C.run(spark, tables([], [])).count() == 0


def _sent_to_python(df):
    """Types of the columns that the plan's Arrow step gets."""
    node = df._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "MapInArrow":
        node = node.children().apply(0)
    return node.children().apply(0).schema().json()


def test_a_text_goes_to_the_tasks_once(spark, tables, monkeypatch):
    path = tables([(i, f"some text {i}") for i in range(8)], [(1, 1, 0), (2, 0, 0)])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    monkeypatch.setattr(C.pii, "train_tagger", lambda docs: None)
    for stage in (C.quality, C.private):
        assert _sent_to_python(stage(spark, docs, path)).count('"name":"text"') == 1
