import llm_plain
import pytest
from pyspark.sql import functions as F

from gramrank.llm import exact_dedup as D


def result(frame, **options):
    found = D.deduplicate(frame, D.parquet_locator(), **options)
    return found.select("row.doc_id", "row.text", "keep_id", "group_size", "kept").collect()


ROWS = [(i, f"text {i % 7}") for i in range(60)] + [(100, "alone"), (101, ""), (102, None)]


@pytest.mark.parametrize("few", [0, 100_000])
@pytest.mark.parametrize("batches", [1, 100])
def test_copies_by_one_batch_or_many(docs, monkeypatch, batches, few):
    """With as many batches as files state carries over; lists too long to be broadcast
    change nothing."""
    monkeypatch.setattr(D, "FEW_ROWS", few)
    found = result(docs(ROWS, files=6), batches=batches)
    want = llm_plain.copies(ROWS)
    assert {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in found} == want
    assert {r["doc_id"] for r in found if r["kept"]} == {keep for keep, _ in want.values()}


def test_a_hit_meets_the_state_of_an_earlier_batch(spark, monkeypatch, tmp_path):
    """Each batch of the log has one arrival; the second finds the first in the state."""
    paths = {}
    plain_path = D.new_shared_path
    monkeypatch.setattr(
        D, "new_shared_path", lambda s, label: paths.setdefault(label, plain_path(s, label))
    )
    log = str(tmp_path / "log")
    for doc_id in (7, 3):
        row = spark.createDataFrame([(doc_id, f"f{doc_id}")], "doc_id long, file string")
        row.selectExpr(
            "unhex('aa') as digest", "4 as n_bytes", "struct(doc_id, struct(file, 0L as row) as locator) as arrival"
        ).coalesce(1).write.mode("append").parquet(log)
    state = D.run_stream(spark, log, batches=2).collect()
    assert [(r["kept"]["doc_id"], r["kept"]["locator"]["file"], r["group_size"]) for r in state] == [(7, "f7", 2)]
    changes = spark.read.parquet(paths["dedup-changes"]).where("batch >= 0")
    assert sorted((r["batch"], r["group_size"]) for r in changes.collect()) == [(0, 1), (1, 2)]


def test_only_hits_are_fetched(docs, monkeypatch):
    """By their locators: of the texts, only copies of others are compared."""
    fetched = []
    plain_clashes = D.clashes
    monkeypatch.setattr(D, "clashes", lambda arrived, hits, n: fetched.append((hits.count(), n)) or plain_clashes(arrived, hits, n))
    rows = [(i, f"text {i}") for i in range(50)] + [(60, "text 3"), (61, "text 3"), (62, "text 9")]
    found = result(docs(rows, files=3))
    assert {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in found} == llm_plain.copies(rows)
    assert fetched == [(5, 5)]


def test_texts_that_share_a_digest_are_told_apart(docs):
    first_byte = lambda text: F.substring(F.unhex(F.sha2(F.substring(text, 1, 1), 256)), 1, 1)
    rows = [(i, f"t{i % 3}") for i in range(12)] + [(20, "t"), (21, "other")]
    found = result(docs(rows), digest=first_byte)
    assert {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in found} == llm_plain.copies(rows)
    assert len(found) == len(rows)


def test_odd_rows_and_empty_tables(docs, odd_rows):
    found = result(docs(odd_rows))
    assert len(found) == len(odd_rows)
    same = [r for r in found if r["text"] == odd_rows[3][1]]
    assert [r["group_size"] for r in same] == [3, 3, 3]
    assert [r["keep_id"] for r in same] == [5, 5, 5]
    assert sum(r["kept"] for r in same) == 1
    blank = {r["doc_id"]: r for r in found if r["doc_id"] in (1, 2)}
    assert blank[1]["keep_id"] == 2 and not blank[1]["kept"] and blank[2]["kept"]
    assert [r["kept"] for r in found if r["doc_id"] is None] == [True]
    assert result(docs([])) == []


def test_rows_keep_all_their_columns(docs):
    frame = docs([(1, "a"), (2, "a")])
    kept = D.deduplicate(frame, D.parquet_locator()).where("kept").select("row.*")
    assert kept.columns == frame.columns
    assert [tuple(r) for r in kept.collect()] == [(2, "a", "en", 2, "a")]
