import os
import random

import pytest
from pyspark.sql import functions as F

from gramrank import jobs, schemas
from gramrank.session import new_shared_path, shared_dir, sibling_session
from gramrank.sources import results, sinks
from gramrank.sources import text as X


@pytest.fixture
def counted(spark):
    return spark.createDataFrame(
        [("", 1), ("apple", 2), ("kiwi", 3), ("lime", 4), ("rice", 5), ("veal", 6), ("7up", 7)],
        "word string, n bigint",
    )


def test_key_value_round_trip(spark, counted, tmp_path):
    path = str(tmp_path / "kv")
    sinks.write_kv(counted, path)
    found = {r["key"]: r["value"] for r in X.read_kv(spark, path).collect()}
    assert found == {r["word"]: str(r["n"]) for r in counted.collect()}
    with pytest.raises(Exception, match="already exists"):
        sinks.write_kv(counted, path)
    sinks.write_kv(counted, path, mode="overwrite")


def test_letter_folders(spark, counted, tmp_path):
    path = str(tmp_path / "letters")
    sinks.write_by_letter(counted, path)
    assert sorted(f for f in os.listdir(path) if f.startswith("bucket")) == [
        f"bucket={b}" for b in range(5)
    ]
    zero = X.read_kv(spark, f"{path}/bucket=0").collect()
    assert {r["key"] for r in zero} == {"", "7up", "apple"}


def test_names_may_contain_the_separator(spark, tmp_path):
    points = [("Plain", 1.5, 2.0), ("One, Inc.", 8.25, 1e-7), ("A, B, C", -1.0, 3.5)]
    df = spark.createDataFrame(points, "name string, x double, y double")
    path = str(tmp_path / "points")
    sinks.write_tuples(df, path, ", ")
    assert sorted(map(tuple, results.parse_points(X.read_lines(spark, path)).collect())) == sorted(points)


def test_clusters_and_elbow(lines):
    saved = lines(
        "((centroid0, 1.5, 2.5),[(Plain, 1.0, 2.0), (One, Inc., 2.0, 3.0)])",
        "((centroid12, 8.0, 0.5),[(A, B, C, 8.0, 0.5)])",
    )
    assert sorted(map(tuple, results.parse_clusters(saved).collect())) == [
        (0, 1.5, 2.5, "One, Inc.", 2.0, 3.0),
        (0, 1.5, 2.5, "Plain", 1.0, 2.0),
        (12, 8.0, 0.5, "A, B, C", 8.0, 0.5),
    ]
    assert [tuple(r) for r in results.parse_elbow(lines("(1,76.5)", "(2,1.0E-4)")).collect()] == [
        (1, 76.5),
        (2, 0.0001),
    ]


@pytest.fixture
def small_splits(spark):
    """A session whose readers cut files into small parts."""
    return sibling_session(
        spark,
        {"spark.sql.files.maxPartitionBytes": "100", "spark.sql.files.openCostInBytes": "1"},
    )


@pytest.mark.parametrize("end", ["\n", ""])
def test_members_are_read_one_by_one(small_splits, tmp_path, end):
    chance = random.Random(3)
    expected, folder = [], tmp_path / "clusters"
    folder.mkdir()
    for part in range(3):
        lines = []
        for cluster in range(8):
            cid = 10 * part + cluster
            members = [
                (chance.choice(["Plain", "One, Inc.", "A, B, C", "((odd", "x" * 90, "e),[d"]), float(i), -0.5)
                for i in range(chance.choice([0, 1, 2, 30]))
            ]
            expected += [(cid, 1.5, float(part), *m) for m in members]
            written = ", ".join(f"({n}, {x}, {y})" for n, x, y in members)
            lines.append(f"((centroid{cid}, 1.5, {float(part)}),[{written}])")
        (folder / f"part-{part}").write_text("\n".join(lines) + end)
    read = results.read_clusters(small_splits, str(folder))
    assert sorted(map(tuple, read.collect())) == sorted(expected)
    whole = results.parse_clusters(X.read_lines(small_splits, str(folder)))
    named = [tuple(r) for r in whole.collect() if r["name"] and "odd" not in r["name"]]
    assert sorted(named) == sorted(row for row in expected if "odd" not in row[3])


def test_a_cluster_of_a_million_members_in_several_splits(spark, tmp_path):
    path = tmp_path / "cluster"
    with path.open("w") as file:
        file.write("((centroid7, 1.0, 2.0),[")
        file.write(", ".join(f"(m{i}, {i}.0, 0.5)" for i in range(1_000_000)))
        file.write("])\n((centroid8, 3.0, 4.0),[(last, 1.0, 1.0)])\n")
    session = sibling_session(spark, {"spark.sql.files.maxPartitionBytes": "4m"})
    found = results.read_clusters(session, str(path))
    assert session.read.option("lineSep", "), (").text(str(path)).rdd.getNumPartitions() > 4
    row = found.groupBy("centroid_id", "cx").agg(F.count("*"), F.sum("x"), F.count_distinct("name"))
    assert sorted(map(tuple, row.collect())) == [
        (7, 1.0, 1_000_000, 499999500000.0, 1_000_000), (8, 3.0, 1, 1.0, 1)
    ]


def test_shared_folder_is_kept(spark):
    assert shared_dir(spark) == shared_dir(spark)
    assert new_shared_path(spark, "a") != new_shared_path(spark, "a")


def run(spark, *argv):
    args = jobs.parser().parse_args(list(argv))
    args.run(spark, args)


def test_jobs(spark, text_file, tmp_path):
    articles = text_file("in.txt", "T<====>1<====>Apple pie. Pie tin", "U<====>2<====>Apple tree")
    out = lambda name: str(tmp_path / name)
    run(spark, "word-count", articles, out("wc"))
    run(spark, "profile", articles, out("corpus"), "--kind", "corpus")
    run(spark, "profile", articles, out("terms"), "--kind", "doc-terms")
    run(spark, "profile", articles, out("words"), "--kind", "vocabulary")
    run(spark, "tf-idf", articles, out("tfidf"))
    run(spark, "summaries", articles, out("sum"))
    assert {r["key"]: r["value"] for r in X.read_kv(spark, out("corpus")).collect()} == {
        "apple": "2",
        "pie": "2",
        "tin": "1",
        "tree": "1",
    }
    assert {r["key"]: r["value"] for r in X.read_kv(spark, out("sum")).collect()} == {
        "1": "Apple pie. Pie tin. ",
        "2": "Apple tree. ",
    }
    links = text_file("links.txt", "1: 2 3 4", "2: 1 4", "3: 3", "4: 2 3")
    titles = text_file("titles.txt", "Node1", "Node2", "Node3 surfing", "Node4")
    for variant in ("ideal", "taxed", "bomb"):
        run(spark, "pagerank", links, titles, out(variant), "--variant", variant)
        top = [r["value"] for r in X.read_lines(spark, out(variant)).collect()]
        assert any(line.startswith("(3,Node3 surfing,") for line in top)
    shops = text_file("shops.txt", *[f"S{i}: AB\t8900{i}\t4.0\t2{i}\tFood" for i in range(6)])
    run(spark, "clusters", shops, out("clusters"), "--k", "2", "--seed", "1")
    run(spark, "elbow", shops, out("elbow"), "--k", "2", "--rounds", "2", "--seed", "1")
    assert X.read_lines(spark, out("clusters")).count() == 6
    saved = results.parse_assignments(X.read_lines(spark, out("clusters")))
    assert sorted(r["name"] for r in saved.collect()) == [f"S{i}" for i in range(6)]
    run(spark, "--format", "parquet", "clusters", shops, out("typed"), "--k", "2", "--seed", "1")
    typed = results.read_table(spark, out("typed"), schemas.ASSIGNMENTS)
    assert sorted(map(tuple, typed.collect())) == sorted(map(tuple, saved.collect()))
    assert results.parse_elbow(X.read_lines(spark, out("elbow"))).count() == 2
