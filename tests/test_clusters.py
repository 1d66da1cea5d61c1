import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gramrank.functions.nearest import CentreTree
from gramrank.operators.sampling import draw_rows, sample_one
from gramrank.plans import kmeans as K
from gramrank.plans import listings as L

CODES = [
    ("AB", "T2E 6L6", 4.0, 24, 6.21646, 1.415112),
    ("NV", "89002", 4.5, 3, 8.9002, 0.550334),
    ("QC", "H2G 1K7", 4.0, 5, 2.22137, 0.716644),
    ("AZ", "85301", 1.0, 3, 8.5301, 0.122296),
    ("AB", "T2H 0N5", 2.0, 4, 6.22045, 0.308642),
    ("NV", "89052", 4.0, 102, 8.9052, 2.059390),
    ("ON", "M6G 1K8", 4.0, 7, 4.62138, 0.866467),
    ("ON", "M5G 1C3", 1.5, 8, 4.52113, 0.347222),
    ("AZ", "85282", 2.5, 45, 8.5282, 1.059385),
    ("PA", "15213", 3.5, 3, 1.5213, 0.428038),
    ("ON", "L3R 1M5", 1.5, 12, 4.36145, 0.414926),
    ("ON", "M6H 1A1", 4.0, 40, 4.62101, 1.642570),
]


def listing(number, state, code, stars, reviews):
    return f"Shop {number}: {state}\t{code}\t{stars}\t{reviews}\tFood, Tea"


@pytest.fixture
def points(lines):
    rows = [listing(i, *row[:4]) for i, row in enumerate(CODES)]
    return L.business_points(lines(*rows))


def in_order(points):
    rows = sorted(points.collect(), key=lambda r: int(r["name"].split()[1]))
    return [(r["x"], r["y"]) for r in rows]


def test_points_of_valid_listings(points):
    found = in_order(points)
    assert len(found) == len(CODES)
    for (x, y), row in zip(found, CODES):
        assert (x, y) == pytest.approx(row[4:], abs=1e-6)


def test_four_and_three_character_codes(lines):
    rows = lines("A: AB\tT2E4 6L6\t4.0\t24\tFood", "B: AB\tZ9A 1B2\t4.0\t24\tFood")
    zips = {r["name"]: r["zip"] for r in L.valid_businesses(rows).collect()}
    assert zips == {"A": 62146.46, "B": 99010.2}


def test_states(lines):
    rows = lines(*[listing(i, *row[:4]) for i, row in enumerate(CODES)])
    assert L.business_points(rows, "AB", "AB").count() == 2
    assert L.business_points(rows, "AB", "NV").count() == 4
    assert L.business_points(rows, "ALL", "NV").count() == 12


@pytest.mark.parametrize(
    "line",
    [
        "Shop: branch: AB\t89002\t4.0\t24\tFood",
        "Shop: AB\t89002\t4.0\t24",
        "Shop: AB\t89\t4.0\t24\tFood",
        "Shop: AB\t890021\t4.0\t24\tFood",
        "Shop: AB\t8900A\t4.0\t24\tFood",
        "Shop: AB\t89-02\t4.0\t24\tFood",
        "Shop: AB\tT2E\t6L\t4.0\t24\tFood",
        "Shop: AB\tT2E\t6l6\t4.0\t24\tFood",
        "Shop: AB\tT2E1\t2e5\t4.0\t24\tFood",
        "Shop: AB\t89002\tmany\t24\tFood",
        "Shop: AB\t89002\t4.0\tfew\tFood",
        "Shop: AB\t89002\t4.0\t0\tFood",
        "Shop: AB\t89002\tNaN\t24\tFood",
        "Shop: AB\t89002\tInfinity\t24\tFood",
        "Shop: AB\t89002\t4.0\tNaN\tFood",
        "Shop: AB\t89002\t4.0\tInfinity\tFood",
        "no separator at all",
        "Shop: ",
        "",
    ],
)
def test_rejected_listings(lines, line):
    assert L.business_points(lines(line)).count() == 0


def test_trailing_separator_is_no_second_part(lines):
    assert L.business_points(lines("Shop: AB\t89002\t4.0\t24\tFood: ")).count() == 1


@pytest.mark.parametrize(
    "k, sse, centroids",
    [
        (1, 76.081234, [(5.764021, 0.827586, 12)]),
        (2, 23.712022, [(4.288069, 0.767453, 8), (8.715925, 0.947851, 4)]),
        (3, 8.035567, [(5.093647, 0.832490, 6), (8.715925, 0.947851, 4), (1.871335, 0.572341, 2)]),
    ],
)
def test_known_clusters(points, k, sse, centroids):
    start = in_order(points)[:k]
    found = K.kmeans(points, k, 10, init=start).groupBy("centroid_id", "cx", "cy").count().collect()
    by_id = [tuple(r)[1:] for r in sorted(found)]
    assert [pytest.approx(c, abs=1e-6) for c in centroids] == by_id
    last = K.assign(points, K.kmeans_centroids(points, k, 10, init=start))
    assert sum(r["sse"] for r in K.cluster_sse(last).collect()) == pytest.approx(sse, abs=1e-6)


def test_elbow(points):
    found = K.elbow(points, 3, 10, init=in_order(points)[:3]).collect()
    assert [r["k"] for r in found] == [1, 2, 3]
    assert [r["sse"] for r in found] == pytest.approx([76.081234, 11.856011, 2.678522], abs=1e-6)


def test_elbow_restarts_add_up(points):
    once = K.elbow(points, 1, 4, restarts=1, seed=1).first()["sse"]
    thrice = K.elbow(points, 1, 4, restarts=3, seed=1).first()["sse"]
    assert thrice == pytest.approx(3 * once)


def lloyd(points, start, rounds):
    centroids = list(enumerate(start))
    for done in range(rounds):
        clusters = {}
        for x, y in points:
            best = min(centroids, key=lambda c: (math.dist((x, y), c[1]), c[0]))
            clusters.setdefault(best, []).append((x, y))
        used = clusters
        centroids = sorted(
            (cid, (sum(x for x, _ in m) / len(m), sum(y for _, y in m) / len(m)))
            for (cid, _), m in clusters.items()
        )
    return {cid: (c, len(m)) for (cid, c), m in used.items()}


@pytest.mark.parametrize("k", [2, 5, 30])
def test_rounds_equal_plain_rounds(spark, k):
    chance = random.Random(k)
    plane = [(chance.uniform(0, 10), chance.uniform(0, 4)) for _ in range(400)]
    start = plane[: k - 1] + [(500.0, 500.0)]
    df = spark.createDataFrame(
        [(str(i), x, y) for i, (x, y) in enumerate(plane)], "name string, x double, y double"
    )
    expected = lloyd(plane, start, 4)
    found = K.kmeans(df, k, 4, init=start).groupBy("centroid_id", "cx", "cy").count().collect()
    assert {r["centroid_id"] for r in found} == set(expected)
    for row in found:
        centre, members = expected[row["centroid_id"]]
        assert (row["cx"], row["cy"], row["count"]) == (
            pytest.approx(centre[0]), pytest.approx(centre[1]), members
        )
    moved, _ = K._move_all(df.select("x", "y"), [[(c, x, y) for c, (x, y) in enumerate(start)]])
    single = K._move(df.select("x", "y"), [(c, x, y) for c, (x, y) in enumerate(start)])
    assert [pytest.approx(c) for c in moved[0]] == single


def test_a_thousand_centroids(spark):
    """The plan does not grow with k, and a round is no slower to plan."""
    df = spark.range(3000).select(
        F.col("id").cast("string").alias("name"),
        (F.col("id") % 97).cast("double").alias("x"),
        (F.col("id") % 89).cast("double").alias("y"),
    )
    start = [(float(i % 97) + 0.25, float(i % 89)) for i in range(1000)]
    expected = lloyd([(r["x"], r["y"]) for r in df.collect()], start, 2)
    found = K.kmeans(df, 1000, 2, init=start)
    rows = found.groupBy("centroid_id").agg(F.count("*").alias("n")).collect()
    assert {r["centroid_id"]: r["n"] for r in rows} == {c: n for c, (_, n) in expected.items()}


def plain_nearest(centres, x, y):
    d = [math.sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)) for cx, cy in centres]
    return min(range(len(d)), key=lambda i: (d[i], i)), min(d)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 60), st.sampled_from(["grid", "plane", "line", "far"]))
def test_a_tree_finds_what_all_distances_find(seed, k, kind):
    chance = random.Random(seed)
    draw = {
        "grid": lambda: (float(chance.randrange(5)), float(chance.randrange(5))),
        "plane": lambda: (chance.gauss(0, 3), chance.gauss(0, 1e-3)),
        "line": lambda: (1.0, chance.uniform(-1, 1)),
        "far": lambda: (chance.choice([1e150, 0.0, -3.0, 1e-200]), chance.uniform(0, 1e-160)),
    }[kind]
    centres, points = [draw() for _ in range(k)], [draw() for _ in range(40)]
    tree = CentreTree(*zip(*centres))
    place, far = tree.nearest(*map(np.array, zip(*points)))
    assert list(zip(place, far)) == [plain_nearest(centres, x, y) for x, y in points]


def test_work_per_point_does_not_grow_with_the_centres():
    chance = np.random.default_rng(2)
    points = chance.uniform(0, 100, (2, 5000))
    counts = {}
    for k in (100, 1_000, 10_000):
        tree = CentreTree(*chance.uniform(0, 100, (2, k)))
        tree.nearest(*points)
        counts[k] = tree.compared / 5000
    assert counts[10_000] < 1.3 * counts[100] < 40


def test_points_without_coordinates_take_no_part(spark):
    rows = [("a", 1.0, 1.0), ("b", 3.0, 3.0), ("c", None, 2.0), ("d", 2.0, None)]
    df = spark.createDataFrame(rows, "name string, x double, y double")
    found = K.kmeans(df, 2, 3, init=[(1.0, 1.0), (3.0, 3.0)]).collect()
    assert sorted(r["name"] for r in found) == ["a", "b"]


@pytest.mark.parametrize("partitions", [1, 2, 4])
def test_a_seed_draws_the_same_rows_in_any_partitioning(spark, partitions):
    df = spark.range(1000).repartition(partitions)
    assert sample_one(df, 5).first() == sample_one(spark.range(1000), 5).first()
    assert draw_rows(df, 50, 5) == draw_rows(spark.range(1000), 50, 5)


def test_starts_of_each_restart(points):
    order = in_order(points)
    both = K.elbow(points, 2, 3, starts=[order[:2], order[::-1][:2]]).collect()
    each = [K.elbow(points, 2, 3, init=s).collect() for s in (order[:2], order[::-1][:2])]
    for k in range(2):
        assert both[k]["sse"] == pytest.approx(each[0][k]["sse"] + each[1][k]["sse"])


def test_sse_does_not_rise(points):
    start = in_order(points)[:3]
    values = [
        sum(r["sse"] for r in K.cluster_sse(K.assign(points, K.kmeans_centroids(points, 3, n, init=start))).collect())
        for n in (1, 2, 3, 4)
    ]
    assert values == sorted(values, reverse=True)


def test_draws(spark):
    df = spark.range(5)
    drawn = draw_rows(df, 200, seed=4)
    assert len(drawn) == 200 and {r["id"] for r in drawn} == set(range(5))
    assert sample_one(df, 1).count() == 1
    starts = K.draw_centroids(
        spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "x double, y double"), [1, 3], seed=2
    )
    assert [len(s) for s in starts] == [1, 3]
    with pytest.raises(ValueError):
        draw_rows(df.where("id < 0"), 1)


def test_points_read_by_one_task_are_dealt_to_all(spark):
    """Also if centroids are drawn from them; the draw does not depend on it."""
    rows = [(f"p{i}", float(i % 7), float(i % 11)) for i in range(400)] + [("none", None, 1.0)]
    points = spark.createDataFrame(rows, "name string, x double, y double").coalesce(1)
    cores = spark.sparkContext.defaultParallelism
    for drawn in (False, True):
        kept, ours = K._cached(points, drawn)
        sizes = [r["count"] for r in kept.groupBy(F.spark_partition_id()).count().collect()]
        assert ours and sum(sizes) == 400 and len(sizes) == cores
        kept.unpersist()
    one, all_tasks = (
        K.elbow(df, 3, 4, restarts=2, seed=3, key=["name"]).collect()
        for df in (points, points.repartition(5))
    )
    assert [r["sse"] for r in one] == pytest.approx([r["sse"] for r in all_tasks])
