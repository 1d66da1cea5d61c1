import plain
import pytest
from pyspark.sql import functions as F

from gramrank.plans import pagerank as P
from gramrank.sources import text as X

LINES = ("1: 2 3 4", "2: 1 4", "3: 3", "4: 2 3")
ABSENT = 1e-9


def as_dict(ranks):
    return {r["id"]: r["rank"] for r in ranks.collect()}


@pytest.fixture
def links(lines):
    return X.parse_links(lines(*LINES))


def test_links(lines):
    found = X.parse_links(lines("1: 2 3 2", "3: ", "4:", "5", "6:  7 ", "8: 9: 10")).collect()
    assert sorted(map(tuple, found)) == [
        ("1", "2"),
        ("1", "3"),
        ("3", ""),
        ("4", ""),
        ("5", ""),
        ("6", "7"),
        ("8", "9"),
    ]


@pytest.mark.parametrize(
    "options, expected",
    [
        ({}, {"3": 0.999625483, "2": 0.000139426, "4": 0.000139426, "1": 0.0000956655}),
        ({"taxation": True}, {"3": 0.705769928, "2": 0.105867887, "4": 0.105867887, "1": 0.082494298}),
        (
            {"taxation": True, "teleport": "unit", "iterations": 25},
            {"3": 2.771507351, "2": 0.423463704, "4": 0.423463704, "1": 0.329971811},
        ),
        ({"iterations": 25}, {"3": 0.999727085, "2": 0.000101601, "4": 0.000101601, "1": 0.0000697128}),
    ],
)
def test_known_ranks(links, options, expected):
    assert as_dict(P.pagerank(links, **options)) == pytest.approx(expected, abs=ABSENT)


@pytest.mark.parametrize("prefix", ["", "page "])
@pytest.mark.parametrize("piece_rows", [2, 1_000_000])
def test_hub_heavy_graph_with_and_without_cut_keys(spark, prefix, piece_rows):
    edges = [("0", str(i)) for i in range(1, 40)]
    edges += [(str(i), "0") for i in range(1, 40)]
    edges += [(str(i), str(i * 7 % 40)) for i in range(1, 40)]
    edges = [(prefix + src, prefix + dst) for src, dst in edges] + [(prefix + "5", "")]
    df = spark.createDataFrame(edges, "src string, dst string")
    found = as_dict(P.pagerank(df, taxation=True, iterations=7, rounds_per_cut=3, piece_rows=piece_rows))
    assert found == pytest.approx(plain.pagerank(edges, True, 7), abs=1e-12)


def test_pages_without_in_links_leave(spark):
    df = spark.createDataFrame([(1, 2), (2, 3), (2, 9), (5, 1)], "src string, dst string")
    found = as_dict(P.pagerank(df, taxation=True, iterations=1))
    assert found == pytest.approx({"1": 1 / 3, "2": 1 / 3, "3": 0.191666667, "9": 0.191666667})
    assert as_dict(P.pagerank(df, taxation=True)) == {}


def test_lines_without_neighbours_count_as_sources(lines):
    edges = X.parse_links(lines("1: 2", "2: 1", "3: "))
    found = as_dict(P.pagerank(edges, taxation=True, iterations=2))
    assert found == pytest.approx({"1": 1 / 3, "2": 1 / 3})


def test_numbers_with_leading_zeros_stay_text(spark):
    edges = [("1", "01"), ("01", "1"), ("1", "2"), ("2", "1")]
    df = spark.createDataFrame(edges, "src string, dst string")
    assert as_dict(P.pagerank(df)) == pytest.approx(plain.pagerank(edges, False))


def test_empty_graph(spark):
    assert P.pagerank(spark.createDataFrame([], "src string, dst string")).count() == 0


def test_subgraph_with_hub(spark, links):
    titles = spark.createDataFrame(
        [("1", "big wave surfing, a history"), ("2", "history, surfing"), ("3", "surfing"), ("4", "Surfing")],
        "id string, title string",
    )
    kept = P.select_links(links, titles, "%surfing%")
    assert {r["src"] for r in kept.collect()} == {"1", "3"}
    edges = P.add_hub(kept, "99")
    assert as_dict(P.pagerank(edges, taxation=True)) == pytest.approx(
        {"3": 0.130434783, "99": 0.130434783}, abs=ABSENT
    )
    titled = P.pagerank_bomb(links, titles, hub="99").collect()
    assert [(r["id"], r["title"]) for r in titled] == [("3", "surfing")]


def _moves(df):
    """Names of the exchanges in a plan, without those by which kept tables were made."""
    found, open_nodes = [], [df._jdf.queryExecution().executedPlan()]
    while open_nodes:
        node = open_nodes.pop()
        assert "Adaptive" not in node.nodeName()
        if "Exchange" in node.nodeName():
            found.append(node.nodeName())
        children = node.children()
        open_nodes += [children.apply(i) for i in range(children.size())]
    return found


@pytest.mark.parametrize("partitions", [2, 3, 8])
@pytest.mark.parametrize("piece_rows, every", [(1_000_000, 4), (10, 1)])
def test_one_exchange_a_round_from_the_first_on(spark, monkeypatch, partitions, piece_rows, every):
    """No cut's plan moves the kept edges, and none moves ranks but to their targets."""
    plans = []

    def noted(keep):
        def run(*args):
            ranks = args[-1]
            if "rank" in ranks.columns:
                plans.append(_moves(ranks))
            return keep(*args)

        return run

    monkeypatch.setattr(P, "_partitions", lambda edges, cores: partitions)
    monkeypatch.setattr(P, "cut_lineage", noted(P.cut_lineage))
    monkeypatch.setattr(P, "_named", noted(P._named))
    edges = [("0", str(i)) for i in range(1, 40)] + [(str(i), "0") for i in range(1, 40)]
    edges += [(str(i), str(i * 7 % 40)) for i in range(1, 40)]
    df = spark.createDataFrame(edges, "src string, dst string")
    found = as_dict(P.pagerank(df, iterations=9, rounds_per_cut=4, piece_rows=piece_rows))
    assert found == pytest.approx(plain.pagerank(edges, False, 9), abs=1e-12)
    assert len(plans) == -(-9 // every)
    for number, moves in enumerate(plans):
        rounds = min(every, 9 - number * every)
        broadcasts = moves.count("BroadcastExchange")
        assert len(moves) - broadcasts == rounds
        assert broadcasts == 0 if every > 1 else broadcasts <= 2


def test_edges_of_a_hot_source_are_spread(spark, monkeypatch):
    kept = []
    plain_join = P._passed_on
    monkeypatch.setattr(P, "_passed_on", lambda tables, *rest: kept.append(
        [t.groupBy(F.input_file_name()).count().collect() for t in tables]
    ) or plain_join(tables, *rest))
    monkeypatch.setattr(P, "_partitions", lambda edges, cores: 8)
    edges = [("0", str(i)) for i in range(1, 2000)] + [(str(i), "0") for i in range(1, 2000)]
    df = spark.createDataFrame(edges, "src string, dst string")
    P.pagerank(df, iterations=1, piece_rows=100)
    cold, hot = kept[0]
    assert sum(r["count"] for r in cold) == sum(r["count"] for r in hot) == 1999
    assert len(hot) == 8 and max(r["count"] for r in hot) < 400


def test_nothing_is_left_behind(spark, links):
    """No cached table, no changed setting, no view."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    kept = len(spark.sparkContext._jsc.getPersistentRDDs())
    P.pagerank(links, iterations=3).collect()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == kept
    assert spark.catalog.listTables("global_temp") == []


def test_hub_links_are_added_once(spark):
    df = spark.createDataFrame([("1", "2"), ("1", "9"), ("3", "")], "src string, dst string")
    assert sorted(map(tuple, P.add_hub(df, "9").collect())) == [("1", "2"), ("1", "9"), ("3", "9")]


def test_top_list_breaks_ties_by_id(spark):
    ranks = spark.createDataFrame([("4", 0.1), ("2", 0.1), ("3", 0.7), ("1", 0.0)], "id string, rank double")
    assert [r["id"] for r in P.top_ranked(ranks, 3).collect()] == ["3", "2", "4"]


def test_dead_ends_lose_rank_and_closed_graphs_keep_it(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("a", "c")]
    df = spark.createDataFrame(edges, "src string, dst string")
    assert sum(as_dict(P.pagerank(df, taxation=True)).values()) == pytest.approx(1.0)


def test_a_source_is_one_row_in_all_rounds(spark, monkeypatch):
    """Sources are joined, not edges; an empty target is a target too."""
    kept = []
    plain_join = P._passed_on
    monkeypatch.setattr(P, "_passed_on", lambda tables, *rest: kept.append(
        [r.asDict() for r in tables[0].collect()]
    ) or plain_join(tables, *rest))
    edges = [("1", str(i)) for i in range(1, 30)] + [("2", "1"), ("2", "1"), ("2", ""), ("3", "2")]
    df = spark.createDataFrame(edges, "src string, dst string")
    found = as_dict(P.pagerank(df, iterations=2))
    assert [sorted(row["src"] for row in table) for table in kept] == [[1, 2, 3]] * 2
    targets = {row["src"]: (row["deg"], len(row["targets"])) for row in kept[0]}
    assert targets == {1: (29, 29), 2: (2, 2), 3: (1, 1)}
    assert found == pytest.approx(plain.pagerank(sorted(set(edges)), False, 2), abs=1e-12)
