"""Page ranks by power iteration.

The rank of a page is what its in-links pass on: each source splits its rank
evenly among its distinct targets. A page without in-links leaves the table after
the first round, a page without out-links receives rank and passes none on.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gramrank import schemas
from gramrank.operators.skew import PIECE_ROWS, hot_keys
from gramrank.session import cut_lineage, new_shared_path, sibling_session

# Edges per task below which fewer tasks are used, and above which more are.
SMALL_TASK = 50_000
LARGE_TASK = 5_000_000

# Fixed value: page that the sub-graph ranking links every selected page to.
HUB = "4290745"


def out_degree(edges: DataFrame) -> DataFrame:
    """``[src, deg]``: number of distinct targets of each source."""
    return edges.distinct().groupBy("src").agg(F.count("*").alias("deg"))


def pagerank(
    edges: DataFrame,
    taxation: bool = False,
    iterations: int = 24,
    damping: float = 0.85,
    teleport: str = "share",
    rounds_per_cut: int = 6,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """``[id, rank]`` after ``iterations`` rounds over ``[src, dst]`` edges.

    All sources start with ``e = 1 / number of sources``. With ``taxation`` a round
    gives ``(1 - damping) * t + damping * sum``, where ``t`` is ``e`` for the
    teleport ``"share"`` and 1 for ``"unit"``.

    Runs when called. The distinct edges are written once to the shared folder; one
    grouping by source gives the degrees, the totals and the form of the ids. Edges are
    then placed and sorted by source, a row for each with the array of its targets, and kept
    before the first round is planned. A round joins sources, not edges, in place: the sums
    per target, the only thing shuffled, come to lie where the next round looks for them as
    sources.

    Sources with a large share of all edges would be a task of their own. Their edges are
    written apart, spread evenly over files, and meet the ranks of the listed sources (fewer than
    ``skew.PIECES``, however large the graph is) by a broadcast; ranks are then used twice a
    round and are written after each, else after every ``rounds_per_cut``, as is the
    result. The number of partitions is set in a session of its own.
    """
    if teleport not in ("share", "unit"):
        raise ValueError(f"unknown teleport {teleport!r}")
    spark = edges.sparkSession
    path = new_shared_path(spark, "edges")
    edges.select("src", "dst").to(schemas.EDGES).distinct().write.parquet(path)
    degrees = cut_lineage(
        spark.read.schema(schemas.EDGES)
        .parquet(path)
        .groupBy("src")
        .agg(F.count("*").alias("deg"), F.bool_and(_number_ids()).alias("numbers"))
    )
    sources, total, numbers = degrees.agg(
        F.count("*"), F.sum("deg"), F.bool_and("numbers")
    ).first()
    if sources == 0:
        return spark.createDataFrame([], schemas.RANKS)

    partitions = _partitions(total, spark.sparkContext.defaultParallelism)
    session = sibling_session(spark, _round_settings(partitions))
    id_type = "bigint" if numbers else "string"
    links = session.read.schema(schemas.EDGES).parquet(path)
    links = links.select(F.col("src").try_cast(id_type), F.col("dst").try_cast(id_type))
    degrees = _in(session, degrees).select(F.col("src").try_cast(id_type), "deg")
    hot = cut_lineage(hot_keys(degrees, "src", "deg", piece_rows))
    any_hot = not hot.isEmpty()

    start = 1.0 / sources
    target = start if teleport == "share" else 1.0
    received = F.sum("share")
    if taxation:
        received = F.lit((1.0 - damping) * target) + F.lit(damping) * received

    cold = _by_source(_of_sources(links, hot, "left_anti") if any_hot else links, partitions)
    kept, every = [cold], rounds_per_cut
    if any_hot:
        few = F.broadcast(_of_sources(degrees, hot, "left_semi"))
        spread = _of_sources(links, hot, "left_semi").join(few, "src")
        path = new_shared_path(spark, "hot-edges")
        spread.repartition(partitions, "src", "dst").write.parquet(path)
        kept.append(session.read.parquet(path))
        every = 1
    try:
        cold.persist().count()
        ranks = None
        for done in range(1, iterations + 1):
            passed = _passed_on(kept, ranks, hot, start)
            ranks = passed.groupBy("dst").agg(received.alias("rank"))
            ranks = ranks.withColumnRenamed("dst", "src")
            if done % every == 0 and done < iterations:
                ranks = cut_lineage(ranks)
        if ranks is None:
            ranks = degrees.select("src", F.lit(start).alias("rank"))
        return _named(spark, ranks)
    finally:
        cold.unpersist()


def _round_settings(partitions: int) -> dict[str, str]:
    """Every shuffle of a round deals out alike, and no table changes its place: what is
    joined in place has to stay there."""
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }


def _of_sources(df: DataFrame, hot: DataFrame, how: str) -> DataFrame:
    """Rows whose source is on the list of hot ones (``left_semi``) or not (``left_anti``)."""
    hashed = df.withColumn("_hash", F.xxhash64("src"))
    return hashed.join(F.broadcast(hot.select("_hash")), "_hash", how).drop("_hash")


def _by_source(links: DataFrame, partitions: int) -> DataFrame:
    """``[src, deg, targets]`` placed and sorted by source. A null target is one too."""
    placed = links.repartition(partitions, "src").groupBy("src")
    listed = placed.agg(F.count("*").alias("deg"), F.collect_list(F.struct("dst")).alias("to"))
    return listed.select("src", "deg", F.col("to.dst").alias("targets")).sortWithinPartitions("src")


def _passed_on(
    kept: list[DataFrame], ranks: DataFrame | None, hot: DataFrame, start: float
) -> DataFrame:
    """``[dst, share]``, a row for each edge. Before the first round all sources have the
    rank ``start``."""

    def sent(table: DataFrame, ranks: DataFrame | None) -> DataFrame:
        ranked = table.withColumn("rank", F.lit(start)) if ranks is None else table.join(ranks, "src")
        return ranked.withColumn("share", F.col("rank") / F.col("deg"))

    parts = [sent(kept[0], ranks).select(F.explode("targets").alias("dst"), "share")]
    if len(kept) > 1:
        few = None if ranks is None else F.broadcast(_of_sources(ranks, hot, "left_semi"))
        parts.append(sent(kept[1], few).select("dst", "share"))
    return parts[0] if len(parts) == 1 else parts[0].union(parts[1])


def _named(spark: SparkSession, ranks: DataFrame) -> DataFrame:
    """The result, written to the shared folder; the empty target is the empty text."""
    path = new_shared_path(spark, "ranks")
    name = F.coalesce(F.col("src").cast("string"), F.lit("")).alias("id")
    ranks.select(name, "rank").write.parquet(path)
    return spark.read.schema(schemas.RANKS).parquet(path)


def _in(session: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` as a table of another session of the same application."""
    name = f"gramrank_{uuid.uuid4().hex}"
    df.createGlobalTempView(name)
    try:
        return session.table(f"global_temp.{name}")
    finally:
        df.sparkSession.catalog.dropGlobalTempView(name)


def _partitions(edges: int, cores: int) -> int:
    """Partitions for the rounds: all cores from some ten thousand edges each, and a
    bounded number of edges per task however many there are."""
    return max(min(cores, edges // SMALL_TASK + 1), edges // LARGE_TASK + 1)


def _number_ids() -> Column:
    """True if both ids are whole numbers that survive being written as such, apart
    from the empty target. If all are, they are ranked as numbers (the empty target as
    null, which passes nothing on), which is smaller to shuffle and join."""

    def number(name: str) -> Column:
        return F.coalesce(F.col(name).try_cast("bigint").cast("string") == F.col(name), F.lit(False))

    return number("src") & (number("dst") | (F.col("dst") == ""))


def with_titles(ranks: DataFrame, titles: DataFrame) -> DataFrame:
    """``[id, title, rank]``; pages without a title are left out."""
    return ranks.join(titles, "id").select("id", "title", "rank")


def top_ranked(ranks: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` highest ranks; equal ranks in order of id."""
    return ranks.orderBy(F.desc("rank"), "id").limit(n)


def select_links(links: DataFrame, titles: DataFrame, pattern: str) -> DataFrame:
    """Edges whose source page has a title like ``pattern`` (case-sensitive, tried
    on the title up to its first comma)."""
    return links.sparkSession.sql(
        """
        SELECT src, dst FROM {links}
        WHERE src IN (
            SELECT id FROM {titles} WHERE substring_index(title, ',', 1) LIKE :pattern
        )
        """,
        args={"pattern": pattern},
        links=links,
        titles=titles,
    )


def add_hub(links: DataFrame, hub: str = HUB) -> DataFrame:
    """The distinct edges and one from every source to ``hub``; empty targets go."""
    other = links.where((F.col("dst") != "") & (F.col("dst") != hub)).select("src", "dst")
    return other.distinct().union(links.select("src").distinct().withColumn("dst", F.lit(hub)))


def pagerank_bomb(
    links: DataFrame,
    titles: DataFrame,
    pattern: str = "%surfing%",
    hub: str = HUB,
    iterations: int = 24,
) -> DataFrame:
    """``[id, title, rank]`` with taxation over the links of the selected pages,
    each of them with ``hub`` as one more target. Titles are used twice, so they are
    written to the checkpoint folder."""
    titles = cut_lineage(titles)
    edges = add_hub(select_links(links, titles, pattern), hub)
    return with_titles(pagerank(edges, taxation=True, iterations=iterations), titles)
