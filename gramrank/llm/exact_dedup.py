"""Exact deduplication as a stream with keyed state.

Arrivals (digest, id, content locator) are taken in batch by batch. The state, kept on disk
by RocksDB and never expired, holds for each digest the id and the content locator of the
copy that stays, and the number of copies, so an arrival meets all copies of earlier
batches. Rows reach it pre-aggregated, so a text with very many copies is a few rows per
batch. Texts never enter the state: equal digests are a hit, and all hits are fetched by
their locators and their full bytes compared. Should two texts share a digest, their groups
are settled by the texts themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gramrank.session import new_shared_path

#: Micro-batches that the files of the arrival log are dealt to.
BATCHES = 4
#: Rows of a list (locators of hits, groups of copies) up to which it is broadcast; some 200
#: bytes each. A longer one is joined by a shuffle.
FEW_ROWS = 100_000
KEY = ("digest", "n_bytes")

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # else each state partition takes some 4 MB of disk, however little it holds
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "192",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def parquet_locator() -> Column:
    """Place of a row in its Parquet file, for frames read straight from files."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )


def arrivals(
    docs: DataFrame, locator: Column, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """``[row, text, digest, n_bytes, arrival]``: ``row`` holds all columns of ``docs``,
    ``arrival`` the id and the locator."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        text.alias("text"),
        digest(text).alias("digest"),
        F.octet_length(text).alias("n_bytes"),
        F.struct(F.col("doc_id").alias("doc_id"), locator.alias("locator")).alias("arrival"),
    )


def keep_latest(arrived: DataFrame) -> DataFrame:
    """``[digest, n_bytes, kept, group_size]`` of a stream or table of arrivals: the
    copy with the largest id, of equal ids the one with the largest locator."""
    return arrived.groupBy(*KEY).agg(
        F.max("arrival").alias("kept"), F.count(F.lit(1)).alias("group_size")
    )


def _stream_session(spark: SparkSession) -> SparkSession:
    """The state store is set in a session of its own, which nobody else sees."""
    session = spark.newSession()
    settings = {
        **STATE_SETTINGS,
        "spark.sql.shuffle.partitions": spark.conf.get("spark.sql.shuffle.partitions"),
        "spark.sql.session.timeZone": spark.conf.get("spark.sql.session.timeZone"),
    }
    for key, value in settings.items():
        session.conf.set(key, value)
    return session


def run_stream(spark: SparkSession, log: str, batches: int = BATCHES) -> DataFrame:
    """State of the arrivals logged at ``log`` after all of them have been taken in, in
    ``batches`` batches (fewer if the log has fewer files).

    Every batch writes the entries it changed to a folder named after it, so a batch
    that is run again after a failure replaces what it wrote before."""
    session = _stream_session(spark)
    logged = session.read.parquet(log)
    schema = logged.schema
    files = -(-len(logged.inputFiles()) // batches) or 1
    changes = new_shared_path(spark, "dedup-changes")
    empty = session.createDataFrame([], schema)
    keep_latest(empty).write.parquet(f"{changes}/batch=-1")
    stream = session.readStream.schema(schema).option("maxFilesPerTrigger", files)
    query = (
        keep_latest(stream.parquet(log))
        .writeStream.outputMode("update")
        .foreachBatch(
            lambda batch, n: batch.write.mode("overwrite").parquet(f"{changes}/batch={n}")
        )
        .option("checkpointLocation", new_shared_path(spark, "dedup-state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # Entries only grow from batch to batch: a later copy has a larger id, or none.
    state = spark.read.parquet(changes).groupBy(*KEY)
    latest = state.agg(F.max("kept").alias("kept"), F.max("group_size").alias("group_size"))
    path = new_shared_path(spark, "dedup-latest")
    latest.write.parquet(path)
    return spark.read.parquet(path)


def _sized(rows: DataFrame, n: int) -> DataFrame:
    return F.broadcast(rows) if n <= FEW_ROWS else rows


def clashes(arrived: DataFrame, hits: DataFrame, n_hits: int) -> DataFrame:
    """Keys under which different texts meet. ``hits`` (``[*KEY, locator]``) are fetched by
    their locators, and all their bytes are compared: the texts of a key are equal if its
    smallest is its largest."""
    texts = arrived.select(F.col("arrival.locator").alias("locator"), "text")
    return (
        texts.join(_sized(hits, n_hits), "locator")
        .groupBy(*KEY)
        .agg(F.min("text").alias("low"), F.max("text").alias("high"))
        .where("low <> high")
        .select(*KEY)
    )


def deduplicate(
    docs: DataFrame,
    locator: Column,
    digest: Callable[[Column], Column] = sha256,
    batches: int = BATCHES,
) -> DataFrame:
    """``[row, digest, n_bytes, keep_id, group_size, kept]``, a row for each of ``docs``.

    Texts are equal if their bytes are; a null text is an empty one. Of equal texts the
    row with the largest ``doc_id`` stays (null ids are the smallest), of equal ids that
    with the largest locator. ``locator`` must tell rows apart and be the same whenever
    ``docs`` is read (``parquet_locator()``). ``row`` is a struct of all columns of
    ``docs``, so that further columns may have any name. An empty table gives no rows.
    """
    spark = docs.sparkSession
    arrived = arrivals(docs, locator, digest)
    log = new_shared_path(spark, "dedup-arrivals")
    arrived.select(*KEY, "arrival").write.parquet(log)
    several = run_stream(spark, log, batches).where("group_size > 1")
    n_several, n_hits = several.agg(F.count(F.lit(1)), F.sum("group_size")).first()
    rows = arrived.select("row", *KEY, "arrival")
    if not n_several:
        return _settled(rows, several, n_several, KEY)
    logged = spark.read.parquet(log).select(*KEY, "arrival.locator")
    hits = logged.join(_sized(several.select(*KEY), n_several), [*KEY], "left_semi")
    path = new_shared_path(spark, "dedup-clashes")
    clashes(arrived, hits, n_hits).write.parquet(path)
    clashing = spark.read.parquet(path)
    if clashing.isEmpty():
        return _settled(rows, several, n_several, KEY)
    by_text = arrived.join(clashing, [*KEY], "left_semi")
    texts = by_text.groupBy(*KEY, "text").agg(
        F.max("arrival").alias("kept"), F.count(F.lit(1)).alias("group_size")
    )
    told_apart = by_text.select("row", *KEY, "arrival", "text")
    clean = _settled(rows.join(clashing, [*KEY], "left_anti"), several, n_several, KEY)
    return clean.unionByName(_settled(told_apart, texts, n_hits, (*KEY, "text")))


def _settled(
    rows: DataFrame, groups: DataFrame, n_groups: int, key: tuple[str, ...]
) -> DataFrame:
    """Only groups of two or more are looked up; any other row stays by itself. There are
    at most ``n_groups``; groups keyed by texts are never broadcast."""
    several = groups.where("group_size > 1")
    several = several if "text" in key else _sized(several, n_groups)
    found = rows.join(several, [*key], "left")
    alone = F.col("kept").isNull()
    return found.select(
        "row",
        *KEY,
        F.when(alone, F.col("arrival.doc_id")).otherwise(F.col("kept.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("arrival").eqNullSafe(F.col("kept")))).alias("kept"),
    )
