"""Session defaults and the folder shared by all executors."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def build_session(
    app_name: str = "gramrank",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with adaptive execution on; ``conf`` overrides any default."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Of two shuffled sides, one with small partitions is hashed, so that the other,
        # larger one need not be sorted. Sizes are those measured while the query runs.
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update(conf or {})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sibling_session(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session like ``spark`` with further settings, which ``spark`` does not see."""
    session = spark.newSession()
    for row in spark.sql("SET").collect():
        try:
            session.conf.set(row["key"], row["value"])
        except AnalysisException:
            continue  # fixed when the application starts, so the same in both
    for key, value in settings.items():
        session.conf.set(key, value)
    return session


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read, taken from ``spark.checkpoint.dir``.

    There is no default: a machine-local folder would be lost with its machine."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def new_shared_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
