"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line.

Each query is run to completion into the no-op sink, so nothing is collected and
every output column is computed. Before the first, a job that reads no table starts the
Python workers.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from gramrank.queries import QUERIES
from gramrank.session import build_session

HEADLINE = (
    "word_count",
    "vocabulary_profile",
    "doc_term_profile",
    "corpus_profile",
    "tf_idf",
    "sentence_scores",
    "summaries",
    "pagerank_ideal",
    "pagerank_taxed",
    "pagerank_bomb",
    "business_points",
    "kmeans_clusters",
    "elbow_curve",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        conf={
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": os.environ.get("BENCH_CHECKPOINTS")
            or tempfile.mkdtemp(prefix="gramrank-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    workers = spark.range(0, 1000, numPartitions=spark.sparkContext.defaultParallelism)
    workers.mapInArrow(lambda batches: batches, "id long").write.format("noop").mode(
        "overwrite"
    ).save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall-clock of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
