"""The analytics as command-line jobs over text files.

    spark-submit run_job.py <job> <arguments>

``spark-submit`` brings master, memory and ``spark.checkpoint.dir``; in cluster mode
pass this package with ``--py-files``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramrank import schemas
from gramrank.operators import counts, profiles
from gramrank.plans import kmeans as K
from gramrank.plans import listings as L
from gramrank.plans import pagerank as P
from gramrank.plans import summary as S
from gramrank.plans import tfidf as T
from gramrank.session import build_session
from gramrank.sources import sinks
from gramrank.sources import text as X


def _articles(spark: SparkSession, path: str) -> DataFrame:
    return X.parse_articles(X.read_lines(spark, path))


def _write(rows: DataFrame, args: argparse.Namespace) -> None:
    if args.format == "parquet":
        sinks.write_table(rows, args.output, rows.schema, args.mode)
    else:
        sinks.write_kv(rows, args.output, args.mode)


def word_count(spark: SparkSession, args: argparse.Namespace) -> None:
    counted = counts.word_count(X.read_lines(spark, args.input))
    _write(counted, args)


def profile(spark: SparkSession, args: argparse.Namespace) -> None:
    articles = _articles(spark, args.input)
    report = {
        "vocabulary": profiles.profile_vocabulary,
        "doc-terms": profiles.profile_doc_terms,
        "corpus": profiles.profile_corpus,
    }[args.kind]
    _write(report(articles, args.n), args)


def tf_idf(spark: SparkSession, args: argparse.Namespace) -> None:
    weights = T.tf_idf(_articles(spark, args.input)).select("doc_id", "word", "tfidf")
    _write(weights, args)


def summaries(spark: SparkSession, args: argparse.Namespace) -> None:
    articles = X.first_per_id(X.with_doc_id(_articles(spark, args.input)))
    _write(S.summarize(articles), args)


def pagerank(spark: SparkSession, args: argparse.Namespace) -> None:
    links = X.parse_links(X.read_lines(spark, args.links))
    titles = X.parse_titles(X.read_lines(spark, args.titles))
    if args.variant == "bomb":
        titled = P.pagerank_bomb(links, titles, args.pattern, args.hub)
    else:
        taxation = args.variant == "taxed"
        titled = P.with_titles(P.pagerank(links, taxation=taxation), titles)
    top = P.top_ranked(titled, args.n)
    if args.format == "parquet":
        sinks.write_table(top, args.output, top.schema, args.mode)
        return
    page = F.concat_ws(",", "id", "title").alias("page")
    sinks.write_tuples(top.select(page, "rank"), args.output, mode=args.mode)


def clusters(spark: SparkSession, args: argparse.Namespace) -> None:
    points = L.business_points(X.read_lines(spark, args.input), args.state1, args.state2)
    points = points.persist()
    try:
        found = K.kmeans(points, args.k, args.rounds, args.seed)
        if args.format == "parquet":
            sinks.write_table(found, args.output, schemas.ASSIGNMENTS, args.mode)
        else:
            sinks.write_tuples(found, args.output, ", ", args.mode)
    finally:
        points.unpersist()


def elbow(spark: SparkSession, args: argparse.Namespace) -> None:
    points = L.business_points(X.read_lines(spark, args.input), args.state1, args.state2)
    curve = K.elbow(points, args.k, args.rounds, args.restarts, args.seed)
    if args.format == "parquet":
        sinks.write_table(curve, args.output, schemas.ELBOW, args.mode)
    else:
        sinks.write_tuples(curve, args.output, mode=args.mode)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="gramrank")
    top.add_argument("--mode", default="errorifexists", choices=["errorifexists", "overwrite"])
    top.add_argument("--format", default="text", choices=["text", "parquet"])
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, run, *positional: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        for argument in positional:
            sub.add_argument(argument)
        return sub

    job("word-count", word_count, "input", "output")
    sub = job("profile", profile, "input", "output")
    sub.add_argument("--kind", required=True, choices=["vocabulary", "doc-terms", "corpus"])
    sub.add_argument("--n", type=int, default=500)
    job("tf-idf", tf_idf, "input", "output")
    job("summaries", summaries, "input", "output")
    sub = job("pagerank", pagerank, "links", "titles", "output")
    sub.add_argument("--variant", default="ideal", choices=["ideal", "taxed", "bomb"])
    sub.add_argument("--pattern", default="%surfing%")
    sub.add_argument("--hub", default=P.HUB)
    sub.add_argument("--n", type=int, default=10)
    for name, run in (("clusters", clusters), ("elbow", elbow)):
        sub = job(name, run, "input", "output")
        sub.add_argument("--k", type=int, required=True)
        sub.add_argument("--rounds", type=int, default=10)
        sub.add_argument("--restarts", type=int, default=1)
        sub.add_argument("--seed", type=int)
        sub.add_argument("--state1", default="ALL")
        sub.add_argument("--state2", default="ALL")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"gramrank {args.job}")
    args.run(spark, args)

