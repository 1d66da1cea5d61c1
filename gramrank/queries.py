"""The registered queries: every operator over the given tables, whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramrank import schemas, tables
from gramrank.operators import counts as C
from gramrank.operators import profiles
from gramrank.operators.sampling import sample_one
from gramrank.plans import kmeans as K
from gramrank.plans import listings as L
from gramrank.plans import pagerank as P
from gramrank.plans import summary as S
from gramrank.plans import tfidf as T
from gramrank.session import new_shared_path
from gramrank.sources import results, sinks
from gramrank.sources import text as X

Query = Callable[[SparkSession, str], DataFrame]

KMEANS_K = 9
KMEANS_ROUNDS = 10
ELBOW_MAX_K = 9
#: Rows of a piece where joins are to cut keys in tables of any size.
SMALL_PIECE = 20
#: Seed of random centroids, and restarts from them.
DRAW_SEED = 11
RANDOM_STARTS = 2
PATTERN = "%widget%"
HUB = "7"


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({name: F.round(name, d) for name, d in digits.items()})


# Words and profiles


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.word_count(tables.articles(spark, sf_dir), "body")


def distinct_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.vocabulary(tables.articles(spark, sf_dir))


def vocabulary_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.profile_vocabulary(tables.articles(spark, sf_dir))


def doc_term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.term_counts(tables.articles(spark, sf_dir))


def doc_term_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.profile_doc_terms(tables.articles(spark, sf_dir))


def corpus_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.corpus_counts(tables.articles(spark, sf_dir))


def corpus_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.profile_corpus(tables.articles(spark, sf_dir))


def letter_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.letter_buckets(word_count(spark, sf_dir))


# Line parsers


def article_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.parse_articles(tables.article_lines(spark, sf_dir))


def unique_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = X.parse_articles(tables.repeated_article_lines(spark, sf_dir))
    return X.first_per_id(X.with_doc_id(parsed)).select("doc_id", "body")


def article_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.first_per_id(X.with_doc_id(article_fields(spark, sf_dir))).select("doc_id")


def key_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.parse_kv(tables.kv_source_lines(spark, sf_dir))


def line_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables.table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    return X.parse_fields(lines).select(
        F.size("fields").alias("n_fields"), F.concat_ws("|", "fields").alias("fields")
    )


# TF-IDF and summaries


def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(T.article_term_frequency(tables.articles(spark, sf_dir)), tf=9)


def document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.document_frequency(doc_term_counts(spark, sf_dir))


def document_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.document_total(doc_term_counts(spark, sf_dir))


def tf_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(T.tf_idf(tables.articles(spark, sf_dir)), tf=9, tfidf=9)


def tf_idf_cut_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = T.tf_idf(tables.articles(spark, sf_dir), SMALL_PIECE)
    return rounded(weights, tf=9, tfidf=9)


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.sentences(tables.line_articles(spark, sf_dir))


def sentence_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.sentence_words(tables.line_articles(spark, sf_dir))


def sentence_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.sentence_weights(tables.line_articles(spark, sf_dir)), tfidf=9)


def sentence_top_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = S.top_weights(S.sentence_weights(tables.line_articles(spark, sf_dir)))
    return rounded(top, tfidf=9)


def sentence_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(S.sentence_scores(tables.line_articles(spark, sf_dir)), score=9)


def top_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = S.sentence_scores(tables.line_articles(spark, sf_dir))
    return rounded(S.top_sentences(scores), score=9)


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.summarize(tables.line_articles(spark, sf_dir))


# Links and page ranks


def link_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.parse_links(tables.link_lines(spark, sf_dir))


def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.with_line_ids(tables.part_names(spark, sf_dir), "p_name").withColumnRenamed(
        "value", "title"
    )


def out_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.out_degree(tables.page_links(spark, sf_dir))


def graph_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out_degree(spark, sf_dir).agg(
        F.count("*").alias("sources"), F.sum("deg").alias("edges")
    )


def pagerank_ideal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(P.pagerank(tables.page_links(spark, sf_dir)), rank=9)


def pagerank_taxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(P.pagerank(tables.page_links(spark, sf_dir), taxation=True), rank=9)


def pagerank_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = P.pagerank(
        tables.page_links(spark, sf_dir), taxation=True, teleport="unit", iterations=25
    )
    return rounded(ranks, rank=6)


def pagerank_cut_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = tables.page_links(spark, sf_dir)
    return rounded(P.pagerank(links, taxation=True, piece_rows=SMALL_PIECE), rank=9)


def top_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = P.pagerank(tables.page_links(spark, sf_dir), taxation=True)
    titled = P.with_titles(ranks, page_titles(spark, sf_dir))
    return rounded(P.top_ranked(titled), rank=9)


def selected_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.select_links(link_edges(spark, sf_dir), page_titles(spark, sf_dir), PATTERN)


def hub_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.add_hub(selected_links(spark, sf_dir), HUB)


def pagerank_bomb(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = P.pagerank_bomb(
        tables.page_links(spark, sf_dir), page_titles(spark, sf_dir), PATTERN, HUB
    )
    return rounded(ranks, rank=9)


# Business listings and clusters


def listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.parse_businesses(tables.listing_lines(spark, sf_dir))


def valid_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.valid_businesses(tables.listing_lines(spark, sf_dir))


def business_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(L.business_points(tables.listing_lines(spark, sf_dir)), x=9, y=9)


def state_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = L.business_points(tables.listing_lines(spark, sf_dir), "AU", "MA")
    return rounded(points, x=9, y=9)


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.business_points(tables.listing_lines(spark, sf_dir))


def _first_points(points: DataFrame, k: int, last: bool = False) -> list[tuple[float, float]]:
    order = F.desc("name") if last else F.asc("name")
    rows = points.orderBy(order).limit(k).collect()
    return [(row["x"], row["y"]) for row in rows]


def nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _points(spark, sf_dir)
    start = _first_points(points, KMEANS_K)
    assigned = K.assign(points, [(cid, x, y) for cid, (x, y) in enumerate(start)])
    return rounded(assigned.select("name", "centroid_id", "d"), d=9)


def kmeans_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _points(spark, sf_dir)
    found = K.kmeans(points, KMEANS_K, KMEANS_ROUNDS, init=_first_points(points, KMEANS_K))
    return rounded(found, cx=6, cy=6, x=6, y=6)


def _last_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _points(spark, sf_dir)
    start = _first_points(points, KMEANS_K)
    return K.assign(points, K.kmeans_centroids(points, KMEANS_K, KMEANS_ROUNDS, init=start))


def kmeans_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(K.centroid_means(_last_assignment(spark, sf_dir)), cx=6, cy=6)


def kmeans_sse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(K.cluster_sse(_last_assignment(spark, sf_dir)), sse=6)


def elbow_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _points(spark, sf_dir)
    start = _first_points(points, ELBOW_MAX_K)
    return rounded(K.elbow(points, ELBOW_MAX_K, KMEANS_ROUNDS, init=start), sse=6)


def elbow_restarts(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _points(spark, sf_dir)
    starts = [_first_points(points, ELBOW_MAX_K), _first_points(points, ELBOW_MAX_K, last=True)]
    return rounded(K.elbow(points, ELBOW_MAX_K, KMEANS_ROUNDS, starts=starts), sse=6)


def elbow_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = K.elbow(
        _points(spark, sf_dir),
        ELBOW_MAX_K,
        KMEANS_ROUNDS,
        restarts=RANDOM_STARTS,
        seed=DRAW_SEED,
        key=["name"],
    )
    return rounded(curve, sse=6)


def random_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The centroids drawn for each k."""
    ks = range(1, ELBOW_MAX_K + 1)
    drawn = K.draw_centroids(_points(spark, sf_dir), ks, seed=DRAW_SEED, key=["name"])
    rows = [(len(run), cid, x, y) for run in drawn for cid, x, y in run]
    starts = spark.createDataFrame(rows, "k int, centroid_id int, x double, y double")
    return rounded(starts, x=9, y=9)


def random_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(sample_one(_points(spark, sf_dir), seed=5, key=["name"]), x=9, y=9)


# Sinks, read back


def kv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "kv")
    sinks.write_kv(corpus_counts(spark, sf_dir), path)
    return X.read_kv(spark, path).select(
        F.col("key").alias("word"), F.col("value").try_cast("bigint").alias("n")
    )


def tuple_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "points")
    sinks.write_tuples(_points(spark, sf_dir), path, ", ")
    return rounded(results.parse_points(X.read_lines(spark, path)), x=9, y=9)


def clusters_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "clusters")
    points = _points(spark, sf_dir)
    start = _first_points(points, KMEANS_K)
    sinks.write_tuples(K.kmeans(points, KMEANS_K, KMEANS_ROUNDS, init=start), path, ", ")
    found = results.parse_assignments(X.read_lines(spark, path))
    return rounded(found, cx=6, cy=6, x=6, y=6)


def parquet_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "points")
    sinks.write_table(_points(spark, sf_dir), path, schemas.POINTS)
    return rounded(results.read_table(spark, path, schemas.POINTS), x=9, y=9)


def letter_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "letters")
    sinks.write_by_letter(corpus_counts(spark, sf_dir), path)
    lines = spark.read.schema("value string, bucket int").text(path)
    parts = F.split("value", "\t", 2)
    return lines.select(
        "bucket",
        F.get(parts, 0).alias("word"),
        F.get(parts, 1).try_cast("bigint").alias("n"),
    )


def saved_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "saved-clusters")
    tables.cluster_lines(spark, sf_dir).write.text(path)
    return results.read_clusters(spark, path)


def saved_elbow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.parse_elbow(tables.elbow_lines(spark, sf_dir))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        word_count,
        distinct_words,
        vocabulary_profile,
        doc_term_counts,
        doc_term_profile,
        corpus_counts,
        corpus_profile,
        letter_buckets,
        article_fields,
        article_ids,
        unique_articles,
        key_values,
        line_fields,
        term_frequency,
        document_frequency,
        document_total,
        tf_idf,
        tf_idf_cut_keys,
        sentences,
        sentence_words,
        sentence_weights,
        sentence_top_weights,
        sentence_scores,
        top_sentences,
        summaries,
        link_edges,
        page_titles,
        out_degree,
        graph_size,
        pagerank_ideal,
        pagerank_taxed,
        pagerank_unit,
        pagerank_cut_sources,
        top_pages,
        selected_links,
        hub_links,
        pagerank_bomb,
        listing_rows,
        valid_listings,
        business_points,
        state_points,
        nearest_centroid,
        kmeans_clusters,
        kmeans_means,
        kmeans_sse,
        elbow_curve,
        elbow_restarts,
        elbow_random,
        random_starts,
        random_point,
        kv_sink,
        tuple_sink,
        clusters_sink,
        parquet_sink,
        letter_sink,
        saved_clusters,
        saved_elbow,
    )
}
