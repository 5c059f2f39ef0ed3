"""Queries over enrichment, similarity and recommendations, and the composed flows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from platewise.operators import audience, enrich, similarity, text_index as texts, vector_index as vectors, views
from platewise.operators.recommend import most_popular as popular, picks_affinity as picks
from platewise.plans.bridge import PHRASES, Tables
from platewise.plans.registry import query
from platewise.plans.table_queries import COMPARED_HITS, joined, menu_hits, names, records
from platewise.session import materialize, scratch_dir


@query
def enrich_menus(t: Tables) -> DataFrame:
    return joined(t.menus_enriched(), "product_description")


@query
def enrich_phrases(t: Tables) -> DataFrame:
    """Menus whose ingredients are phrases, against a lexicon of phrases and all food groups."""
    phrased = t.menus().withColumn("ingredients", F.concat(
        F.regexp_replace("meal", " ", "-"), F.lit(", Fried "), F.element_at(F.split("ingredients", ", "), -1), F.lit(", sea salt")))
    lexicon = t.spark.createDataFrame(PHRASES, "term string, base string, food_group string")
    return joined(enrich.enrich_menus(phrased, lexicon, t.cuisines()), "product_description")


def text_index(t: Tables, name: str = "source") -> texts.TextIndex:
    return texts.build_text_index(t.documents(), scratch_dir(t.spark, "text-index"), "doc_id", name=name)


@query
def embed_passages(t: Tables) -> DataFrame:
    """Weighted terms of every document, unit length."""
    vectors = text_index(t).vectors.select(F.col("id").cast("bigint").alias("doc_id"), "dims", "weights")
    return texts.vector_text(vectors, "doc_id")


@query
def embed_queries(t: Tables) -> DataFrame:
    """Query texts in the space of the documents' terms."""
    weights = texts.query_terms(text_index(t), t["benchmark"], "item_id").withColumn("item_id", F.col("item_id").cast("bigint"))
    return texts.vector_text(weights, "item_id")


@query
def search_texts(t: Tables) -> DataFrame:
    """Text search end to end: the best documents for every query text."""
    queries = t["benchmark"].select(F.col("item_id").alias("query_id"), "text")
    return texts.search_index(text_index(t), queries).withColumn("score", F.round("score", 4))


@query
def knn_cosine(t: Tables) -> DataFrame:
    index = records(t)
    return similarity.knn(index, similarity.centroids(index)).withColumn("score", F.round("score", 4))


@query
def knn_lsh(t: Tables) -> DataFrame:
    index = records(t)
    return similarity.knn_lsh(index, similarity.centroids(index)).withColumn("score", F.round("score", 4))


def indexed(t: Tables) -> vectors.VectorIndex:
    return vectors.build_index(records(t), scratch_dir(t.spark, "vector-index"))


@query
def knn_ivf(t: Tables) -> DataFrame:
    """The ten mean vectors against the index: approximate, exact scores."""
    return vectors.knn_ivf(indexed(t), similarity.centroids(records(t))).withColumn("score", F.round("score", 4))


@query
def knn_ivf_recall(t: Tables) -> DataFrame:
    """Does the approximate search find at least nine tenths of the exact hits? Asked for every twentieth vector."""
    index = records(t)
    asked = t["embeddings"].where("vec_id % 20 = 0").select(F.col("vec_id").cast("string").alias("query_id"), F.col("embedding").alias("vector"))
    exact = similarity.knn(index, asked).select("query_id", "item_id")
    near = vectors.knn_ivf(indexed(t), asked).select("query_id", "item_id", F.lit(1).alias("found"))
    return exact.join(near, ["query_id", "item_id"], "left").agg(
        F.count_distinct("query_id").alias("queries"), F.count(F.lit(1)).alias("hits"),
        (F.count("found") >= 0.9 * F.count(F.lit(1))).alias("recall_reached"))


@query
def knn_bounded(t: Tables) -> DataFrame:
    """The exact search of ``knn_cosine``, without the vectors that distance bounds rule out."""
    found = vectors.knn_bounded(indexed(t), similarity.centroids(records(t)))
    return found.hits.withColumn("score", F.round("score", 4))


@query
def most_popular(t: Tables) -> DataFrame:
    return popular(t.interactions())


@query
def picks_affinity(t: Tables) -> DataFrame:
    return picks(t.interactions(), t.menus_enriched())


@query
def search_with_audience(t: Tables) -> DataFrame:
    """Search hits with the users who liked each menu, their share of all users, and the users reached
    by all hits of the search together. Both counts come from one table of bitmaps."""
    hits = materialize(menu_hits(t, COMPARED_HITS), "hits")
    bitmaps = materialize(audience.item_bitmaps(t.interactions(), hits), "bitmaps")
    per_hit = audience.with_reach(audience.with_counts(hits, audience.audience_by_item(bitmaps)), t.users_raw())
    together = audience.audience_by_group(bitmaps, hits, "query_id").withColumnRenamed("users", "search_users")
    return (views.with_names(per_hit, names(t), "N/A", "name").join(together, "query_id", "left")
            .withColumn("search_users", F.coalesce("search_users", F.lit(0)).cast("bigint")))


@query
def user_view(t: Tables) -> DataFrame:
    """Latest events and picks of every user, and the popular menus once for everybody."""
    interactions, menus = t.interactions_table(), t.menus_table()

    def section(name: str, rows: DataFrame, user=F.col("user_id")) -> DataFrame:
        return rows.select(F.lit(name).alias("section"), user.alias("user_id"), "rank", "item_id")

    rows = (section("recent", views.recent_by_user(interactions))
            .unionByName(section("picks", picks(interactions, menus)))
            .unionByName(section("popular", popular(interactions), F.lit("everybody"))))
    return views.with_names(rows, menus, "N/A")


def flagship(t: Tables) -> DataFrame:
    """Raw ratings and choices to the most popular menus with their names."""
    return views.numbered_with_names(popular(t.interactions()), names(t))
