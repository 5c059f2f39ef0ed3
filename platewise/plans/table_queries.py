"""Queries over the tables: joins, counts, ranks, pages and comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from platewise.operators import aliases as A
from platewise.operators import audience, ingredients, views
from platewise.operators.dedup import first_rows, keep_first, keep_last
from platewise.operators.recommend import most_popular as popular
from platewise.operators.similarity import centroids, knn, vector_records
from platewise.functions.scalars import not_blank
from platewise.operators.joins import lookup_join
from platewise.plans.bridge import Tables
from platewise.plans.registry import query
from platewise.session import materialize, scratch_dir
from platewise.sources.sorted_tables import page_sorted, write_sorted

COMPARED_HITS = 200
VECTOR_LIMIT = 100_000
USERS_PAGE = 10


def joined(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.array_join(name, "|"))


def records(t: Tables) -> DataFrame:
    return vector_records(t["embeddings"], "vec_id", "embedding", "label")


def menu_hits(t: Tables, k: int) -> DataFrame:
    """Best menus for the mean vector of every label; hits on aliases count for their menu."""
    index = records(t)
    hits = knn(index, centroids(index), k).select("query_id", F.col("item_id").alias("raw_id"), "score")
    return (A.resolve(hits, t.alias_map(), stored=True).groupBy("query_id", "item_id")
            .agg(F.round(F.max("score"), 4).alias("score")))


def names(t: Tables) -> DataFrame:
    return t.menus().select("item_id", F.col("meal").alias("name"))


# --- joins ---------------------------------------------------------------------------------------

@query
def alias_resolve(t: Tables) -> DataFrame:
    return t.resolved()


@query
def menus_by_ids(t: Tables) -> DataFrame:
    """Menus of a comma list of ids: the most popular ones."""
    best = popular(t.interactions())
    ids = best.agg(F.array_join(F.collect_list("item_id"), ",").alias("ids"))  # a list of five
    return joined(views.menus_by_ids(t.menus_enriched(), views.ids_from_list(ids, "ids")), "product_description")


@query
def users_liking_items(t: Tables) -> DataFrame:
    interactions = t.interactions_table()
    return audience.users_liking(t.users(), interactions, popular(interactions)).select(
        "user_id", "shipping_city", "shipping_state", "locale", "created_at")


@query
def recs_with_names(t: Tables) -> DataFrame:
    return views.numbered_with_names(popular(t.interactions()), names(t))


@query
def interactions_with_names(t: Tables) -> DataFrame:
    """All events, aliases unresolved, with the name of the menu that has the very id."""
    events = t.events().withColumnRenamed("raw_id", "item_id")
    return views.interactions_with_names(events, names(t))


@query
def menus_with_scores(t: Tables) -> DataFrame:
    scores = menu_hits(t, COMPARED_HITS).groupBy("item_id").agg(F.max("score").alias("score"))
    return views.with_scores(names(t), scores)


@query
def role_counts(t: Tables) -> DataFrame:
    menus = t.menus_table()
    return ingredients.role_counts(menus, ingredients.ingredient_counts(menus))


@query
def other_ingredients(t: Tables) -> DataFrame:
    menus = t.menus_table()
    return ingredients.other_ingredients(menus, ingredients.ingredient_counts(menus))


@query
def hits_with_audience(t: Tables) -> DataFrame:
    return audience.with_audience(materialize(menu_hits(t, COMPARED_HITS), "hits"), t.interactions())


# --- counts --------------------------------------------------------------------------------------

@query
def collapse_menus(t: Tables) -> DataFrame:
    return A.menus_with_ids(t.menus_raw()).drop("ord")


@query
def ingredient_counts(t: Tables) -> DataFrame:
    return ingredients.ingredient_counts(t.menus_enriched())


@query
def count_users(t: Tables) -> DataFrame:
    return audience.count_users(t.users_raw())


@query
def audience_size(t: Tables) -> DataFrame:
    interactions = t.interactions_table()
    return audience.audience_size(interactions, popular(interactions, 3))


@query
def audience_per_item(t: Tables) -> DataFrame:
    return audience.audience_per_item(t.interactions())


@query
def role_sets(t: Tables) -> DataFrame:
    return ingredients.role_sets(t.menus_enriched())


@query
def reach_pct(t: Tables) -> DataFrame:
    return audience.with_reach(audience.audience_per_item(t.interactions()), t.users_raw())


@query
def dedup_counts(t: Tables) -> DataFrame:
    return t.menus_raw().agg(F.count(F.lit(1)).alias("menus_loaded"), F.count_distinct("meal").alias("menus_kept"))


# --- keep-one rules and ranks ----------------------------------------------------------------------

@query
def dedup_first(t: Tables) -> DataFrame:
    return keep_first(t.menus_raw(), ["meal"], ["ord"])


@query
def dedup_last(t: Tables) -> DataFrame:
    return keep_last(t.users_raw(), ["user_id"], "ord")


@query
def dedup_newest(t: Tables) -> DataFrame:
    return t.interactions().drop("raw_id")


@query
def rank_numbers(t: Tables) -> DataFrame:
    counts = ingredients.ingredient_counts(t.menus_enriched())
    return views.top_ranked(counts, [F.desc("count"), "name"], 5, "number")


@query
def recent_by_user(t: Tables) -> DataFrame:
    return views.recent_by_user(t.interactions().drop("raw_id"))


@query
def ingredients_sorted(t: Tables) -> DataFrame:
    return ingredients.by_count(ingredients.ingredient_counts(t.menus_enriched()))


@query
def ingredients_top50(t: Tables) -> DataFrame:
    """The names of parts, as ingredient lists of raw menus, counted and shown fifty at a time."""
    terms = t.menus_raw().select(F.explode(F.split("ingredients", ",")).alias("name"))
    counts = (terms.select(F.trim("name").alias("name")).where(not_blank("name"))
              .groupBy("name").agg(F.count(F.lit(1)).alias("count")))
    return ingredients.shown_ingredients(counts)


@query
def users_page(t: Tables) -> DataFrame:
    """The second page of users: the rows behind the last key of the first page, from the files that can hold them."""
    path = scratch_dir(t.spark, "users-by-id")
    write_sorted(t.users().select("user_id", "shipping_city", "shipping_state", "locale", "created_at"), path, ["user_id"])
    last = page_sorted(t.spark, path, "user_id", limit=USERS_PAGE).agg(F.max("user_id").alias("last")).first()["last"]
    return page_sorted(t.spark, path, "user_id", last, USERS_PAGE)


@query
def vector_cap(t: Tables) -> DataFrame:
    """The first 100,000 vectors that go into the index."""
    return first_rows(t["embeddings"], "vec_id", VECTOR_LIMIT).select("vec_id", "label")


@query
def compare_menus(t: Tables) -> DataFrame:
    """The five most popular menus side by side, one column per place."""
    scores = menu_hits(t, COMPARED_HITS).groupBy("item_id").agg(F.max("score").alias("score"))
    best = popular(t.interactions()).select("item_id", F.concat(F.lit("menu_"), F.col("rank")).alias("slot"))
    menus = lookup_join(t.menus_enriched(), best, "item_id")
    slots = [f"menu_{place}" for place in range(1, 6)]
    return views.compare_menus(views.with_scores(menus, scores), slots, "slot")
