"""Joins, keep-one rules, aliases, audience, ingredients and views on small frames."""

import random

import pytest
from pyspark.sql import functions as F

from platewise.operators import aliases as A
from platewise.operators import audience, ingredients, normalize, views
from platewise.operators.dedup import first_rows, keep_first, keep_last, keep_newest, positions
from platewise.operators.enrich import enrich_menus, enrich_with_model
from platewise.operators.joins import fits_broadcast, hot_keys, lookup_join, split_join


def skewed(spark, total=3000):
    """A third of the rows on one key, some without a key, copies among them."""
    generator = random.Random(3)
    keys = ["hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{generator.randrange(400)}" for i in range(total)]
    return spark.createDataFrame([(k, i % 7) for i, k in enumerate(keys)], "key string, v int")


@pytest.fixture(params=["true", "false"])
def adaptive_skew(spark, request):
    """With Spark's own handling of hot partitions, and without it."""
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limits", [{}, {"max_rows": 120}, {"max_bytes": 200}, {"max_rows": 0}])
def test_lookup_join_is_exact_on_every_path(spark, rows, adaptive_skew, how, limits):
    left = skewed(spark)
    lookup = spark.createDataFrame([("hot", "H")] + [(f"k{i}", f"n{i}") for i in range(300)], "key string, name string")
    expected = rows(left.join(lookup, "key", how))
    assert rows(lookup_join(left, lookup, "key", how, **limits)) == expected


def test_split_join_without_hot_keys(spark, rows):
    left = spark.createDataFrame([(f"k{i}", i) for i in range(500)] + [(None, 0)], "key string, v int")
    lookup = left.where("v < 100").select("key", F.lit(1).alias("one"))
    for how in ("inner", "left"):
        assert rows(split_join(left, lookup, "key", how)) == rows(left.join(lookup, "key", how))
    with pytest.raises(ValueError):
        lookup_join(left, lookup, "key", "full")


def test_split_join_broadcasts_only_the_hot_rows_of_the_lookup(spark):
    left = skewed(spark)
    lookup = spark.createDataFrame([(f"k{i}", i) for i in range(400)] + [("hot", -1)], "key string, n int")
    assert "hot" in hot_keys(left, "key") and len(hot_keys(left, "key")) <= 100
    plan = split_join(left, lookup, "key", max_rows=120)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and plan.count("Join Inner") == 2 and plan.count("strategy=broadcast") == 1


def test_broadcast_bound_counts_bytes(spark):
    wide = spark.createDataFrame([("x" * 1000, ["y" * 500])], "a string, b array<string>")
    assert fits_broadcast(wide, max_bytes=2000) and not fits_broadcast(wide, max_bytes=1400)
    assert not fits_broadcast(spark.range(11).toDF("n"), max_rows=10)


def test_keep_one_rules(spark, rows):
    df = spark.createDataFrame([("a", 1, 100, "x"), ("a", 2, 200, "y"), ("a", 3, 200, "z"), ("b", 4, None, "n")],
                               "k string, ord int, at bigint, v string")
    assert rows(keep_first(df, ["k"], ["ord"]), "v") == [("n",), ("x",)]
    assert rows(keep_last(df, ["k"], "ord"), "v") == [("n",), ("z",)]
    assert rows(keep_newest(df, ["k"], "at", ["ord"]), "v") == [("n",), ("y",)]


def test_keep_newest_cuts_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("at"))
    plan = keep_newest(df, ["k"], "at", [])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


@pytest.mark.parametrize("keys", [[], ["g"]])
def test_positions_equal_row_numbers(spark, keys):
    generator = random.Random(5)
    data = [("hot" if i % 3 else f"g{i % 4}", generator.random(), i) for i in range(2000)]
    df = spark.createDataFrame(data, "g string, x double, id int").repartition(8)
    found = positions(df, keys, [F.desc("x"), F.col("id")])
    expected = {}
    for g, x, i in sorted(data, key=lambda r: (-r[1], r[2])):
        group = g if keys else ""
        expected[i] = expected.get(("n", group), 0) + 1
        expected[("n", group)] = expected[i]
    assert {r["id"]: r["position"] for r in found.collect()} == {i: expected[i] for _, _, i in data}


def test_first_rows(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("n"), F.lit("p").alias("payload")).repartition(6)
    assert sorted(r["n"] for r in first_rows(df, "n", 10).collect()) == list(range(10))
    assert first_rows(df, "n", 5000).count() == 1000


RAW = "ord int, item_id string, meal string, ingredients string, creation_ts bigint"


def raw_menus(spark):
    return spark.createDataFrame([
        (0, "5", "Soup", "leek", 10), (1, "7", "Pie", "egg", 20), (2, "6", "Soup", "onion", 30),
        (3, "5", "Soup", "x", 40), (4, "9", "Soup", "y", 50)], RAW)


def test_collapse_keeps_first_and_all_ids_in_order(spark, rows):
    whole = A.menus_with_ids(raw_menus(spark))
    assert rows(whole, "item_id", "chunk_no", "other_ids", "ingredients") == [
        ("5", 0, "5|6|5|9", "leek"), ("7", 0, "7", "egg")]
    parts = A.menus_with_ids(raw_menus(spark), per_row=2)
    assert rows(parts, "item_id", "chunk_no", "other_ids") == [("5", 0, "5|6"), ("5", 1, "5|9"), ("7", 0, "7")]


def test_alias_rules(spark, rows):
    menus = spark.createDataFrame([("10", ["7", "2"]), ("2", ["7"]), ("x", ["7", "y"]), ("3", None)],
                                  "item_id string, other_ids array<string>")
    events = spark.createDataFrame([(i,) for i in ("7", "2", "99", "y", "3", "7")], "raw_id string")
    mapping = A.alias_map(A.aliases_from_lists(menus))
    assert rows(A.resolve(events, mapping), "raw_id", "item_id") == [
        ("2", "2"), ("3", "3"), ("7", "2"), ("7", "2"), ("y", "x")]


LIKES = "user_id string, item_id string, event_type string, created_at bigint, liked int"


def interactions(spark):
    return spark.createDataFrame([
        ("u", "1", "Watch", 1, 1), ("u", "1", "Click", 2, 1), ("v", "1", "Watch", 3, 1), ("v", "2", "Watch", 4, 0),
        ("w", "2", "Click", 5, 1), ("u", "3", "Watch", 6, 1)], LIKES)


def test_audience(spark, rows):
    events = interactions(spark)
    users = spark.createDataFrame([("u",), ("v",), ("w",), ("z",), ("z",)], "user_id string")

    def items(*ids):
        return spark.createDataFrame([(i,) for i in ids], "item_id string")

    assert rows(audience.audience_per_item(events)) == [("1", 2), ("2", 1), ("3", 1)]
    assert audience.audience_size(events, items("1", "2")).first()[0] == 3
    assert audience.audience_size(events, items("1", "2"), approximate=True).first()[0] == 3
    assert audience.audience_size(events, items("nobody")).first()[0] == 0
    assert rows(audience.users_liking(users, events, items("1", "3"))) == [("u",), ("v",)]
    assert audience.count_users(users).first()[0] == 4
    hits = spark.createDataFrame([("q", "1"), ("q", "9")], "query_id string, item_id string")
    assert rows(audience.with_reach(audience.with_audience(hits, events), users)) == [
        ("1", "q", 2, 50), ("9", "q", 0, 0)]
    bitmaps = audience.item_bitmaps(events, hits)
    assert rows(audience.audience_by_group(bitmaps, hits, "query_id")) == [("q", 2)]
    assert rows(audience.with_counts(hits, audience.audience_by_item(bitmaps))) == rows(audience.with_audience(hits, events))
    nobody = users.limit(0)
    assert rows(audience.with_reach(audience.audience_per_item(events), nobody), "reach_pct") == [(0,)] * 3


MENU = "item_id string, name string, genres string, genre_l2 string, genre_l3 string, product_description array<string>"


def menus(spark):
    return spark.createDataFrame([
        ("1", "Soup", "a", "none", "leek", ["a", "a", " salt "]), ("2", "Pie", "egg", "", "leek", None)], MENU)


def test_ingredients(spark, rows):
    counts = ingredients.ingredient_counts(menus(spark))
    assert rows(counts) == [("a", 3), ("egg", 1), ("leek", 2), ("none", 1), ("salt", 1)]
    assert rows(ingredients.role_sets(menus(spark))) == [("primary", "a"), ("primary", "egg"), ("tertiary", "leek")]
    some = counts.where("name <> 'egg'")
    assert rows(ingredients.role_counts(menus(spark), some)) == [
        ("primary", "a", 3), ("primary", "egg", 0), ("tertiary", "leek", 2)]
    assert rows(ingredients.other_ingredients(menus(spark), counts)) == [("none", 1), ("salt", 1)]
    assert [r["name"] for r in ingredients.by_count(counts).collect()] == ["a", "leek", "egg", "none", "salt"]
    shown = ingredients.shown_ingredients(counts, 2).collect()
    assert [(r["name"], r["remaining"]) for r in shown] == [("a", 3), ("leek", 3)]
    assert ingredients.shown_ingredients(counts).first()["remaining"] == 0


def test_views(spark, rows):
    events, table = interactions(spark), menus(spark)
    named = views.interactions_with_names(events, table)
    assert rows(named.where("item_id = '3'"), "menu_name", "price") == [("Unknown", "N/A")]
    assert rows(views.numbered_with_names(spark.createDataFrame([("9", 1)], "item_id string, rank int"), table),
                "number", "menu_name") == [(1, "N/A")]
    assert rows(views.recent_by_user(events, 2).where("user_id = 'u'"), "item_id", "rank") == [("1", 2), ("3", 1)]
    assert [r[0] for r in views.page_after(table, "item_id", "1", 5).select("item_id").collect()] == ["2"]
    assert [r[0] for r in views.page_after(table, "item_id", limit=1).select("item_id").collect()] == ["1"]
    ids = views.ids_from_list(spark.createDataFrame([("2,7,2",)], "ids string"), "ids")
    assert rows(views.menus_by_ids(table, ids), "item_id") == [("2",)]
    assert rows(views.lookup(events, "user_id", "w"), "item_id") == [("2",)]
    best = views.top_ranked(audience.audience_per_item(events), [F.desc("users"), "item_id"], 2)
    assert rows(best, "item_id", "rank") == [("1", 1), ("2", 2)]


def test_comparison(spark):
    scores = spark.createDataFrame([("1", 0.12345)], "item_id string, score double")
    scored = views.with_scores(menus(spark).withColumn("content_classification", F.lit("none")), scores)
    table = {r["attribute"]: (r["2"], r["1"]) for r in views.compare_menus(scored, ["2", "1"]).collect()}
    assert table == {
        "Score": ("", "12.35"), "ID": ("2", "1"), "Type": ("none", "none"), "Main Ingredient": ("egg", "a"),
        "Secondary": ("", "none"), "Tertiary": ("leek", "leek"), "Other Ingredients:": (None, "a,a, salt ")}


def test_normalised_menus_and_choices(spark, rows):
    enriched = spark.createDataFrame(
        [("1", 5, "Soup, hot", "a", None, "b", ["x"], ""), ("2", 6, "", None, None, None, None, None)],
        "item_id string, created_at bigint, name string, genres string, genre_l2 string, genre_l3 string,"
        "product_description array<string>, content_classification string")
    found = normalize.menus_table(normalize.menus_curated(enriched))
    assert rows(found) == [("1", 5, "Soup  hot", "a", "", "b", ["x"], "none"), ("2", 6, " ", "", "", "", [], "none")]
    assert normalize.menus_curated(enriched).schema["PRICE"].dataType.simpleString() == "decimal(10,2)"
    choices = spark.createDataFrame([("u", "1", "true", "2024-05-06"), ("u", "2", "false", "2024-05-06"),
                                     ("u", "3", None, "x")],
                                    "user_id string, menu_item_id string, manual string, created_at string")
    assert rows(normalize.choices_to_interactions(choices)) == [("u", "1", "Click", 1.0, 1714953600, 1)]
    assert tuple(normalize.unusable_dates(choices, "created_at").first()) == (3, 1)
    users = spark.createDataFrame([("u", "a", None, "en", "1", 7)],
                                  "user_id string, shipping_city string, shipping_state string, locale string, grandpa string, created_at int")
    assert rows(normalize.users_curated(users)) == [("u", ["a", "", "en", "grandpa"], "a", None, "en", 7)]


def test_enrichment(spark, rows):
    raw = spark.createDataFrame([
        (0, "1", "Stew", "Yukon Potatoes, fried pork, salt, pork,, leek", 1), (1, "2", "Air", "", 2),
        (2, "3", "Odd", "mystery", 3), (3, "4", "Null", None, 4)], RAW)
    lexicon = spark.createDataFrame([
        ("yukon potatoes", "potato", "grain"), ("fried pork", "pork", "protein"), ("pork", "pork", "protein"),
        ("leek", "leek", "vegetable"), ("salt", "salt", "other")], "term string, base string, food_group string")
    cuisines = spark.createDataFrame([("pork", "german"), ("potato", "german"), ("leek", "french"), ("salt", "french")],
                                     "base string, cuisine string")
    found = enrich_menus(raw, lexicon, cuisines)
    assert rows(found) == [
        ("1", 1, "Stew", "pork", "potato", "leek", ["salt", "pork"], "german"),
        ("2", 2, "Air", "", "", "", [], "none"), ("3", 3, "Odd", "", "", "", ["mystery"], "none"),
        ("4", 4, "Null", "", "", "", [], "none")]


def test_phrases_and_food_groups(spark, rows):
    """The leftmost, then longest phrase names an ingredient; starch, fruit and spice fill roles too."""
    lexicon = spark.createDataFrame([
        ("rice", "rice", "grain"), ("rice flour", "rice flour", "starch"), ("Pork", "pork", "protein"), ("black pepper", "pepper", "spice"),
        ("pepper", "bell pepper", "vegetable"), ("apple", "apple", "fruit"), ("crème fraîche", "cream", "other"), ("pork", "pork", "protein"),
        (" ", "nothing", "protein"), (None, "null", "protein")], "term string, base string, food_group string")
    cuisines = spark.createDataFrame([("rice", "thai")], "base string, cuisine string")
    menus = spark.createDataFrame([
        ("1", "a", 0, "Fried pork, Brown rice, ground black pepper, apple"), ("2", "b", 0, "rice-flour cake, pepper & pork, licorice"),
        ("3", "c", 0, "sliced apple pork, CRÈME FRAÎCHE"), ("4", "d", 0, None), ("5", "e", 0, ", !,")],
        "item_id string, meal string, creation_ts long, ingredients string")
    found = enrich_menus(menus, lexicon, cuisines)
    assert rows(found, "item_id", "genres", "genre_l2", "genre_l3", "product_description", "content_classification") == [
        ("1", "pork", "rice", "pepper", ["apple"], "thai"), ("2", "", "rice flour", "bell pepper", ["licorice"], "none"),
        ("3", "", "", "apple", ["cream"], "none"), ("4", "", "", "", [], "none"), ("5", "", "", "", ["!"], "none")]
    assert rows(enrich_menus(menus.limit(1), lexicon.limit(0), cuisines), "product_description") == [
        (["fried pork", "brown rice", "ground black pepper", "apple"],)]


def test_enrichment_hook(spark, rows):
    def model(batch):
        if (batch["name"] == "Pie").any():
            raise RuntimeError("model is down")
        return ['{"primary_ingredient":"' + text + '"}' for text in batch["ingredients"]]

    soup, pie = raw_menus(spark).where("ord = 0"), raw_menus(spark).where("ord = 1")
    assert rows(enrich_with_model(soup, model), "item_id", "genres", "content_classification") == [("5", "leek", "none")]
    assert rows(enrich_with_model(pie, model)) == []  # not answered: left out, so a later load asks again
    both = soup.unionByName(pie).coalesce(1)
    assert rows(enrich_with_model(both, model), "item_id", "genres") == [("5", "leek")]


def test_bitmap_audiences_equal_sets(spark, rows):
    """Users beyond one bucket of 32,768, a hot item that a third of all likes go to, and groups that share items."""
    likes = spark.range(90_000).selectExpr(
        "concat('u', id % 40000) as user_id", "case when id % 3 = 0 then 'hot' else concat('i', id * 7 % 50) end as item_id",
        "cast(id % 5 > 0 as int) as liked")
    groups = spark.createDataFrame([(f"g{g}", f"i{i}") for g in range(6) for i in range(g, 50, 9)] + [("g0", "hot"), ("g9", "none"), ("g0", "i0")],
                                   "query_id string, item_id string")
    bitmaps = audience.item_bitmaps(likes, groups)
    want = groups.join(likes.where("liked = 1"), "item_id").groupBy("query_id").agg(F.count_distinct("user_id").alias("users"))
    assert rows(audience.audience_by_group(bitmaps, groups, "query_id")) == rows(want)
    per_item = likes.where("liked = 1").join(groups, "item_id", "left_semi").groupBy("item_id").agg(F.count_distinct("user_id").alias("users"))
    assert rows(audience.audience_by_item(bitmaps)) == rows(per_item)
    assert audience.item_bitmaps(likes, groups.limit(0)).count() == 0
