"""The given tables seen as menus, users, ratings and choices."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from platewise.operators.aliases import alias_map, collapse_menus, menu_aliases, resolve
from platewise.operators.dedup import keep_last, keep_newest
from platewise.operators.enrich import enrich_menus
from platewise.operators.joins import lookup_join
from platewise.operators.normalize import as_events, choices_to_interactions, ratings_to_interactions
from platewise.session import materialize, spread_scan, use_utc

# Ingredient term, base name, food group.
LEXICON = (
    ("widget", "widget", "protein"), ("gizmo", "gadget", "protein"), ("gear", "gear", "protein"),
    ("plate", "plate", "grain"), ("ring", "ring", "grain"),
    ("rod", "rod", "vegetable"), ("bolt", "bolt", "vegetable"), ("anvil", "anvil", "vegetable"),
    ("red", "red", "vegetable"), ("blue", "blue", "grain"), ("cold", "cold", "other"),
    ("hot", "hot", "other"), ("new", "new", "other"), ("old", "old", "other"),
    ("small", "small", "other"), ("large", "large", "other"), ("economy", "economy", "other"),
    ("medium", "medium", "other"), ("promo", "promo", "other"), ("standard", "standard", "other"),
)
# Base name, cuisine it points to.
CUISINES = (
    ("widget", "greek"), ("gadget", "mexican"), ("gear", "korean"), ("plate", "indian"),
    ("ring", "mexican"), ("rod", "greek"), ("bolt", "chinese"), ("anvil", "healthy"),
    ("red", "indian"), ("blue", "greek"), ("cold", "healthy"), ("hot", "mexican"),
)
# Phrases beside the single words above: term, base name, food group.
PHRASES = (
    ("hot plate", "hot plate", "starch"), ("cold ring", "ring", "fruit"), ("blue bolt", "bolt", "spice"),
    ("fried promo", "promo", "fruit"), ("red", "paprika", "spice"), ("widget", "widget", "protein"),
    ("gear", "gear", "protein"), ("rod", "rod", "vegetable"), ("plate", "plate", "grain"),
    ("economy", "economy", "starch"),
)
# End of the fixed values.

TIES = ["event_type", "event_value", "raw_id"]


def once(view):
    """Build a view one time per ``Tables``, so that what it measures or writes is not repeated."""
    @wraps(view)
    def kept(self):
        if view.__name__ not in self._views:
            self._views[view.__name__] = view(self)
        return self._views[view.__name__]
    return kept


class Tables:
    """Views over one folder of Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        use_utc(spark)
        self.spark = spark
        self.folder = folder
        self._views: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}.parquet"

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    @once
    def documents(self) -> DataFrame:
        return spread_scan(self["documents"], "doc_id")

    @once
    def lexicon(self) -> DataFrame:
        return self.spark.createDataFrame(LEXICON, "term string, base string, food_group string")

    @once
    def cuisines(self) -> DataFrame:
        return self.spark.createDataFrame(CUISINES, "base string, cuisine string")

    @once
    def users_raw(self) -> DataFrame:
        """Users in file order; every tenth has a later, changed row."""
        places = self["nation"].join(self["region"], F.col("n_regionkey") == F.col("r_regionkey"))
        nations = places.select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
        key = F.col("c_custkey")
        first = lookup_join(self["customer"], nations, "c_nationkey", stored=True).select(
            key.cast("string").alias("user_id"), F.col("n_name").alias("shipping_city"),
            F.col("r_name").alias("shipping_state"),
            F.when(key % 2 == 0, "en").otherwise("fr").alias("locale"),
            F.when(F.col("c_mktsegment") == "FURNITURE", "1").otherwise("0").alias("grandpa"),
            F.when(F.col("c_acctbal") > 0, "1").otherwise("0").alias("subscribed"),
            (F.lit(788918400) + 86400 * key).cast("bigint").alias("created_at"),
            key.alias("ord"))
        moved = first.where(F.col("ord") % 10 == 0).select(
            "user_id", F.lit("MOVED").alias("shipping_city"), "shipping_state", F.lit("en").alias("locale"),
            F.lit("0").alias("grandpa"), F.lit("1").alias("subscribed"), "created_at",
            (F.lit(1000000000) + F.col("ord")).alias("ord"))
        return first.unionByName(moved)

    @once
    def users(self) -> DataFrame:
        return keep_last(self.users_raw(), ["user_id"], "ord")

    @once
    def menus_raw(self) -> DataFrame:
        """Menu rows in file order, one per part."""
        words = r"([a-z]+) ([a-z]+)"
        return self["part"].select(
            F.col("p_partkey").alias("ord"), F.col("p_partkey").cast("string").alias("item_id"),
            F.col("p_name").alias("meal"),
            F.concat(F.regexp_extract("p_name", words, 1), F.lit(", "), F.regexp_extract("p_name", words, 2),
                     F.lit(", "), F.lower("p_type")).alias("ingredients"),
            (F.lit(788918400) + 86400 * F.col("p_partkey")).cast("bigint").alias("creation_ts"))

    @once
    def menus(self) -> DataFrame:
        return collapse_menus(self.menus_raw())

    @once
    def menus_enriched(self) -> DataFrame:
        return enrich_menus(self.menus(), self.lexicon(), self.cuisines())

    @once
    def aliases(self) -> DataFrame:
        raw = self.menus_raw()
        return menu_aliases(raw, collapse_menus(raw))

    @once
    def alias_map(self) -> DataFrame:
        return materialize(alias_map(self.aliases()), "aliases")

    @once
    def ratings(self) -> DataFrame:
        lines = spread_scan(self["lineitem"], "l_orderkey", "l_partkey").select(
            F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_quantity", "l_shipdate")
        orders = self["orders"].select("o_orderkey", "o_custkey")
        return lookup_join(lines, orders, "o_orderkey", stored=True).select(
            F.col("o_custkey").cast("string").alias("user_id"),
            F.col("l_partkey").cast("string").alias("menu_item_id"),
            (F.floor((F.col("l_quantity") - 1) / 10) + 1).cast("int").alias("rating"),
            F.col("l_shipdate").alias("date"))

    @once
    def choices(self) -> DataFrame:
        return self["events"].where(F.col("event_type").isin("click", "purchase")).select(
            F.col("user_id").cast("string").alias("user_id"),
            F.regexp_extract("props", "([0-9]+)", 1).alias("menu_item_id"),
            F.when(F.col("event_type") == "click", "true").otherwise("false").alias("manual"),
            F.col("ts").alias("created_at"))

    @once
    def events(self) -> DataFrame:
        """Ratings and choices under one contract, item ids unresolved, all rows."""
        both = ratings_to_interactions(self.ratings()).unionByName(choices_to_interactions(self.choices()))
        return as_events(both)

    @once
    def resolved(self) -> DataFrame:
        return resolve(self.events(), self.alias_map(), stored=True)

    @once
    def interactions(self) -> DataFrame:
        """The interactions table: the newest event per user and menu. The cut to one row per pair
        starts before the shuffle, so copies of an event never travel."""
        return keep_newest(self.resolved(), ["user_id", "item_id"], "created_at", TIES)

    @once
    def interactions_table(self) -> DataFrame:
        """The interactions table, written: for queries that read it more than once."""
        return materialize(self.interactions().drop("raw_id"), "interactions")

    @once
    def menus_table(self) -> DataFrame:
        """The enriched menus, written: for queries that read them more than once."""
        return materialize(self.menus_enriched(), "menus")
