"""Reading views over the tables: names, pages, latest events, side-by-side comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from platewise.functions.scalars import col_of, split_list
from platewise.operators.dedup import top_per_key
from platewise.operators.joins import lookup_join

RECENT = 5
PAGE = 100


def ids_from_list(ids: DataFrame, column: str) -> DataFrame:
    """One row per id of a comma list."""
    return ids.select(F.explode(split_list(column, ",")).alias("item_id")).distinct()


def menus_by_ids(menus: DataFrame, ids: DataFrame) -> DataFrame:
    return menus.join(ids.select("item_id"), "item_id", "left_semi")


def with_names(rows: DataFrame, menus: DataFrame, missing: str, name: str = "menu_name") -> DataFrame:
    names = menus.select("item_id", F.col("name").alias(name))
    return (lookup_join(rows, names, "item_id", "left")
            .withColumn(name, F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(missing))))


def numbered_with_names(recommendations: DataFrame, menus: DataFrame) -> DataFrame:
    """Recommendations, already ranked, with their menu names ('N/A' where unknown)."""
    return with_names(recommendations, menus, "N/A").withColumnRenamed("rank", "number")


def interactions_with_names(interactions: DataFrame, menus: DataFrame) -> DataFrame:
    """Interactions with menu name and price text; menus carry no price, so it is always 'N/A'."""
    return with_names(interactions, menus, "Unknown").withColumn("price", F.lit("N/A"))


def with_scores(menus: DataFrame, scores: DataFrame) -> DataFrame:
    return (lookup_join(menus, scores.select("item_id", "score"), "item_id", "left")
            .withColumn("score", F.coalesce("score", F.lit(0.0))))


def recent_by_user(interactions: DataFrame, limit: int = RECENT) -> DataFrame:
    return top_per_key(interactions, ["user_id"], [F.desc_nulls_last("created_at"), "item_id"], limit, "rank")


def page_after(df: DataFrame, key: str, after: Column | str | None = None, limit: int = PAGE) -> DataFrame:
    """The next rows in key order behind a start key; without one, the first page."""
    rest = df if after is None else df.where(F.col(key) > (F.lit(after) if isinstance(after, str) else after))
    return rest.orderBy(key).limit(limit)


def top_ranked(df: DataFrame, order: list, limit: int, rank: str = "rank") -> DataFrame:
    """The best rows with their place; the rank is given after the cut, on ``limit`` rows at most."""
    best = df.orderBy(*order).limit(limit)
    return best.withColumn(rank, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def lookup(df: DataFrame, column: str, value: Column | str) -> DataFrame:
    return df.where(F.col(column) == (value if isinstance(value, Column) else F.lit(value)))


# The rows of the comparison and the column each one shows.
COMPARED = {
    "Score": "score_text",
    "ID": "item_id",
    "Type": "content_classification",
    "Main Ingredient": "genres",
    "Secondary": "genre_l2",
    "Tertiary": "genre_l3",
    "Other Ingredients:": "description_text",
}


def compare_menus(menus: DataFrame, slots: list, slot: str = "item_id") -> DataFrame:
    """Attributes as rows, the chosen menus as columns, named by the values of ``slot``."""
    score = F.round(F.col("score") * 100, 2).cast("decimal(10,2)").cast("string")
    shown = (menus.where(F.col(slot).isin(slots))
             .withColumn("score_text", F.when(F.col("score") != 0, score).otherwise(F.lit("")))
             .withColumn("description_text", F.array_join("product_description", ",")))
    pairs = [F.struct(F.lit(label).alias("attribute"), col_of(c).alias("value")) for label, c in COMPARED.items()]
    cells = shown.select(F.col(slot).alias("_slot"), F.explode(F.array(*pairs)).alias("p"))
    return (cells.select("_slot", "p.attribute", "p.value")
            .groupBy("attribute").pivot("_slot", slots).agg(F.first("value")))
