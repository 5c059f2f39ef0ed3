"""Raw rows to the common contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from platewise.contracts import CHOICE_EVENT, RATING_EVENT, USER_COLUMNS, USER_DATE_COLUMNS, keep_columns
from platewise.functions.scalars import (
    comma_to_space, epoch_seconds, int_prefix, interest_tags, not_blank, or_default)
from platewise.operators.dedup import top_per_key


def _interaction(event_type: str, value: Column, time: Column, liked: Column) -> list[Column]:
    return [
        F.col("user_id").alias("USER_ID"),
        F.col("menu_item_id").alias("ITEM_ID"),
        F.lit(event_type).alias("EVENT_TYPE"),
        value.cast("double").alias("EVENT_VALUE"),
        time.cast("bigint").alias("TIMESTAMP"),
        liked.cast("int").alias("LIKED"),
    ]


def ratings_to_interactions(ratings: DataFrame) -> DataFrame:
    """Ratings 1-5 as watch events valued 0-100; above 3 is a like. Rows without an item go."""
    stars = F.col("rating")
    if dict(ratings.dtypes)["rating"] == "string":
        stars = int_prefix(stars)
    liked = F.when(stars > 3, 1).otherwise(0)
    return (ratings.where(not_blank("menu_item_id") & not_blank("user_id"))
            .select(_interaction(RATING_EVENT, stars * 20, _time(ratings, "date"), liked)))


def manual_choices(choices: DataFrame) -> DataFrame:
    return choices.where(F.col("manual") == "true")


def choices_to_interactions(choices: DataFrame) -> DataFrame:
    """A choice made by hand is a click and a like."""
    return manual_choices(choices).where(not_blank("user_id")).select(
        _interaction(CHOICE_EVENT, F.lit(1), _time(choices, "created_at"), F.lit(1)))


def _time(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    if kind == "string":
        return epoch_seconds(name)
    if kind.startswith("timestamp") or kind == "date":
        return F.unix_seconds(F.col(name).cast("timestamp"))
    return F.col(name)


def interactions_union(ratings: DataFrame, choices: DataFrame) -> DataFrame:
    return ratings_to_interactions(ratings).unionByName(choices_to_interactions(choices))


def as_events(interactions: DataFrame) -> DataFrame:
    """Interactions in table spelling, the item id still unresolved."""
    return interactions.select(
        F.col("USER_ID").alias("user_id"), F.col("ITEM_ID").alias("raw_id"),
        F.col("EVENT_TYPE").alias("event_type"), F.col("EVENT_VALUE").alias("event_value"),
        F.col("TIMESTAMP").alias("created_at"), F.col("LIKED").alias("liked"))


def menus_formated(rows: DataFrame) -> DataFrame:
    """Sheet rows as raw menus, with all ten columns; their place is the file and the line in it. Rows without an id go."""
    return rows.where(not_blank("ITEM_ID")).select(
        F.struct("sheet", "at").alias("ord"), F.col("ITEM_ID").alias("item_id"), F.col("Meal").alias("meal"),
        F.col("Ingredients").alias("ingredients"), epoch_seconds("CREATION_TIMESTAMP").alias("creation_ts"),
        "menu_id", "meal_id", F.col("AllergensContains").alias("allergens_contains"),
        F.col("AllergensMayContains").alias("allergens_may_contain"), F.col("Spicy").alias("spicy"), "gluten_free")


def users_last(rows: DataFrame) -> DataFrame:
    """User rows of files, formated; the last line of a user wins."""
    return users_formated(top_per_key(rows.where(not_blank("user_id")), ["user_id"],
                                      [F.desc("sheet"), F.desc("at")], 1))


def users_formated(raw: DataFrame) -> DataFrame:
    """Keep-list for users: dates to epoch seconds by name, commas out of text, blank keys out."""
    kept = keep_columns(raw, USER_COLUMNS).where(not_blank("user_id"))
    text = dict(kept.dtypes)

    def clean(name: str) -> Column:
        if name in USER_DATE_COLUMNS:
            return _time(kept, name).alias(name)
        if text[name] == "string":
            return F.translate(F.col(name), ",", "").alias(name)
        return F.col(name)

    return kept.select([clean(name) for name in kept.columns])


def users_curated(users: DataFrame) -> DataFrame:
    return users.select(
        F.col("user_id").alias("USER_ID"),
        interest_tags(users.columns).alias("INTEREST"),
        F.col("shipping_city").alias("CITY"),
        F.col("shipping_state").alias("STATE"),
        F.col("locale").alias("LOCALE"),
        F.col("created_at").cast("bigint").alias("CREATED_AT"))


def menus_curated(menus: DataFrame) -> DataFrame:
    """Enriched menus under the curated contract: no price is known, blanks get their defaults."""
    return menus.select(
        F.col("item_id").alias("ITEM_ID"),
        F.lit(0).cast("decimal(10,2)").alias("PRICE"),
        F.col("created_at").cast("bigint").alias("CREATION_TIMESTAMP"),
        comma_to_space(or_default("name", " ")).alias("NAME"),
        F.coalesce("genres", F.lit("")).alias("GENRES"),
        F.coalesce("genre_l2", F.lit("")).alias("GENRE_L2"),
        F.coalesce("genre_l3", F.lit("")).alias("GENRE_L3"),
        F.coalesce("product_description", F.array().cast("array<string>")).alias("PRODUCT_DESCRIPTION"),
        or_default("content_classification", "none").alias("CONTENT_CLASSIFICATION"))


def menus_table(curated: DataFrame) -> DataFrame:
    return curated.select(
        F.col("ITEM_ID").alias("item_id"), F.col("CREATION_TIMESTAMP").alias("created_at"),
        F.col("NAME").alias("name"), F.col("GENRES").alias("genres"),
        F.col("GENRE_L2").alias("genre_l2"), F.col("GENRE_L3").alias("genre_l3"),
        F.col("PRODUCT_DESCRIPTION").alias("product_description"),
        F.col("CONTENT_CLASSIFICATION").alias("content_classification"))


def users_table(curated: DataFrame) -> DataFrame:
    return curated.select(
        F.col("USER_ID").alias("user_id"), F.col("CITY").alias("shipping_city"),
        F.col("STATE").alias("shipping_state"), F.col("LOCALE").alias("locale"),
        F.col("CREATED_AT").alias("created_at"))


def unusable_dates(df: DataFrame, text: str) -> DataFrame:
    """How many rows have a date text that cannot be read."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(epoch_seconds(text).isNull()).alias("n_bad"))
