"""Structured answers of a text model: one JSON object per menu."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from platewise.functions.scalars import col_of, or_default

# Fixed value: the fields of an answer.
ANSWER_SCHEMA = (
    "cuisine_type string, primary_ingredient string, secondary_ingredient string, "
    "third_ingredient string, other_ingredients array<string>"
)


def parse_answer(answer: Column | str) -> Column:
    """An answer as a struct; anything unreadable gives null fields."""
    return F.from_json(col_of(answer), ANSWER_SCHEMA, {"mode": "PERMISSIVE"})


def with_answer_roles(df: DataFrame, answer: str) -> DataFrame:
    """Add the menu roles of an answer column, with defaults where the answer says nothing."""
    parsed = df.withColumn("_answer", parse_answer(answer))
    return parsed.select(
        *df.columns,
        or_default("_answer.primary_ingredient", "").alias("genres"),
        or_default("_answer.secondary_ingredient", "").alias("genre_l2"),
        or_default("_answer.third_ingredient", "").alias("genre_l3"),
        F.coalesce(F.col("_answer.other_ingredients"), F.array().cast("array<string>"))
        .alias("product_description"),
        or_default("_answer.cuisine_type", "none").alias("content_classification"),
    )
