"""Ingredient and role counts over menus."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from platewise.functions.scalars import not_blank
from platewise.operators.joins import lookup_join

ROLES = {"genres": "primary", "genre_l2": "secondary", "genre_l3": "tertiary"}
SHOWN = 50


def ingredient_counts(menus: DataFrame) -> DataFrame:
    """Occurrences of every ingredient in descriptions and roles; repeats in one menu count."""
    roles = F.array(*[F.col(c) for c in ROLES])
    names = F.concat(F.coalesce("product_description", F.array().cast("array<string>")), roles)
    return (menus.select(F.explode(names).alias("name"))
            .select(F.trim("name").alias("name")).where(not_blank("name"))
            .groupBy("name").agg(F.count(F.lit(1)).alias("count")))


def role_sets(menus: DataFrame) -> DataFrame:
    """Distinct names per role; blank and 'none' are no names."""
    pairs = [F.struct(F.lit(role).alias("role"), F.col(c).alias("name")) for c, role in ROLES.items()]
    return (menus.select(F.explode(F.array(*pairs)).alias("r")).select("r.role", "r.name")
            .where(not_blank("name") & (F.col("name") != "none")).distinct())


def role_counts(menus: DataFrame, counts: DataFrame) -> DataFrame:
    return (lookup_join(role_sets(menus), counts, "name", "left")
            .select("role", "name", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def other_ingredients(menus: DataFrame, counts: DataFrame) -> DataFrame:
    """Ingredients that are in no role of any menu."""
    return counts.join(role_sets(menus).select("name").distinct(), "name", "left_anti")


def by_count(counts: DataFrame) -> DataFrame:
    return counts.orderBy(F.coalesce(F.col("count"), F.lit(0)).desc(), "name")


def shown_ingredients(counts: DataFrame, shown: int = SHOWN) -> DataFrame:
    """The first names by count, with the number of names left out."""
    total = counts.agg(F.count(F.lit(1)).alias("n")).scalar()
    return by_count(counts).limit(shown).withColumn("remaining", F.greatest(total - shown, F.lit(0)).cast("bigint"))
