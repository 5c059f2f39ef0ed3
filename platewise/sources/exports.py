"""Import contracts of a recommender: items, interactions, users."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from platewise.contracts import EXPORT_INTERACTIONS, EXPORT_ITEMS, EXPORT_USERS, to_contract


def export_items(curated: DataFrame) -> DataFrame:
    return to_contract(curated, EXPORT_ITEMS)


def export_interactions(resolved: DataFrame) -> DataFrame:
    """Resolved interactions, so that every item id is one the items export knows."""
    named = resolved.select(
        F.col("user_id").alias("USER_ID"), F.col("item_id").alias("ITEM_ID"),
        F.col("event_type").alias("EVENT_TYPE"), F.col("event_value").alias("EVENT_VALUE"),
        F.col("created_at").alias("TIMESTAMP"))
    return to_contract(named, EXPORT_INTERACTIONS)


def export_users(curated: DataFrame) -> DataFrame:
    return to_contract(curated, EXPORT_USERS)
