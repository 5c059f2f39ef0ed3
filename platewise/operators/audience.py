"""Who liked which menus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from platewise.functions.scalars import whole_pct
from platewise.operators.dedup import positions
from platewise.operators.joins import lookup_join
from platewise.session import materialize


def liked_only(interactions: DataFrame) -> DataFrame:
    return interactions.where(F.col("liked") == 1)


def audience_per_item(interactions: DataFrame) -> DataFrame:
    """Distinct liking users per item. Pairs are made distinct first, so a hot item is spread out."""
    likes = liked_only(interactions).select("item_id", "user_id").distinct()
    return likes.groupBy("item_id").agg(F.count(F.lit(1)).alias("users"))


def audience_changes(before: DataFrame, arrived: DataFrame, order: list) -> DataFrame:
    """How many liking users each item gains or loses by new events: item_id, users (signed, never 0).

    ``before`` holds events from earlier, several per pair of user and item or none; ``order`` says which event of a pair counts.
    A pair's events meet in one window: its state before is the first earlier event, its state after is the first of all. An older
    event that comes late changes nothing; a like that became a dislike is taken back.
    """
    columns = [c for c in arrived.columns if c in before.columns]
    both = before.select(*columns, F.lit(0).alias("_new")).unionByName(arrived.select(*columns, F.lit(1).alias("_new")))
    ranked = Window.partitionBy("user_id", "item_id").orderBy(*order)
    earlier = F.count_if(F.col("_new") == 0).over(ranked.rowsBetween(Window.unboundedPreceding, 0))
    placed = both.withColumn("_place", F.row_number().over(ranked)).withColumn("_earlier", earlier).where("liked = 1")
    gained = (F.col("_place") == 1).cast("bigint")
    lost = ((F.col("_new") == 0) & (F.col("_earlier") == 1)).cast("bigint")
    return placed.groupBy("item_id").agg(F.sum(gained - lost).alias("users")).where("users <> 0")


def audience_size(interactions: DataFrame, items: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct users who liked any of the items; 0 when nobody did."""
    likes = liked_only(interactions).select("item_id", "user_id")
    reached = lookup_join(likes, items.select("item_id").distinct(), "item_id")
    counted = F.approx_count_distinct("user_id") if approximate else F.count_distinct("user_id")
    return reached.agg(counted.alias("users"))


def numbered_users(likes: DataFrame) -> DataFrame:
    """A gapless number from 1 for every user with a like."""
    return positions(likes.select("user_id").distinct(), [], [F.col("user_id")], "number")


def item_bitmaps(interactions: DataFrame, items: DataFrame) -> DataFrame:
    """Who liked each of the items, as bits: item_id, bucket (of 32,768 user numbers), users (4 KB of bits).

    Likes of other items are dropped first. A hot item is as many rows as there are buckets of
    users, filled in the map tasks already; its likes never meet in one task.
    """
    likes = liked_only(interactions).select("item_id", "user_id")
    wanted = materialize(lookup_join(likes, items.select("item_id").distinct(), "item_id"), "likes")
    numbered = lookup_join(wanted, numbered_users(wanted), "user_id")
    return numbered.groupBy("item_id", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users"))


def audience_by_item(bitmaps: DataFrame) -> DataFrame:
    return bitmaps.groupBy("item_id").agg(F.sum(F.bitmap_count("users")).alias("users"))


def audience_by_group(bitmaps: DataFrame, items: DataFrame, group: str) -> DataFrame:
    """Distinct users who liked any item of each group (group, item_id): bits are united per group and bucket, so no pairs of
    group and user are made."""
    wanted = lookup_join(bitmaps, items.select(group, "item_id").distinct(), "item_id")
    united = wanted.groupBy(group, "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    return united.groupBy(group).agg(F.sum(F.bitmap_count("users")).alias("users"))


def users_liking(users: DataFrame, interactions: DataFrame, items: DataFrame) -> DataFrame:
    likes = liked_only(interactions).select("item_id", "user_id")
    reached = lookup_join(likes, items.select("item_id").distinct(), "item_id").select("user_id").distinct()
    return users.join(reached, "user_id", "left_semi")


def count_users(users: DataFrame) -> DataFrame:
    return users.agg(F.count_distinct("user_id").alias("users"))


def with_reach(df: DataFrame, users: DataFrame, part: str = "users") -> DataFrame:
    """Add the share of all users as a whole percentage."""
    total: Column = count_users(users).select(F.col("users").alias("total")).scalar()
    return df.withColumn("reach_pct", whole_pct(F.coalesce(F.col(part), F.lit(0)), total))


def with_audience(hits: DataFrame, interactions: DataFrame) -> DataFrame:
    """Add the number of liking users to each hit; 0 where nobody liked the item. Only likes of the hits are counted, so ``hits``
    should be a stored table: it is read twice."""
    likes = liked_only(interactions).select("item_id", "user_id")
    likes = lookup_join(likes, hits.select("item_id").distinct(), "item_id").distinct()
    return with_counts(hits, likes.groupBy("item_id").agg(F.count(F.lit(1)).alias("users")))


def with_counts(hits: DataFrame, counts: DataFrame) -> DataFrame:
    """Add the users of ``counts`` (item_id, users) to each hit; 0 where the item is not among them."""
    return lookup_join(hits, counts, "item_id", "left").withColumn("users", F.coalesce("users", F.lit(0)).cast("bigint"))
