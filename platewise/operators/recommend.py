"""Recommendations for all users at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from platewise.operators.audience import audience_per_item
from platewise.operators.dedup import positions, top_per_key
from platewise.operators.joins import lookup_join
from platewise.operators.views import top_ranked
from platewise.session import materialize

RESULTS = 5
RUN = 1000  # places generated by one array


def most_popular(interactions: DataFrame, limit: int = RESULTS) -> DataFrame:
    """The items with the most liking users, ties in id order."""
    return top_ranked(audience_per_item(interactions), [F.desc("users"), "item_id"], limit)


def picks_affinity(interactions: DataFrame, menus: DataFrame, limit: int = RESULTS) -> DataFrame:
    """Best-for-you: unseen menus whose main ingredient the user likes, the popular ones first.

    score = (user's liked menus with that main ingredient) x (users who liked the menu); ties in id
    order. Within one ingredient the order is the same for everybody, so a user with s seen menus
    of it needs only the first ``limit + s`` places. Those places are generated as rows and joined by
    equality: the work grows with the interactions, not with users times menus.
    """
    segments = menus.select("item_id", F.col("genres").alias("segment"))
    pairs = materialize(
        lookup_join(interactions.groupBy("user_id", "item_id").agg(F.max("liked").alias("liked")),
                    segments, "item_id"), "pairs")
    audience = (pairs.where(F.col("liked") == 1).groupBy("segment", "item_id")
                .agg(F.count(F.lit(1)).alias("users")))
    ranked = positions(materialize(audience, "audience"), ["segment"], [F.desc("users"), F.col("item_id")], "place")
    taste = (pairs.groupBy("user_id", "segment")
             .agg(F.count(F.lit(1)).alias("seen"), F.count_if(F.col("liked") == 1).alias("likes"))
             .where("likes > 0"))
    slots = ranked.select(_slot().alias("slot"), "item_id", "users")
    candidates = (lookup_join(_wanted_places(taste, limit), slots, "slot")
                  .select("user_id", "item_id", (F.col("likes") * F.col("users")).alias("score")))
    unseen = candidates.join(pairs.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    return top_per_key(unseen, ["user_id"], [F.desc("score"), "item_id"], limit, "rank")


def _slot():
    return F.concat_ws("|", "place", "segment")


def _wanted_places(taste: DataFrame, limit: int) -> DataFrame:
    """Places 1 to ``limit + seen`` per user and ingredient, made in runs so that no array gets long."""
    need = F.col("seen") + limit
    run = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((need - 1) / RUN)))
    place = F.explode(F.sequence(F.col("run") * RUN + 1, F.least((F.col("run") + 1) * RUN, F.col("need"))))
    runs = taste.select("user_id", "segment", "likes", need.alias("need"), run.alias("run"))
    return (runs.select("user_id", "segment", "likes", place.alias("place"))
            .select("user_id", "likes", _slot().alias("slot")))
