"""Queries that run a stream over the given tables until nothing is left, then read its result."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from platewise.operators.normalize import as_events, choices_to_interactions, ratings_to_interactions
from platewise.plans.bridge import TIES, Tables
from platewise.plans.registry import query
from platewise.session import scratch_dir
from platewise.sources.delimited import write_delimited
from platewise.sources.snapshots import take_snapshot, take_sums
from platewise.sources.tables import read_latest, replace_table
from platewise.streaming import ingest


@query
def stream_ingest(t: Tables) -> DataFrame:
    """Raw rating and choice files to one folder of interactions, file by file."""
    root = scratch_dir(t.spark, "ingest")
    write_delimited(t.ratings().withColumn("date", F.col("date").cast("string")), f"{root}/raw/user_ratings")
    write_delimited(t.choices().withColumn("created_at", F.col("created_at").cast("string")), f"{root}/raw/choices")
    handle = ingest.raw_stage(f"{root}/raw", f"{root}/formated")
    lines = ingest.stream_lines(t.spark, f"{root}/raw")
    ingest.start_batches(lines, handle, f"{root}/progress/raw").awaitTermination()
    # The next stage is a stream over what this one wrote.
    formated = ingest.read_stage(t.spark, f"{root}/formated", "interactions")
    arriving = ingest.stream_parquet(t.spark, f"{root}/formated/interactions", formated.schema)
    ingest.start_append(arriving.select(formated.columns), f"{root}/curated", f"{root}/progress/formated").awaitTermination()
    return t.spark.read.parquet(f"{root}/curated")


@query
def stream_upsert(t: Tables) -> DataFrame:
    """The interactions table kept by a stream of unresolved events."""
    root = scratch_dir(t.spark, "upsert")
    replace_table(t.events(), f"{root}/events")
    events = ingest.stream_parquet(t.spark, f"{root}/events", t.events().schema)
    handle = ingest.interaction_upsert(t.alias_map, f"{root}/interactions", TIES)
    ingest.start_batches(events, handle, f"{root}/progress").awaitTermination()
    return read_latest(t.spark, f"{root}/interactions", ["user_id", "item_id"], "created_at", TIES).drop("raw_id")


@query
def stream_audience(t: Tables) -> DataFrame:
    """Liking users per menu kept by signed changes: choices arrive, both tables are folded, then the ratings arrive."""
    root = scratch_dir(t.spark, "audience")
    table, changes = f"{root}/interactions", f"{root}/changes"
    handle = ingest.audience_upsert(t.spark, t.alias_map, table, changes, TIES)
    for number, arriving in enumerate((choices_to_interactions(t.choices()), ratings_to_interactions(t.ratings()))):
        events = as_events(arriving)
        events.write.mode("append").parquet(f"{root}/events")
        stream = ingest.stream_parquet(t.spark, f"{root}/events", events.schema)
        ingest.start_batches(stream, handle, f"{root}/progress").awaitTermination()
        if number == 0:
            take_snapshot(t.spark, table, 0, ["user_id", "item_id"], "created_at", TIES)
            take_sums(t.spark, changes, 0, "item_id", "users")
    return ingest.read_audience(t.spark, changes)


@query
def stream_counters(t: Tables) -> DataFrame:
    """Ingredient counts kept by a stream of menus."""
    root = scratch_dir(t.spark, "counters")
    menus = t.menus_enriched().select("item_id", "name", "genres", "genre_l2", "genre_l3", "product_description")
    replace_table(menus, f"{root}/arriving")
    stream = ingest.stream_parquet(t.spark, f"{root}/arriving", menus.schema, files_per_batch=1)
    handle = ingest.ingredient_counters(t.spark, f"{root}/menus", f"{root}/counts")
    ingest.start_batches(stream, handle, f"{root}/progress").awaitTermination()
    return ingest.read_counters(t.spark, f"{root}/counts")
