"""Queries over sources, sinks and keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from platewise.contracts import MENU_SHEET_COLUMNS, MENU_SHEET_REQUIRED
from platewise.functions.scalars import epoch_seconds, int_prefix
from platewise.operators.dedup import keep_newest
from platewise.operators.normalize import (
    as_events, choices_to_interactions, menus_curated, ratings_to_interactions, users_curated)
from platewise.operators.aliases import resolve
from platewise.operators.similarity import vector_records
from platewise.plans.bridge import TIES, Tables
from platewise.plans.registry import query
from platewise.plans.row_queries import dietary_cells
from platewise.session import scratch_dir
from platewise.sources.delimited import (
    project_sheets, read_ratings, read_sheets, read_typed, read_users, write_delimited)
from platewise.sources.exports import export_interactions as to_interactions
from platewise.sources.exports import export_items as to_items
from platewise.sources.exports import export_users as to_users
from platewise.sources.routes import routed
from platewise.sources.snapshots import read_snapshot, take_snapshot
from platewise.sources.tables import insert_absent as put_absent
from platewise.sources.tables import read_latest, replace_table, upsert_latest as put_latest, write_batch

SHEET_ROWS = 50_000


@query
def scan_csv_roundtrip(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "ratings")
    write_delimited(t.ratings().withColumn("date", F.col("date").cast("string")), path)
    return read_ratings(t.spark, path).select(
        "user_id", "menu_item_id", int_prefix("rating").alias("rating"), epoch_seconds("date").alias("created_at"))


@query
def scan_tsv_roundtrip(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "users")
    write_delimited(t.users_raw(), path, sep="\t")
    return read_users(t.spark, path, sep="\t").select(
        "user_id", "shipping_city", "shipping_state", "grandpa", "subscribed", "locale",
        int_prefix("created_at").alias("created_at"))


def write_sheets(menus: DataFrame, path: str, rows_per_sheet: int) -> None:
    """Menu rows as sheet files with two header rows each."""
    dietary = dietary_cells()
    first = ["Menu ID", "Start", " ", "Meal Id", "  ", "Ingredients(En)", *dietary, "   ", "Notes"]
    second = ["", "Menu Start Date", "Item Id", "", "Meal(En)", "", *["" for _ in dietary], "", "Remarks"]
    day = F.date_format(F.timestamp_seconds("creation_ts"), "M/d/yyyy")
    cells = ["item_id", day, "item_id", "ord", "meal", "ingredients", *dietary.values(), F.lit(""), F.lit("x")]
    sheet = F.floor(F.col("ord") / rows_per_sheet).alias("sheet")
    rows = menus.select(sheet, F.col("ord").cast("bigint").alias("ord"),
                        *[(F.col(c) if isinstance(c, str) else c).cast("string").alias(n)
                          for c, n in zip(cells, first)])
    heads = rows.select("sheet").distinct().select(
        "sheet", F.lit(-1).cast("bigint").alias("ord"), *[F.lit(s).alias(n) for s, n in zip(second, first)])
    (rows.unionByName(heads).repartition("sheet").sortWithinPartitions("sheet", "ord").drop("ord")
     .write.partitionBy("sheet").options(header=True, quote='"', escape='"', emptyValue="").csv(path))


@query
def header_merge(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "sheets")
    write_sheets(t.menus_raw(), path, SHEET_ROWS)
    rows, _ = project_sheets(read_sheets(t.spark, path), MENU_SHEET_COLUMNS, MENU_SHEET_REQUIRED)
    return rows.select("menu_id", epoch_seconds("CREATION_TIMESTAMP").alias("CREATION_TIMESTAMP"),
                       "ITEM_ID", "meal_id", "Meal", "Ingredients", "AllergensContains", "AllergensMayContains", "Spicy", "gluten_free")


@query
def route_files(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "landing")
    name = (F.when(F.col("event_type") == "view", "user_rating").when(F.col("event_type") == "click", "choices")
            .when(F.col("event_type") == "signup", "users").when(F.col("event_type") == "purchase", "menus.xlsx")
            .otherwise("unknown"))
    t["events"].select("event_id", name.alias("file")).write.partitionBy("file").option("header", True).csv(path)
    rows = t.spark.read.option("header", True).schema("event_id bigint").csv(path)
    return routed(rows, path).groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))


@query
def quarantine(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "mixed")
    value = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("user_id").cast("string"))
    write_delimited(t["events"].select("event_id", "event_type", value.alias("score")), path)
    schema = t.spark.createDataFrame([], "event_id bigint, event_type string, score double").schema
    good, bad = read_typed(t.spark, path, schema)
    return (good.select("event_id", "score", F.lit("").alias("record"))
            .unionByName(bad.select("event_id", F.lit(None).cast("double").alias("score"), "record")))


@query
def upsert_latest(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "interactions")
    keys = ["user_id", "item_id"]
    batches = (ratings_to_interactions(t.ratings()), choices_to_interactions(t.choices()))
    for number, batch in enumerate(batches):
        resolved = resolve(as_events(batch), t.alias_map(), stored=True)
        write_batch(keep_newest(resolved, keys, "created_at", TIES), path, number)
    return read_latest(t.spark, path, keys, "created_at", TIES).drop("raw_id")


@query
def upsert_snapshots(t: Tables) -> DataFrame:
    """The same table out of a snapshot of the first batch and the batch after it."""
    path = scratch_dir(t.spark, "interactions")
    rule = (["user_id", "item_id"], "created_at", TIES)
    batches = (ratings_to_interactions(t.ratings()), choices_to_interactions(t.choices()))
    for number, batch in enumerate(batches):
        resolved = resolve(as_events(batch), t.alias_map(), stored=True)
        write_batch(keep_newest(resolved, *rule), path, number)
        if number == 0:
            take_snapshot(t.spark, path, number, *rule)
    return read_snapshot(t.spark, path, *rule).drop("raw_id")


@query
def insert_absent(t: Tables) -> DataFrame:
    kept = t.menus().select("item_id", F.col("meal").alias("name"), F.lit("kept").alias("origin"))
    new = t.menus_raw().select("item_id", F.col("meal").alias("name"), F.lit("new").alias("origin"))
    return put_absent(kept, new, ["item_id"], ["name"])


@query
def scan_table(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "menus")
    replace_table(t.menus_raw(), path)
    return t.spark.read.parquet(path).select("item_id", "meal", "ingredients", "creation_ts")


@query
def vector_upsert(t: Tables) -> DataFrame:
    vectors = t["embeddings"]
    first = vector_records(vectors, "vec_id", "embedding", "label").withColumn("version", F.lit(1))
    renamed = vectors.where(F.col("label") >= 5).withColumn("label", F.concat(F.lit("new-"), F.col("label")))
    second = vector_records(renamed, "vec_id", "embedding", "label").withColumn("version", F.lit(2))
    merged = put_latest(first, second, ["id"], "version", [])
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return merged.select("id", F.col("metadata.name").alias("name"),
                         F.size("vector").cast("bigint").alias("n_dims"), F.round(F.sqrt(squares), 4).alias("norm"))


@query
def export_items(t: Tables) -> DataFrame:
    return to_items(menus_curated(t.menus_enriched()))


@query
def export_interactions(t: Tables) -> DataFrame:
    return to_interactions(t.interactions())


@query
def export_users(t: Tables) -> DataFrame:
    return to_users(users_curated(t.users()))
