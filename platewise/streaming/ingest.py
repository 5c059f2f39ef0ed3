"""Continuous ingest: each stage is a file stream that reads what the stage before wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from platewise.contracts import (
    CHOICE_COLUMNS, MENU_SHEET_COLUMNS, MENU_SHEET_REQUIRED, RATING_COLUMNS, USER_COLUMNS)
from platewise.operators.aliases import resolve
from platewise.operators.audience import audience_changes
from platewise.operators.dedup import keep_newest
from platewise.operators.ingredients import ingredient_counts
from platewise.operators.joins import fits_broadcast
from platewise.operators.normalize import (
    choices_to_interactions, menus_formated, ratings_to_interactions, users_last)
from platewise.session import materialize
from platewise.sources.delimited import file_lines, numbered, project_sheets, rows_by_header
from platewise.sources.routes import route_of
from platewise.sources.snapshots import read_sums, rows_if_any
from platewise.sources.tables import absent_rows, read_batches, write_batch

FILES_PER_BATCH = 1000

# Raw datasets: wanted columns, required columns, header rows, normalisation, target folder.
RAW_STAGES = {
    "ratings": (RATING_COLUMNS, RATING_COLUMNS, 1, ratings_to_interactions, "interactions"),
    "choices": (CHOICE_COLUMNS, CHOICE_COLUMNS, 1, choices_to_interactions, "interactions"),
    "users": (USER_COLUMNS, ("user_id",), 1, users_last, "users"),
    "menus": (MENU_SHEET_COLUMNS, MENU_SHEET_REQUIRED, 2, menus_formated, "menus"),
}


def stream_lines(spark: SparkSession, path: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Lines of new text files anywhere below a folder."""
    return file_lines(spark.readStream.options(recursiveFileLookup=True, maxFilesPerTrigger=files_per_batch)
                      .text(path))


def stream_parquet(spark: SparkSession, path: str, schema, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def start_append(stream: DataFrame, target: str, progress: str) -> StreamingQuery:
    """Append the stream to a folder, each input file exactly once, then stop when none is left."""
    return (stream.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", progress).trigger(availableNow=True).start(target))


def start_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], progress: str) -> StreamingQuery:
    return (stream.writeStream.foreachBatch(handle)
            .option("checkpointLocation", progress).trigger(availableNow=True).start())


def raw_stage(root: str, target: str) -> Callable[[DataFrame, int], None]:
    """Batch handler of the raw stage: lines of files below ``root`` are routed by file name, read by
    their own header and normalised. A file without the required columns is listed under ``rejected``
    and does not stop the others; a file no route wants is left alone."""
    tail = root.rstrip("/").rsplit("/", 1)[-1]

    def handle(batch: DataFrame, number: int) -> None:
        dataset_of = route_of(F.substring_index("sheet", f"/{tail}/", -1))
        named = numbered(batch).withColumn("dataset", dataset_of).where(F.col("dataset").isin(*RAW_STAGES))
        lines_by_dataset = materialize(named, "lines")  # the raw text is read once for all datasets
        arrived = {r["dataset"] for r in lines_by_dataset.select("dataset").distinct().collect()}
        for dataset in sorted(arrived):
            columns, required, header_rows, normalise, folder = RAW_STAGES[dataset]
            names = columns if isinstance(columns, dict) else {name: name for name in columns}
            lines = lines_by_dataset.where(F.col("dataset") == dataset).drop("dataset")
            rows, rejected = project_sheets(rows_by_header(lines, header_rows=header_rows), names, required)
            write_batch(normalise(rows), f"{target}/{folder}/source={dataset}", number)
            write_batch(rejected, f"{target}/rejected/source={dataset}", number)
    return handle


def read_stage(spark: SparkSession, target: str, folder: str) -> DataFrame:
    """What the raw stage wrote to one folder, over all sources and batches."""
    path = f"{target}/{folder}"
    return spark.read.option("basePath", path).parquet(path).drop("source", "batch")


def interaction_upsert(mapping: Callable[[], DataFrame], target: str, ties: list) -> Callable[[DataFrame, int], None]:
    """Batch handler: resolve ids, keep the newest event per user and menu, write the batch folder.
    Reading the table with ``read_latest`` then gives the newest over all batches. ``mapping`` gives
    the stored alias map and is asked again for every batch, so that later menus are known."""
    def handle(batch: DataFrame, number: int) -> None:
        resolved = resolve(batch, mapping(), stored=True)
        write_batch(keep_newest(resolved, ["user_id", "item_id"], "created_at", ties), target, number)
    return handle


def audience_upsert(spark: SparkSession, mapping: Callable[[], DataFrame], target: str, changes: str, ties: list,
                    last_write_wins: bool = False) -> Callable[[DataFrame, int], None]:
    """Batch handler: ``interaction_upsert``, and the liking users that each menu gains or loses by the batch.

    Only the stored events of the batch's own pairs are looked at, out of the last snapshot and the batches after it, and only of
    batches before this one: a batch that runs again writes the same changes again and replaces its folder. ``read_audience``
    sums them up, so a count never needs all events. The snapshots of ``target`` must follow the same rule.
    """
    upsert = interaction_upsert(mapping, target, ties)
    pair = ["user_id", "item_id"]
    order = [F.desc_nulls_last("created_at"), *ties]

    def handle(batch: DataFrame, number: int) -> None:
        upsert(batch, number)
        arrived = spark.read.parquet(f"{target}/batch={number}").withColumn("batch", F.lit(number))
        touched = arrived.select(*pair)
        if fits_broadcast(touched):
            touched = F.broadcast(touched)
        before = rows_if_any(spark, target, before=number).join(touched, pair, "left_semi")
        write_batch(audience_changes(before, arrived, [F.desc("batch"), *order] if last_write_wins else order), changes, number)
    return handle


def read_audience(spark: SparkSession, changes: str) -> DataFrame:
    """Liking users per menu, summed over the changes."""
    return read_sums(spark, changes, "item_id", "users")


def ingredient_counters(spark: SparkSession, menus_path: str, counts_path: str) -> Callable[[DataFrame, int], None]:
    """Batch handler: insert menus that are not known yet and count the ingredients of just those.

    Only batches before this one count as known, so a replay of a batch computes the same rows again
    and replaces its folders.
    """
    def handle(batch: DataFrame, number: int) -> None:
        if number == 0:
            known = batch.select("item_id").limit(0)
        else:
            known = read_batches(spark, menus_path).where(F.col("batch") < number).select("item_id")
        write_batch(absent_rows(known, batch, ["item_id"], [F.to_json(F.struct("*"))]), menus_path, number)
        added = spark.read.parquet(f"{menus_path}/batch={number}")
        write_batch(ingredient_counts(added), counts_path, number)
    return handle


def read_counters(spark: SparkSession, counts_path: str) -> DataFrame:
    """Counts per ingredient, summed over the batches."""
    return read_batches(spark, counts_path).groupBy("name").agg(F.sum("count").cast("bigint").alias("count"))
