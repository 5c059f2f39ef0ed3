"""Keyed Parquet tables: upsert, put-if-absent and replay-safe batch folders."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from platewise.operators.dedup import keep_first, top_per_key
from platewise.operators.joins import fits_broadcast


def upsert_latest(base: DataFrame, new: DataFrame, keys: list[str], time: str, ties: list,
                  last_write_wins: bool = False) -> DataFrame:
    """One row per key out of both sides: the newest by ``time``.

    With ``last_write_wins`` a new row replaces the base row even when it is older.
    """
    both = base.withColumn("_write", F.lit(0)).unionByName(new.withColumn("_write", F.lit(1)))
    order = [F.desc_nulls_last(time), *ties]
    if last_write_wins:
        order = [F.desc("_write"), *order]
    return top_per_key(both, keys, order, 1).drop("_write")


def absent_rows(base: DataFrame, new: DataFrame, keys: list[str], order: list) -> DataFrame:
    """New rows whose key the base does not have; the first one where the new rows repeat a key.

    The base is the large side: it is filtered to the keys of the new rows where it lies when those
    are few enough to broadcast, and only what is left of it meets the new rows.
    """
    first = keep_first(new, keys, order)
    wanted = new.select(*keys).distinct()
    if fits_broadcast(wanted):
        wanted = F.broadcast(wanted)
    known = base.select(*keys).join(wanted, keys, "left_semi").distinct()
    return first.join(known, keys, "left_anti")


def insert_absent(base: DataFrame, new: DataFrame, keys: list[str], order: list) -> DataFrame:
    return base.unionByName(absent_rows(base, new, keys, order).select(*base.columns))


def write_batch(df: DataFrame, path: str, batch: int) -> None:
    """Write one batch into its own folder. A replayed batch replaces its folder, so nothing doubles
    and the cost of a batch does not depend on the size of the table."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All batches, with their number as column ``batch``."""
    return spark.read.option("basePath", path).parquet(path)


def batches_if_any(spark: SparkSession, path: str) -> DataFrame | None:
    """All batches, or None where nothing was written yet."""
    try:
        return read_batches(spark, path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def latest_of(batches: DataFrame, keys: list[str], time: str, ties: list, last_write_wins: bool = False) -> DataFrame:
    """The newest row per key over all batches."""
    order = [F.desc_nulls_last(time), *ties]
    if last_write_wins:
        order = [F.desc("batch"), *order]
    return top_per_key(batches, keys, order, 1).drop("batch")


def read_latest(spark: SparkSession, path: str, keys: list[str], time: str, ties: list,
                last_write_wins: bool = False) -> DataFrame:
    """The table: the newest row per key over all batches."""
    return latest_of(read_batches(spark, path), keys, time, ties, last_write_wins)


def replace_batches(df: DataFrame, path: str, touched: DataFrame) -> None:
    """Give the batches named in ``touched`` (column batch) the rows of ``df``, in one job, however many batches they are.

    A batch that keeps no rows gets one row of nulls, because Spark replaces only folders that it writes to: readers
    leave rows without a key out. ``df`` must not read from ``path``.
    """
    empty = touched.select(*[F.col("batch") if f.name == "batch" else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema])
    (df.join(F.broadcast(touched), "batch", "left_semi").select(*df.columns).unionByName(empty.distinct())
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path))


def compact(spark: SparkSession, path: str, target: str, keys: list[str], time: str, ties: list) -> None:
    """Fold all batches into batch 0 of a new table, laid out by key so that key filters skip files.
    Until the next batch arrives, ``read_batches`` of the new table needs no merging."""
    latest = read_latest(spark, path, keys, time, ties)
    write_batch(latest.repartitionByRange(*keys).sortWithinPartitions(*keys), target, 0)


def replace_table(df: DataFrame, target: str) -> None:
    """Truncate and load: the folder holds exactly the new rows afterwards."""
    df.write.mode("overwrite").parquet(target)
