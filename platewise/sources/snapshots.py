"""Snapshots of a table of batch folders: reads start from a folded base and add only the batches after it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from platewise.operators.dedup import top_per_key
from platewise.sources.tables import batches_if_any


def _base(path: str, upto: int) -> str:
    return f"{path}_snapshots/upto={upto}"


def snapshots(spark: SparkSession, path: str) -> list[int]:
    """The last batch of each finished snapshot, in order. One that broke off has no end mark and is not among them."""
    marks = spark._jvm.org.apache.hadoop.fs.Path(f"{path}_snapshots/upto=*/_SUCCESS")
    found = marks.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marks) or []
    return sorted(int(status.getPath().getParent().getName().split("=")[1]) for status in found)


def _newest(rows: DataFrame, keys: list[str], time: str, ties: list, last_write_wins: bool) -> DataFrame:
    order = [F.desc_nulls_last(time), *ties]
    return top_per_key(rows, keys, [F.desc("batch"), *order] if last_write_wins else order, 1)


def _since(spark: SparkSession, path: str, base: int | None) -> DataFrame | None:
    """The rows of a snapshot and of the batches after it; all batches without one. None where nothing was written yet."""
    batches = batches_if_any(spark, path)
    if base is None:
        return batches
    folded = spark.read.parquet(_base(path, base))
    return folded if batches is None else batches.where(F.col("batch") > base).unionByName(folded)


def rows_if_any(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The rows of the last snapshot and of the batches after it, with their batch; None where nothing was written yet.

    ``before`` leaves out that batch and all after it, and the snapshots that hold them.
    """
    known = [n for n in snapshots(spark, path) if before is None or n < before]
    rows = _since(spark, path, known[-1] if known else None)
    return rows if rows is None or before is None else rows.where(F.col("batch") < before)


def _rows(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    rows = rows_if_any(spark, path) if upto is None else _upto(spark, path, upto)
    if rows is None:
        raise ValueError(f"no batch was written to {path}")
    return rows


def _upto(spark: SparkSession, path: str, upto: int) -> DataFrame | None:
    """The rows to batch ``upto``, out of the snapshot before it, never out of its own: that may be taken again."""
    earlier = [n for n in snapshots(spark, path) if n < upto]
    rows = _since(spark, path, earlier[-1] if earlier else None)
    return None if rows is None else rows.where(F.col("batch") <= upto)


def take_snapshot(spark: SparkSession, path: str, upto: int, keys: list[str], time: str, ties: list,
                  last_write_wins: bool = False) -> None:
    """Fold the batches to ``upto`` into a snapshot, beside the batches and sorted by key.

    It starts from the snapshot before it, so its cost grows with the table and the batches since, not with all batches ever.
    Rows keep their batch, so the later write still wins where that is the rule; a table keeps one rule. Batches that
    are folded must not change any more: one that runs again may only write what it wrote before. An end mark is
    written last; readers see the snapshot from then on, and those that pinned an earlier one go on with it.
    """
    newest = _newest(_rows(spark, path, upto), keys, time, ties, last_write_wins)
    newest.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(_base(path, upto))


def read_snapshot(spark: SparkSession, path: str, keys: list[str], time: str, ties: list, last_write_wins: bool = False,
                  pinned: int | None = None) -> DataFrame:
    """The newest row per key. ``pinned`` names a snapshot to read exactly as it was; else the last one and all later batches."""
    if pinned is not None:
        return spark.read.parquet(_base(path, pinned)).drop("batch")
    return _newest(_rows(spark, path), keys, time, ties, last_write_wins).drop("batch")


def take_sums(spark: SparkSession, path: str, upto: int, key: str, value: str) -> None:
    """The same for a table of signed changes: the changes of a key up to a batch become their sum."""
    sums = _rows(spark, path, upto).groupBy(key).agg(F.sum(value).alias(value)).where(F.col(value) != 0)
    sums.withColumn("batch", F.lit(upto)).write.mode("overwrite").parquet(_base(path, upto))


def read_sums(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """The sum of all changes per key; keys whose changes cancel out are left out."""
    return _rows(spark, path).groupBy(key).agg(F.sum(value).alias(value)).where(F.col(value) != 0)
