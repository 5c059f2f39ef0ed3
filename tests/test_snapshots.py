"""Snapshots of batch tables against all batches read at once."""

import pytest
from pyspark.sql import functions as F

from platewise.sources import snapshots, tables

KEYS, TIES = ["key"], ["value"]


@pytest.mark.parametrize("last_write_wins", [False, True])
def test_snapshots_equal_all_batches(spark, tmp_path, last_write_wins):
    path = str(tmp_path / "t")
    events = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.pmod(F.xxhash64("id"), F.lit(150))).alias("key"),
        F.when(F.col("id") % 11 != 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(40))).alias("time"),
        F.col("id").alias("value"), (F.col("id") % 50).cast("int").alias("batch"))
    events.write.partitionBy("batch").parquet(path)
    rule = (KEYS, "time", TIES, last_write_wins)

    def read(**options):
        return sorted(map(tuple, snapshots.read_snapshot(spark, path, *rule, **options).collect()), key=str)

    def whole():
        return sorted(map(tuple, tables.read_latest(spark, path, *rule).select("key", "time", "value").collect()), key=str)

    assert snapshots.snapshots(spark, path) == [] and read() == whole()
    snapshots.take_snapshot(spark, path, 19, *rule)
    assert read() == whole()
    snapshots.take_snapshot(spark, path, 39, *rule)
    snapshots.take_snapshot(spark, path, 39, *rule)  # the same again
    assert snapshots.snapshots(spark, path) == [19, 39] and read() == whole()
    pinned = read(pinned=39)
    tables.write_batch(events.where("batch = 45").drop("batch"), path, 45)  # a replay
    late = spark.createDataFrame([(0, 10**6, 1), (1, -5, 2), (9999, None, 3)], "key long, time long, value long")
    tables.write_batch(late, path, 50)
    assert read() == whole() and read(pinned=39) == pinned
    # A snapshot that broke off has no end mark.
    spark.range(1).write.parquet(f"{path}_snapshots/upto=49")
    (tmp_path / "t_snapshots" / "upto=49" / "_SUCCESS").unlink()
    assert snapshots.snapshots(spark, path) == [19, 39] and read() == whole()


def test_no_batches(spark, tmp_path):
    with pytest.raises(ValueError):
        snapshots.read_snapshot(spark, str(tmp_path / "none"), KEYS, "time", TIES)
