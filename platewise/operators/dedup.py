"""Keep-one rules and ranks. ``row_number`` filters run as a group limit before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from platewise.session import materialize


def top_per_key(df: DataFrame, keys: list[str], order: list, limit: int, rank: str | None = None) -> DataFrame:
    """The first ``limit`` rows per key; each map task already cuts its rows to that many."""
    name = rank or "_rank"
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= limit)
    return ranked.withColumn(name, F.col(name).cast("bigint")) if rank else ranked.drop(name)


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    return top_per_key(df, keys, order, 1)


def keep_last(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    return top_per_key(df, keys, [F.desc(position)], 1)


def keep_newest(df: DataFrame, keys: list[str], time: str, ties: list) -> DataFrame:
    """The row with the latest time per key; ``ties`` must decide between equal times."""
    return top_per_key(df, keys, [F.desc_nulls_last(time), *ties], 1)


def positions(df: DataFrame, keys: list[str], order: list[Column], name: str = "position") -> DataFrame:
    """Rank from 1 within the keys, without sending a whole group through one task.

    ``order`` must be unique within the keys. The rows are range-partitioned by keys and order, so
    a large group is cut into several ranges. The ranges are written down, counted per key, and
    each one starts at the number of rows in the ranges before it.
    """
    key_columns = [F.col(k) for k in keys]
    ranged = df.repartitionByRange(*key_columns, *order)
    ranges = materialize(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranges.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_rows"))
              .select(*keys, "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")))
    inside = Window.partitionBy(*keys, "_range").orderBy(*order)
    return (ranges.join(starts, [*keys, "_range"])
            .withColumn(name, (F.col("_start") + F.row_number().over(inside)).cast("bigint"))
            .drop("_range", "_start"))


def first_rows(df: DataFrame, order: str, limit: int) -> DataFrame:
    """The ``limit`` lowest rows by a unique column, found through a cut-off value instead of a sort
    of whole rows."""
    ranked = positions(df.select(order), [], [F.col(order)])
    cutoff = ranked.where(F.col("position") <= limit).agg(F.max(order).alias("cutoff"))
    return df.where(F.col(order) <= cutoff.scalar())
