"""Tables sorted by key over their files, with the range of each file: lookups and pages read only the files they need."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from platewise.session import materialize

FILE_ROWS = 1_000_000  # rows of a file, about
PAGE_FILES = 2         # files that a page asks for at first


def write_sorted(df: DataFrame, path: str, keys: list[str], file_rows: int = FILE_ROWS) -> None:
    """Replace the table at ``path`` by ``df``, sorted by ``keys``; lookups and pages go by the first of them.

    Ranges are cut by all the keys, so the rows of a hot first key fill several files. The lowest and highest first key of
    each file, its rows and its name go to a small table beside the data. Rows with a null first key are left out.
    """
    stored = materialize(df.where(F.col(keys[0]).isNotNull()), "unsorted")
    files = max(1, -(-stored.count() // file_rows))
    stored.repartitionByRange(files, *keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(f"{path}/rows")
    written = df.sparkSession.read.parquet(f"{path}/rows")
    written.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min(keys[0]).alias("low"), F.max(keys[0]).alias("high"), F.count(F.lit(1)).alias("rows")).coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/ranges")


def _read(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    """The named files of the table; none of them: the table without rows."""
    rows = spark.read.schema(spark.read.parquet(f"{path}/rows").schema)
    return rows.parquet(*[f"{path}/rows/{name}" for name in files]) if files else rows.parquet(f"{path}/rows").limit(0)


def file_ranges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/ranges")


def lookup_sorted(spark: SparkSession, path: str, key: str, values: list) -> DataFrame:
    """Rows whose key is one of the values, read from the files whose range holds one of them."""
    if not values:
        return _read(spark, path, [])
    held = reduce(lambda a, b: a | b, [F.lit(v).between(F.col("low"), F.col("high")) for v in values])
    files = [r["file"] for r in file_ranges(spark, path).where(held).select("file").collect()]
    return _read(spark, path, files).where(F.col(key).isin(values))


def page_sorted(spark: SparkSession, path: str, key: str, after=None, limit: int = 100) -> DataFrame:
    """The next rows in key order behind a start key; without one, the first page. Keys are unique.

    Reads the first files whose range reaches beyond the start key, as many as surely hold ``limit`` such rows: the rows of
    the first one may lie before the key, those of later ones don't.
    """
    beyond: Column = F.lit(True) if after is None else F.col("high") > F.lit(after)
    ranges, count = file_ranges(spark, path).where(beyond).orderBy("low", "high", "file"), PAGE_FILES
    while True:
        found = ranges.limit(count).collect()
        if len(found) < count or sum(r["rows"] for r in found[1:]) >= limit:
            break
        count *= 2
    rows = _read(spark, path, [r["file"] for r in found])
    return (rows if after is None else rows.where(F.col(key) > F.lit(after))).orderBy(key).limit(limit)
