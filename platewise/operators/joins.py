"""Joins of a large side with a lookup side, safe for hot keys and for lookups of any size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from platewise.session import materialize, materialize_measured

MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 0.01  # a key with at least this share of the rows counts as hot


def _row_bytes(schema: T.StructType):
    sizes = []
    for field in schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            sizes.append(F.coalesce(F.octet_length(column), F.lit(0)))
        elif isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            sizes.append(F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)))
        else:
            sizes.append(F.lit(8))
    return reduce(lambda a, b: a + b, sizes)


def _size(df: DataFrame) -> dict[str, Column]:
    return {"rows": F.count(F.lit(1)), "bytes": F.coalesce(F.sum(_row_bytes(df.schema)), F.lit(0))}


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                   max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Measure the rows and bytes of ``df``; only one row with two numbers reaches the driver."""
    size = df.agg(*[value.alias(name) for name, value in _size(df).items()]).first()
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Every key that holds at least ``share`` of the rows, so at most ``1 / share`` candidates."""
    found = df.where(F.col(key).isNotNull()).select(key).freqItems([key], share).first()
    return list(found[0]) if found and found[0] else []


def splits_skew(spark: SparkSession) -> bool:
    """Does the session split the hot partitions of a sort-merge join at run time?"""
    return all(spark.conf.get(name, "true").lower() == "true"
               for name in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"))


def lookup_join(left: DataFrame, lookup: DataFrame, key: str, how: str = "inner", stored: bool = False,
                max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Join ``left`` with a lookup that has one or few rows per key; ``how`` is inner or left.

    A lookup of measured small size is broadcast; a computed lookup is written once, so that measuring
    it does not compute it twice (``stored``: it is a plain table already). A larger lookup is joined
    by a shuffle: adaptive execution cuts the partition of a hot key into many tasks, and where the
    session has that switched off, ``split_join`` keeps hot keys out of the shuffle.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how}")
    if stored:
        small = fits_broadcast(lookup, max_rows, max_bytes)
    else:
        lookup, size = materialize_measured(lookup, "lookup", **_size(lookup))
        small = size["rows"] <= max_rows and size["bytes"] <= max_bytes
    if small:
        return left.join(F.broadcast(lookup), key, how)
    if splits_skew(left.sparkSession):
        return left.join(lookup, key, how)
    return split_join(left, lookup, key, how, max_rows, max_bytes)


def split_join(left: DataFrame, lookup: DataFrame, key: str, how: str = "inner",
               max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Rows with a hot or null key meet a broadcast of just the lookup rows of those at most
    ``1 / HOT_SHARE`` keys where they lie; only the other rows are shuffled. ``left`` is written once,
    because it is read three times."""
    left = materialize(left, "left")
    hot = hot_keys(left, key)
    hot_lookup = lookup.where(F.col(key).isin(hot)) if hot else lookup.limit(0)
    if not fits_broadcast(hot_lookup, max_rows, max_bytes):
        return left.join(lookup, key, how)  # many lookup rows per key: their product is the result's own size
    is_hot = F.col(key).isNull() | F.col(key).isin(hot) if hot else F.col(key).isNull()
    cold = left.where(~is_hot).join(lookup, key, how)
    return cold.unionByName(left.where(is_hot).join(F.broadcast(hot_lookup), key, how))
