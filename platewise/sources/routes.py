"""Which dataset a file belongs to, by its name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from platewise.functions.scalars import col_of

# Name fragments in the order they are tested, and the dataset each one means.
RAW_ROUTES = (("rating", "ratings"), ("choice", "choices"), ("users", "users"), ("xlsx", "menus"))
STAGE_ROUTES = (("menus.csv", "menus"), ("users.csv", "users"), ("rating", "ratings"))
# End of the fixed values.


def route_of(name: Column | str, routes=RAW_ROUTES) -> Column:
    """The dataset of the first fragment found in the name; null when none fits."""
    route = F.lit(None).cast("string")
    for fragment, dataset in reversed(routes):
        route = F.when(F.contains(col_of(name), F.lit(fragment)), F.lit(dataset)).otherwise(route)
    return route


def relative_name(root: str) -> Column:
    """The file name of a row, counted from below ``root``."""
    tail = root.rstrip("/").rsplit("/", 1)[-1]
    return F.substring_index(F.col("_metadata.file_path"), f"/{tail}/", -1)


def routed(rows: DataFrame, root: str, routes=RAW_ROUTES) -> DataFrame:
    """Rows of files below ``root`` with their dataset; rows of other files are left out."""
    return rows.withColumn("dataset", route_of(relative_name(root), routes)).where(F.col("dataset").isNotNull())
