"""Repeated menus collapse to one row; every raw item id stays known as an alias of the kept menu."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from platewise.functions.scalars import not_blank
from platewise.operators.dedup import keep_first, positions
from platewise.operators.joins import lookup_join

IDS_PER_ROW = 1000
LAST_NUMBER = 2**63 - 1


def with_same(menus: DataFrame, name: str = "meal") -> DataFrame:
    """Add ``_same``, equal for rows of one menu: by meal name, or by id where there is no name."""
    named = F.when(not_blank(name), F.concat(F.lit("name:"), F.col(name)))
    return menus.withColumn("_same", F.coalesce(named, F.concat(F.lit("id:"), F.col("item_id"))))


def collapse_menus(raw: DataFrame) -> DataFrame:
    """One row per meal name: the first one by ``ord``. A row without a name is a menu of its own id."""
    return keep_first(with_same(raw), ["_same"], [F.col("ord"), F.col("item_id")]).drop("_same")


def menu_aliases(raw: DataFrame, menus: DataFrame) -> DataFrame:
    """Long form of the id lists, in file order: every raw id of a meal next to the kept id."""
    kept = with_same(menus).select("_same", F.col("item_id").alias("kept_id"))
    ids = with_same(raw).select("_same", F.col("item_id").alias("raw_id"), "ord")
    return lookup_join(ids, kept, "_same").select(F.col("kept_id").alias("item_id"), "raw_id", "ord")


def alias_map(aliases: DataFrame) -> DataFrame:
    """One menu per raw id: the menu with that very id, else the lowest id (numeric, then text)."""
    order = F.struct(
        (F.col("raw_id") != F.col("item_id")).alias("foreign"),
        F.coalesce(F.col("item_id").try_cast("bigint"), F.lit(LAST_NUMBER)).alias("number"),
        F.col("item_id").alias("id"))
    return aliases.groupBy("raw_id").agg(F.min(order)["id"].alias("item_id"))


def aliases_from_lists(menus: DataFrame) -> DataFrame:
    """Alias rows of menus that carry their ids as a list; a menu also answers to its own id."""
    own = F.array(F.col("item_id"))
    ids = F.array_distinct(F.concat(own, F.coalesce(F.col("other_ids"), F.array().cast("array<string>"))))
    return menus.select("item_id", F.explode(ids).alias("raw_id"))


def packed_aliases(aliases: DataFrame, per_row: int = IDS_PER_ROW) -> DataFrame:
    """The ids of a menu as '|' text in file order. No row holds more than ``per_row`` ids: a longer
    list goes on in the next chunk, so nothing is cut off and no list grows without bound."""
    placed = positions(aliases, ["item_id"], [F.col("ord"), F.col("raw_id")])
    chunk = F.floor((F.col("position") - 1) / per_row).cast("bigint")
    ids = F.transform(F.array_sort(F.collect_list(F.struct("position", "raw_id"))), lambda x: x["raw_id"])
    return (placed.groupBy("item_id", chunk.alias("chunk_no"))
            .agg(F.array_join(ids, "|").alias("other_ids")))


def menus_with_ids(raw: DataFrame, per_row: int = IDS_PER_ROW) -> DataFrame:
    """Collapsed menus with their packed ids; chunk 0 is the menu row, later chunks continue it."""
    menus = collapse_menus(raw)
    return lookup_join(packed_aliases(menu_aliases(raw, menus), per_row), menus, "item_id")


def resolve(events: DataFrame, mapping: DataFrame, stored: bool = False) -> DataFrame:
    """Add the menu that ``raw_id`` stands for by an alias map; events of unknown ids are dropped."""
    return lookup_join(events, mapping, "raw_id", stored=stored)
