"""Queries over single rows: projections, filters and column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from platewise.contracts import INTERACTIONS, MENU_SHEET_COLUMNS, keep_columns, to_contract
from platewise.functions import scalars as S
from platewise.functions.answers import with_answer_roles
from platewise.operators import audience, normalize
from platewise.plans.bridge import Tables
from platewise.plans.registry import query
from platewise.session import scratch_dir
from platewise.sources.sorted_tables import lookup_sorted, write_sorted

SERVED_ROWS = 10_000  # rows of a file that single users are looked up in


def joined(name: str, alias: str | None = None, separator: str = "|") -> Column:
    return F.array_join(name, separator).alias(alias or name)


def dietary_cells() -> dict[str, Column]:
    """Allergens and marks of the raw menus, by sheet column; allergens of one cell stand below each other."""
    listed = F.split("ingredients", ", ")
    return {"Allergens Contains(En)": F.element_at(listed, 1),
            "Allergens May Contains(En)": F.array_join(listed, "\n"),
            "Spicy": F.when(F.col("ord") % 3 == 0, "yes").otherwise("no"),
            "gluten_free": F.when(F.col("ord") % 2 == 0, "true").otherwise("false")}


@query
def menus_project(t: Tables) -> DataFrame:
    sheet = t.menus_raw().select(
        F.col("item_id").alias("Item Id"), F.col("creation_ts").alias("Menu Start Date"),
        F.col("meal").alias("Meal(En)"), F.col("ingredients").alias("Ingredients(En)"), F.col("ord").alias("Row"),
        F.col("item_id").alias("Menu ID"), F.col("ord").cast("string").alias("Meal Id"),
        *[value.alias(name) for name, value in dietary_cells().items()])
    return keep_columns(sheet, MENU_SHEET_COLUMNS)


@query
def users_project(t: Tables) -> DataFrame:
    return normalize.users_formated(t.users_raw())


@query
def ratings_to_interactions(t: Tables) -> DataFrame:
    return normalize.ratings_to_interactions(t.ratings())


@query
def choices_to_interactions(t: Tables) -> DataFrame:
    return normalize.choices_to_interactions(t.choices())


@query
def choices_manual(t: Tables) -> DataFrame:
    return normalize.manual_choices(t.choices()).select(
        "user_id", "menu_item_id", "manual", F.unix_seconds(F.col("created_at").cast("timestamp")).alias("created_at"))


@query
def interactions_union(t: Tables) -> DataFrame:
    return normalize.interactions_union(t.ratings(), t.choices())


@query
def liked_only(t: Tables) -> DataFrame:
    return audience.liked_only(t.interactions()).drop("raw_id")


@query
def users_curated(t: Tables) -> DataFrame:
    return normalize.users_curated(t.users_raw()).withColumn("INTEREST", joined("INTEREST"))


@query
def menus_curated(t: Tables) -> DataFrame:
    return (normalize.menus_curated(t.menus_enriched())
            .withColumn("PRODUCT_DESCRIPTION", joined("PRODUCT_DESCRIPTION")))


@query
def typed_curated(t: Tables) -> DataFrame:
    """Curated rows as text, read back under the contract; unusable values become null."""
    bad = F.col("event_type") == "error"
    text = t["events"].select(
        F.col("user_id").cast("string").alias("USER_ID"), F.col("event_id").cast("string").alias("ITEM_ID"),
        F.col("event_type").alias("EVENT_TYPE"),
        F.when(bad, "NaN").otherwise(F.col("user_id").cast("string")).alias("EVENT_VALUE"),
        F.when(bad, "yesterday").otherwise(F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"))
        .alias("TIMESTAMP"),
        F.when(F.col("event_type") == "click", "1").otherwise("0").alias("LIKED"))
    return to_contract(text, INTERACTIONS)


def order_dates(t: Tables) -> DataFrame:
    """Order dates as text, in one form per priority; one of them is no date."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = (F.when(F.col("o_orderpriority") == "1-URGENT", day)
            .when(F.col("o_orderpriority") == "2-HIGH", F.concat(day, F.lit("T12:30:00+02:00")))
            .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format("o_orderdate", "M/d/yyyy"))
            .when(F.col("o_orderpriority") == "5-LOW", F.concat(day, F.lit(" 23:59:58")))
            .otherwise("unknown"))
    return t["orders"].select("o_orderkey", text.alias("created"))


@query
def date_to_epoch(t: Tables) -> DataFrame:
    return order_dates(t).select("o_orderkey", S.epoch_seconds("created").alias("created_at"))


@query
def bad_dates(t: Tables) -> DataFrame:
    return normalize.unusable_dates(order_dates(t), "created")


@query
def serial_to_epoch(t: Tables) -> DataFrame:
    serial = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1899-12-30").cast("date")) + 0.25
    return t["orders"].select("o_orderkey", S.serial_to_epoch(serial).alias("created_at"))


@query
def strip_quoted_commas(t: Tables) -> DataFrame:
    return t["documents"].select("doc_id", S.strip_quoted_commas("text").alias("cleaned"))


@query
def comma_to_space(t: Tables) -> DataFrame:
    return t["documents"].select("doc_id", S.comma_to_space("text").alias("cleaned"))


@query
def parse_number_prefix(t: Tables) -> DataFrame:
    price = F.concat(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit(" EUR"))
    return t["orders"].select(
        "o_orderkey", S.int_prefix("o_orderpriority").alias("priority"), S.float_prefix(price).alias("price"),
        S.int_prefix("o_orderstatus").alias("status"))


@query
def split_membership(t: Tables) -> DataFrame:
    users = t.users_raw().withColumn("tags", F.concat_ws("|", "shipping_city", "shipping_state", "locale"))
    return users.select("ord", "user_id", S.in_list("tags", F.lit("en")).cast("int").alias("english"),
                        S.in_list("tags", F.lit("ASIA")).cast("int").alias("asian"))


@query
def interest_tags(t: Tables) -> DataFrame:
    users = t.users_raw()
    return users.select("ord", "user_id", F.array_join(S.interest_tags(users.columns), "|").alias("interest"))


@query
def score_pct(t: Tables) -> DataFrame:
    return (t["lineitem"].select(S.score_pct("l_discount").alias("score_pct"))
            .groupBy("score_pct").agg(F.count(F.lit(1)).alias("n")))


@query
def passage_text(t: Tables) -> DataFrame:
    roles = ["genres", "genre_l2", "genre_l3"]
    return t.menus_enriched().select("item_id", S.passage_text("name", roles, "product_description").alias("passage"))


@query
def query_text(t: Tables) -> DataFrame:
    return t.menus_enriched().select("item_id", S.query_text("name", "product_description").alias("query"))


@query
def event_label(t: Tables) -> DataFrame:
    return t.events().select("user_id", "raw_id", "created_at", S.event_label("event_type").alias("label"))


@query
def epoch_to_date(t: Tables) -> DataFrame:
    return t.events().select("user_id", "raw_id", "event_type", S.epoch_to_date("created_at").alias("day"))


@query
def parse_answer(t: Tables) -> DataFrame:
    """Model answers, some of them no JSON, to menu roles."""
    words = F.split("p_name", " ")
    answer = F.concat(
        F.lit('{"cuisine_type":"'), F.lower("p_type"), F.lit('","primary_ingredient":"'), words[1],
        F.lit('","secondary_ingredient":"","third_ingredient":null,"other_ingredients":["'),
        words[0], F.lit('","salt"]}'))
    rows = t["part"].select("p_partkey", F.when(F.col("p_type") == "PROMO", "sorry").otherwise(answer).alias("answer"))
    return (with_answer_roles(rows, "answer").drop("answer")
            .withColumn("product_description", joined("product_description")))


@query
def lookup_by_key(t: Tables) -> DataFrame:
    """All interactions of the busiest user, by key equality from the files that can hold the user."""
    path = scratch_dir(t.spark, "interactions-by-user")
    write_sorted(t.interactions().drop("raw_id"), path, ["user_id", "created_at", "item_id"], file_rows=SERVED_ROWS)
    interactions = t.spark.read.parquet(f"{path}/rows")
    busiest = (interactions.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.desc("n"), "user_id").select("user_id").head(1))
    return lookup_sorted(t.spark, path, "user_id", [r["user_id"] for r in busiest])
