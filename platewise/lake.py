"""The lake: raw files to the serving tables, and what is read from them.

Every table is a folder of batch folders below ``root``. A load names its batch; loading a batch again
replaces it. Batch numbers grow, and one source of numbers (one stream, one scheduler) feeds a table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from platewise.contracts import (
    CHOICE_COLUMNS, INTERACTIONS, INTERACTIONS_TABLE, MENU_SHEET_COLUMNS, MENU_SHEET_REQUIRED, MENUS_TABLE,
    RATING_COLUMNS, USER_COLUMNS, USERS_TABLE, to_contract)
from platewise.functions.scalars import passage_text
from platewise.operators import normalize
from platewise.operators.aliases import alias_map, collapse_menus, menu_aliases, resolve, with_same
from platewise.operators.audience import liked_only, with_audience, with_reach
from platewise.operators.dedup import first_rows, keep_first, keep_newest, top_per_key
from platewise.operators.enrich import enrich_menus
from platewise.operators.ingredients import ingredient_counts
from platewise.operators.similarity import TOP_K
from platewise.operators.text_index import build_text_index, read_text_index, search_index
from platewise.operators.views import PAGE, RECENT, recent_by_user, with_names
from platewise.session import materialize, use_utc
from platewise.sources.delimited import project_sheets, read_mixed, read_sheets
from platewise.sources.snapshots import read_snapshot, rows_if_any, take_snapshot
from platewise.sources.sorted_tables import FILE_ROWS, lookup_sorted, page_sorted, write_sorted
from platewise.sources.tables import absent_rows, batches_if_any, latest_of, read_batches, replace_batches, write_batch
from platewise.streaming.ingest import start_batches, stream_parquet

PAIR = ["user_id", "item_id"]
TIES = ["event_type", "event_value", "raw_id"]
Enricher = Callable[[DataFrame], DataFrame]


def lexicon_enricher(lexicon: DataFrame, cuisines: DataFrame) -> Enricher:
    return lambda menus: enrich_menus(menus, lexicon, cuisines)


def _known(spark: SparkSession, path: str, batch: int, empty: DataFrame) -> DataFrame:
    """Rows of the batches before this one, so that a load that runs again sees what it saw at first."""
    return read_batches(spark, path).where(F.col("batch") < batch).drop("batch") if batch else empty.limit(0)


def load_menus(spark: SparkSession, root: str, sheets: str, enrich: Enricher, batch: int) -> DataFrame:
    """Menu sheets to the tables ``menus``, ``menu_aliases`` and ``ingredients``. Returns the sheets left
    out for missing columns."""
    use_utc(spark)
    rows, rejected = project_sheets(read_sheets(spark, sheets), MENU_SHEET_COLUMNS, MENU_SHEET_REQUIRED)
    add_menus(spark, root, normalize.menus_formated(rows), enrich, batch)
    return rejected


def add_menus(spark: SparkSession, root: str, formated: DataFrame, enrich: Enricher, batch: int) -> None:
    """Raw menus to the tables: only menus that are not known yet are enriched, added and counted. New ids of
    known menus are stored too."""
    raw = materialize(formated, "raw")
    first = materialize(collapse_menus(raw), "first")
    known = _known(spark, f"{root}/menus", batch, first)
    fresh = absent_rows(known, first, ["item_id"], ["ord"])
    menus = to_contract(normalize.menus_table(normalize.menus_curated(enrich(fresh))), MENUS_TABLE)
    write_batch(menus, f"{root}/menus", batch)
    added = spark.read.parquet(f"{root}/menus/batch={batch}")
    write_batch(ingredient_counts(added), f"{root}/ingredients", batch)
    ids = menu_aliases(raw, first).select("item_id", "raw_id")
    stored = _known(spark, f"{root}/menu_aliases", batch, ids)
    write_batch(absent_rows(stored, ids, ["item_id", "raw_id"], ["raw_id"]), f"{root}/menu_aliases", batch)
    release_events(spark, root, batch)


def load_users(spark: SparkSession, root: str, files: str, batch: int) -> DataFrame:
    """User files to the table ``users``: the last row of a user wins. Returns the files left out."""
    use_utc(spark)
    rows, rejected = read_mixed(spark, files, USER_COLUMNS, ["user_id"])
    add_users(root, normalize.users_last(rows), batch)
    return rejected


def add_users(root: str, formated: DataFrame, batch: int) -> None:
    """Formated users, one row per user, to the table."""
    table = normalize.users_table(normalize.users_curated(formated))
    write_batch(to_contract(table, USERS_TABLE), f"{root}/users", batch)


def load_events(spark: SparkSession, root: str, ratings: str, choices: str, batch: int) -> DataFrame:
    """Rating and choice files to the table ``interactions``. Returns the files left out."""
    use_utc(spark)
    rated, bad_ratings = read_mixed(spark, ratings, RATING_COLUMNS, RATING_COLUMNS)
    chosen, bad_choices = read_mixed(spark, choices, CHOICE_COLUMNS, CHOICE_COLUMNS)
    add_interactions(spark, root, normalize.interactions_union(rated, chosen), batch)
    return bad_ratings.unionByName(bad_choices)


def add_interactions(spark: SparkSession, root: str, interactions: DataFrame, batch: int) -> None:
    """Interactions under the common contract: resolve ids, keep the newest per user and menu.

    Events whose id no menu has yet wait in the table ``waiting`` until a load of menus brings it.
    """
    events = materialize(normalize.as_events(to_contract(interactions, INTERACTIONS)), "events")
    ids = batches_if_any(spark, f"{root}/menu_aliases")
    if ids is None:
        waiting = events
    else:
        mapping = materialize(alias_map(ids), "alias-map")
        write_batch(keep_newest(resolve(events, mapping, stored=True), PAIR, "created_at", TIES), f"{root}/interactions", batch)
        waiting = events.join(mapping.select("raw_id"), "raw_id", "left_anti")
    write_batch(waiting, f"{root}/waiting", batch)


def waiting_events(spark: SparkSession, root: str) -> DataFrame | None:
    """Events without a menu so far, with the batch they came in; None before any events."""
    stored = batches_if_any(spark, f"{root}/waiting")
    return None if stored is None else stored.where("raw_id is not null")


def release_events(spark: SparkSession, root: str, batch: int) -> None:
    """Waiting events that the known menu ids now resolve go to the table ``released``, below the batch of menus that brought
    them and with the batch they came in; then they wait no longer.

    Released rows are stored before they are cleared, and a batch that runs again keeps those it released
    before. So at every break each event is in one of the tables, and one in both counts once, as the newest row of its key.
    """
    waiting = waiting_events(spark, root)
    if waiting is None:
        return
    mapping = materialize(alias_map(read_batches(spark, f"{root}/menu_aliases")), "alias-map")
    found = materialize(resolve(waiting.withColumnRenamed("batch", "event_batch"), mapping, stored=True), "found")
    touched = materialize(found.select(F.col("event_batch").alias("batch")).distinct(), "touched")
    earlier = batches_if_any(spark, f"{root}/released")
    if earlier is not None:
        found = found.unionByName(earlier.where(F.col("batch") == batch).select(*found.columns))
    found = materialize(found.distinct(), "released")
    write_batch(found, f"{root}/released", batch)
    left = materialize(waiting.join(mapping.select("raw_id"), "raw_id", "left_anti").select(*waiting.columns), "left")
    replace_batches(left, f"{root}/waiting", touched)


def fold(spark: SparkSession, root: str, events: int | None = None, users: int | None = None) -> None:
    """Fold the events and users of the batches up to these into snapshots, which later reads start from.

    Loads go on as before, also of released events; a folded batch that runs again must bring what it brought. Reads by
    ``last_write_wins`` need the older events too and leave the snapshot of events aside.
    """
    if events is not None:
        take_snapshot(spark, f"{root}/interactions", events, PAIR, "created_at", TIES)
    if users is not None:
        take_snapshot(spark, f"{root}/users", users, ["user_id"], "created_at", [], last_write_wins=True)


def _event_batches(spark: SparkSession, root: str, folded: bool = True) -> DataFrame | None:
    """Resolved events of all batches; a released one counts as of the batch it came in. ``folded``: those that a snapshot holds
    only as far as they are the newest of their pair."""
    direct = (rows_if_any if folded else batches_if_any)(spark, f"{root}/interactions")
    released = batches_if_any(spark, f"{root}/released")
    if released is not None:
        released = released.drop("batch").withColumnRenamed("event_batch", "batch")
    if direct is None or released is None:
        return released if direct is None else direct
    return direct.unionByName(released)


def stream_tables(spark: SparkSession, formated: str, root: str, enrich: Enricher, progress: str) -> list[str]:
    """Everything that arrived in the formated stage to the tables, as streams that stop when nothing is
    left. Menus go first, because events need their ids. Returns the datasets that had arrived."""
    use_utc(spark)

    def newest_users(batch: DataFrame, number: int) -> None:
        # One micro-batch can hold several batches of the raw stage; the later one wins.
        latest = top_per_key(batch, ["user_id"], [F.desc("batch")], 1)
        add_users(root, latest, number)

    handlers = {
        "menus": lambda batch, number: add_menus(spark, root, batch, enrich, number),
        "users": newest_users,
        "interactions": lambda batch, number: add_interactions(spark, root, batch, number),
    }
    arrived = []
    for dataset, handle in handlers.items():
        path = f"{formated}/{dataset}"
        try:
            schema = spark.read.option("basePath", path).parquet(path).schema
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                continue
            raise
        start_batches(stream_parquet(spark, path, schema), handle, f"{progress}/{dataset}").awaitTermination()
        arrived.append(dataset)
    return arrived


def menus(spark: SparkSession, root: str) -> DataFrame:
    return read_batches(spark, f"{root}/menus").drop("batch")


def ingredients(spark: SparkSession, root: str) -> DataFrame:
    return (read_batches(spark, f"{root}/ingredients").groupBy("name")
            .agg(F.sum("count").cast("bigint").alias("count")))


def users(spark: SparkSession, root: str) -> DataFrame:
    return read_snapshot(spark, f"{root}/users", ["user_id"], "created_at", [], last_write_wins=True)


def interactions(spark: SparkSession, root: str, last_write_wins: bool = False) -> DataFrame:
    latest = latest_of(_event_batches(spark, root, not last_write_wins), PAIR, "created_at", TIES, last_write_wins)
    return latest.select(*INTERACTIONS_TABLE.fieldNames())


def index_menus(spark: SparkSession, root: str, limit: int | None = None) -> None:
    """Menu texts to postings: one menu per name, all of them unless a limit is asked for."""
    chosen = keep_first(with_same(menus(spark, root), "name"), ["_same"], ["created_at", "item_id"])
    if limit is not None:
        chosen = first_rows(chosen, "item_id", limit)
    passages = chosen.select("item_id", "name", passage_text(
        "name", ["genres", "genre_l2", "genre_l3"], "product_description").alias("text"))
    build_text_index(materialize(passages, "passages"), f"{root}/text_index", "item_id")


def search(spark: SparkSession, root: str, queries: DataFrame, k: int = TOP_K) -> DataFrame:
    """The best menus per query text ``(query_id, text)``, with the users who liked each one and their
    share of all users. Commas in a query count as spaces."""
    asked = queries.withColumn("text", F.translate("text", ",", " "))
    hits = materialize(search_index(read_text_index(spark, f"{root}/text_index"), asked, k), "hits")
    return with_reach(with_audience(hits, interactions(spark, root)), users(spark, root))


def publish(spark: SparkSession, root: str, file_rows: int = FILE_ROWS) -> None:
    """The tables as of now, sorted for reads by key: users, events by user, likes by menu, and menus."""
    events = materialize(interactions(spark, root), "interactions")
    write_sorted(users(spark, root), f"{root}/serving/users", ["user_id"], file_rows)
    write_sorted(events, f"{root}/serving/events", ["user_id", "created_at", "item_id"], file_rows)
    write_sorted(liked_only(events).select("item_id", "user_id"), f"{root}/serving/likes", ["item_id", "user_id"], file_rows)
    write_sorted(menus(spark, root), f"{root}/serving/menus", ["item_id"], file_rows)


def users_page(spark: SparkSession, root: str, after: str | None = None, limit: int = PAGE) -> DataFrame:
    """The published users behind a start key, in key order."""
    return page_sorted(spark, f"{root}/serving/users", "user_id", after, limit)


def latest_events(spark: SparkSession, root: str, user: str, limit: int = RECENT) -> DataFrame:
    """A user's newest published events with the names of their menus, 'Unknown' where there is none."""
    newest = recent_by_user(lookup_sorted(spark, f"{root}/serving/events", "user_id", [user]), limit)
    ids = [r["item_id"] for r in newest.select("item_id").collect()]  # ``limit`` at most
    return with_names(newest, menus_by_ids(spark, root, ids), "Unknown")


def menus_by_ids(spark: SparkSession, root: str, ids: list[str]) -> DataFrame:
    return lookup_sorted(spark, f"{root}/serving/menus", "item_id", ids)


def users_who_liked(spark: SparkSession, root: str, ids: list[str]) -> DataFrame:
    """Published users who liked any of the menus."""
    likers = lookup_sorted(spark, f"{root}/serving/likes", "item_id", ids).select("user_id").distinct()
    return spark.read.parquet(f"{root}/serving/users/rows").join(likers, "user_id", "left_semi")
