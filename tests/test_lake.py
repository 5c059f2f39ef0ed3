"""Raw files to tables and answers, end to end."""

import pytest

from platewise import lake
from platewise.operators.enrich import enrich_with_model
from platewise.operators.recommend import most_popular
from platewise.streaming import ingest


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


SHEET = ("Menu ID,From,,Meal(En),Ingredients(En)\n,Menu Start Date,Item Id,,\n"
         '1,5/6/2024,10,Pork stew,"pork, potato, salt"\n1,5/6/2024,11,Leek soup,"leek, salt"\n'
         '1,5/6/2024,12,Pork stew,"other"\n1,5/6/2024,,No id,x\n')


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    raw = base / "raw"
    put(raw / "sheets" / "week1.csv", SHEET)
    put(raw / "sheets" / "broken.csv", "a,b\nItem Id,c\n9,8\n")
    put(raw / "users" / "a.csv", "user_id,shipping_city,locale,created_at\n1,Rome,it,2024-05-06\n2,Oslo,no,bad\n1,Bari,it,2024-05-07\n")
    put(raw / "rating" / "a.csv", "user_id,menu_item_id,rating,date\n1,12,5,2024-05-06\n1,10,2,2024-05-05\n2,99,5,2024-05-06\n2,11,4,2024-05-06\n")
    put(raw / "choice" / "a.csv", "user_id,menu_item_id,manual,created_at\n2,10,true,2024-05-06\n3,10,false,2024-05-06\n")
    root = str(base / "tables")
    lexicon = spark.createDataFrame([("pork", "pork", "protein"), ("potato", "potato", "grain"), ("leek", "leek", "vegetable")],
                                    "term string, base string, food_group string")
    cuisines = spark.createDataFrame([("pork", "german"), ("leek", "french")], "base string, cuisine string")
    enrich = lake.lexicon_enricher(lexicon, cuisines)
    for batch in (0, 1, 1):  # the same sheets again, and the second load replayed
        rejected = lake.load_menus(spark, root, str(raw / "sheets"), enrich, batch)
    assert [r["sheet"].rsplit("/", 1)[-1] for r in rejected.collect()] == ["broken.csv"]
    assert lake.load_users(spark, root, str(raw / "users"), 0).count() == 0
    assert lake.load_events(spark, root, str(raw / "rating"), str(raw / "choice"), 0).count() == 0
    return root


def test_tables(spark, root, rows):
    assert rows(lake.menus(spark, root)) == [
        ("10", 1714953600, "Pork stew", "pork", "potato", "", ["salt"], "german"),
        ("11", 1714953600, "Leek soup", "", "", "leek", ["salt"], "french")]
    assert rows(lake.ingredients(spark, root)) == [("leek", 1), ("pork", 1), ("potato", 1), ("salt", 2)]
    assert rows(lake.users(spark, root)) == [("1", "Bari", None, "it", 1715040000), ("2", "Oslo", None, "no", None)]
    assert rows(lake.interactions(spark, root)) == [
        ("10", "1", "Watch", 100.0, 1714953600, 1), ("10", "2", "Click", 1.0, 1714953600, 1),
        ("11", "2", "Watch", 80.0, 1714953600, 1)]


def test_later_batches(spark, root, tmp_path, rows):
    put(tmp_path / "rating" / "b.csv", "user_id,menu_item_id,rating,date\n1,10,1,2024-01-01\n2,11,1,2024-06-01\n")
    put(tmp_path / "choice" / "b.csv", "user_id,menu_item_id,manual,created_at\n")
    lake.load_events(spark, root, str(tmp_path / "rating"), str(tmp_path / "choice"), 1)
    newest = rows(lake.interactions(spark, root), "user_id", "item_id", "event_value")
    assert newest == [("1", "10", 100.0), ("2", "10", 1.0), ("2", "11", 20.0)]
    written = rows(lake.interactions(spark, root, last_write_wins=True), "user_id", "item_id", "event_value")
    assert written == [("1", "10", 20.0), ("2", "10", 1.0), ("2", "11", 20.0)]
    put(tmp_path / "users" / "b.csv", "user_id,shipping_city,locale,created_at\n2,Bergen,no,2024-05-08\n")
    lake.load_users(spark, root, str(tmp_path / "users"), 1)
    assert rows(lake.users(spark, root), "user_id", "shipping_city") == [("1", "Bari"), ("2", "Bergen")]
    assert most_popular(lake.interactions(spark, root)).first()["item_id"] == "10"


def test_reads_start_from_snapshots(spark, tmp_path, rows, root):
    """Folded events and users, later batches, a replay and events released after the fold read like all batches."""
    tables = str(tmp_path / "t")
    enrich = lambda m: enrich_with_model(m, lambda batch: ["{}"] * len(batch))
    put(tmp_path / "a" / "a.csv", SHEET)
    put(tmp_path / "b" / "b.csv", SHEET.replace("12,Pork stew", "77,Pie"))
    put(tmp_path / "choice" / "c.csv", "user_id,menu_item_id,manual,created_at\n")
    days = ["2024-05-06", "2024-01-01", "2024-06-01", "2024-03-01"]

    def batch(n):
        put(tmp_path / f"r{n}" / "r.csv", "user_id,menu_item_id,rating,date\n" + "".join(
            f"{u},{m},{(u + n) % 5 + 1},{days[n]}\n" for u in range(3) for m in (10, 11, 77)))
        put(tmp_path / f"u{n}" / "u.csv", f"user_id,shipping_city,created_at\n1,City{n},{days[n]}\n{n + 5},Rome,{days[n]}\n")
        lake.load_events(spark, tables, str(tmp_path / f"r{n}"), str(tmp_path / "choice"), n)
        lake.load_users(spark, tables, str(tmp_path / f"u{n}"), n)

    def check():
        whole = lake.latest_of(lake._event_batches(spark, tables, False), lake.PAIR, "created_at", lake.TIES)
        assert rows(lake.interactions(spark, tables)) == rows(whole.select(*lake.INTERACTIONS_TABLE.fieldNames()))
        written = lake.latest_of(lake._event_batches(spark, tables, False), lake.PAIR, "created_at", lake.TIES, True)
        assert rows(lake.interactions(spark, tables, True)) == rows(written.select(*lake.INTERACTIONS_TABLE.fieldNames()))
        last = lake.top_per_key(lake.read_batches(spark, f"{tables}/users"), ["user_id"], [lake.F.desc("batch")], 1).drop("batch")
        assert rows(lake.users(spark, tables)) == rows(last)

    lake.load_menus(spark, tables, str(tmp_path / "a"), enrich, 0)
    for n in range(3):
        batch(n)
    lake.fold(spark, tables, events=1, users=1)
    check()
    batch(1)  # a replay of a folded batch
    lake.load_menus(spark, tables, str(tmp_path / "b"), enrich, 1)  # releases events of batches 0 to 2
    check()
    assert rows(lake.interactions(spark, tables).where("item_id = '77'"), "user_id") == [("0",), ("1",), ("2",)]
    lake.fold(spark, tables, events=2, users=2)
    batch(3)
    check()


def test_search(spark, root):
    lake.index_menus(spark, root)
    queries = spark.createDataFrame([("q", "stew,PORK")], "query_id string, text string")
    best = lake.search(spark, root, queries, 1).first()
    assert (best["item_id"], best["name"], best["users"], best["reach_pct"]) == ("10", "Pork stew", 2, 100)
    lake.index_menus(spark, root, limit=1)
    assert spark.read.parquet(f"{root}/text_index/passages").count() == 1


def test_reads_by_key(spark, root, rows):
    lake.publish(spark, root, file_rows=1)
    assert [r["user_id"] for r in lake.users_page(spark, root, limit=1).collect()] == ["1"]
    assert [r["user_id"] for r in lake.users_page(spark, root, "1").collect()] == ["2"]
    assert rows(lake.menus_by_ids(spark, root, ["11", "99"]), "item_id", "name") == [("11", "Leek soup")]
    assert rows(lake.latest_events(spark, root, "2"), "item_id", "menu_name", "rank")[0][:2] == ("10", "Pork stew")
    assert lake.latest_events(spark, root, "nobody").count() == 0
    assert rows(lake.users_who_liked(spark, root, ["10"]), "user_id") == rows(
        lake.interactions(spark, root).where("liked = 1 and item_id = '10'"), "user_id")
    assert lake.users_who_liked(spark, root, []).count() == 0


def test_menus_through_a_text_model(spark, tmp_path, rows):
    put(tmp_path / "sheets" / "w.csv", SHEET)
    answer = '{"cuisine_type":"any","primary_ingredient":"p","other_ingredients":["x, y"]}'
    enrich = lambda menus: enrich_with_model(menus, lambda batch: [answer] * len(batch))
    lake.load_menus(spark, str(tmp_path / "t"), str(tmp_path / "sheets"), enrich, 0)
    assert rows(lake.menus(spark, str(tmp_path / "t")), "item_id", "genres", "product_description") == [
        ("10", "p", ["x, y"]), ("11", "p", ["x, y"])]


def test_new_ids_of_known_menus_and_menus_without_a_name(spark, tmp_path, rows):
    head = "Menu ID,From,,Meal(En),Ingredients(En)\n,Menu Start Date,Item Id,,\n"
    put(tmp_path / "a" / "a.csv", head + "1,5/6/2024,9,Stew,pork\n1,5/6/2024,31,,leek\n1,5/6/2024,32,,salt\n")
    put(tmp_path / "b" / "b.csv", head + "1,6/6/2024,9,Stew,pork\n1,6/6/2024,13,Stew,pork\n")
    put(tmp_path / "rating" / "r.csv", "user_id,menu_item_id,rating,date\n1,9,1,2024-05-06\n1,13,5,2024-06-06\n1,31,4,2024-05-06\n1,32,5,2024-05-06\n")
    put(tmp_path / "choice" / "c.csv", "user_id,menu_item_id,manual,created_at\n")
    root, enrich = str(tmp_path / "t"), lambda menus: enrich_with_model(menus, lambda batch: [None] * len(batch))
    for batch, sheets in ((0, "a"), (1, "b"), (1, "b")):
        lake.load_menus(spark, root, str(tmp_path / sheets), enrich, batch)
    assert rows(lake.menus(spark, root), "item_id") == [("31",), ("32",), ("9",)]
    lake.load_events(spark, root, str(tmp_path / "rating"), str(tmp_path / "choice"), 0)
    assert rows(lake.interactions(spark, root), "item_id", "event_value") == [("31", 80.0), ("32", 100.0), ("9", 100.0)]


def test_streams_give_the_same_tables(spark, root, tmp_path, rows):
    raw, formated, tables = tmp_path / "landing", str(tmp_path / "formated"), str(tmp_path / "tables")
    put(raw / "week1.xlsx.csv", SHEET)
    put(raw / "users_a.csv", "user_id,shipping_city,locale,created_at\n1,Rome,it,2024-05-06\n2,Oslo,no,bad\n1,Bari,it,2024-05-07\n")
    put(raw / "rating.csv", "user_id,menu_item_id,rating,date\n1,12,5,2024-05-06\n1,10,2,2024-05-05\n2,99,5,2024-05-06\n,10,5,2024-05-06\n")
    lexicon = spark.createDataFrame([("pork", "pork", "protein"), ("potato", "potato", "grain"), ("leek", "leek", "vegetable")],
                                    "term string, base string, food_group string")
    cuisines = spark.createDataFrame([("pork", "german"), ("leek", "french")], "base string, cuisine string")
    enrich = lake.lexicon_enricher(lexicon, cuisines)

    def run():
        lines = ingest.stream_lines(spark, str(raw), 1)
        ingest.start_batches(lines, ingest.raw_stage(str(raw), formated), str(tmp_path / "p" / "raw")).awaitTermination()
        return lake.stream_tables(spark, formated, tables, enrich, str(tmp_path / "p"))

    assert run() == ["menus", "users", "interactions"]
    assert rows(lake.menus(spark, tables)) == rows(lake.menus(spark, root))
    assert rows(lake.ingredients(spark, tables)) == rows(lake.ingredients(spark, root))
    assert rows(lake.users(spark, tables)) == [("1", "Bari", None, "it", 1715040000), ("2", "Oslo", None, "no", None)]
    assert rows(lake.interactions(spark, tables)) == [("10", "1", "Watch", 100.0, 1714953600, 1)]
    put(raw / "choice_late.csv", "user_id,menu_item_id,manual,created_at\n2,11,true,2024-05-06\n")
    put(raw / "users_b.csv", "user_id,shipping_city,locale,created_at\n2,Bergen,no,2024-05-08\n")
    put(raw / "week2.xlsx.csv", SHEET)
    run()
    assert rows(lake.ingredients(spark, tables)) == rows(lake.ingredients(spark, root))
    assert rows(lake.users(spark, tables), "user_id", "shipping_city") == [("1", "Bari"), ("2", "Bergen")]
    assert rows(lake.interactions(spark, tables), "user_id", "item_id") == [("1", "10"), ("2", "11")]


def event_rows(spark, root, rows):
    return rows(lake.interactions(spark, root), "user_id", "item_id", "event_value")


def test_events_wait_for_their_menu(spark, tmp_path, rows):
    root = str(tmp_path / "t")
    lexicon = spark.createDataFrame([("pork", "pork", "protein")], "term string, base string, food_group string")
    enrich = lake.lexicon_enricher(lexicon, spark.createDataFrame([("pork", "german")], "base string, cuisine string"))
    put(tmp_path / "choice" / "a.csv", "user_id,menu_item_id,manual,created_at\n")

    def events(name, text):
        put(tmp_path / name / "a.csv", "user_id,menu_item_id,rating,date\n" + text)
        return lambda batch: lake.load_events(spark, root, str(tmp_path / name), str(tmp_path / "choice"), batch)

    first = events("r0", "1,10,5,2024-05-06\n1,77,5,2024-05-06\n2,11,3,2024-05-06\n")
    first(0)
    assert event_rows(spark, root, rows) == [] if lake._event_batches(spark, root) is not None else True
    put(tmp_path / "sheets" / "a.csv", SHEET)
    menus = lambda batch: lake.load_menus(spark, root, str(tmp_path / "sheets"), enrich, batch)
    menus(0)
    both = [("1", "10", 100.0), ("2", "11", 60.0)]
    assert event_rows(spark, root, rows) == both
    assert rows(lake.waiting_events(spark, root), "raw_id", "batch") == [("77", 0)]
    for again in (menus, first, menus):  # replays in any order change nothing and double nothing
        again(0)
        assert event_rows(spark, root, rows) == both
        assert rows(lake.waiting_events(spark, root), "raw_id", "batch") == [("77", 0)]
    newer = events("r1", "1,10,1,2024-06-01\n3,78,4,2024-06-01\n")
    newer(1)
    assert event_rows(spark, root, rows) == [("1", "10", 20.0), ("2", "11", 60.0)]
    put(tmp_path / "sheets" / "b.csv", SHEET.replace("5/6/2024,10,Pork stew", "5/6/2024,77,Pork stew").replace(
        "5/6/2024,12,Pork stew", "5/6/2024,78,Pie"))
    menus(1)
    found = event_rows(spark, root, rows)
    assert ("3", "78", 80.0) in found and len(rows(lake.waiting_events(spark, root))) == 0
    # The old event of user 1 on 77, an id of the same menu, is older than the one on 10.
    assert ("1", "10", 20.0) in found and len([f for f in found if f[0] == "1"]) == 1
    # By order of arrival a released event counts as of its own batch, not of the batch of menus that freed it.
    written = rows(lake.interactions(spark, root, last_write_wins=True), "user_id", "item_id", "event_value")
    assert ("1", "10", 20.0) in written


def test_streamed_events_wait_too(spark, tmp_path, rows):
    root = str(tmp_path / "t")
    enrich = lambda m: enrich_with_model(m, lambda batch: ["{}"] * len(batch))
    put(tmp_path / "raw" / "rating.csv", "user_id,menu_item_id,rating,date\n1,10,5,2024-05-06\n")
    start = lambda: (ingest.start_batches(ingest.stream_lines(spark, str(tmp_path / "raw")), ingest.raw_stage(
        str(tmp_path / "raw"), str(tmp_path / "formated")), str(tmp_path / "progress-raw")).awaitTermination(),
        lake.stream_tables(spark, str(tmp_path / "formated"), root, enrich, str(tmp_path / "progress")))
    start()
    assert rows(lake.waiting_events(spark, root), "raw_id") == [("10",)]
    put(tmp_path / "raw" / "menus.xlsx.csv", SHEET)
    start()
    assert event_rows(spark, root, rows) == [("1", "10", 100.0)]
    assert rows(lake.waiting_events(spark, root)) == []
