"""Streams equal batches, also when a batch is replayed or a file is bad."""

import pytest
from pyspark.sql import functions as F

from platewise.operators.audience import audience_per_item
from platewise.operators.dedup import keep_newest
from platewise.operators.ingredients import ingredient_counts
from platewise.sources.snapshots import snapshots, take_snapshot, take_sums
from platewise.sources.tables import read_latest
from platewise.streaming import ingest


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_raw_stage_goes_on_after_a_bad_file(spark, tmp_path, rows):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    put(raw / "rating_1.csv", "user_id,menu_item_id,rating,date\nu,1,5,2024-05-06\n")
    put(raw / "rating_2.csv", "user_id,stars\nu,1\n")
    put(raw / "choice.csv", "created_at,manual,menu_item_id,user_id\n2024-05-06,true,2,v\n2024-05-06,false,2,w\n")
    put(raw / "users.csv", 'user_id,created_at,shipping_city\n1,2024-05-06,"A, B"\n')
    put(raw / "notes.txt", "nothing\n")

    def run():
        handle = ingest.raw_stage(str(raw), out)
        ingest.start_batches(ingest.stream_lines(spark, str(raw), 2), handle, str(tmp_path / "p")).awaitTermination()

    run()
    first = rows(ingest.read_stage(spark, out, "interactions"))
    assert first == [("u", "1", "Watch", 100.0, 1714953600, 1), ("v", "2", "Click", 1.0, 1714953600, 1)]
    assert rows(ingest.read_stage(spark, out, "users"), "user_id", "shipping_city", "created_at") == [("1", "A B", 1714953600)]
    assert [r["sheet"].rsplit("/", 1)[-1] for r in ingest.read_stage(spark, out, "rejected").collect()] == ["rating_2.csv"]
    put(raw / "rating_3.csv", "user_id,menu_item_id,rating,date\nx,3,1,2024-05-06\n")
    run()  # only the new file is read
    assert rows(ingest.read_stage(spark, out, "interactions")) == sorted(first + [("x", "3", "Watch", 20.0, 1714953600, 0)])


EVENT = "user_id string, raw_id string, event_type string, event_value double, created_at bigint, liked int"
TIES = ["event_type", "event_value", "raw_id"]
KEYS = ["user_id", "item_id"]


def test_upsert_stream_equals_batch(spark, tmp_path, rows):
    events = spark.createDataFrame(
        [(f"u{i % 7}", str(i % 5), "Watch", float(i % 3), (i * 37) % 50, i % 2) for i in range(200)], EVENT)
    mapping = spark.createDataFrame([(str(i), str(i // 2)) for i in range(4)], "raw_id string, item_id string")
    events.repartition(6).write.parquet(str(tmp_path / "in"))
    target = str(tmp_path / "out")
    handle = ingest.interaction_upsert(lambda: mapping, target, TIES)
    stream = ingest.stream_parquet(spark, str(tmp_path / "in"), EVENT, files_per_batch=2)
    ingest.start_batches(stream, handle, str(tmp_path / "p")).awaitTermination()
    expected = rows(keep_newest(events.join(mapping, "raw_id"), KEYS, "created_at", TIES), *sorted(events.columns + ["item_id"]))
    read = read_latest(spark, target, KEYS, "created_at", TIES)
    assert rows(read, *sorted(read.columns)) == expected
    handle(events.limit(0), 0)  # a batch that replays with other content replaces its folder
    handle(events, 0)
    read = read_latest(spark, target, KEYS, "created_at", TIES)
    assert rows(read, *sorted(read.columns)) == expected


@pytest.mark.parametrize("last_write_wins", [False, True])
def test_audience_by_changes_equals_a_recount(spark, tmp_path, rows, last_write_wins):
    """Likes that turn into dislikes and back, late older events, null times, a hot menu, replays and folds between batches."""
    mapping = spark.createDataFrame([(str(i), str(i // 2)) for i in range(12)], "raw_id string, item_id string")
    target, changes = str(tmp_path / "t"), str(tmp_path / "c")
    handle = ingest.audience_upsert(spark, lambda: mapping, target, changes, TIES, last_write_wins)

    def arriving(n):
        seen = [(f"u{(i * 7 + n) % 9}", str(0 if i % 3 == 0 else (i * n) % 13), "Watch", float(i % 4),
                 None if i % 17 == 0 else (i * 31 + n * 5) % 60, (i + n) % 2) for i in range(60)]
        return spark.createDataFrame(seen, EVENT)

    def check():
        table = read_latest(spark, target, KEYS, "created_at", TIES, last_write_wins)
        assert rows(ingest.read_audience(spark, changes), "item_id", "users") == rows(audience_per_item(table))

    for n in range(5):
        handle(arriving(n), n)
        handle(arriving(n), n)  # a replay
        check()
        if n in (1, 3):
            take_snapshot(spark, target, n, KEYS, "created_at", TIES, last_write_wins)
            take_sums(spark, changes, n, "item_id", "users")
            check()
    assert snapshots(spark, target) == snapshots(spark, changes) == [1, 3]
    assert spark.read.parquet(changes).where("users < 0").count()
    handle(arriving(3).limit(0), 5)  # nothing new
    assert spark.read.parquet(f"{changes}/batch=5").isEmpty()
    everybody = arriving(0).select("user_id", "raw_id", "event_type", "event_value", F.lit(10**6).cast("bigint").alias("created_at"),
                                   F.lit(0).alias("liked"))
    for n in range(1, 5):
        everybody = everybody.unionByName(arriving(n).select("user_id", "raw_id", "event_type", "event_value", F.lit(10**6).cast(
            "bigint").alias("created_at"), F.lit(0).alias("liked")))
    handle(everybody, 6)  # nobody likes anything any more
    assert rows(ingest.read_audience(spark, changes)) == []


MENU = "item_id string, name string, genres string, genre_l2 string, genre_l3 string, product_description array<string>"


def test_counters_count_a_menu_once(spark, tmp_path, rows):
    menus = spark.createDataFrame([(str(i), f"m{i}", f"g{i % 3}", "rice", "", ["salt", "salt"]) for i in range(20)], MENU)
    source, known, counts = (str(tmp_path / n) for n in ("in", "menus", "counts"))
    menus.repartition(4).write.parquet(source)
    menus.where("item_id < 5").repartition(1).write.mode("append").parquet(source)  # menus that come again

    handle = ingest.ingredient_counters(spark, known, counts)
    ingest.start_batches(ingest.stream_parquet(spark, source, MENU, 1), handle, str(tmp_path / "p")).awaitTermination()
    expected = rows(ingredient_counts(menus))
    assert rows(ingest.read_counters(spark, counts)) == expected
    last = spark.read.parquet(known).agg(F.max("batch")).first()[0]
    assert last >= 3
    handle(spark.read.parquet(f"{known}/batch={last}").union(menus.limit(3)), last)
    assert rows(ingest.read_counters(spark, counts)) == expected
