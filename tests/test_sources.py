"""Files in and out: headers, quoting, line ends, routes, bad rows, keyed tables."""

import pytest
from pyspark.sql import functions as F

from platewise.contracts import (
    CHOICE_COLUMNS, INTERACTIONS, MENU_SHEET_COLUMNS, MENU_SHEET_REQUIRED, RATING_COLUMNS, to_contract)
from platewise.operators.normalize import ratings_to_interactions, users_formated
from platewise.sources import delimited, tables
from platewise.sources.exports import export_items
from platewise.sources.routes import STAGE_ROUTES, route_of, routed


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


RATINGS = ["user_id,menu_item_id,rating,date", "u1,7,4,2024-05-06", "u1,8,4.7,05/06/2024", "u2,7,3abc,bad",
           "u3,9,,2024-05-06", "u4,9,x,2024-05-06", "u5,,5,2024-05-06", ""]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_ratings_with_any_line_end(spark, tmp_path, rows, end):
    path = put(tmp_path / "r" / "rating.csv", end.join(RATINGS))
    found = rows(ratings_to_interactions(delimited.read_ratings(spark, path)))
    assert found == [
        ("u1", "7", "Watch", 80.0, 1714953600, 1), ("u1", "8", "Watch", 80.0, 1714953600, 1),
        ("u2", "7", "Watch", 60.0, None, 0), ("u3", "9", "Watch", None, 1714953600, 0),
        ("u4", "9", "Watch", None, 1714953600, 0)]


def test_missing_required_column_names_it(spark, tmp_path):
    path = put(tmp_path / "r.csv", "user_id,menu_item_id,rating\nu,1,5\n")
    with pytest.raises(ValueError, match="date"):
        delimited.read_ratings(spark, path)


def test_other_header_in_one_folder_stops_the_uniform_reader(spark, tmp_path):
    put(tmp_path / "r" / "a.csv", "user_id,menu_item_id,rating,date\nu,1,5,2024-05-06\n")
    put(tmp_path / "r" / "b.csv", "user_id,rating,menu_item_id,date\nv,4,2,2024-05-06\n")
    with pytest.raises(Exception, match="(?i)header"):
        delimited.read_ratings(spark, str(tmp_path / "r")).collect()


def test_mixed_reader_follows_each_header_and_sets_bad_files_aside(spark, tmp_path, rows):
    put(tmp_path / "r" / "a.csv", "user_id,menu_item_id,rating,date\nu,1,5,2024-05-06\n")
    put(tmp_path / "r" / "b.csv", '﻿extra,date,"rating",menu_item_id,user_id\r\n"x, y","May 6, 2024",4,2,v\r\n')
    put(tmp_path / "r" / "c.csv", "user_id,menu_item_id\nw,3\n")
    good, bad = delimited.read_mixed(spark, str(tmp_path / "r"), RATING_COLUMNS, RATING_COLUMNS)
    assert rows(good.drop("sheet", "at")) == [("u", "1", "5", "2024-05-06"), ("v", "2", "4", "May 6, 2024")]
    assert [r["sheet"].rsplit("/", 1)[-1] for r in bad.collect()] == ["c.csv"]


def test_users_keep_dates_by_name_and_lose_commas(spark, tmp_path, rows):
    path = put(tmp_path / "u.csv", 'shipping_city,user_id,created_at,color\n"Paris, FR",1,2024-05-06,red\nX,,2024-05-06,\n')
    found = users_formated(delimited.read_users(spark, path))
    assert found.columns == ["user_id", "shipping_city", "created_at"]
    assert rows(found) == [("1", "Paris FR", 1714953600)]


def test_header_merge_stops_at_double_blank(spark):
    df = spark.createDataFrame([(["Menu ID", "X", " ", ""], [" ", "Item Id", "", "Z"])],
                               "a array<string>, b array<string>")
    assert df.select(delimited.merge_headers(F.col("a"), F.col("b"))).first()[0] == ["Menu ID", "Item Id"]


def test_sheets_with_other_layouts(spark, tmp_path, rows):
    put(tmp_path / "s" / "one.csv", "Menu ID,From,,Meal(En),Ingredients(En),,lost\n,Menu Start Date,Item Id,,,,\n"
                                    '5,5/6/2024,7,Soup,"leek, salt",,no\n6,bad,8,Pie,egg,,no\n')
    put(tmp_path / "s" / "two.csv", "A,B,C\nIngredients(En),Item Id,Meal(En)\nrice,9,Bowl\n")
    put(tmp_path / "s" / "bad.csv", "A,B\nItem Id,Spicy\n1,yes\n")
    good, bad = delimited.project_sheets(delimited.read_sheets(spark, str(tmp_path / "s")),
                                         MENU_SHEET_COLUMNS, MENU_SHEET_REQUIRED)
    assert rows(good, "menu_id", "CREATION_TIMESTAMP", "ITEM_ID", "Meal", "Ingredients", "Spicy") == [
        ("5", "5/6/2024", "7", "Soup", "leek, salt", None), ("6", "bad", "8", "Pie", "egg", None),
        (None, None, "9", "Bowl", "rice", None)]
    assert [r["sheet"].rsplit("/", 1)[-1] for r in bad.collect()] == ["bad.csv"]


def test_records_with_line_breaks(spark, tmp_path, rows):
    put(tmp_path / "u" / "a.csv", 'user_id,shipping_city,locale\n1,"Mont\nreal",fr\n2,"A, ""B""\n\nC ""x"", y",en\n3,5" pan,de\n4,"q",en\n'
                                  '5,"\n","a\nb"\n')
    put(tmp_path / "u" / "plain.csv", 'locale,user_id,shipping_city\nde,6,"Bonn, Rh"\n"",7,""\n')
    put(tmp_path / "u" / "torn.csv", 'user_id,shipping_city,locale\n8,Rome,it\n9,"Oslo,no\n10,Bern,ch\n')
    put(tmp_path / "u" / "long.csv", 'user_id,shipping_city,locale\n11,"' + "x\n" * 1200 + 'y",it\n')
    good, bad = delimited.read_mixed(spark, str(tmp_path / "u"), ["user_id", "shipping_city", "locale"], ["user_id"])
    assert rows(good, "user_id", "shipping_city", "locale") == [
        ("1", "Mont\nreal", "fr"), ("2", 'A, "B"\n\nC "x", y', "en"), ("3", '5" pan', "de"), ("4", "q", "en"),
        ("5", "\n", "a\nb"), ("6", "Bonn, Rh", "de"), ("7", None, None)]
    assert sorted(r["sheet"].rsplit("/", 1)[-1] for r in bad.collect()) == ["long.csv", "torn.csv"]


def test_records_over_parts_of_a_file(spark, tmp_path, rows):
    """Parts of 64 bytes: records, and whole runs of their lines, cross them."""
    cell = lambda i: "\n".join(f"w{i}-{j}" for j in range(i % 9 * 3))
    put(tmp_path / "u" / "a.csv", "user_id,shipping_city\n" + "".join(f'{i},"{cell(i)}"\n' for i in range(60)))
    sizes = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1"}
    before = {key: spark.conf.get(key) for key in sizes}
    try:
        for key, value in sizes.items():
            spark.conf.set(key, value)
        good, bad = delimited.read_mixed(spark, str(tmp_path / "u"), ["user_id", "shipping_city"], ["user_id"])
        found, left = rows(good, "user_id", "shipping_city"), bad.count()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert left == 0 and sorted(found, key=lambda r: int(r[0])) == [(str(i), cell(i) or None) for i in range(60)]


def test_rows_that_do_not_fit(spark, tmp_path, rows):
    path = put(tmp_path / "x.csv", 'id,score\n1,2.5\n2,n/a\n"3",4,5\n')
    schema = spark.createDataFrame([], "id bigint, score double").schema
    good, bad = delimited.read_typed(spark, path, schema)
    assert rows(good) == [(1, 2.5)]
    assert rows(bad.select("record")) == [('"3",4,5',), ("2,n/a",)]
    assert good.select("id").count() == 1


def test_list_columns_written_as_text(spark, tmp_path):
    delimited.write_delimited(spark.createDataFrame([("1", ["a", "b"])], "id string, l array<string>"), str(tmp_path / "o"))
    assert spark.read.option("header", True).csv(str(tmp_path / "o")).first()["l"] == "a|b"


def test_routes(spark, tmp_path, rows):
    names = ["data/user_rating.csv", "rating_choice.csv", "choices.csv", "users.csv", "book.xlsx", "menus.csv", "x"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(route_of("n")).collect()] == [
        "ratings", "ratings", "choices", "users", "menus", None, None]
    assert [r[0] for r in df.select(route_of("n", STAGE_ROUTES)).collect()] == [
        "ratings", "ratings", None, "users", None, "menus", None]
    put(tmp_path / "rating_root" / "users.csv", "a\n1\n")
    put(tmp_path / "rating_root" / "notes.txt", "a\n1\n")
    root = str(tmp_path / "rating_root")
    found = routed(spark.read.option("header", True).csv(root), root)
    assert rows(found) == [("1", "users")]


def test_contract_nulls_bad_values(spark, rows):
    df = spark.createDataFrame([("u", "1", "Watch", "NaN", "12", "1"), ("u", "2", "Watch", "80", "x", "0")],
                               "USER_ID string, ITEM_ID string, EVENT_TYPE string, EVENT_VALUE string, TIMESTAMP string, LIKED string")
    assert rows(to_contract(df, INTERACTIONS)) == [
        ("u", "1", "Watch", None, 12, 1), ("u", "2", "Watch", 80.0, None, 0)]


def test_export_flags(spark):
    df = spark.createDataFrame([("1", "0.00", 5, "a", "b", "c", ["x", "y"], "none")],
                               "ITEM_ID string, PRICE string, CREATION_TIMESTAMP bigint, GENRES string, GENRE_L2 string,"
                               "GENRE_L3 string, PRODUCT_DESCRIPTION array<string>, CONTENT_CLASSIFICATION string")
    out = export_items(df)
    assert out.schema["GENRES"].metadata == {"categorical": True}
    assert out.schema["PRODUCT_DESCRIPTION"].metadata == {"textual": True}
    assert tuple(out.first()) == ("1", 0.0, 5, "a", "b", "c", "x|y", "none")


EVENT = "user_id string, item_id string, created_at bigint, value string"


def test_upsert_newest_across_batches(spark, rows):
    base = spark.createDataFrame([("u", "1", 200, "old"), ("v", "1", 5, "kept")], EVENT)
    late = spark.createDataFrame([("u", "1", 100, "late"), ("w", "1", 1, "new")], EVENT)
    keys = ["user_id", "item_id"]
    assert rows(tables.upsert_latest(base, late, keys, "created_at", ["value"])) == [
        ("u", "1", 200, "old"), ("v", "1", 5, "kept"), ("w", "1", 1, "new")]
    assert rows(tables.upsert_latest(base, late, keys, "created_at", ["value"], last_write_wins=True)) == [
        ("u", "1", 100, "late"), ("v", "1", 5, "kept"), ("w", "1", 1, "new")]


def test_batches_replay_and_compact(spark, tmp_path, rows):
    path, keys = str(tmp_path / "t"), ["user_id", "item_id"]
    first = spark.createDataFrame([("u", "1", 200, "a"), ("v", "1", 1, "b")], EVENT)
    second = spark.createDataFrame([("u", "1", 100, "c"), ("v", "1", 2, "d")], EVENT)
    tables.write_batch(first, path, 0)
    tables.write_batch(second, path, 1)
    tables.write_batch(second, path, 1)
    newest = [("u", "1", 200, "a"), ("v", "1", 2, "d")]
    assert rows(tables.read_latest(spark, path, keys, "created_at", ["value"])) == newest
    assert rows(tables.read_latest(spark, path, keys, "created_at", ["value"], last_write_wins=True)) == [
        ("u", "1", 100, "c"), ("v", "1", 2, "d")]
    tables.compact(spark, path, str(tmp_path / "c"), keys, "created_at", ["value"])
    assert rows(tables.read_latest(spark, str(tmp_path / "c"), keys, "created_at", ["value"])) == newest


def test_insert_absent_ignores_known_and_repeated_keys(spark, rows):
    base = spark.createDataFrame([("1", "a")], "id string, v string")
    new = spark.createDataFrame([("1", "z"), ("2", "c"), ("2", "b")], "id string, v string")
    assert rows(tables.insert_absent(base, new, ["id"], ["v"])) == [("1", "a"), ("2", "b")]


def test_replace_table(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(5).toDF("x"), path)
    tables.replace_table(spark.range(2).toDF("x"), path)
    assert rows(spark.read.parquet(path)) == [(0,), (1,)]


def test_choice_columns_are_required(spark, tmp_path):
    path = put(tmp_path / "c.csv", "user_id,menu_item_id,created_at\nu,1,2024-05-06\n")
    with pytest.raises(ValueError, match="manual"):
        delimited.read_choices(spark, path)
    assert CHOICE_COLUMNS[2] == "manual"


def test_a_data_line_that_equals_the_header_stays(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("x,y\n1,2\nx,y\n")
    found, _ = delimited.read_mixed(spark, str(tmp_path), ["x", "y"])
    assert rows(found, "x", "y") == [("1", "2"), ("x", "y")]


@pytest.mark.parametrize("header_rows", [1, 2])
def test_headers_are_found_without_ranking_all_lines(spark, monkeypatch, header_rows):
    lines = [(f"f{f}", 0, 10 * f + n, None if (f, n) == (3, 0) else f"line {f} {n}") for f in range(6) for n in range(1 if f == 2 else 4)]
    frame = spark.createDataFrame(lines, "sheet string, start long, at long, line string").repartition(3)
    plans, store = [], delimited.materialize

    def noted(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, label)

    monkeypatch.setattr(delimited, "materialize", noted)
    found = delimited.rows_by_header(frame, header_rows=header_rows)
    assert plans and not any("Window" in plan for plan in plans)
    heads = {r["sheet"]: r for r in delimited._heads(frame, ["line1", "line2"][:header_rows]).collect()}
    for f in range(6):
        assert heads[f"f{f}"]["line1"] == (None if f == 3 else f"line {f} 0")
        assert heads[f"f{f}"]["last"] == 10 * f + (0 if f == 2 else header_rows - 1)
        assert header_rows == 1 or heads[f"f{f}"]["line2"] == (None if f == 2 else f"line {f} 1")
    assert found.count() == 5 * (4 - header_rows)
