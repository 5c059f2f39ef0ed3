"""Column functions on literal edge cases."""

import pytest
from pyspark.sql import functions as F

from platewise.functions import scalars as S
from platewise.functions.answers import with_answer_roles


def values(spark, data, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_dates(spark):
    texts = ["2024-05-06", "2024-05-06T07:08:09+02:00", "05/06/2024", "5/6/2024", "bad", "", None,
             "2024-05-06 00:00:01", "5/6/24", "May 6, 2024", "1969-12-31T23:59:59.5Z"]
    assert values(spark, texts, S.epoch_seconds) == [
        1714953600, 1714972089, 1714953600, 1714953600, None, None, None, 1714953601, 1714953600, 1714953600, -1]


def test_serial_dates(spark):
    df = spark.createDataFrame([(45000.5,), (25569.0,), (25568.0,)], "n double")
    assert [r[0] for r in df.select(S.serial_to_epoch("n")).collect()] == [1678881600, 0, -86400]


def test_number_prefixes(spark):
    texts = ["4", "4.7", "3abc", "", "x", None, " 5", "-2", "+7.5e1kg", ".5"]
    assert values(spark, texts, S.int_prefix) == [4, 4, 3, None, None, None, 5, -2, 7, None]
    assert values(spark, texts, S.float_prefix) == [4.0, 4.7, 3.0, None, None, None, 5.0, -2.0, 75.0, 0.5]


@pytest.mark.parametrize("line, cleaned", [
    ('1,"a, b",x', '1,"a b",x'),
    ('no quotes, here', 'no quotes, here'),
    ('"a,b","c,d,e"', '"ab","cde"'),
    ('1,"open, end', '1,"open, end'),
    ('', ''),
])
def test_quoted_commas(spark, line, cleaned):
    assert values(spark, [line], S.strip_quoted_commas) == [cleaned]


def test_tags(spark):
    df = spark.createDataFrame([("a", None, "en", "1", "0"), (None, None, None, "0", "1")],
                               "shipping_city string, shipping_state string, locale string, grandpa string, show_meats string")
    assert [r[0] for r in df.select(S.interest_tags(df.columns)).collect()] == [
        ["a", "", "en", "grandpa"], ["", "", "", "show_meats"]]
    absent = df.drop("shipping_city", "grandpa")
    assert absent.select(S.interest_tags(absent.columns)).first()[0] == ["", "", "en"]


def test_membership_and_labels(spark):
    assert values(spark, ["1|7|9", "17", "", None], lambda c: S.in_list(c, F.lit("7"))) == [True, False, False, None]
    assert values(spark, ["Watch", "Click", "Other"], S.event_label) == ["+3 rating", "Selection", "Other"]


def test_percentages(spark):
    df = spark.createDataFrame([(1, 200), (1, 8), (0, 5), (3, 0)], "part bigint, total bigint")
    assert [r[0] for r in df.select(S.whole_pct(F.col("part"), F.col("total"))).collect()] == [1, 13, 0, 0]
    scores = spark.createDataFrame([(0.12345,), (1.0,)], "s double")
    assert [r[0] for r in scores.select(S.score_pct("s")).collect()] == [12.35, 100.0]


def test_texts(spark):
    df = spark.createDataFrame([("Soup", "leek", None, "", ["salt", "oil"]), (None, None, None, None, None)],
                               "name string, a string, b string, c string, d array<string>")
    passages = [r[0] for r in df.select(S.passage_text("name", ["a", "b", "c"], "d")).collect()]
    assert passages[0] == "Soup leek   salt oil" and "None" not in passages[1] and passages[1].strip() == ""
    assert df.select(S.query_text("name", "d")).first()[0] == "Soup,salt,oil"


def test_answers(spark):
    df = spark.createDataFrame([
        ('{"cuisine_type":"greek","primary_ingredient":"fish","secondary_ingredient":"rice",'
         '"third_ingredient":"leek, wild","other_ingredients":["salt","oil"]}',),
        ("sorry",), ('{"primary_ingredient":"egg"}',), (None,)], "answer string")
    found = [tuple(r)[1:] for r in with_answer_roles(df, "answer").collect()]
    empty = ("", "", "", [], "none")
    assert found == [("fish", "rice", "leek, wild", ["salt", "oil"], "greek"), empty,
                     ("egg", "", "", [], "none"), empty]
