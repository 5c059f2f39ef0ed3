"""Key-sorted tables: lookups and pages give the right rows and read few files."""

import pytest

from platewise.sources import sorted_tables as T


def files_read(df):
    return {f.rsplit("/", 1)[-1] for f in df.inputFiles()}


@pytest.fixture(scope="module")
def path(spark, tmp_path_factory):
    """6,000 rows in about 20 files; the key 'hot' holds a third of them."""
    rows = spark.range(6000).selectExpr(
        "case when id % 3 = 0 then 'hot' else concat('k', id * 7919 % 2500) end as k", "id as n", "'x' as file", "1 as low")
    path = str(tmp_path_factory.mktemp("sorted") / "t")
    T.write_sorted(rows.unionByName(rows.limit(3).selectExpr("cast(null as string) as k", "n", "file", "low")), path, ["k", "n"], file_rows=300)
    return path


def test_lookup_reads_the_files_that_can_hold_the_key(spark, path):
    total = T.file_ranges(spark, path).count()
    assert total >= 18 and T.file_ranges(spark, path).selectExpr("sum(rows)").first()[0] == 6000
    expected = {(f"k{i * 7919 % 2500}", i) for i in range(6000) if i % 3}
    for key in ("k0", "k1700", "k999", "none", "zzz", ""):
        found = T.lookup_sorted(spark, path, "k", [key])
        assert {(r["k"], r["n"]) for r in found.collect()} == {e for e in expected if e[0] == key}
        assert len(files_read(found)) <= 2 or found.count() == 0
    hot = T.lookup_sorted(spark, path, "k", ["hot"])
    assert hot.count() == 2000 and 5 <= len(files_read(hot)) < total  # a hot key is several files
    assert T.lookup_sorted(spark, path, "k", []).count() == 0
    assert T.lookup_sorted(spark, path, "k", ["k0", "k2499"]).count() == len([e for e in expected if e[0] in ("k0", "k2499")])


@pytest.mark.parametrize("limit", [1, 7, 250, 5000])
def test_pages_cover_all_keys_in_order(spark, tmp_path, limit):
    keys = sorted(f"u{i}" for i in range(700))
    T.write_sorted(spark.createDataFrame([(k,) for k in keys], "k string").repartition(6), str(tmp_path / "t"), ["k"], file_rows=60)
    after = None if limit > 7 else keys[-3 * limit - 1]
    seen = [] if after is None else keys[:-3 * limit]
    while True:
        page = T.page_sorted(spark, str(tmp_path / "t"), "k", after, limit)
        got = [r["k"] for r in page.collect()]
        if limit <= 7 and got:
            assert len(files_read(page)) <= 2
        if not got:
            break
        seen += got
        after = got[-1]
    assert seen == keys


def test_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    T.write_sorted(spark.createDataFrame([], "k string, v int"), path, ["k"])
    assert T.lookup_sorted(spark, path, "k", ["a"]).count() == 0 and T.page_sorted(spark, path, "k").count() == 0
    T.write_sorted(spark.createDataFrame([("a", 1), ("a", 1)], "k string, v int"), path, ["k"])  # replaces the table
    assert T.lookup_sorted(spark, path, "k", ["a"]).count() == 2
