"""The vector index: exact search with bounds equals brute force, approximate search reaches its recall."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from platewise.operators import similarity as S, vector_index as V
from platewise.session import scratch_dir


def clustered(spark, count=1200, dimension=12, clusters=15, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dimension))
    matrix = centres[rng.integers(clusters, size=count)] + 0.05 * rng.normal(size=(count, dimension))
    matrix[count // 3:2 * count // 3] = matrix[0]  # a third of the vectors are copies
    matrix[5] = 0
    data = [(str(i), row.tolist(), f"n{i % 4}") for i, row in enumerate(matrix)] + [("none", None, "n0")]
    df = spark.createDataFrame(data, "key string, v array<double>, name string").repartition(5)
    return S.vector_records(df, "key", "v", "name"), matrix


def asked(spark, matrix, rows):
    data = [(f"q{i}", (matrix[i] + 0.00005 * i).tolist()) for i in rows] + [("zero", [0.0] * matrix.shape[1]), ("null", None)]
    return spark.createDataFrame(data, "query_id string, vector array<double>")


def hits(df):
    return sorted((r["query_id"], r["item_id"], r["name"], round(r["score"], 6), r["rank"]) for r in df.collect())


@pytest.fixture(scope="module")
def setting(spark):
    records, matrix = clustered(spark)
    return records, matrix, V.build_index(records, scratch_dir(spark, "index"))


@pytest.mark.parametrize("part_rows,query_rows", [(V.PART_ROWS, V.QUERY_ROWS), (50, 4)])
def test_bounded_search_is_exact_and_skips(spark, setting, monkeypatch, part_rows, query_rows):
    records, matrix, index = setting
    monkeypatch.setattr(V, "QUERY_ROWS", query_rows)
    if part_rows != V.PART_ROWS:
        monkeypatch.setattr(V, "PART_ROWS", part_rows)
        index = V.build_index(records, scratch_dir(spark, "index"))
        assert index.lists.agg(F.max("parts")).first()[0] >= 8  # the copies are many parts
    queries = asked(spark, matrix, range(0, 1200, 60))
    found = V.knn_bounded(index, queries)
    assert hits(found.hits) == hits(S.knn(records, queries))
    work = {r["query_id"]: r["scored"] / r["vectors"] for r in found.work.collect()}
    assert work["zero"] == 1.0 and np.median([v for q, v in work.items() if q != "zero"]) < 0.5


def test_approximate_search_reaches_its_recall(spark, setting):
    records, matrix, index = setting
    queries = asked(spark, matrix, range(1, 1200, 13)).where("query_id <> 'zero'")
    exact = {(r["query_id"], r["score"]) for r in S.knn(records, queries).collect()}
    near = {(r["query_id"], r["score"]) for r in V.knn_ivf(index, queries).collect()}
    assert len(exact & near) >= 0.9 * len(exact)
    assert V.knn_ivf(index, queries, k=3).groupBy("query_id").count().where("count <> 3").count() == 0
    everything = V.knn_ivf(index, queries, probes=V.MAX_LISTS, rescore=2000)
    assert hits(everything) == hits(S.knn(records.where("id <> '5'"), queries))


def test_every_vector_is_indexed_once(spark, setting):
    _, matrix, index = setting
    assert index.vectors.select("id").distinct().count() == index.vectors.count() == index.entries.count() == len(matrix)
    assert index.lists.agg(F.sum("rows")).first()[0] == len(matrix)
    inside = index.entries.join(index.lists, "list").where("distance > radius").count()
    assert inside == 0 and index.entries.where(f"list = {V.NO_LIST}").count() == 1


def test_small_and_odd_tables(spark):
    records, matrix = clustered(spark, 6, 4, 2)
    queries = asked(spark, matrix, [0, 1])
    for some in (records, records.where("id in ('0', '5')"), records.limit(0), records.where("id = '5'")):
        index = V.build_index(some, scratch_dir(spark, "index"))
        assert hits(V.knn_bounded(index, queries, 50).hits) == hits(S.knn(some, queries, 50))
        assert V.knn_ivf(index, queries.limit(0)).count() == 0
    longer = records.unionByName(records.limit(1).withColumn("vector", F.array(F.lit(1.0).cast("float"))))
    with pytest.raises(PythonException, match="unequal length"):
        S.knn(longer.coalesce(1), queries).collect()


def test_memory_of_products_does_not_grow_with_lists_or_opened_lists(spark):
    rng = np.random.default_rng(2)
    unit, centres = rng.normal(size=(20_000, 8)), rng.normal(size=(500, 8))
    tracemalloc.start()
    where, distance = V._nearest(unit, centres)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 4 * 8 * V.CELLS  # the whole product is 80 MB
    assert all(where[i] == np.argmin(((unit[i] - centres) ** 2).sum(axis=1)) for i in range(0, 20_000, 500))
    assert np.allclose(distance, np.linalg.norm(unit - centres[where], axis=1))
    # Every query opens every list: 200 x 500 rows, but never in one batch.
    lists = spark.createDataFrame([(i, c.tolist(), 1.0, 1, 1) for i, c in enumerate(centres)], V.LISTS)
    queries = SimpleNamespace(sparkSession=spark, mapInArrow=lambda probe, schema: probe)
    probe = V._probes(queries, V.VectorIndex(lists, None, None, None, 1), lambda gaps, *rest: np.full(gaps.shape, True))
    batch = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(200)]), pa.array(list(unit[:200])), pa.array([True] * 200)],
                                       ["query_id", "unit", "sized"])
    found = list(probe([batch]))
    assert max(b.num_rows for b in found) <= V.PROBE_ROWS
    opened = pa.Table.from_batches(found)
    assert opened.num_rows == 200 * 500 == len(set(zip(opened["query_id"].to_pylist(), opened["list"].to_pylist())))
