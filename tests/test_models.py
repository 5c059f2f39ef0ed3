"""Similarity and recommendations against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from platewise.operators import similarity as S
from platewise.operators.recommend import most_popular, picks_affinity


def vectors(spark, count=300, dimension=16, seed=1):
    generator = np.random.default_rng(seed)
    matrix = generator.normal(size=(count, dimension)).astype(np.float32)
    matrix[count // 3:2 * count // 3] = matrix[0]  # a third of the vectors are copies
    data = [(i, [float(x) for x in row], f"n{i % 4}") for i, row in enumerate(matrix)]
    df = spark.createDataFrame(data, "key int, v array<float>, name string").repartition(5)
    return S.vector_records(df, "key", "v", "name"), matrix


def brute_force(matrix, queries, k):
    unit = matrix.astype(np.float64) / np.linalg.norm(matrix.astype(np.float64), axis=1, keepdims=True)
    found = []
    for q, vector in queries:
        scores = np.round(unit @ (np.array(vector) / np.linalg.norm(vector)), 6)
        order = sorted(range(len(matrix)), key=lambda i: (-scores[i], str(i)))[:k]
        found += [(str(q), str(i), rank + 1, round(float(scores[i]), 6)) for rank, i in enumerate(order)]
    return sorted(found)


@pytest.mark.parametrize("settings", [{}, {"max_queries": 3, "vectors_per_block": 64}])
def test_knn_is_exact(spark, settings):
    records, matrix = vectors(spark)
    queries = [(i, [float(x) for x in matrix[i] + 0.01 * i]) for i in (0, 7, 150, 299, 42, 43, 44, 45)]
    asked = spark.createDataFrame(queries, "query_id int, vector array<double>")
    hits = S.knn(records, asked, 5, **settings)
    found = sorted((r["query_id"], r["item_id"], r["rank"], round(r["score"], 6)) for r in hits.collect())
    assert found == brute_force(matrix, queries, 5)
    assert all(r["name"] == f"n{int(r['item_id']) % 4}" for r in hits.collect())


def test_knn_edge_cases(spark):
    records, _ = vectors(spark, 6, 4)
    none = spark.createDataFrame([], "query_id int, vector array<double>")
    assert S.knn(records, none).count() == 0
    one = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 0.0]), (2, None)], "query_id int, vector array<double>")
    assert S.knn(records, one, 50).count() == 6
    gap = records.unionByName(records.limit(1).withColumn("vector", F.lit(None).cast("array<float>")))
    two = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.0, 0.0])], "query_id int, vector array<double>")
    assert S.knn(gap, two, 50).count() == 12 and S.knn(gap, two, 50, max_queries=1).count() == 12
    zero = spark.createDataFrame([(1, [0.0] * 4)], "query_id int, vector array<double>")
    assert {r["score"] for r in S.knn(records, zero).collect()} == {0.0}


def test_lsh_recall(spark):
    records = S.vector_records(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet"), "vec_id", "embedding", "label")
    queries = S.centroids(records)
    exact = {(r["query_id"], r["item_id"]) for r in S.knn(records, queries).collect()}
    near = {(r["query_id"], r["item_id"]) for r in S.knn_lsh(records, queries).collect()}
    assert len(exact & near) / len(exact) >= 0.8
    blocked = S.knn(*S.lsh_codes(records, queries), max_queries=2)
    assert {(r["query_id"], r["item_id"]) for r in blocked.collect()} == near


def test_embedding(spark):
    passages = spark.createDataFrame([(1, "Grilled tuna ceviche"), (2, "Beef stew, potatoes"), (3, None), (4, "")],
                                     "id int, text string")
    model = S.fit_embedder(passages)
    embedded = {r["id"]: np.array(r["vector"]) for r in S.embed(model, passages).collect()}
    assert embedded[1].shape == (S.DIMENSION,)
    assert abs(np.linalg.norm(embedded[1]) - 1) < 1e-6 and not embedded[3].any() and not embedded[4].any()
    queries = S.embed(model, spark.createDataFrame([("q", "CEVICHE tuna")], "query_id string, text string"))
    records = S.vector_records(S.embed(model, passages).withColumn("name", F.col("id")), "id", "vector", "name")
    assert S.knn(records, queries, 1).first()["item_id"] == "1"


def test_embedding_hook(spark):
    def lengths(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [float(len(t)), 1.0])

    df = spark.createDataFrame([("abc",), (None,)], "text string")
    assert [r["vector"] for r in S.embed_with(df, lengths).collect()] == [[3.0, 1.0], [0.0, 1.0]]


def test_popular(spark):
    df = spark.createDataFrame([("u", "2", 1), ("u", "2", 1), ("v", "10", 1), ("w", "10", 0), ("w", "3", 1)],
                               "user_id string, item_id string, liked int")
    assert [(r["item_id"], r["users"], r["rank"]) for r in most_popular(df).collect()] == [
        ("10", 1, 1), ("2", 1, 2), ("3", 1, 3)]


def test_picks_equal_brute_force(spark):
    generator = np.random.default_rng(9)
    genres = {str(i): ["fish", "beef", "egg", ""][i % 4] for i in range(60)}
    events = {}
    for _ in range(900):
        user, item = f"u{generator.integers(25)}", str(generator.integers(60))
        events[user, item] = max(events.get((user, item), 0), int(generator.random() > 0.5))
    for item in genres:  # one user has seen nearly everything
        if item != "17":
            events["u0", item] = 1
    frame = spark.createDataFrame([(u, i, v) for (u, i), v in events.items()], "user_id string, item_id string, liked int")
    menus = spark.createDataFrame(list(genres.items()), "item_id string, genres string")
    likers = {i: sum(v for (_, j), v in events.items() if j == i) for i in genres}
    expected = set()
    for user in {u for u, _ in events}:
        taste = {}
        for (u, i), v in events.items():
            if u == user:
                taste[genres[i]] = taste.get(genres[i], 0) + v
        scored = sorted((-taste.get(genres[i], 0) * likers[i], i) for i in genres
                        if (user, i) not in events and taste.get(genres[i], 0) and likers[i])
        expected |= {(user, i, -s, n + 1) for n, (s, i) in enumerate(scored[:5])}
    found = {(r["user_id"], r["item_id"], r["score"], r["rank"]) for r in picks_affinity(frame, menus).collect()}
    assert found == expected
