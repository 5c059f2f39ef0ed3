"""Text search over postings equals scoring every passage."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from platewise.operators import text_index as T
from platewise.session import scratch_dir

WORDS = ["leek", "pork", "Potato", "crème", "brûlée", "a1", "漢字", "salt", "of", "ÉTÉ"] + [f"w{i}" for i in range(300)]


def passages(count=900, seed=4):
    rng = np.random.default_rng(seed)
    weights = 1 / np.arange(1, len(WORDS) + 1)
    texts = [" ".join(rng.choice(WORDS, rng.integers(1, 30), p=weights / weights.sum())) for _ in range(count)]
    texts[count // 3:2 * count // 3] = ["Pork, leek; salt!"] * (count // 3)
    return [(i, t, f"n{i % 3}") for i, t in enumerate(texts)] + [(count, None, "x"), (count + 1, "", "x"), (count + 2, " ,; ", "x")]


def terms(text):
    return Counter(w for w in re.split(r"[\W_]+", text.lower()) if w)


def brute_force(rows, queries, k):
    known = {i: terms(t) for i, t, _ in rows if t is not None}
    holding = Counter(w for c in known.values() for w in c)
    idf = lambda w: math.log((len(known) + 1) / (holding[w] + 1))

    def unit(counts):
        raw = {w: n * idf(w) for w, n in counts.items()}
        norm = math.sqrt(sum(v * v for v in raw.values())) or 1
        return {w: v / norm for w, v in raw.items()}

    vectors = {i: unit(c) for i, c in known.items()}
    names = {i: n for i, _, n in rows}
    out = []
    for q, text in queries:
        asked = unit(terms(text or ""))
        scored = [(round(sum(v * vector.get(w, 0) for w, v in asked.items()), 6), str(i)) for i, vector in vectors.items()]
        best = sorted(((-s, i) for s, i in scored if s > 0))[:k]
        out += [(q, i, names[int(i)], -s, rank) for rank, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows_and_index(spark):
    rows = passages()
    frame = spark.createDataFrame(rows, "id int, text string, name string").repartition(4)
    return rows, T.build_text_index(frame, scratch_dir(spark, "texts"))


@pytest.mark.parametrize("first", [1, 4, 50])
def test_search_equals_brute_force(spark, rows_and_index, monkeypatch, first):
    monkeypatch.setattr(T, "FIRST_BLOCKS", first)
    rows, index = rows_and_index
    queries = [("a", "leek PORK"), ("b", "crème brûlée w7"), ("c", "unknown words"), ("d", ""), ("e", None), ("f", "漢字 été w299 w299"), ("g", "of w1 unknown")]
    asked = spark.createDataFrame(queries, "query_id string, text string")
    got = [(r["query_id"], r["item_id"], r["name"], r["score"], r["rank"]) for r in T.search_index(index, asked, 7).collect()]
    want = brute_force(rows, queries, 7)
    assert [g[:3] + g[4:] for g in sorted(got)] == [w[:3] + w[4:] for w in want]
    assert np.allclose([g[3] for g in sorted(got)], [w[3] for w in want], atol=1.1e-6)


def test_weights(spark, rows_and_index):
    _, index = rows_and_index
    lengths = index.postings.selectExpr("id", "weight * weight as w").groupBy("id").sum("w").collect()
    assert all(abs(r[1] - 1) < 1e-9 for r in lengths)
    assert index.postings.groupBy("dim", "block").count().agg({"count": "max"}).first()[0] <= 4 * T.BLOCK_PASSAGES


def test_no_passages_and_common_terms(spark):
    empty = spark.createDataFrame([], "id int, text string, name string")
    asked = spark.createDataFrame([("q", "leek")], "query_id string, text string")
    assert T.search_index(T.build_text_index(empty, scratch_dir(spark, "texts")), asked).count() == 0
    same = spark.createDataFrame([(1, "leek", "x"), (2, "leek", "y")], "id int, text string, name string")
    assert T.search_index(T.build_text_index(same, scratch_dir(spark, "texts")), asked).count() == 0  # in every passage: no weight


def test_build_shuffles_no_terms_of_texts_but_the_postings(spark):
    """Terms are counted and weighed in their row; only repeated ids, and the postings, meet in a shuffle."""
    rows = [(str(i), f"n{i}", f"w{i % 7} w{i % 5} w{i % 5} x{i}") for i in range(300)]
    frame = spark.createDataFrame(rows, "id string, name string, text string").repartition(3)
    repeated = spark.createDataFrame([("7", "n7", "w1 more"), (None, "n", "w1"), (None, "n", "w2")], frame.schema)
    none = frame.limit(0).select("id")
    plan = T._counted(frame.select("id", "text"), none)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange hashpartitioning" not in plan
    for passages in (frame, frame.union(repeated)):
        known = passages.groupBy("id").agg(F.count(F.lit(1)).alias("texts"))
        got = T._counted(passages.select("id", "text"), known.where("texts > 1")).select("id", F.explode(F.arrays_zip("dims", "ns")).alias("e"))
        want = T.term_counts(passages, "id").select("id", "dim", F.col("n").cast("int").alias("n"))
        assert sorted(map(str, got.select("id", "e.dims", "e.ns").collect())) == [
            r.replace("dim=", "dims=").replace("n=", "ns=") for r in sorted(map(str, want.collect()))]
    index = T.build_text_index(frame.union(repeated), scratch_dir(spark, "texts"))
    flat = index.vectors.select("id", "block", F.inline(F.arrays_zip("dims", "weights"))).collect()
    assert sorted((r["id"], r["block"], r["dims"], r["weights"]) for r in flat) == sorted(
        (r["id"], r["block"], r["dim"], r["weight"]) for r in index.postings.collect())
    top = {}
    for r in index.postings.collect():
        top[r["dim"], r["block"]] = max(top.get((r["dim"], r["block"]), 0), r["weight"])
    assert {(r["dim"], r["block"]): r["top"] for r in index.maxima.collect()} == top


@pytest.mark.parametrize("cells", [1, 7, T.CELLS])
def test_few_and_many_queries_give_the_same_hits(spark, monkeypatch, cells):
    texts = [(str(i), f"n{i}", f"w{i % 7} w{i % 11} w{i % 5} x{i // 3}") for i in range(400)]
    index = T.build_text_index(spark.createDataFrame(texts, "id string, name string, text string"), scratch_dir(spark, "texts"))
    asked = spark.createDataFrame([(f"q{i}", f"w{i % 7} x{i} w{i % 5}") for i in range(40)], "query_id string, text string")
    monkeypatch.setattr(T, "CELLS", cells)
    shared = sorted(map(tuple, T.search_index(index, asked).collect()))
    monkeypatch.setattr(T, "MAX_CHOSEN", 0)
    assert shared == sorted(map(tuple, T.search_index(index, asked).collect())) and len(shared) == 200
