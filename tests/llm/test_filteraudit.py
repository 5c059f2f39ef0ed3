"""The filter audit against plain Python, and the subset walk against counting anew."""

import itertools
import re

import numpy as np
from pyspark.sql import functions as F

from platewise.llm import filteraudit
from platewise.llm.filteraudit import filter_audit, gray_states, text_filters


def plain_audit(docs, labels):
    """All rows by filtering document lists, order by order."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    rows = []
    for i, text, part in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "D": bool(re.search("[#$%&*|]", text)),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "E": i is not None and least[text] < i}
        rows.append((i, part or "", fails))
    out = {}
    for part in {p for _, p, _ in rows}:
        mine = [(i, f) for i, p, f in rows if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if f[letter]]
                left = [(i, f) for i, f in left if not f[letter]]
                shapley[letter] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f[letter] for _, f in mine) - len(gone),
                    sum(f[letter] and sum(f.values()) == 1 for _, f in mine), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return out


def _audit(spark, docs, labels):
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr(
        "*", "'clash' as part", "1 as mask", "2 as n", "3 as good", "4 as digest", "5 as id")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'x' as text", "'y' as source")
    rows = filter_audit(frame.repartition(5), known, text_filters(F.col("text"))).collect()
    return {tuple(r)[:3]: list(r)[3:] for r in rows}


def test_audit_equals_plain_python(spark):
    rng = np.random.default_rng(2)
    base = ["", None, "short", "Word " * 60, " ".join(f"w{i}" for i in range(70)), " ".join(f"W{i}" for i in range(70)), "a b # c",
            " ".join(f"w{i}" for i in range(55)) + " 50%", "\t".join(f"x{i % 40}" for i in range(90)), "é" * 30_000, "UP " * 3, " " + "k " * 50]
    docs = [(i, base[rng.integers(len(base))], [None, "", "s", "t", "t", "t"][rng.integers(6)]) for i in range(300)]
    docs += docs[:9] + [(None, base[3], "s"), (None, base[4], None), (5, "another text", "t"), (-4, base[4], "u"), (1000, "lone", "only")]
    labels = [(i, int(rng.integers(2)), int(rng.integers(2))) for i in range(0, 300, 2)] + [(4, 1, None), (6, None, 1), (None, 1, 1), (4, 0, 0), (9999, 1, 1)]
    assert _audit(spark, docs, labels) == plain_audit(docs, labels)


def test_no_rows_and_no_labels(spark):
    assert _audit(spark, [], []) == {}
    docs = [(1, None, None), (2, "", None)]
    assert _audit(spark, docs, []) == plain_audit(docs, [])


def test_walk_equals_counting_anew():
    rng = np.random.default_rng(1)
    cells = rng.integers(0, 50, (7, 16, 3))
    states = gray_states(cells)
    for subset in range(16):
        alive = [m for m in range(16) if m & subset == 0]
        assert (states[:, subset] == cells[:, alive].sum(axis=1)).all()


def test_own_filters(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "a", "x")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = filter_audit(docs, labels, {"P": F.col("text") == "b"}, copies="Q").orderBy("filter_order", "step").collect()
    assert [(r["filter_order"], r["step"], r["kept"], r["removed"], r["shapley"]) for r in rows] == [
        ("PQ", 1, 2, 1, 2), ("PQ", 2, 1, 1, 2), ("QP", 1, 2, 1, 2), ("QP", 2, 1, 1, 2)]
    assert filteraudit.STEP_SCHEMA.count(" long") == 7
