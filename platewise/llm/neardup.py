"""Near-duplicate vectors by collision-counting projections."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from platewise.llm.common import materialize
from platewise.llm.components import connected_components

BLOCK = 512  # vectors of one cell in a block; a task compares two blocks
CELL = 48  # wanted vectors in a cell
WIDTH = 4.0  # width of a cell along a projection, in standard deviations of a limiting pair's difference
RECALL = 0.9995  # wanted share of pairs at the limit that meet in a cell
WINDOWS = 24  # projections of the collision count
REACH = 2.0  # half a window, in the same standard deviations


def _normal_within(x: float) -> float:
    return math.erf(x / math.sqrt(2))


def cell_recall(width: float) -> float:
    """Chance that two points whose projections differ by a standard normal step fall into one cell of this width."""
    return _normal_within(width) - 2 / (width * math.sqrt(2 * math.pi)) * (1 - math.exp(-width * width / 2))


def table_plan(rows: int, width: float = WIDTH, cell: int = CELL, recall: float = RECALL, far: float = 0.2) -> tuple[int, int]:
    """(projections per cell, tables): cells of about ``cell`` of ``rows`` vectors, tables enough for the recall.

    ``far`` is the share of unrelated vectors in one cell of one projection. Projections grow with the
    logarithm of the rows, tables slowly with their number, so work grows little faster than the rows.
    """
    k = max(1, math.ceil(math.log(max(rows, 1) / cell, 1 / far))) if rows > cell else 1
    meet = cell_recall(width) ** k
    return k, max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


def calibrated_count(windows: int = WINDOWS, reach: float = REACH, recall: float = RECALL) -> int:
    """The largest collision count that pairs at the limit reach with at least this chance."""
    p, total = _normal_within(reach), 0.0
    for count in range(windows, 0, -1):
        total += math.comb(windows, count) * p ** count * (1 - p) ** (windows - count)
        if total >= recall:
            return count
    return 1


def _directions(dim: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, count))


def window_counts(a: np.ndarray, b: np.ndarray, reach: float) -> np.ndarray:
    """For each row of ``a`` and of ``b`` (projections, one column each): windows around a's value that hold b's.

    Every projection of b is sorted once; the window of each query is a run of the sorted rows.
    """
    counts = np.zeros((len(a), len(b)), np.uint8)
    for j in range(a.shape[1]):
        order = np.argsort(b[:, j], kind="stable")
        values = b[order, j]
        low = np.searchsorted(values, a[:, j] - reach, "left")
        high = np.searchsorted(values, a[:, j] + reach, "right")
        rank = np.empty(len(b), np.int64)
        rank[order] = np.arange(len(b))
        counts += (rank >= low[:, None]) & (rank < high[:, None])
    return counts


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
        return i != j


def _pair_block(threshold: float, dim_of_seed: int, least: int, reach: float):
    """Task function: one group holds block ``x`` and block ``y`` (the same, on the diagonal) of one cell."""
    def compare(group: pa.Table) -> pa.Table:
        ids = np.asarray(group.column("node"))
        side = np.asarray(group.column("side"))
        weight = np.asarray(group.column("weight"))
        table_no = int(group.column("t")[0].as_py())
        diagonal = group.column("x")[0].as_py() == group.column("y")[0].as_py()
        vectors = group.column("unit").combine_chunks()
        dim = len(vectors[0])
        unit = np.asarray(vectors.flatten()).reshape(len(ids), dim)
        cells = np.asarray(group.column("cells").combine_chunks().flatten()).reshape(len(ids), -1)
        order = np.lexsort((ids, side))
        ids, side, weight, unit, cells = ids[order], side[order], weight[order], unit[order], cells[order]
        left = np.flatnonzero(side == 0)
        right = left if diagonal else np.flatnonzero(side == 1)
        shadows = unit @ _directions(dim, WINDOWS, dim_of_seed)
        counts = window_counts(shadows[left], shadows[right], reach)
        i, j = np.nonzero(counts >= least)
        i, j = left[i], right[j]
        # A pair counts in the first table where it shares a cell.
        new = ~(cells[i, :table_no] == cells[j, :table_no]).any(axis=1)
        if diagonal:
            new &= i < j
        i, j = i[new], j[new]
        # The exact check: cosine in double precision.
        hit = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold if len(i) else np.zeros(0, bool)
        i, j = i[hit], j[hit]
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, i, weight[j])
        np.add.at(links, j, weight[i])
        union, keep = _Union(len(ids)), []
        for n, (p, q) in enumerate(zip(i.tolist(), j.tolist())):
            if union.join(p, q):
                keep.append(n)
        some = np.flatnonzero(links)
        return pa.table({"node": pa.array(np.concatenate([ids[some], ids[i[keep]]]), pa.int64()),
                         "links": pa.array(np.concatenate([links[some], np.zeros(len(keep), np.int64)]), pa.int64()),
                         "other": pa.array([None] * len(some) + ids[j[keep]].tolist(), pa.int64())})
    return compare


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, key: str = "vec_id", vector: str = "embedding",
                    label: str | None = "label", seed: int = 11) -> DataFrame:
    """Link vectors of the same label whose cosine is at least ``threshold``: key, n_links, component_id, kept.

    Equal vectors of a label are one node with a weight, whatever their number. A node is filed in several
    tables under the cell that a few random projections give it (their number follows the rows, see
    ``table_plan``). In a cell, many more projections are sorted; a pair is a candidate when it
    falls into enough of the windows around the query's projections, the count being calibrated so that pairs
    at the threshold reach it with chance RECALL; candidates are verified exactly. A cell of more than
    BLOCK nodes is split, and pairs of its blocks go to different tasks, so no group is unbounded. Tasks
    return link counts and the edges that hold their components together, never all pairs.

    One row per input row, in which: a null label, and vectors that are null, empty, zero or hold null or
    non-finite components, have no links and are their own component. Rows with the same key and vector are
    rows like others (they link; component_id is the smallest key). Vectors of different lengths don't link.
    An empty table gives an empty table. Other columns are not read.
    """
    spark = vectors.sparkSession
    v = F.col(vector).cast("array<double>")
    good = F.col(vector).isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    group = F.coalesce(F.col(label).cast("string"), F.lit("")) if label else F.lit("")
    if label:
        good = good & F.col(label).isNotNull()
    rows = vectors.select(F.col(key).alias("key"), group.alias("label"), F.when(good, v).alias("v"))
    # Scaled first by the largest component, so that squares neither overflow nor vanish.
    largest = F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    rows = rows.withColumn("v", F.when(largest > 0, F.transform("v", lambda x: x / largest)))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    rows = materialize(rows.withColumn("unit", F.transform("v", lambda x: x / norm + 0.0)).drop("v").withColumn(
        "hash", F.when(F.col("unit").isNotNull(), F.sha2(F.concat_ws(",", F.col("unit").cast("array<string>")), 256))),
        "vectors")
    nodes = materialize(rows.where("unit is not null").groupBy("label", "hash").agg(
        F.min("key").alias("least"), F.count(F.lit(1)).alias("weight"), F.first("unit").alias("unit")).withColumn(
        "node", F.monotonically_increasing_id()), "nodes")
    sizes = nodes.groupBy("label", F.size("unit").alias("dim")).count()
    largest_group = sizes.agg(F.max("count")).first()[0] or 0
    step = math.sqrt(max(2 - 2 * threshold, 1e-12))
    k, tables = table_plan(largest_group)
    least, reach = calibrated_count(), REACH * step

    def file_cells(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            units = batch.column("unit")
            lengths = np.asarray(pc.list_value_length(units))
            out = [None] * batch.num_rows
            for dim in np.unique(lengths):
                some = np.flatnonzero(lengths == dim)
                x = np.asarray(units.take(pa.array(some)).flatten()).reshape(len(some), dim)
                grid = np.random.default_rng([seed, 1, int(dim)]).uniform(0, 1, k * tables)
                place = np.floor(x @ _directions(int(dim), k * tables, seed + 1) / (WIDTH * step) + grid).astype(np.int64)
                mult = np.random.default_rng(seed).integers(1, 1 << 62, k) | 1
                cell = (place.reshape(len(some), tables, k) * mult).sum(axis=2) ^ int(dim)
                for r, c in zip(some, cell):
                    out[r] = c
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("node", "label", "weight", "unit")] + [pa.array(out, pa.list_(pa.int64()))],
                ["node", "label", "weight", "unit", "cells"])

    filed = materialize(nodes.select("node", "label", "weight", "unit").mapInArrow(
        file_cells, "node long, label string, weight long, unit array<double>, cells array<long>"), "cells")
    places = filed.select("node", "label", F.posexplode("cells").alias("t", "cell"))
    shared = places.groupBy("label", "t", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = shared.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    spread = filed.select("node", "label", "weight", "unit", "cells", F.posexplode("cells").alias("t", "cell")).join(
        shared, ["label", "t", "cell"]).withColumn("own", mine)
    spread = spread.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "node", "weight", "unit", "cells", "label", "t", "cell", F.least("own", "with").alias("x"),
        F.greatest("own", "with").alias("y"), (F.col("own") > F.col("with")).cast("int").alias("side"))
    found = materialize(spread.groupBy("label", "t", "cell", "x", "y").applyInArrow(
        _pair_block(threshold, seed, least, reach), "node long, links long, other long"), "links")
    names = nodes.select("node", "least", "label", "hash", "weight")
    edges = found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    components = connected_components(edges)
    # The smallest key of each component.
    smallest = names.join(components, "node").groupBy("component").agg(F.min("least").alias("smallest"))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = names.join(counts, "node", "left").join(components, "node", "left").join(smallest, "component", "left").select(
        F.col("label").alias("__label"), F.col("hash").alias("__hash"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("smallest", "least").alias("component_id"))
    out = rows.select("key", "label", "hash").join(
        known, (F.col("label") == F.col("__label")) & (F.col("hash") == F.col("__hash")), "left")
    component = F.coalesce("component_id", "key")
    return out.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), (component == F.col("key")).alias("kept"))
