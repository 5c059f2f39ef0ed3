"""Exact top-k by an impact-ordered index, searched a score at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, Window as W

from platewise.llm.common import materialize

VECTORS = 16_384  # vectors of an index block: a walk over segments costs little more for more vectors
QUERIES = 256  # queries of a query block
LEVELS = 16  # levels of quantised impact per dimension
CHECKS = 16  # tests of the stopping proof over all segments
ENOUGH = 0.04  # stop once at most this share of a block may still be in the result


def usable(vector: Column) -> Column:
    """Not null, not empty, and only finite components."""
    v = vector.cast("array<double>")
    return vector.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def integer_vectors(vectors: DataFrame, vector: str, scale: float = 1024.0) -> DataFrame:
    """floor(scale * x) of every component, in double precision."""
    return vectors.where(usable(F.col(vector))).withColumn(vector, F.transform(
        F.col(vector).cast("array<double>"), lambda x: F.floor(x * scale).cast("long")))


class ImpactBlock:
    """Posting segments of one block: for each dimension and level of quantised value, the vectors there."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        low, high = x.min(axis=0), x.max(axis=0)
        self.width = np.maximum(1, (high - low) // LEVELS + 1)
        self.low = low
        level = (x - low) // self.width
        self.segments = []
        for d in range(x.shape[1]):
            order = np.argsort(level[:, d], kind="stable")
            cuts = np.searchsorted(level[order, d], np.arange(LEVELS + 1))
            for n in range(LEVELS):
                if cuts[n] < cuts[n + 1]:
                    # The members' least and largest value bound what the segment adds to a score.
                    some = order[cuts[n]:cuts[n + 1]]
                    values = x[some, d]
                    self.segments.append((d, int(values.min()), int(values.max()), some))
        self.dim = np.array([s[0] for s in self.segments])
        self.least = np.array([s[1] for s in self.segments])
        self.most = np.array([s[2] for s in self.segments])

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Exact best k (scores, ids), ties to smaller ids.

        Segments are taken by descending impact, the most that they can add to a score. What a vector can
        still gain is at most its open dimensions times the next impact; once few vectors can reach the
        k-th best score known, these are scored exactly. That is the proof: no other vector reaches it.
        """
        n = len(self.ids)
        q = query[self.dim]
        impact = np.where(q > 0, q * self.most, q * self.least)
        order = np.argsort(-impact, kind="stable")
        upper = np.zeros(n, np.int64)
        open_ = np.full(n, len(query), np.int64)
        every = max(1, len(order) // CHECKS)
        others = self.ids != own
        possible = np.flatnonzero(others)
        for step, s in enumerate(order.tolist(), 1):
            members = self.segments[s][3]
            upper[members] += impact[s]
            open_[members] -= 1
            if step % every == 0 and step < len(order) and step * 2 > len(order):
                bound = upper + open_ * int(impact[order[step]])
                leaders = np.flatnonzero(others)
                if len(leaders) > 2 * k:
                    leaders = leaders[np.argpartition(-bound[leaders], 2 * k)[:2 * k]]
                scores = self.x[leaders] @ query
                if len(scores) < k:
                    break
                floor = np.partition(scores, len(scores) - k)[len(scores) - k]
                possible = np.flatnonzero(others & (bound >= floor))
                if len(possible) <= max(4 * k, ENOUGH * n):
                    break
        scores = self.x[possible] @ query
        best = np.lexsort((self.ids[possible], -scores))[:k]
        return scores[best], self.ids[possible][best]


def _search_blocks(k: int):
    def search(group: pa.Table) -> pa.Table:
        is_query = np.asarray(group.column("is_query").combine_chunks().to_numpy(zero_copy_only=False), dtype=bool)
        ids = np.asarray(group.column("id"))
        lists = group.column("v").combine_chunks()
        x = np.asarray(lists.flatten(), dtype=np.int64).reshape(len(ids), -1)
        query_ids, out, scores, own = [], [], [], np.flatnonzero(is_query)
        rows = np.flatnonzero(~is_query)
        if len(rows) and len(own):
            block = ImpactBlock(ids[rows], x[rows])
            for i in own:
                s, found = block.search(x[i], ids[i], k)
                query_ids.append(np.full(len(s), ids[i]))
                out.append(found)
                scores.append(s)
        joined = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64())
        return pa.table({"query_id": joined(query_ids), "id": joined(out), "score": joined(scores)})
    return search


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k rows of ``vectors`` with the highest inner product with each row of ``queries``, exactly.

    Both hold ``key`` (long) and ``vector`` (array<long>). Vectors are filed in blocks of about VECTORS
    rows, each with its own impact-ordered index; queries come in blocks of about QUERIES, and each pair of a
    query block and an index block is one task group. Each group returns k rows a query, and the best k of all
    follow from a window over a query's k rows per block, cut in the map tasks first. A query's own key is no
    candidate; ties go to the smaller key. Rows with a null key or vector, and empty vectors, take no part; vectors of
    another length than the query's are no candidates; repeated rows appear repeatedly. Result: query_id, rank,
    key, score. Empty tables give an empty result. Other columns aren't read.
    """
    part = lambda frame: frame.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).where(
        "id is not null and v is not null").where(F.size("v") > 0).withColumn("dim", F.size("v"))
    rows = materialize(part(vectors).withColumn("row", F.monotonically_increasing_id()), "topk-vectors")
    asked = materialize(part(queries).distinct(), "topk-queries")
    n_rows, n_queries = rows.count(), asked.count()
    row_blocks, query_blocks = max(1, -(-n_rows // VECTORS)), max(1, -(-n_queries // QUERIES))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    index = rows.select("id", "v", "dim", F.lit(False).alias("is_query"),
                        F.pmod(F.xxhash64("id", "row"), F.lit(row_blocks)).cast("int").alias("block"), every(query_blocks).alias("of"))
    wanted = asked.select("id", "v", "dim", F.lit(True).alias("is_query"), every(row_blocks).alias("block"),
                          F.pmod(F.xxhash64("id", "v"), F.lit(query_blocks)).cast("int").alias("of"))
    found = index.unionByName(wanted).groupBy("dim", "block", "of").applyInArrow(
        _search_blocks(k), "query_id long, id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(key), "score")
