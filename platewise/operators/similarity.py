"""Embedding of menu texts and cosine search over vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import HashingTF, IDF, BucketedRandomProjectionLSH, Normalizer, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from platewise.operators.dedup import top_per_key

DIMENSION = 1024
TOP_K = 5
SCORE_DECIMALS = 6
MAX_QUERIES = 4096      # queries that every task gets as a whole
QUERIES_AT_ONCE = 256   # rows of one product, so that its size is bounded by the batch
VECTORS_PER_BLOCK = 32_768
_HIT_SCHEMA = "query_id string, item_id string, name string, score double"


def fit_embedder(passages: DataFrame, text: str = "text", dimension: int = DIMENSION) -> PipelineModel:
    """Hashed term weights, scaled by rarity and to unit length; fitted on the passages."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"[^\p{L}\p{M}\p{N}]+", toLowercase=True),
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dimension),
        IDF(inputCol="_counts", outputCol="_weights"),
        Normalizer(inputCol="_weights", outputCol="_unit"),
    ]).fit(passages.where(F.col(text).isNotNull()))


def embed(model: PipelineModel, df: DataFrame, text: str = "text") -> DataFrame:
    """Add the vector of a text; passages and queries go through the same fitted model."""
    filled = df.withColumn(text, F.coalesce(F.col(text), F.lit("")))
    return (model.transform(filled).withColumn("vector", vector_to_array("_unit", "float32"))
            .select(*df.columns, "vector"))


def embed_with(df: DataFrame, embedder: Callable[[pd.Series], pd.Series], text: str = "text") -> DataFrame:
    """Add vectors of a caller's embedding model, called with one batch of texts at a time."""
    vectorise = F.pandas_udf(embedder, "array<float>")
    return df.withColumn("vector", vectorise(F.coalesce(F.col(text), F.lit(""))))


def vector_records(df: DataFrame, key: str, vector: str, name: str) -> DataFrame:
    """Vector records: text id, vector, metadata with the name."""
    return df.select(F.col(key).cast("string").alias("id"), F.col(vector).cast("array<float>").alias("vector"),
                     F.struct(F.col(name).cast("string").alias("name")).alias("metadata"))


def centroids(records: DataFrame) -> DataFrame:
    """The mean vector per metadata name: one query for each kind of menu."""
    mean = Summarizer.mean(array_to_vector(F.col("vector").cast("array<double>")))
    return (records.groupBy(F.col("metadata.name").alias("query_id")).agg(mean.alias("_mean"))
            .select("query_id", vector_to_array("_mean").alias("vector")))


def matrix_of(column) -> np.ndarray:
    """A list column as a matrix, one row per list; lists of unequal length are an error."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.min_max(pc.list_value_length(column))
    if sizes["min"] != sizes["max"]:
        raise ValueError(f"vectors of unequal length: {sizes['min']} and {sizes['max']}")
    return np.array(column.flatten()).reshape(len(column), -1 if len(column) else 0)


def _with_vector(rows):
    """Rows that have a vector. Asked here and not in a filter, which would compute the vectors twice."""
    return rows.filter(rows.column("vector").is_valid())


def _text(column) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=object)


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms == 0, 1, norms)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k best scores, equal scores in id order."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        kept = np.flatnonzero(scores >= floor)
    else:
        kept = np.arange(len(scores))
    return kept[np.lexsort((ids[kept], -scores[kept]))][:k]


def _block_hits(vectors, ids, names, codes, queries, query_codes, k):
    """Best rows of one block of unit vectors for every query: lists of row index and score."""
    for q in range(len(queries)):
        if codes is None:
            if q % QUERIES_AT_ONCE == 0:
                product = np.round(queries[q:q + QUERIES_AT_ONCE] @ vectors.T, SCORE_DECIMALS)
            rows, scores = np.arange(len(ids)), product[q % QUERIES_AT_ONCE]
        else:
            rows = np.flatnonzero((codes == query_codes[q]).any(axis=1))
            scores = np.round(vectors[rows] @ queries[q], SCORE_DECIMALS)
        best = _best(scores, ids[rows], k)
        yield q, ids[rows[best]], names[rows[best]], scores[best]


def _join_hits(parts: list, k: int) -> tuple | None:
    """Hits of several blocks, cut to the k best per query: parallel arrays query, id, name, score."""
    if not parts:
        return None
    query, ids, names, scores = (np.concatenate(column) for column in zip(*parts))
    order = np.lexsort((ids, -scores, query))
    query = query[order]
    place = np.arange(len(query)) - np.searchsorted(query, query, side="left")
    kept = order[place < k]
    return query[place < k], ids[kept], names[kept], scores[kept]


def _hits_of(vectors, ids, names, codes, queries, query_codes, k) -> tuple | None:
    found = _block_hits(vectors, ids, names, codes, queries, query_codes, k)
    return _join_hits([(np.full(len(i), q), i, n, s) for q, i, n, s in found if len(i)], k)


def _hits_table(query_ids: np.ndarray, hits: tuple | None) -> pa.Table:
    query, ids, names, scores = hits if hits else ([], [], [], [])
    return pa.table({
        "query_id": pa.array(query_ids[query].tolist() if len(query) else [], pa.string()),
        "item_id": pa.array(list(ids), pa.string()), "name": pa.array(list(names), pa.string()),
        "score": pa.array(scores, pa.float64())})


def _shared_queries_search(records: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Every task scans its own vectors against the shared query matrix and emits k rows per query."""
    rows = queries.collect()  # at most MAX_QUERIES, checked by the caller
    if not rows:
        return records.sparkSession.createDataFrame([], _HIT_SCHEMA)
    probes = [r["codes"] for r in rows]
    shared = records.sparkSession.sparkContext.broadcast((
        np.array([r["query_id"] for r in rows], dtype=object),
        unit_rows(np.array([r["vector"] for r in rows], dtype=np.float64)),
        np.array(probes) if probes[0] else None))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, matrix, query_codes = shared.value
        best = None
        for batch in batches:
            batch = _with_vector(batch)
            if batch.num_rows:
                hits = _hits_of(unit_rows(matrix_of(batch.column("vector")).astype(np.float64)),
                                _text(batch.column("id")), _text(batch.column("name")),
                                matrix_of(batch.column("codes")) if query_codes is not None else None,
                                matrix, query_codes, k)
                best = _join_hits([h for h in (best, hits) if h], k)
        yield from _hits_table(query_ids, best).to_batches()

    return records.mapInArrow(scan, _HIT_SCHEMA)


def _block_search(records: DataFrame, queries: DataFrame, k: int, query_blocks: int, vector_blocks: int) -> DataFrame:
    """Many queries: vectors and queries are cut into blocks, each pair of blocks is one task's work."""
    def block(column: str, blocks: int):
        return F.pmod(F.xxhash64(column), F.lit(blocks)).cast("bigint")

    def every(blocks: int):
        return F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))

    left = (records.withColumn("vb", block("id", vector_blocks))
            .withColumn("qb", F.explode(every(query_blocks))))
    right = (queries.withColumn("qb", block("query_id", query_blocks))
             .withColumn("vb", F.explode(every(vector_blocks))))

    def product(vectors: pa.Table, asked: pa.Table) -> pa.Table:
        query_ids, vectors = _text(asked.column("query_id")), _with_vector(vectors)
        if not vectors.num_rows or not asked.num_rows:
            return _hits_table(query_ids, None)
        probes = matrix_of(asked.column("codes"))
        coded = probes.shape[1] > 0
        return _hits_table(query_ids, _hits_of(
            unit_rows(matrix_of(vectors.column("vector")).astype(np.float64)),
            _text(vectors.column("id")), _text(vectors.column("name")),
            matrix_of(vectors.column("codes")) if coded else None,
            unit_rows(matrix_of(asked.column("vector"))), probes if coded else None, k))

    return (left.groupBy("vb", "qb").cogroup(right.groupBy("vb", "qb"))
            .applyInArrow(product, _HIT_SCHEMA))


def knn(records: DataFrame, queries: DataFrame, k: int = TOP_K, max_queries: int = MAX_QUERIES,
        vectors_per_block: int = VECTORS_PER_BLOCK) -> DataFrame:
    """The k records with the highest cosine per query: exact, or among equal ``codes`` when both sides
    carry that column. Scores are rounded to six decimals; equal scores rank by id."""
    coded = "codes" in records.columns and "codes" in queries.columns
    codes = F.col("codes") if coded else F.array().cast("array<int>").alias("codes")
    slim = records.select("id", F.col("metadata.name").alias("name"), "vector", codes)
    asked = (queries.where(F.col("vector").isNotNull())
             .select(F.col("query_id").cast("string").alias("query_id"),
                     F.col("vector").cast("array<double>").alias("vector"), codes))
    n_queries = asked.count()
    if n_queries <= max_queries:
        hits = _shared_queries_search(slim, asked, k)
    else:
        # A block may come out above its mean size, so blocks are planned at half of the bound.
        query_blocks = -(-2 * n_queries // max_queries)
        vector_blocks = max(1, -(-2 * slim.count() // vectors_per_block))
        hits = _block_search(slim, asked, k, query_blocks, vector_blocks)
    return top_per_key(hits, ["query_id"], [F.desc("score"), "item_id"], k, "rank")


def lsh_codes(records: DataFrame, queries: DataFrame, tables: int = 8, bucket: float = 0.5,
              seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """Add random-projection bucket numbers to both sides; near vectors share some of them."""
    def unit(df: DataFrame) -> DataFrame:
        return df.withColumn("_unit", array_to_vector(F.col("vector").cast("array<double>")))

    scaled = Normalizer(inputCol="_unit", outputCol="_scaled")
    model = BucketedRandomProjectionLSH(
        inputCol="_scaled", outputCol="_hashes", numHashTables=tables, bucketLength=bucket, seed=seed,
    ).fit(scaled.transform(unit(records)))

    def coded(df: DataFrame) -> DataFrame:
        hashed = model.transform(scaled.transform(unit(df)))
        numbers = F.transform("_hashes", lambda h: vector_to_array(h)[0].cast("int"))
        return hashed.withColumn("codes", numbers).select(*df.columns, "codes")

    return coded(records), coded(queries)


def knn_lsh(records: DataFrame, queries: DataFrame, k: int = TOP_K, **settings) -> DataFrame:
    """Approximate search: only records that share a bucket with the query are scored."""
    coded_records, coded_queries = lsh_codes(records, queries, **settings)
    return knn(coded_records, coded_queries, k)
