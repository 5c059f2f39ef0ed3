"""Text search over postings: terms are joined with terms, and blocks of passages that cannot be hits are not scored."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window as W

from platewise.operators.dedup import top_per_key
from platewise.operators.joins import fits_broadcast, lookup_join
from platewise.operators.similarity import MAX_QUERIES, SCORE_DECIMALS, TOP_K
from platewise.session import materialize

SPACE = 1 << 20        # dimensions that terms are hashed to; rows hold only those that occur
BLOCK_PASSAGES = 128   # passages of one block, about
FIRST_BLOCKS = 4       # blocks of the highest bounds, whose hits set what the other blocks must reach
MAX_CHOSEN = 1 << 26   # queries times blocks that every task gets as bits: 8 MB; more are joined
CELLS = 1 << 19        # terms, or scores of passages by queries, that a task holds at a time
_NEAR = 10 ** -SCORE_DECIMALS
_VECTORS = "id string, block bigint, dims array<int>, weights array<double>"
_HITS = "query_id string, item_id string, score double"


@dataclass
class TextIndex:
    """``terms``: dim, idf of the passages' terms. ``vectors``: id, block, and by dimension the dims and weights of a passage
    (unit length). ``postings``: the same by term: dim, block, id, weight. ``maxima``: dim, block, highest weight.
    ``passages``: id, name, texts (rows of that id). ``total``: one row with the number of passages."""

    terms: DataFrame
    vectors: DataFrame
    postings: DataFrame
    maxima: DataFrame
    passages: DataFrame
    total: DataFrame


def term_dim(term: Column) -> Column:
    """A term's dimension: the same number in any engine that knows MD5."""
    return F.pmod(F.conv(F.substring(F.md5(term.cast("binary")), 1, 13), 16, 10).cast("bigint"), F.lit(SPACE)).cast("int")


def term_counts(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, dim, n: lower-cased runs of letters, marks and digits of each text. Rows of one key are one text."""
    return df.select(F.col(key).cast("string").alias(key), F.explode(_words(text)).alias("term")).groupBy(
        key, term_dim(F.col("term")).alias("dim")).agg(F.count(F.lit(1)).alias("n"))


def _words(text: str) -> Column:
    return F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def _counted(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """id, dims, ns: the terms of each id by dimension, and how often they occur. The terms of a text are counted in its row;
    only those of the ``repeated`` ids meet in a shuffle."""
    same = lambda a, b: a.eqNullSafe(b)
    alone, several = rows, None
    if not repeated.isEmpty():
        repeated = repeated.select(F.col("id").alias("_id"))
        alone = rows.join(repeated, same(rows["id"], repeated["_id"]), "left_anti")
        several = rows.join(repeated, same(rows["id"], repeated["_id"]), "left_semi")
    found = alone.select("id", F.sort_array(F.transform(_words("text"), term_dim)).alias("all"))
    starts = F.filter(F.transform("all", lambda d, i: F.when((i == 0) | (d != F.get("all", i - 1)), i)), lambda i: i.isNotNull())
    found = found.select("id", "all", starts.alias("starts")).select(
        "id", F.transform("starts", lambda i: F.get("all", i)).alias("dims"),
        F.transform("starts", lambda i, j: F.coalesce(F.get("starts", j + 1), F.size("all")) - i).alias("ns"))
    if several is None:
        return found
    entry = F.struct("dim", F.col("n").cast("int").alias("n"))
    merged = term_counts(several, "id").groupBy("id").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    return found.unionByName(merged.select("id", F.col("entries.dim").alias("dims"), F.col("entries.n").alias("ns")))


def _some_rows(lists: pa.Array) -> list[slice]:
    """Slices of list rows that hold about CELLS values, one row at least."""
    return _pieces(np.asarray(lists.offsets)[1:] - lists.offsets[0].as_py())


def _weighed(counts: DataFrame, terms: DataFrame, blocks: int) -> DataFrame:
    """The passages' vectors out of counts (id, dims, ns): each row by itself, against the terms' rarity in every task."""
    known = terms.toArrow()  # SPACE rows at most
    idf = np.zeros(SPACE)
    idf[np.asarray(known.column("dim"))] = np.asarray(known.column("idf"))
    held = counts.sparkSession.sparkContext.broadcast(idf)

    def weigh(batches):
        idf = held.value
        for batch in batches:
            for rows in _some_rows(batch.column("dims")):
                part = batch.slice(rows.start, rows.stop - rows.start)
                dims, ns = (np.asarray(part.column(c).flatten()) for c in ("dims", "ns"))
                row = np.repeat(np.arange(part.num_rows), np.diff(np.asarray(part.column("dims").offsets)))
                weight = ns * idf[dims]
                kept = weight > 0
                dims, weight, row = dims[kept], weight[kept], row[kept]
                norm = np.sqrt(np.bincount(row, weight * weight, part.num_rows))
                bounds = pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)), pa.int32())
                some = pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("block"), pa.ListArray.from_arrays(bounds, pa.array(dims)),
                     pa.ListArray.from_arrays(bounds, pa.array(weight / norm[row]))], ["id", "block", "dims", "weights"])
                yield some.filter(pa.array(norm > 0))

    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("bigint")
    return counts.where(F.col("id").isNotNull() & (F.size("dims") > 0)).select(
        "id", block.alias("block"), "dims", "ns").mapInArrow(weigh, _VECTORS)


def _unit(weighted: DataFrame, key: str) -> DataFrame:
    """Weights scaled to unit length per key; weights of zero go."""
    norms = weighted.groupBy(key).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    return weighted.where("weight > 0").join(norms, key).select(key, "dim", (F.col("weight") / F.col("norm")).alias("weight"))


def rarity(passages: Column, holding: Column) -> Column:
    return F.log((passages + 1) / (holding + 1))


def build_text_index(passages: DataFrame, path: str, key: str = "id", text: str = "text", name: str = "name") -> TextIndex:
    """Index passages (key, text, name) below ``path`` and read the index back.

    A weight is the term's count times ln((passages + 1) / (passages with it + 1)); a term in every passage weighs nothing
    and has no posting. Null texts are no passages, texts without a term have no postings. A term's postings
    are dealt to blocks of passages, so a frequent term is many rows of bounded weight, not one list. Vectors are made row by
    row: only the postings are shuffled, once.
    """
    spark = passages.sparkSession
    rows = passages.where(F.col(text).isNotNull()).select(
        F.col(key).cast("string").alias("id"), F.col(name).cast("string").alias("name"), F.col(text).alias("text"))
    rows.groupBy("id").agg(F.min("name").alias("name"), F.count(F.lit(1)).alias("texts")).write.mode("overwrite").parquet(f"{path}/passages")
    known = spark.read.parquet(f"{path}/passages")
    known.agg(F.count(F.lit(1)).alias("passages")).write.mode("overwrite").parquet(f"{path}/total")
    total = spark.read.parquet(f"{path}/total")
    counts = materialize(_counted(rows.select("id", "text"), known.where("texts > 1")), "counts")
    holding = counts.select(F.explode("dims").alias("dim")).groupBy("dim").agg(F.count(F.lit(1)).alias("holding"))
    holding.crossJoin(F.broadcast(total)).select("dim", rarity(F.col("passages"), F.col("holding")).alias("idf")).write.mode(
        "overwrite").parquet(f"{path}/terms")
    blocks = max(1, -(-total.first()["passages"] // BLOCK_PASSAGES))
    _weighed(counts, spark.read.parquet(f"{path}/terms"), blocks).write.mode("overwrite").parquet(f"{path}/vectors")
    postings = spark.read.schema(_VECTORS).parquet(f"{path}/vectors").select(
        "id", "block", F.inline(F.arrays_zip(F.col("dims").alias("dim"), F.col("weights").alias("weight")))).select("id", "dim", "weight", "block")
    highest = F.row_number().over(W.partitionBy("dim", "block").orderBy(F.desc("weight"), "id")) == 1
    postings.repartitionByRange("dim", "block").withColumn("highest", highest).write.mode("overwrite").parquet(f"{path}/postings")
    return read_text_index(spark, path)


def read_text_index(spark: SparkSession, path: str) -> TextIndex:
    terms, vectors, postings, passages, total = [
        spark.read.parquet(f"{path}/{name}") for name in ("terms", "vectors", "postings", "passages", "total")]
    maxima = postings.where("highest").select("dim", "block", F.col("weight").alias("top"))
    return TextIndex(terms, vectors, postings.drop("highest"), maxima, passages, total)


def query_terms(index: TextIndex, queries: DataFrame, key: str = "query_id", text: str = "text") -> DataFrame:
    """key, dim, weight of query texts, in the passages' space; a term that no passage has counts in the length."""
    counts = term_counts(queries, key, text)
    unseen = F.coalesce("idf", rarity(F.col("passages"), F.lit(0)))
    weighted = lookup_join(counts, index.terms, "dim", "left", stored=True).crossJoin(F.broadcast(index.total))  # one row
    return _unit(materialize(weighted.select(key, "dim", (F.col("n") * unseen).alias("weight")), "query-weights"), key)


def search_index(index: TextIndex, queries: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k passages of the highest cosine per query (query_id, text): query_id, item_id, name, score, rank.

    Only passages that share a weighted term with the query are hits. A block's bound is the sum of the query's weights
    times the block's highest ones. The blocks of the highest bounds are scored first; of the others only those whose bound
    reaches the k-th score found there. The result is that of scoring every passage; scores are rounded to
    six decimals and equal ones rank by id.
    """
    asked = materialize(query_terms(index, queries).withColumnRenamed("weight", "asked"), "asked")
    bounds = materialize(asked.join(index.maxima, "dim").groupBy("query_id", "block").agg(
        F.sum(F.col("asked") * F.col("top")).alias("bound")), "bounds")
    first = materialize(top_per_key(bounds, ["query_id"], [F.desc("bound"), "block"], FIRST_BLOCKS), "first")
    begun = materialize(_scored(index, asked, first, k), "begun")
    kth = top_per_key(begun, ["query_id"], [F.desc("score"), "item_id"], k, "rank").where(F.col("rank") == k).select(
        "query_id", F.col("score").alias("least"))
    rest = materialize(bounds.join(first.select("query_id", "block"), ["query_id", "block"], "left_anti").join(kth, "query_id", "left").where(
        F.col("least").isNull() | (F.col("bound") >= F.col("least") - 2 * _NEAR)).select("query_id", "block"), "rest")
    found = top_per_key(begun.unionByName(_scored(index, asked, rest, k)), ["query_id"], [F.desc("score"), "item_id"], k, "rank")
    named = lookup_join(index.passages.withColumnRenamed("id", "item_id"), found, "item_id")
    return named.select("query_id", "item_id", "name", "score", "rank")


def _scored(index: TextIndex, asked: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """Scores of the passages in the blocks (query_id, block) that share a term with the query: the k best of each query
    at least. Few queries are held by every task, which reads the passages' vectors; many meet the postings in a join."""
    n_queries = asked.select("query_id").distinct().count()
    n_blocks = index.vectors.agg(F.max("block")).first()[0]
    if n_blocks is not None and n_queries <= MAX_QUERIES and n_queries * (n_blocks + 1) <= MAX_CHOSEN and fits_broadcast(asked):
        return _shared_scores(index, asked, blocks, k, n_blocks + 1)
    wanted = asked.join(blocks.select("query_id", "block"), "query_id")
    pairs = index.postings.join(wanted, ["dim", "block"])
    return pairs.groupBy("query_id", F.col("id").alias("item_id")).agg(
        F.round(F.sum(F.col("asked") * F.col("weight")), SCORE_DECIMALS).alias("score")).where("score > 0")


def _shared_scores(index: TextIndex, asked: DataFrame, blocks: DataFrame, k: int, n_blocks: int) -> DataFrame:
    """Every task scores its own passages with all queries that want their block, and keeps k hits a query."""
    spark = asked.sparkSession
    terms = asked.select("query_id", "dim", "asked").toArrow()  # bounded by the caller
    names, query = np.unique(np.array(terms.column("query_id").to_pylist(), object), return_inverse=True)
    order = np.argsort(np.asarray(terms.column("dim")), kind="stable")
    dims, query, weight = np.asarray(terms.column("dim"))[order], query[order], np.asarray(terms.column("asked"))[order]
    chosen = np.zeros((n_blocks, len(names)), bool)
    number = F.broadcast(spark.createDataFrame([(name, i) for i, name in enumerate(names)], "query_id string, query int"))
    kept = blocks.join(number, "query_id").select("query", "block").toArrow()
    chosen[np.asarray(kept.column("block")), np.asarray(kept.column("query"))] = True
    starts = np.searchsorted(dims, np.arange(SPACE + 1)).astype(np.int32)  # of each dimension's queries
    held = spark.sparkContext.broadcast((names, query.astype(np.int32), weight, starts, np.packbits(chosen, axis=1)))

    def best(query, ids, scores):
        order = np.lexsort((ids, -scores, query))
        query = query[order]
        first = np.arange(len(query)) - np.searchsorted(query, query) < k
        return query[first], ids[order[first]], scores[order[first]]

    def score(batches):
        names, query, weight, starts, bits = held.value
        found = (np.zeros(0, np.int64), np.zeros(0, object), np.zeros(0))
        for batch in batches:
            batch = batch.filter(pa.array(bits.any(axis=1)[np.asarray(batch.column("block"))])) if batch.num_rows else batch
            for rows in _some_rows(batch.column("dims")):
                for at in range(rows.start, rows.stop, max(1, CELLS // len(names))):
                    part = batch.slice(at, min(rows.stop, at + max(1, CELLS // len(names))) - at)
                    n = part.num_rows
                    dims, value = (np.asarray(part.column(c).flatten()) for c in ("dims", "weights"))
                    row = np.repeat(np.arange(n), np.diff(np.asarray(part.column("dims").offsets)))
                    many = starts[dims + 1] - starts[dims]  # queries of each term
                    hit = many > 0
                    dims, value, row, many = dims[hit], value[hit], row[hit], many[hit]
                    ends, total = np.cumsum(many), np.zeros(n * len(names))
                    for rows_ in _pieces(ends):
                        each = np.repeat(np.arange(rows_.start, rows_.stop), many[rows_])
                        of = starts[dims[each]] + np.arange(len(each)) - np.repeat(np.cumsum(many[rows_]) - many[rows_], many[rows_])
                        total += np.bincount(row[each] * len(names) + query[of], value[each] * weight[of], len(total))
                    wanted = np.unpackbits(bits[np.asarray(part.column("block"))], axis=1, count=len(names)).ravel() > 0
                    cell = np.flatnonzero(wanted & (np.round(total, SCORE_DECIMALS) > 0))
                    if len(cell):
                        ids = np.array(part.column("id").to_pylist(), object)
                        scores, of, ids = np.round(total[cell], SCORE_DECIMALS), cell % len(names), ids[cell // len(names)]
                        found = best(*(np.concatenate(both) for both in zip(found, (of, ids, scores))))
        yield pa.RecordBatch.from_arrays(
            [pa.array(names[found[0]].tolist(), pa.string()), pa.array(found[1].tolist(), pa.string()), pa.array(found[2])],
            ["query_id", "item_id", "score"])

    return index.vectors.select("id", "block", "dims", "weights").mapInArrow(score, _HITS)


def _pieces(ends: np.ndarray) -> list[slice]:
    """Slices of items with running totals ``ends`` that add about CELLS each, one item at least."""
    found, first = [], 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + CELLS, "right")))
        found.append(slice(first, last))
        first = last
    return found


def vector_text(weights: DataFrame, key: str) -> DataFrame:
    """One row per key: its number of terms, and ``dim:weight`` in ten-thousandths, by dimension. ``weights`` has a row
    a term (dim, weight), or a row a key (dims, weights), which needs no shuffle."""
    if "dims" in weights.columns:
        listed = F.zip_with("dims", "weights", lambda d, w: F.concat_ws(
            ":", d.cast("string"), F.round(w * 10_000).cast("bigint").cast("string")))
        return weights.select(key, F.size("dims").cast("bigint").alias("terms"), F.array_join(listed, " ").alias("vector"))
    entry = F.struct("dim", F.round(F.col("weight") * 10_000).cast("bigint").alias("weight"))
    listed = F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.concat_ws(":", e["dim"].cast("string"), e["weight"].cast("string")))
    return weights.groupBy(key).agg(F.count(F.lit(1)).alias("terms"), F.array_join(listed, " ").alias("vector"))
