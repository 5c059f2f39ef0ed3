"""The queries opN_<name>: each operator on its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from platewise.llm import (
    bpe, dialogue, filteraudit, jaccard, langid, mixing, neardup, pieces, quality, secrets, sharding, substrings, topk)
from platewise.llm.common import crc_of, scratch_dir, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

MIX_WEIGHTS = {"src0": 4.0, "src1": 2.0, "src2": 0.5}
MIX_OTHERS = 1.0
MIX_SEED = 17


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """The mixed and shuffled corpus: one row per copy of a document."""
    mixed = mixing.mix_sources(table(spark, folder, "documents"), MIX_WEIGHTS, MIX_OTHERS, MIX_SEED)
    return mixed.select("doc_id", "text", "lang", "source", "n_chars", "repeats", "repeat", "order_key")


def metadata_dims() -> dict:
    return {"length": F.log2(mixing.text_size().cast("double")), "source": sharding.text_key(F.col("source")),
            "lang": sharding.text_key(F.col("lang"))}


@query
def op2_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    shards = sharding.kd_shards(table(spark, folder, "documents"), metadata_dims(), leaves=8)
    return shards.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query
def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_classes(table(spark, folder, "documents"), k=3, percent=90)


@query
def op4_top_k(spark: SparkSession, folder: str) -> DataFrame:
    rows = topk.integer_vectors(table(spark, folder, "embeddings").select("vec_id", "embedding"), "embedding")
    return topk.top_k(rows, rows.where("vec_id % 100 = 0"), k=10).select("query_id", "rank", "vec_id", "score")


@query
def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.where(crc_of(F.col("doc_id")) % 4 != 2))
    return langid.identify(docs, model).select(
        "doc_id", (crc_of(F.col("doc_id")) % 4 == 2).alias("held_out"), "lang_pred", "score", "accepted")


@query
def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    stats = quality.with_statistics(table(spark, folder, "documents"))
    labels = table(spark, folder, "labels").where(crc_of(F.col("doc_id")) % 5 != 0)
    scored = quality.score(stats, quality.train(stats, labels))
    return scored.select("doc_id", (crc_of(F.col("doc_id")) % 5 == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op7_repeats(spark: SparkSession, folder: str) -> DataFrame:
    out = substrings.remove_repeats(table(spark, folder, "documents"), window=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@query
def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = bpe.Tokenizer(spark, VOCABULARY)
    docs = table(spark, folder, "documents").select("doc_id", tokenizer.round_trip(F.col("text")).alias("coded"))
    docs = docs.select("doc_id", "coded.ids", F.col("coded.text").alias("decoded"))
    digest = lambda column: F.sha2(column.cast("binary"), 256)
    return docs.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       digest(F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("ids_sha256"),
                       digest(F.col("decoded")).alias("decoded_sha256"))


@query
def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, folder, "documents").select("doc_id", "text"), scratch_dir(spark, "ledger"))
    base = tuple(r[0] for r in secrets.BASE_RULES)
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(kind) for kind in base],
                        F.sha2(secrets.span_text(F.col("secrets"), base).cast("binary"), 256).alias("base_sha256"),
                        secrets.span_text(F.col("secrets")).alias("spans"))


@query
def op10_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "embeddings"), threshold=0.98)


@query
def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return filteraudit.filter_audit(docs, labels, filteraudit.text_filters(F.col("text")), copies="E")


PIECES = public_tokenizers.path("piece_bpe_32k.model")


@query
def op12_pieces(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = pieces.PieceTokenizer(spark, PIECES)
    docs = table(spark, folder, "documents").select("doc_id", "text").withColumn("ids", tokenizer.encode(F.col("text")))
    docs = docs.withColumn("decoded", tokenizer.decode(F.col("ids")))
    return docs.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op13_dialogue_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    found = dialogue.repair(dialogue.damaged(turns))
    digests = dialogue.repaired_digests(found)
    known = turns.select(F.col("conv_id").alias("__conv")).distinct()
    same = F.col("__conv").eqNullSafe(F.col("conv_id"))
    out = known.join(dialogue.audits(found), same, "left").drop("conv_id").join(digests, same, "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(F.col("__conv").alias("conv_id"), *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counts],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
