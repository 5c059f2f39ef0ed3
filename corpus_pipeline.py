"""From raw documents to mixed, tokenized training data, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from platewise.llm import bpe, jaccard, langid, mixing, secrets
from platewise.llm.common import materialize, scratch_dir, table

MIX_WEIGHTS = {"src0": 4.0, "src1": 2.0, "src2": 0.5}
MIX_OTHERS = 1.0
MIX_SEED = 17
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model, trained on the labelled ones, accepts."""
    model = langid.train(docs)
    return langid.identify(docs, model).where("accepted").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates (five words, similarity 0.8) the document with the smallest id."""
    return jaccard.keep_one(docs, k=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts become marks; all documents stay."""
    found = secrets.redact(secrets.scan_secrets(docs, scratch_dir(spark, "ledger")))
    return found.withColumn("n_chars", F.when(F.size("secrets") > 0, F.length("text")).otherwise(F.col("n_chars"))).select(
        *docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources reach their weights, in a global random order."""
    return mixing.mix_sources(docs, MIX_WEIGHTS, MIX_OTHERS, MIX_SEED).select(*docs.columns)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether decoding them gives the text back."""
    tokenizer = bpe.Tokenizer(spark, VOCABULARY)
    rows = docs.select("doc_id", "source", "lang", "text").withColumn("coded", tokenizer.round_trip(F.col("text")))
    same = F.col("coded.text") == F.coalesce(F.col("text"), F.lit(""))
    return rows.select(
        "doc_id", "source", "lang", "coded.ids", F.size("coded.ids").cast("long").alias("n_tokens"), same.alias("exact"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id), ("near_duplicates", near_duplicates), ("secret_scan", secret_scan),
    ("source_mix", source_mix), ("bpe_tokens", bpe_tokens)]

#: The learned model, the backtracking encoder and its vocabulary have no SQL; tests hold brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again by the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
