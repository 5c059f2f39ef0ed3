"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from platewise.llm.common import hash52, literal_rows

MAX_BROADCAST_SOURCES = 10_000
RATE_STEP = 16.0  # a larger rate is the sum of several draws of at most this rate
TERMS = 100  # a draw of rate 16 exceeds 99 with a chance far below 2 ** -52
SALTS = 64


def text_size(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long")


def repetition_rates(docs: DataFrame, weights: dict[str, float], default_weight: float = 0.0,
                     source: str = "source", size: Column | None = None,
                     total: int | None = None) -> tuple[DataFrame, bool]:
    """One row per source of ``docs``: __source, weight, source_size, rate; and whether it is safe to broadcast.

    ``rate`` is the mean number of copies that brings the source to its share of ``total`` (by default
    all sizes together, so that the mix is as large as the input). Weights need not add up to 1.
    Only one number per source is shuffled. Up to MAX_BROADCAST_SOURCES sources come to the driver
    (one more is asked for, to know); more stay a distributed table.
    """
    spark = docs.sparkSession
    per = docs.select(F.col(source).cast("string").alias("__source"),
                      (text_size() if size is None else size).cast("long").alias("size")).groupBy(
        "__source").agg(F.sum("size").alias("source_size"))
    weight = F.lit(float(default_weight))
    if weights:
        known = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))])
        weight = F.coalesce(known[F.col("__source")], weight)
    got = per.limit(MAX_BROADCAST_SOURCES + 1).collect()
    few = len(got) <= MAX_BROADCAST_SOURCES
    per = (literal_rows(spark, got, "__source string, source_size long") if few else per).withColumn("weight", weight)
    sums = per.agg(F.sum("weight").alias("weights"), F.sum("source_size").alias("sizes")).first()
    goal = float(total if total is not None else sums["sizes"] or 0)
    rate = F.col("weight") * goal / (F.lit(float(sums["weights"] or 0)) * F.col("source_size").cast("double"))
    return per.withColumn("rate", rate if sums["weights"] else F.lit(0.0)), few


def poisson_steps(rate: Column) -> Column:
    """floor(2**52 * P(X <= k)) for k = 0, 1, ...: a 52-bit number u draws as many copies as steps lie at or below u."""
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"),
                     F.array(F.floor(F.exp(-rate) * 2.0 ** 52).cast("long")).alias("steps"))

    def add(state: Column, k: Column) -> Column:
        p = state["p"] * rate / k
        return F.struct(p.alias("p"), (state["c"] + p).alias("c"), F.concat(
            state["steps"], F.array(F.floor((state["c"] + p) * 2.0 ** 52).cast("long"))).alias("steps"))

    ks = F.array(*[F.lit(float(k)) for k in range(1, TERMS)])
    return F.aggregate(ks, start, add, lambda state: state["steps"])


def mix_sources(docs: DataFrame, weights: dict[str, float], default_weight: float = 0.0, seed: int = 0,
                doc_id: str = "doc_id", source: str = "source", size: Column | None = None,
                total: int | None = None, shards: int | None = None) -> DataFrame:
    """Repeat each document a Poisson number of times so that sources reach their weights, then shuffle globally.

    A document's count inverts the Poisson distribution of its source's rate at a number seeded by the
    hash of (seed, doc_id): the same document always gets the same count, on any cluster, and no state
    is kept. Adds mix_source, rate, repeats, repeat (1 to repeats), order_key and shard; rows of one
    shard lie together in order_key order, and shards in turn are the shuffled corpus.

    The rates of up to MAX_BROADCAST_SOURCES sources are broadcast (the number is counted first); more are
    joined on (source, salt), so that no source's documents meet in one task.

    Nulls and edge cases: a null source is a source of its own, named by no weight; a source without a
    weight has ``default_weight``; weight 0 or all weights 0 keep nothing of the source. A null or empty
    text has size 1. A null doc_id hashes as the text 'null'. Rows of the same doc_id get the same
    count. An empty table gives an empty table. Input columns with one of the added names are replaced.
    """
    spark = docs.sparkSession
    rates, few = repetition_rates(docs, weights, default_weight, source, size, total)
    rates = rates.withColumn("__draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / RATE_STEP).cast("int")))
    rates = rates.withColumn("__steps", poisson_steps(F.col("rate") / F.col("__draws"))).select(
        "__source", "rate", "__draws", "__steps")
    kept = [c for c in docs.columns if c not in ("mix_source", "rate", "repeats", "repeat", "order_key", "shard")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(source).cast("string").alias("mix_source"),
                       hash52(F.lit(str(seed)), F.col(doc_id)).alias("__u"))
    same = F.col("mix_source").eqNullSafe(F.col("__source"))
    if few:
        rows = rows.join(F.broadcast(rates), same)
    else:
        salted = rates.withColumn("__r_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("__salt", (F.col("__u") % SALTS).cast("int")).join(
            salted, same & (F.col("__salt") == F.col("__r_salt"))).drop("__salt", "__r_salt")
    below = lambda u: F.size(F.filter("__steps", lambda step: step <= u))
    more = F.aggregate(F.sequence(F.lit(2), F.greatest(F.lit(2), F.col("__draws"))), F.lit(0), lambda n, i: n + F.when(
        i <= F.col("__draws"), below(hash52(F.lit(str(seed)), F.col(doc_id), i.cast("string")))).otherwise(0))
    rows = rows.withColumn("repeats", below(F.col("__u")) + F.when(F.col("__draws") > 1, more).otherwise(0))
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    copies = rows.where("repeats > 0").withColumn("repeat", F.explode(F.sequence(F.lit(1), F.col("repeats"))))
    copies = copies.withColumn("order_key", hash52(F.lit(f"order {seed}"), F.col(doc_id), F.col("repeat")))
    copies = copies.withColumn("shard", F.floor(F.col("order_key") / F.lit(math.ceil(2 ** 52 / shards))).cast("int"))
    return copies.drop("__source", "__draws", "__steps", "__u").repartitionById(
        shards, F.col("shard")).sortWithinPartitions("order_key")
