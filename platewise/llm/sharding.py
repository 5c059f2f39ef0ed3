"""K-d tree sharding: split at weighted medians along the widest metadata dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window as W

from platewise.llm.common import crc_of, hash52, literal_rows, materialize
from platewise.llm.mixing import text_size

BINS = 1024  # bins of one pass over a dimension
FEW = 10_000  # a bin of at most this many rows is cut by a window
MAX_LEAVES = 1 << 20  # rows of the tree, which live on the driver
CHUNK = 8192  # rows that one window numbers
STORE_EVERY = 4  # levels between two written copies of the light rows
KEYS = ("k0", "k1", "k2", "k3")


def text_key(column: Column) -> Column:
    """The first six bytes of a text as a number: keeps the order of texts up to there."""
    head = F.substring(F.coalesce(column.cast("string"), F.lit("")).cast("binary"), 1, 6)
    return F.conv(F.rpad(F.hex(head), 12, "0"), 16, 10).cast("double")


def _frame(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    names = [c.split()[0] for c in schema.split(",")]
    return literal_rows(spark, [tuple(r[n] for n in names) for r in rows], schema)


def _not_after(cut: list[str]) -> Column:
    """(k0, k1, k2, k3) <= (c0, c1, c2, c3), compared in turn."""
    test = F.col(KEYS[-1]) <= F.col(cut[-1])
    for key, c in list(zip(KEYS, cut))[-2::-1]:
        test = (F.col(key) < F.col(c)) | ((F.col(key) == F.col(c)) & test)
    return test


def _find_cuts(spark: SparkSession, rows: DataFrame, nodes: list[dict]) -> list[dict]:
    """The last row (its keys c0..c3) of each node's left side.

    ``nodes``: node, goal (bytes wanted left). The rows' order is (k0, k1, k2, k3). A pass narrows each
    node to the bin in which the running sum of bytes reaches the goal; values that are all equal there
    pass on to the next key, and a bin of few rows is cut exactly by a window over just these rows.
    """
    open_, done = [n | {"at": 0, "lo": None, "hi": None, "below": 0, "e0": 0.0, "e1": 0.0, "e2": 0.0, "n": None}
                   for n in nodes], []
    schema = "node int, goal double, at int, lo double, hi double, below long, e0 double, e1 double, e2 double"
    while open_:
        small = [n for n in open_ if n["n"] is not None and n["n"] <= FEW]
        wide = [n for n in open_ if n["n"] is None or n["n"] > FEW]
        key = F.when(F.col("at") == 0, F.col("k0"))
        equal = F.lit(True)
        for i, k in enumerate(KEYS[1:], 1):
            key = key.when(F.col("at") == i, F.col(k))
            equal = equal & ((F.col("at") < i) | (F.col(KEYS[i - 1]) == F.col(f"e{i - 1}")))
        inside = equal & (F.col("lo").isNull() | key.between(F.col("lo"), F.col("hi")))
        if small:
            # Bounded groups: at most FEW rows of a node are left.
            order = W.partitionBy("node").orderBy(*KEYS)
            run = rows.join(F.broadcast(_frame(spark, small, schema)), "node").where(inside).select(
                "node", "goal", "size", *KEYS, (F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0))
                                               + F.col("below")).alias("upto"))
            # The cut nearest to the goal: before or after the row that crosses it.
            picked = run.withColumn("off", F.abs(F.col("upto") - F.col("goal"))).groupBy("node").agg(
                F.min_by(F.struct(*KEYS), F.struct("off", *KEYS)).alias("cut"))
            done += [{"node": r["node"], **{f"c{i}": r["cut"][k] for i, k in enumerate(KEYS)}} for r in picked.collect()]
        if not wide:
            break
        here = rows.join(F.broadcast(_frame(spark, wide, schema)), "node").where(inside).withColumn("key", key)
        if any(n["lo"] is None for n in wide):
            ends = {r["node"]: r for r in here.groupBy("node").agg(
                F.min("key").alias("lo"), F.max("key").alias("hi"), F.count(F.lit(1)).alias("n")).collect()}
            open_ = [n | {"lo": ends[n["node"]]["lo"], "hi": ends[n["node"]]["hi"], "n": ends[n["node"]]["n"]} for n in wide]
            open_ = [_pass_on(n) for n in open_]
            continue
        width = F.col("hi") - F.col("lo")
        place = F.least(F.lit(BINS - 1), F.floor((F.col("key") - F.col("lo")) / width * BINS).cast("int"))
        bins = here.groupBy("node", "goal", "below", place.alias("bin")).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        upto = F.sum("size").over(W.partitionBy("node").orderBy("bin").rowsBetween(W.unboundedPreceding, 0)) + F.col("below")
        found = bins.withColumn("upto", upto).where("upto >= goal").groupBy("node").agg(
            F.min_by(F.struct("size", "n", "lo", "hi", "upto"), "bin").alias("b")).collect()
        crossed = {r["node"]: r["b"] for r in found}
        open_ = []
        for n in wide:
            b = crossed[n["node"]]
            open_.append(_pass_on(n | {"lo": b["lo"], "hi": b["hi"], "n": b["n"], "below": b["upto"] - b["size"]}))
    return done


def _pass_on(n: dict) -> dict:
    """All values of the bin equal: fix this key and go on with the next one."""
    if n["lo"] == n["hi"] and n["at"] < len(KEYS) - 1 and n["n"] > FEW:
        return n | {f"e{n['at']}": n["lo"], "at": n["at"] + 1, "lo": None, "hi": None}
    return n


def kd_shards(docs: DataFrame, dims: dict[str, Column], target_bytes: int | None = None, leaves: int | None = None,
              doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Put every row of ``docs`` into shards of near equal bytes: doc_id, size, text_crc32, shard, slot.

    A node that is to become n shards is split where n // 2 of n parts of its bytes lie, along the
    dimension that is widest in it (its range there over its range in all rows), until each leaf is one
    shard; ``target_bytes`` asks for as many shards as bring leaves down to that size, ``leaves`` for a
    number. Rows with the same value follow each other by (text CRC, hash of doc_id, row), so that one
    value, or one text with many copies, is divided like any other and equal texts part at cuts only.

    Only light rows (ids, sizes, dimensions) are written and scanned; a level costs a few aggregates
    over them, without a shuffle of the rows. The tree, bounded by MAX_LEAVES, is all the driver holds.
    Slots count from 0 in each shard without gaps: windows number at most CHUNK rows of one shard,
    and sums of the chunks' counts shift them.

    Nulls and edge cases: a null text has size 1 and the CRC of empty text; null dimension values count
    as 0; a null doc_id stays null and hashes as 'null'; repeated rows are separate rows; fewer rows than
    shards leave shards empty; an empty table gives an empty table. ``docs`` columns of other names
    are not read.
    """
    spark = docs.sparkSession
    numbers = [F.coalesce(c.cast("double"), F.lit(0.0)) for c in dims.values()]
    numbers = [F.when(F.isnan(c), 0.0).otherwise(c) for c in numbers]
    light = materialize(docs.select(
        F.col(doc_id).alias("doc_id"), text_size(text).alias("size"), crc_of(F.col(text)).alias("text_crc32"),
        F.array(*numbers).alias("dims"), hash52(F.col(doc_id)).cast("double").alias("k2"),
        F.monotonically_increasing_id().alias("row")), "kd-rows")
    light = light.withColumn("k1", F.col("text_crc32").cast("double")).withColumn("k3", F.col("row").cast("double"))

    def summary(rows: DataFrame) -> dict[int, dict]:
        ends = [x for i in range(len(numbers)) for x in (
            F.min(F.col("dims")[i]).alias(f"lo{i}"), F.max(F.col("dims")[i]).alias(f"hi{i}"))]
        found = rows.groupBy("node").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"), *ends).collect()
        return {r["node"]: r.asDict() for r in found}

    rows = light.withColumn("node", F.lit(1))
    stats = summary(rows)
    if not stats:
        return light.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    total = stats[1]["size"]
    leaves = leaves or max(1, -(-total // target_bytes))
    if leaves > MAX_LEAVES:
        raise ValueError(f"{leaves} shards are more than MAX_LEAVES; ask for larger ones")
    range_of = [max(stats[1][f"hi{i}"] - stats[1][f"lo{i}"], 1e-300) for i in range(len(numbers))]
    todo, shard_of, level = {1: (leaves, 0)}, {}, 0  # node: shards below it, the first of them
    while todo:
        for node, (parts, first) in list(todo.items()):
            if parts == 1 or stats.get(node, {"n": 0})["n"] <= 1:
                shard_of[node] = first
                del todo[node]
        if not todo:
            break
        asked = []
        for node, (parts, _) in todo.items():
            s = stats[node]
            wide = max(range(len(range_of)), key=lambda i: ((s[f"hi{i}"] - s[f"lo{i}"]) / range_of[i], -i))
            asked.append({"node": node, "dim": wide, "goal": s["size"] * (parts // 2) / parts})
        dim = F.broadcast(_frame(spark, asked, "node int, dim int"))
        keyed = rows.join(dim, "node").withColumn("k0", F.element_at("dims", F.col("dim") + 1))
        cuts = _find_cuts(spark, keyed, asked)
        found = {c["node"]: c for c in cuts}
        cut_frame = F.broadcast(_frame(spark, [a | found[a["node"]] for a in asked],
                                       "node int, dim int, c0 double, c1 double, c2 double, c3 double"))
        base = [c for c in rows.columns if c != "node"]
        left = _not_after(["c0", "c1", "c2", "c3"])
        rows = rows.join(cut_frame, "node", "left").withColumn("k0", F.element_at("dims", F.col("dim") + 1)).select(
            *base, F.when(F.col("dim").isNull(), F.col("node")).when(left, F.col("node") * 2).otherwise(
                F.col("node") * 2 + 1).alias("node"))
        level += 1
        if level % STORE_EVERY == 0:
            rows = materialize(rows, "kd-level")
        stats = summary(rows)
        todo = {child: place for node, (parts, first) in todo.items() for child, place in (
            (2 * node, (parts // 2, first)), (2 * node + 1, (parts - parts // 2, first + parts // 2)))}
    names = _frame(spark, [{"node": n, "shard": s} for n, s in shard_of.items()], "node int, shard int")
    rows = rows.join(F.broadcast(names), "node").withColumn("chunk", F.floor(F.col("row") / CHUNK))
    counts = rows.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("n"))
    return number_chunks(rows, counts).select("doc_id", "size", "text_crc32", "shard", "slot")


def number_chunks(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Gapless slots per shard from windows over (shard, chunk), at most CHUNK rows each.

    Chunk counts are summed in two steps (blocks of chunks, then chunks of a block), so that no window
    holds more than about the square root of a shard's chunks times CHUNK.
    """
    block = F.floor(F.col("chunk") / 4096)
    blocks = counts.groupBy("shard", block.alias("block")).agg(F.sum("n").alias("n"))
    up = lambda *keys: W.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(W.unboundedPreceding, -1)
    before_block = blocks.select("shard", "block", F.coalesce(F.sum("n").over(up("shard", "block")), F.lit(0)).alias("b0"))
    before = counts.withColumn("block", block).withColumn(
        "c0", F.coalesce(F.sum("n").over(up("shard", "block", "chunk")), F.lit(0))).join(
        before_block, ["shard", "block"]).select("shard", "chunk", (F.col("b0") + F.col("c0")).alias("before"))
    place = F.row_number().over(W.partitionBy("shard", "chunk").orderBy("row")) - 1
    return rows.withColumn("place", place).join(before, ["shard", "chunk"]).withColumn(
        "slot", (F.col("place") + F.col("before")).cast("long"))
