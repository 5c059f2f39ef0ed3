"""Filter interaction audit: what each filter removes in every order, from one walk over all subsets of filters."""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from platewise.llm.common import discard, materialize

MEASURES = ("docs", "good", "toxic")
PARTS_AT_ONCE = 500  # parts whose rows are made at a time


def text_filters(text: Column) -> dict[str, Column]:
    """True where the text fails: A few words, B repeated words, C capitals, D signs. A null text is empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    count = lambda c: F.size(c).cast("long")
    points = F.length(text).cast("long")
    capitals = points - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": count(words) < 50,
        "B": 100 * count(F.array_distinct(words)) < 65 * count(words),
        "C": 100 * capitals > 5 * points,
        "D": text.rlike("[#$%&*|]"),
    }


def filter_cells(docs: DataFrame, labels: DataFrame, filters: dict[str, Column], text: str = "text",
                 doc_id: str = "doc_id", part: str = "source") -> DataFrame:
    """Per part the documents of each mask cell: part, docs, good, toxic (arrays of 2^n longs, written once).

    Bit i of a cell's number says that its documents fail filter i; the last bit is the copy filter: another row of the whole
    table has the same text and a smaller doc_id, removed or not. Texts are compared by SHA-256. Copies of one doc_id
    don't fail it for each other; a null doc_id neither fails it nor makes others fail. A null text is empty, a null
    part the empty string. ``labels`` (doc_id, quality, toxic) may repeat a doc_id: one row with 1 is enough.

    Texts don't travel: a document's digest and mask are joined with its labels, then counted per digest
    before the copies of a digest meet, so a text that a third of all rows share is a few rows by then.
    """
    mask = sum((F.coalesce(f.cast("int"), F.lit(0)) * (1 << i) for i, f in enumerate(filters.values())), F.lit(0))
    rows = docs.select(
        F.col(doc_id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), mask.alias("mask"),
        F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)).alias("digest"))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("known")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    flag = lambda name: F.coalesce(F.col(name), F.lit(False)).alias(name)
    of_id = rows.join(known, F.col("id") == F.col("known"), "left").select(
        "id", "part", "mask", "digest", flag("good"), flag("toxic")).groupBy(
        "id", "part", "mask", "digest", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))
    named = F.col("id").isNotNull()
    of_text = materialize(of_id.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(named, F.col("n"))).alias("named"),
        F.min(F.when(named, F.struct("id", "n"))).alias("first")), "texts")
    least = of_text.groupBy(F.col("digest").alias("text")).agg(F.min("first.id").alias("least"))
    # Of a group only the rows of the table-wide smallest doc_id (and those without one) are no copies.
    copies = F.coalesce("named", F.lit(0)) - F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    counted = of_text.join(least, F.col("digest") == F.col("text")).withColumn("copies", F.coalesce(copies, F.lit(0)))
    once = 1 << len(filters)

    def cell(number: int, kept: Column) -> Column:
        n = F.col("n") - F.col("copies") if number < once else F.col("copies")
        return F.sum(F.when(kept & (F.col("mask") == number % once), n).otherwise(0))

    kinds = dict(zip(MEASURES, (F.lit(True), F.col("good"), F.col("toxic"))))
    cells = materialize(counted.groupBy("part").agg(
        *[F.array(*[cell(i, kept) for i in range(2 * once)]).alias(name) for name, kept in kinds.items()]), "cells")
    discard(of_text)
    return cells


def gray_states(cells: np.ndarray) -> np.ndarray:
    """What survives each subset of filters: (parts, 2^n, measures) from cells of that shape.

    The subsets follow one another by a Gray code, so each step turns one filter on or off. Every cell keeps how many
    active filters it fails; a cell leaves the survivors when that number rises from 0 and comes back when it falls to 0.
    """
    size = cells.shape[1]
    numbers, failing = np.arange(size), np.zeros(size, np.int64)
    states = np.empty_like(cells)
    alive = cells.sum(axis=1)
    states[:, 0] = alive
    subset = 0
    for step in range(1, size):
        bit = step & -step
        subset ^= bit
        fails = (numbers & bit) > 0
        if subset & bit:
            alive = alive - cells[:, fails & (failing == 0)].sum(axis=1)
            failing[fails] += 1
        else:
            failing[fails] -= 1
            alive = alive + cells[:, fails & (failing == 0)].sum(axis=1)
        states[:, subset] = alive
    return states


def subset_states(cells: DataFrame) -> DataFrame:
    """``filter_cells`` to what survives each subset of filters: part, docs, good, toxic, arrays indexed by the subset's bits."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                table = np.stack([np.asarray(batch.column(m).flatten()) for m in MEASURES], axis=1)
                states = gray_states(table.reshape(batch.num_rows, -1, len(MEASURES)))
                lists = [pa.array(list(states[:, :, i])) for i in range(len(MEASURES))]
                yield pa.RecordBatch.from_arrays([batch.column("part"), *lists], ["part", *MEASURES])
    return cells.mapInArrow(run, cells.select("part", *MEASURES).schema)


STEP_SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
               "good_lost long, toxic_lost long, shapley long")


def order_steps(states: DataFrame, letters: str) -> DataFrame:
    """``subset_states`` to one row per part, order of the filters and step, by differences of states.

    ``redundant`` fail the step's filter but left earlier, ``unique_fails`` fail no other one, and ``shapley`` is the
    filter's removals summed over all orders. Work per part is bounded by the number of orders, not by its documents.
    """
    orders = np.array(list(permutations(range(len(letters)))))
    bits = 1 << orders
    after = np.cumsum(bits, axis=1)
    before = after - bits
    names = np.repeat(["".join(letters[i] for i in order) for order in orders], len(letters))
    steps = np.tile(np.arange(1, len(letters) + 1, dtype=np.int32), len(orders))
    full = (1 << len(letters)) - 1

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, PARTS_AT_ONCE):
                some = batch.slice(first, PARTS_AT_ONCE)
                docs, good, toxic = (np.asarray(some.column(m).flatten()).reshape(some.num_rows, -1) for m in MEASURES)
                removed = docs[:, before] - docs[:, after]
                fails = (docs[:, :1] - docs)[:, bits]
                alone = docs[:, full ^ bits] - docs[:, full][:, None, None]
                by_filter = np.stack([removed[:, orders == i].sum(axis=1) for i in range(len(letters))], axis=1)
                columns = [docs[:, after], removed, fails - removed, alone, good[:, before] - good[:, after],
                           toxic[:, before] - toxic[:, after], by_filter[:, orders]]
                part = some.column("part").take(pa.array(np.repeat(np.arange(some.num_rows), len(steps))))
                yield pa.RecordBatch.from_arrays(
                    [part, pa.array(np.tile(names, some.num_rows)), pa.array(np.tile(steps, some.num_rows)),
                     *[pa.array(c.ravel()) for c in columns]], [f.split(" ")[0] for f in STEP_SCHEMA.split(", ")])
    return states.mapInArrow(run, STEP_SCHEMA)


def filter_audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column], copies: str = "E", **names: str) -> DataFrame:
    """The audit of ``filters`` (letter to failure condition) and of the copy filter, whose letter is ``copies``.

    One row per part, order and step, zeros included; see ``filter_cells`` for nulls, ties and repeated rows. An empty
    table gives an empty result. Columns of ``docs`` other than the named ones are read only by the conditions.
    """
    return order_steps(subset_states(filter_cells(docs, labels, filters, **names)), "".join(filters) + copies)
