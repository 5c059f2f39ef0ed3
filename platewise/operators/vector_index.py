"""A vector index of lists around centroids: approximate search on residual codes, exact search with distance bounds."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from platewise.operators.dedup import top_per_key
from platewise.operators.joins import lookup_join
from platewise.operators.similarity import SCORE_DECIMALS, TOP_K, matrix_of, unit_rows
from platewise.session import materialize

MAX_LISTS = 4096         # centroids that every task gets: 32 MB at 1,024 numbers each
SAMPLE_ROWS = 100_000    # vectors that centroids and codebooks are fitted on, about; every vector is indexed
CODE_PARTS = 16          # bytes of a residual's code, each for one stretch of its numbers
CODEWORDS = 256
TRIED_QUERIES = 256      # sample vectors whose neighbours say how many lists a search must open
LEAST_PROBES = 8         # lists that a search opens at least: queries may lie farther off than the sample
PART_ROWS = 32_768       # vectors of one part of a list, about
QUERY_ROWS = 4_096       # queries that one part of a list meets at a time, about
CELLS = 1 << 19          # numbers of one product of rows and centres: 4 MB, however many lists there are
PROBE_ROWS = 8_192       # rows of one batch of opened lists: a query opens many lists, each with its vector
NO_LIST = -1             # vectors without a direction (all zeros) stand in no list: their score is always 0
LISTS = "list int, centroid array<double>, radius double, rows bigint, parts int"
ENTRIES = "id string, name string, list int, part int, distance double, codes binary"
_NEAR = 10 ** -SCORE_DECIMALS


@dataclass
class VectorIndex:
    """``lists``: centroids with radius and size. ``entries``: the list, distance to its centroid and residual code of
    each vector. ``vectors``: unit vectors by id and list. ``codebooks``: the values of each code byte. ``probes``: how many
    lists a query opens to reach the recall that the index was built for."""

    lists: DataFrame
    entries: DataFrame
    vectors: DataFrame
    codebooks: DataFrame
    probes: int


def read_index(spark: SparkSession, path: str) -> VectorIndex:
    tables = [spark.read.parquet(f"{path}/{name}") for name in ("lists", "entries", "vectors", "codebooks")]
    return VectorIndex(*tables, spark.read.parquet(f"{path}/settings").first()["probes"])


def build_index(records: DataFrame, path: str, lists: int | None = None, sample_rows: int = SAMPLE_ROWS,
                recall: float = 0.97, seed: int = 7) -> VectorIndex:
    """Index vector records (id, vector, metadata) below ``path`` and read the index back.

    Centroids are fitted on about ``sample_rows`` unit vectors of the smallest id hashes, about the square root
    of all rows many (``lists``), MAX_LISTS at most. What the centroid leaves of a vector is coded in bytes, one for
    each stretch of numbers. How many lists a query must open for ``recall`` is measured on the sample. Records without a vector are left out, vectors of unequal length are an error.
    A list is dealt to parts by id, so a third of all rows being copies of one vector makes many parts, not one task.
    """
    spark = records.sparkSession
    rows = _units(records.select("id", F.col("metadata.name").alias("name"), "vector"))
    rows = materialize(rows, "units")
    total = rows.count()
    lists = max(1, min(MAX_LISTS, lists or round(total ** 0.5)))
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / float(1 << 40)
    sample = materialize(rows.where(F.col("sized") & (place < sample_rows / max(total, 1))).select("id", "unit"), "sample")
    centroids = _centroids(sample, lists, seed)
    books = _codebooks(sample, centroids, seed)
    probes = _probes_needed(sample, centroids, recall)
    held = spark.sparkContext.broadcast((centroids, books))

    def enter(batches):
        centroids, books = held.value
        for batch in batches:
            if batch.num_rows:
                unit, sized = matrix_of(batch.column("unit")), np.asarray(batch.column("sized"))
                where, distance = _nearest(unit, centroids)
                codes = _coded(unit - centroids[where], books) if len(centroids) else np.zeros((len(unit), 0), np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("name"), pa.array(np.where(sized, where, NO_LIST).astype(np.int32)),
                     pa.array(np.where(sized, distance, 0.0)), pa.array([c.tobytes() for c in codes], pa.binary()), batch.column("unit")],
                    ["id", "name", "list", "distance", "codes", "unit"])

    entered = materialize(rows.mapInArrow(
        enter, "id string, name string, list int, distance double, codes binary, unit array<double>"), "entered")
    sizes = entered.groupBy("list").agg(F.max("distance").alias("radius"), F.count(F.lit(1)).alias("rows"))
    known = spark.createDataFrame([(NO_LIST, None), *[(i, c.tolist()) for i, c in enumerate(centroids)]], "list int, centroid array<double>")
    known = known.join(sizes, "list").withColumn("parts", F.ceil(F.col("rows") / PART_ROWS).cast("int"))
    known.select("list", "centroid", "radius", "rows", "parts").write.mode("overwrite").parquet(f"{path}/lists")
    parts = F.broadcast(spark.read.parquet(f"{path}/lists").select("list", "parts"))  # MAX_LISTS rows at most
    placed = entered.join(parts, "list").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    placed.select("id", "name", "list", "part", "distance", "codes").write.mode("overwrite").parquet(f"{path}/entries")
    placed.select("id", "name", "list", "part", "distance", "unit").write.mode("overwrite").parquet(f"{path}/vectors")
    spark.createDataFrame([(i, book.tolist()) for i, book in enumerate(books)], "stretch int, words array<array<double>>").write.mode(
        "overwrite").parquet(f"{path}/codebooks")
    spark.createDataFrame([(probes,)], "probes int").write.mode("overwrite").parquet(f"{path}/settings")
    return read_index(spark, path)


def _units(rows: DataFrame) -> DataFrame:
    """Rows that have a vector, with its unit vector and whether it has a direction at all."""
    kept = [c for c in rows.columns if c != "vector"]

    def scale(batches):
        for batch in batches:
            batch = batch.filter(batch.column("vector").is_valid())
            if batch.num_rows:
                matrix = matrix_of(batch.column("vector")).astype(np.float64)
                unit = unit_rows(matrix)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in kept], pa.array(list(unit)), pa.array(matrix.any(axis=1))], [*kept, "unit", "sized"])

    fields = ", ".join(f"{c} string" for c in kept)
    return rows.select(*[F.col(c).cast("string").alias(c) for c in kept], "vector").mapInArrow(
        scale, f"{fields}, unit array<double>, sized boolean")


def _centroids(sample: DataFrame, lists: int, seed: int) -> np.ndarray:
    """At most ``lists`` centres of the sample, found by Spark's distributed k-means."""
    if sample.isEmpty():
        return np.zeros((0, 0))
    if lists == 1:
        model_rows = [sample.select(F.col("unit").alias("c")).first()["c"]]
        return np.array(model_rows)
    model = KMeans(k=lists, maxIter=8, seed=seed, initSteps=2).fit(sample.select(array_to_vector("unit").alias("features")))
    return np.array([list(c) for c in model.clusterCenters()])


def _nearest(unit: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and distance of the nearest centroid of each row."""
    if not len(centroids):
        return np.full(len(unit), NO_LIST), np.zeros(len(unit))
    squares, where, distance = (centroids ** 2).sum(axis=1), np.zeros(len(unit), np.int64), np.zeros(len(unit))
    for some in _pieces(len(unit), len(centroids)):
        where[some] = np.argmin(squares - 2 * unit[some] @ centroids.T, axis=1)
        distance[some] = np.linalg.norm(unit[some] - centroids[where[some]], axis=1)
    return where, distance


def _pieces(rows: int, width: int) -> list[slice]:
    """Slices of rows whose products with ``width`` centres hold about CELLS numbers."""
    step = max(1, CELLS // max(1, width))
    return [slice(a, min(a + step, rows)) for a in range(0, rows, step)]


def _probes_needed(sample: DataFrame, centroids: np.ndarray, recall: float, asked: int = TRIED_QUERIES, k: int = TOP_K) -> int:
    """How many of its nearest lists hold ``recall`` of a vector's nearest others: tried for a few vectors against the whole sample."""
    if len(centroids) < 2:
        return 1
    rows = sample.orderBy(F.xxhash64("id", F.lit(1))).limit(asked).collect()
    units = np.array([r["unit"] for r in rows])
    held = sample.sparkSession.sparkContext.broadcast((np.array([r["id"] for r in rows], object), units, centroids))

    def search(batches):
        names, units, centroids = held.value
        for batch in batches:
            if batch.num_rows:
                rows, ids = matrix_of(batch.column("unit")), np.array(batch.column("id").to_pylist(), object)
                where, scores = _nearest(rows, centroids)[0], units @ rows.T
                best = [_top(np.where(ids == name, -2.0, s), ids, k) for name, s in zip(names, scores)]
                of = np.repeat(np.arange(len(names)), [len(b) for b in best])
                at = np.concatenate(best)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(of), pa.array(ids[at].tolist(), pa.string()), pa.array(scores[of, at]), pa.array(where[at].astype(np.int32))],
                    ["query", "id", "score", "list"])

    near = sample.mapInArrow(search, "query bigint, id string, score double, list int")
    near = top_per_key(near.where("score > -1.5"), ["query"], [F.desc("score"), "id"], k).collect()
    gaps = (centroids ** 2).sum(axis=1) - 2 * units @ centroids.T
    places = np.argsort(np.argsort(gaps, axis=1, kind="stable"), axis=1, kind="stable")
    needed = int(np.quantile([places[r["query"], r["list"]] for r in near], recall, method="higher")) + 1 if near else 1
    return min(len(centroids), max(LEAST_PROBES, needed))


def _stretches(width: int) -> list[np.ndarray]:
    return np.array_split(np.arange(width), min(CODE_PARTS, width))


def _codebooks(sample: DataFrame, centroids: np.ndarray, seed: int) -> list[np.ndarray]:
    """Code words of each stretch of the residuals: one task a stretch, each over the bounded sample."""
    if not len(centroids):
        return []
    held = sample.sparkSession.sparkContext.broadcast(centroids)
    stretches = _stretches(centroids.shape[1])

    def residuals(batches):
        for batch in batches:
            if batch.num_rows:
                unit = matrix_of(batch.column("unit"))
                rest = unit - held.value[_nearest(unit, held.value)[0]]
                for i, columns in enumerate(stretches):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rest), i, np.int32)), batch.column("id"), pa.array(list(rest[:, columns]))], ["stretch", "id", "rest"])

    def settle(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")  # the order of rows decides ties, so it is fixed
        words = _lloyd(matrix_of(table.column("rest")), seed)
        return pa.table({"stretch": pa.array([table.column("stretch")[0].as_py()], pa.int32()),
                         "words": pa.array([words.tolist()], pa.list_(pa.list_(pa.float64())))})

    found = sample.mapInArrow(residuals, "stretch int, id string, rest array<double>").groupBy("stretch").applyInArrow(
        settle, "stretch int, words array<array<double>>")
    return [np.array(r["words"]) for r in sorted(found.collect(), key=lambda r: r["stretch"])]


def _lloyd(rows: np.ndarray, seed: int, rounds: int = 10) -> np.ndarray:
    """Plain k-means of short rows, at most CODEWORDS centres, started from rows chosen at random."""
    chosen = np.unique(rows, axis=0)
    words = np.random.default_rng(seed).permutation(chosen)[:CODEWORDS]
    for _ in range(rounds if len(chosen) > CODEWORDS else 0):
        where, _ = _nearest(rows, words)
        count = np.bincount(where, minlength=len(words))
        total = np.stack([np.bincount(where, rows[:, j], len(words)) for j in range(rows.shape[1])], axis=1)
        words = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], words)
    return words


def _coded(rest: np.ndarray, books: list[np.ndarray]) -> np.ndarray:
    return np.stack([_nearest(rest[:, columns], book)[0].astype(np.uint8)
                     for columns, book in zip(_stretches(rest.shape[1]), books)], axis=1)


def _asked(queries: DataFrame) -> DataFrame:
    return materialize(_units(queries.select("query_id", "vector")), "queries")


def _lists_of(index: VectorIndex) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, centroids and radii of all lists with a centroid: MAX_LISTS at most."""
    rows = index.lists.where(F.col("list") != NO_LIST).orderBy("list").collect()
    return (np.array([r["list"] for r in rows], np.int32), np.array([r["centroid"] for r in rows], np.float64),
            np.array([r["radius"] for r in rows], np.float64))


def _probes(asked: DataFrame, index: VectorIndex, choose: Callable, extra: str = "") -> DataFrame:
    """The lists each query opens: query_id, unit, list, gap (distance to the centroid). ``choose`` gets the gaps (queries x lists),
    the radii, which queries have a direction, and the batch, and marks the lists to open."""
    numbers, centroids, radii = _lists_of(index)
    held = asked.sparkSession.sparkContext.broadcast((numbers, centroids, radii))

    def probe(batches):
        numbers, centroids, radii = held.value
        squares, columns = (centroids ** 2).sum(axis=-1), ["query_id", "unit", *extra.split()]
        for batch in batches:
            for piece in _pieces(batch.num_rows, len(numbers)) if len(numbers) else ():
                part = batch.slice(piece.start, piece.stop - piece.start)
                unit = matrix_of(part.column("unit"))
                gaps = np.sqrt(np.maximum((unit ** 2).sum(axis=1)[:, None] + squares - 2 * unit @ centroids.T, 0))
                row, at = np.nonzero(choose(gaps, radii, np.asarray(part.column("sized")), part))
                for first in range(0, len(row), PROBE_ROWS):
                    one, to = row[first:first + PROBE_ROWS], at[first:first + PROBE_ROWS]
                    some = part.take(pa.array(one))
                    yield pa.RecordBatch.from_arrays(
                        [*[some.column(c) for c in columns], pa.array(numbers[to]), pa.array(gaps[one, to])], [*columns, "list", "gap"])

    more = "".join(f", {name} double" for name in extra.split())
    return asked.mapInArrow(probe, f"query_id string, unit array<double>{more}, list int, gap double")


def _meet(left: DataFrame, probes: DataFrame, index: VectorIndex, scan: Callable, schema: str) -> DataFrame:
    """Queries meet the rows of the lists they open: an equality join by list, part of the list and block of queries."""
    probes = materialize(probes, "probes")
    blocks = probes.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("blocks"))
    opened = F.broadcast(blocks.join(index.lists.select("list", "parts"), "list"))  # MAX_LISTS rows at most
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = left.join(opened.drop("parts"), "list").withColumn("block", every("blocks")).drop("blocks")
    asked = probes.join(opened, "list").withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int")).withColumn(
        "part", every("parts")).drop("blocks", "parts")
    keys = ["list", "part", "block"]
    return rows.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(scan, schema)


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, equal ones by id."""
    places = np.arange(len(scores))
    if len(scores) > k:
        places = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return places[np.lexsort((ids[places], -scores[places]))][:k]


def knn_ivf(index: VectorIndex, queries: DataFrame, k: int = TOP_K, probes: int | None = None, rescore: int = 10) -> DataFrame:
    """Approximate search: query_id, item_id, name, score, rank; the scores themselves are exact.

    A query opens its ``probes`` nearest lists (as many as the index was tried with). There the score of an entry is the centroid's plus one looked-up value
    a code byte; the ``rescore`` x k best per query are scored again on their vectors. Only codes are read for the search;
    vectors are fetched for the candidates alone. Vectors and queries without a direction find nothing.
    """
    asked, probes = _asked(queries), probes or index.probes
    nearest = lambda gaps, radii, sized, _: (
        np.argsort(np.argsort(gaps, axis=1, kind="stable"), axis=1, kind="stable") < probes) & sized[:, None]
    numbers, centroids, _ = _lists_of(index)
    books = [np.array(r["words"]) for r in index.codebooks.orderBy("stretch").collect()]
    held = asked.sparkSession.sparkContext.broadcast((dict(zip(numbers.tolist(), centroids)), books))
    wanted = rescore * k

    def scan(entries: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"query_id": [], "id": [], "about": []}
        if entries.num_rows and asked.num_rows:
            centroids, books = held.value
            codes = np.frombuffer(b"".join(entries.column("codes").to_pylist()), np.uint8).reshape(entries.num_rows, -1)
            ids, centre = np.array(entries.column("id").to_pylist(), object), centroids[asked.column("list")[0].as_py()]
            stretches = _stretches(len(centre))
            for query_id, unit in zip(asked.column("query_id").to_pylist(), matrix_of(asked.column("unit"))):
                about = np.full(len(ids), unit @ centre)
                for j, (columns, book) in enumerate(zip(stretches, books)):
                    about += (book @ unit[columns])[codes[:, j]]
                best = _top(about, ids, wanted)
                out["query_id"] += [query_id] * len(best)
                out["id"] += ids[best].tolist()
                out["about"] += about[best].tolist()
        return pa.table({"query_id": pa.array(out["query_id"], pa.string()), "id": pa.array(out["id"], pa.string()),
                         "about": pa.array(out["about"], pa.float64())})

    entries = index.entries.select("id", "list", "part", "codes")
    found = _meet(entries, _probes(asked, index, nearest), index, scan, "query_id string, id string, about double")
    candidates = top_per_key(found, ["query_id"], [F.desc("about"), "id"], wanted).select("query_id", "id")
    return rescored(candidates, index, asked, k)


def rescored(candidates: DataFrame, index: VectorIndex, asked: DataFrame, k: int) -> DataFrame:
    """The k best of candidates (query_id, id) by their exact cosine."""
    pairs = lookup_join(index.vectors.select("id", "name", "unit"), candidates, "id")
    pairs = pairs.join(asked.select("query_id", F.col("unit").alias("query")), "query_id")
    score = F.aggregate(F.zip_with("unit", "query", lambda x, y: x * y), F.lit(0.0), lambda a, b: a + b)
    hits = pairs.select("query_id", F.col("id").alias("item_id"), "name", F.round(score, SCORE_DECIMALS).alias("score"))
    return top_per_key(hits, ["query_id"], [F.desc("score"), "item_id"], k, "rank")


_SCAN = "query_id string, item_id string, name string, score double, scored bigint"


def _exact_scan(k: int) -> Callable:
    """Score the rows of a list that its triangle bound leaves, and count them. ``least`` is the score a hit must reach."""
    def scan(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out = {name.split(" ")[0]: [] for name in _SCAN.split(", ")}
        if rows.num_rows and asked.num_rows:
            units, pivot = matrix_of(rows.column("unit")), np.asarray(rows.column("distance"))
            ids, names = (np.array(rows.column(c).to_pylist(), object) for c in ("id", "name"))
            listed = asked.column("list")[0].as_py() != NO_LIST
            least = np.asarray(asked.column("least").fill_null(-2.0))
            for query_id, unit, gap, floor in zip(
                    asked.column("query_id").to_pylist(), matrix_of(asked.column("unit")), np.asarray(asked.column("gap")), least):
                reach = np.sqrt(max(2 - 2 * (floor - 2 * _NEAR), 0))
                left = np.flatnonzero(np.abs(pivot - gap) <= reach) if listed and unit.any() else np.arange(len(ids))
                scores = np.round(units[left] @ unit, SCORE_DECIMALS)
                best = _top(scores, ids[left], k)
                for name, values in (("query_id", [query_id] * (len(best) + 1)), ("item_id", [*ids[left][best], None]),
                                     ("name", [*names[left][best], None]), ("score", [*scores[best], None]),
                                     ("scored", [None] * len(best) + [len(left)])):
                    out[name] += values
        kinds = (pa.string(), pa.string(), pa.string(), pa.float64(), pa.int64())
        return pa.table({name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds)})
    return scan


@dataclass
class BoundedSearch:
    """``hits``: query_id, item_id, name, score, rank. ``work``: query_id, scored, vectors (in the index)."""

    hits: DataFrame
    work: DataFrame


def knn_bounded(index: VectorIndex, queries: DataFrame, k: int = TOP_K, first: int = 2) -> BoundedSearch:
    """Exact search that skips what cannot be a hit.

    The ``first`` nearest lists give each query a k-th best score. After that a list is opened only if its nearest possible vector,
    by the distance to the centroid less the radius, may reach that score, and in it a vector is scored only if its own
    distance to the centroid allows it. Scores and ties are those of a search over all vectors. Vectors and queries without a
    direction have the score 0 with all; they take part without a bound.
    """
    asked = _asked(queries)
    scan, vectors = _exact_scan(k), index.vectors
    far = F.lit(None).cast("double")

    def nearest(gaps, radii, sized, _):
        return np.argsort(np.argsort(gaps, axis=1, kind="stable"), axis=1, kind="stable") < first

    def may_reach(gaps, radii, sized, batch):
        least = np.asarray(batch.column("least").fill_null(-2.0))
        reach = np.sqrt(np.maximum(2 - 2 * (least - 2 * _NEAR), 0))[:, None]
        return ((gaps - radii <= reach) | ~sized[:, None]) & ~nearest(gaps, radii, sized, batch)

    start = _probes(asked, index, nearest).withColumn("least", far)
    unlisted = asked.select("query_id", "unit", F.lit(NO_LIST).alias("list"), F.lit(0.0).alias("gap"), far.alias("least"))
    begun = materialize(_meet(vectors, start.unionByName(unlisted), index, scan, _SCAN), "begun")
    kth = top_per_key(begun.where("item_id is not null"), ["query_id"], [F.desc("score"), "item_id"], k, "rank").where(
        F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    known = asked.join(kth, "query_id", "left")
    rest = _probes(known, index, may_reach, "least")
    scanned = materialize(begun.unionByName(_meet(vectors, rest, index, scan, _SCAN)), "scanned")
    hits = top_per_key(scanned.where("item_id is not null").drop("scored"), ["query_id"], [F.desc("score"), "item_id"], k, "rank")
    total = index.lists.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("vectors"))
    work = scanned.groupBy("query_id").agg(F.sum("scored").alias("scored")).crossJoin(F.broadcast(total))  # one row
    return BoundedSearch(hits, work)
