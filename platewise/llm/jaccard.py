"""N-gram Jaccard join by signature trees."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, Window as W

from platewise.llm.common import PRIME, Words, discard, materialize, mix, ragged, released, small_batches, text_chunks
from platewise.llm.components import connected_components

BITS = 2048  # of a token bitmap
PARTS = BITS // 64
HEAVY = 64  # a root shingle in more documents than this moves to the end of the order
MAX_HEAVY = 1 << 16  # such shingles at most: 512 KB of broadcast
LEAF = 32  # sets of a leaf
FIRST = 16  # roots of a set that say whether a pair met below an earlier root
STARS = 3  # centres that a set is compared with at a time
FEW = 50  # other centres are drawn while the last ones link more than one in so many sets below tall roots,
SPARSE = 256  # and while sets below tall roots make more than so many pairs a set: fewer are opened at once
TRIES = 64  # pairs that stand for two classes at first: one link makes the classes one, so the others need no look then
BATCH = 1024  # texts that a Python worker is given at a time,
LEAVES = 64  # and pairs of leaves: some 25 KB a pair, more where many small classes share a leaf
BLOCK = 1 << 18  # bytes of texts whose shingles are taken at once: their arrays are several times as large
MAX_FETCH = 200_000  # sets whose ids (24 bytes each) are broadcast to fetch their texts; more are joined by a shuffle


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct shingle hashes, sorted within each text; the text of each; bounds by text)."""
    words = Words(texts, lower=True)
    n = len(texts)
    grams, at = words.grams(k)
    doc = words.doc[at]
    sizes = np.diff(words.bounds)
    short = np.flatnonzero((sizes > 0) & (sizes < k))
    if len(short):  # the whole sequence is the one shingle
        h = np.full(len(short), np.uint64(0x5DEECE66D))
        for i in range(k - 1):
            some = sizes[short] > i
            h[some] = mix(h[some] * PRIME + words.hashes[words.bounds[short[some]] + i] + np.uint64(i + 1))
        grams, doc = np.concatenate([grams, h]), np.concatenate([doc, short])
    order = np.lexsort((grams, doc))
    grams, doc = grams[order], doc[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
    grams, doc = grams[new], doc[new]
    return grams, doc, np.searchsorted(doc, np.arange(n + 1))


def root_sizes(n: np.ndarray, share: int) -> np.ndarray:
    """How many first shingles of a set of n (in one order for all) two linked sets can't avoid sharing one of."""
    return np.where(n > 0, n - -(-share * n // 100) + 1, 0)


def _roots(grams, doc, bounds, share, heavy):
    """The root shingles of each set: first by (heavy or not, hash)."""
    n = np.diff(bounds)
    take = root_sizes(n, share)
    if len(heavy):
        place = np.minimum(np.searchsorted(heavy, grams), len(heavy) - 1)
        order = np.lexsort((grams, heavy[place] == grams, doc))
        grams = grams[order]
    rank = np.arange(len(grams)) - np.repeat(bounds[:-1], n)
    return grams[rank < np.repeat(take, n)], np.concatenate([[0], np.cumsum(take)])


def _root_counts(k: int, share: int):
    """Root shingles of the texts and in how many texts each is one, summed within a block."""
    def run(batches):
        none = np.zeros(0, np.uint64)
        for batch in batches:
            for a, b in text_chunks(batch.column("text"), BLOCK):
                roots, _ = _roots(*shingle_sets(batch.column("text").slice(a, b - a), k), share, none)
                token, count = np.unique(roots, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(count)], ["token", "n"])
    return released(run)


def _signatures(k: int, share: int, heavy):
    """One row per text: id, size and 128-bit sum of its set, root shingles, bitmap and hidden tokens.

    ``hidden`` is how many shingles share a bit with another one.
    """
    def run(batches):
        for batch in batches:
            for a, b in text_chunks(batch.column("text"), BLOCK):
                grams, doc, bounds = shingle_sets(batch.column("text").slice(a, b - a), k)
                n = np.diff(bounds)
                sums = [np.add.reduceat(np.append(mix(grams + np.uint64(c)), np.uint64(0)), np.minimum(bounds[:-1], len(grams)))
                        if b > a else np.zeros(0, np.uint64) for c in (1, 2)]
                sums = [np.where(n > 0, s, np.uint64(0)).view(np.int64) for s in sums]
                bits = np.zeros((b - a, BITS), np.uint8)
                bits[doc, (mix(grams ^ PRIME) >> np.uint64(64 - 11)).astype(np.int64)] = 1
                maps = np.packbits(bits, axis=1).view(np.int64)
                # Sets that would fill that map get a finer one of their own.
                fine = [np.zeros(0, np.int64)] * (b - a)
                for i in np.flatnonzero(n > BITS):
                    own = np.zeros(1 << int(n[i] - 1).bit_length(), np.uint8)
                    own[(mix(grams[bounds[i]:bounds[i + 1]] ^ PRIME) & np.uint64(len(own) - 1)).astype(np.int64)] = 1
                    fine[i] = np.packbits(own).view(np.int64)
                fine_bounds = np.concatenate([[0], np.cumsum([len(x) for x in fine])]).astype(np.int64)
                roots, root_bounds = _roots(grams, doc, bounds, share, heavy.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a), pa.array(n), pa.array(sums[0]), pa.array(sums[1]),
                     ragged(roots.view(np.int64), root_bounds), ragged(maps.ravel(), np.arange(b - a + 1) * PARTS),
                     pa.array(n - bits.sum(axis=1, dtype=np.int64)), ragged(np.concatenate(fine), fine_bounds)],
                    ["id", "n", "s1", "s2", "roots", "bitmap", "hidden", "fine"])
    return released(run)


def _tokens(k: int):
    def run(batches):
        for batch in batches:
            for a, b in text_chunks(batch.column("text"), BLOCK):
                grams, _, bounds = shingle_sets(batch.column("text").slice(a, b - a), k)
                n = np.diff(bounds)
                s1 = np.add.reduceat(np.append(mix(grams + np.uint64(1)), np.uint64(0)), np.minimum(bounds[:-1], len(grams)))
                same = (np.where(n > 0, s1, np.uint64(0)).view(np.int64) == np.asarray(batch.column("s1").slice(a, b - a)))
                rows = pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(a, b - a), pa.array(n), ragged(grams.view(np.int64), bounds)], ["node", "n", "tokens"])
                yield rows.filter(pa.array(same))
    return released(run)


def _needed(a: Column, b: Column, share: int) -> Column:
    """The least overlap of linked sets of these sizes."""
    return F.ceil((a + b) * share / (100 + share))


def _in_reach(a: str, b: str, share: int) -> Column:
    """Where a root may be the first common shingle of linked sets: what follows it in each set is enough overlap."""
    n, place = lambda x: F.col(f"{x}n"), lambda x: F.col(f"{x}place")
    return _needed(n(a), n(b), share) <= F.least(n(a) - place(a), n(b) - place(b))


def _popcount(a: Column, b: Column, test) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(test(x, y))), F.lit(0), lambda s, x: s + x)


def _folded(fine: Column, other: Column) -> Column:
    """Half as long where ``other`` is: bit i and bit i + half become one."""
    half = F.floor(F.size(fine) / 2).cast("int")
    return F.when(F.size(fine) > F.size(other), F.zip_with(
        F.slice(fine, F.lit(1), half), F.slice(fine, half + 1, half), lambda x, y: x.bitwiseOR(y))).otherwise(fine)


def sets_may_link(a: str, b: str, share: int) -> Column:
    """Leaf test: a bit that only one set has stands for a shingle that the other lacks.

    Large sets are tested by their finer maps; sizes of sets that may link differ by less than a factor of two.
    """
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    need = _needed(na, nb, share)

    def enough(ba: Column, bb: Column) -> Column:
        lacks = lambda x, y: x.bitwiseAND(F.bitwise_not(y))
        return (na - _popcount(ba, bb, lacks) >= need) & (nb - _popcount(bb, ba, lacks) >= need)

    fa, fb = F.col(f"{a}.fine"), F.col(f"{b}.fine")
    large = (F.size(fa) > 0) & (F.size(fb) > 0)
    return (need <= F.least(na, nb)) & F.when(large, enough(_folded(fa, fb), _folded(fb, fa))).otherwise(
        enough(F.col(f"{a}.bitmap"), F.col(f"{b}.bitmap")))


def nodes_may_link(a: str, b: str, share: int) -> Column:
    """Node test: sizes that fit, more than one component, roots early enough in the sets, and enough common bits.

    The root is early (``inner``) in the smaller of two linked sets at least, if it is the first that they share.

    The most that a set below ``a`` and one below ``b`` can have in common is the number of bits that both OR-combined
    maps have, plus the shingles that hide behind another one's bit.
    """
    col = lambda side, name: F.col(f"{side}.{name}")
    need = _needed(col(a, "least"), col(b, "least"), share)
    fit = (need <= col(a, "most")) & (need <= col(b, "most")) & (
        col(a, "least") * share <= col(b, "most") * 100) & (col(b, "least") * share <= col(a, "most") * 100)
    early = (col(a, "inner") | col(b, "inner")) & (need <= col(a, "room")) & (need <= col(b, "room"))
    apart = ~((col(a, "low") == col(a, "high")) & (col(b, "low") == col(b, "high")) & (col(a, "low") == col(b, "low")))
    possible = _popcount(col(a, "bitmap"), col(b, "bitmap"), lambda x, y: x.bitwiseAND(y)) + F.least(
        col(a, "hidden"), col(b, "hidden"))
    return fit & early & apart & (possible >= need)


def _stars(members: DataFrame, a_maps: DataFrame, b_maps: DataFrame, share: int, seed: int | None) -> DataFrame:
    """Pairs (a, b) that may link: every set with at most STARS centres of another class, one centre for each root and band.

    The centre is the first set below a root, or any one of them, drawn by ``seed``.
    """
    draw = F.lit(0) if seed is None else F.xxhash64("node", "token", F.lit(seed))
    centres = members.groupBy("token", "band").agg(
        F.min(F.struct(draw.alias("draw"), "node", "n", "place", "class")).alias("centre"),
        F.min("class").alias("low"), F.max("class").alias("high")).where("low < high").select(
        "token", "band", F.col("centre.node").alias("a"), F.col("centre.n").alias("centre_n"),
        F.col("centre.place").alias("centre_place"), F.col("centre.class").alias("centre_class"))
    stars = members.join(centres, ["token", "band"]).where(
        (F.col("class") != F.col("centre_class")) & _in_reach("", "centre_", share)).select("a", F.col("node").alias("b")).distinct()
    return stars.join(a_maps, "a").join(b_maps, "b").where(sets_may_link("x", "y", share)).groupBy("b").agg(
        F.slice(F.array_sort(F.collect_list("a")), 1, STARS).alias("centres")).select(F.explode("centres").alias("a"), "b")


def _mixed(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Members with their class, below roots over more than one class; ``tall`` are roots of more than LEAF sets."""
    placed = materialize(members.join(classes, "node", "left").withColumn("class", F.coalesce("component", "node")).drop(
        "component"), "placed")
    mixed = placed.groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count(F.lit(1)).alias("sets")).where(
        "low < high").select("token", (F.col("sets") > LEAF).alias("tall"))
    stored = materialize(placed.join(mixed, "token"), "mixed")
    discard(placed)
    return stored


def _open_sets(share: int, tries: int):
    """The pairs of sets of two open leaves that may link, by their bitmaps, with their classes; both leaves of a row may be one.
    Of a row's pairs between the same two classes ``tries`` stand for all, and ``more`` marks that there are others."""
    def side(batch, name):
        lists = [batch.column(f"{name}_{part}") for part in ("node", "n", "place", "class", "bitmap")]
        return [(np.asarray(column.flatten()), np.asarray(column.offsets) - column.offsets[0].as_py()) for column in lists]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = np.asarray(batch.column("token"))
            left, right = side(batch, "x"), side(batch, "y")
            first = [np.asarray(batch.column(f"{name}_first").flatten()).reshape(-1, FIRST) for name in "xy"]
            for row, token in enumerate(tokens):
                (a, na, pa_, ca, ba), (b, nb, pb, cb, bb) = (
                    [values[at[row]:at[row + 1]] for values, at in one] for one in (left, right))
                need = -(-(na[:, None] + nb[None, :]) * share // (100 + share))
                may = (ca[:, None] != cb[None, :]) & (need <= np.minimum((na - pa_)[:, None], (nb - pb)[None, :]))
                i, j = np.nonzero(may)
                ma, mb = ba.reshape(-1, PARTS).view(np.uint64), bb.reshape(-1, PARTS).view(np.uint64)
                enough = np.zeros(len(i), bool)
                for at in range(0, len(i), 4096):
                    some = slice(at, at + 4096)
                    x, y, least = ma[i[some]], mb[j[some]], need[i[some], j[some]]
                    enough[some] = (na[i[some]] - np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64) >= least) & (
                        nb[j[some]] - np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64) >= least)
                i, j = i[enough], j[enough]
                if not len(i):
                    continue
                # Roots stand in one order for all: sets that share one before this root met there.
                fa, fb = (f[at[row]:at[row + 1]] for f, (_, at) in zip(first, (left[0], right[0])))
                met = np.zeros(len(i), bool)
                for at in range(0, len(i), 4096):
                    some = slice(at, at + 4096)
                    x, y = fa[i[some]], fb[j[some]]
                    # What is before this root in x's order, or all of x's first roots if it is not among them.
                    before = np.cumsum(x == token, axis=1) == 0
                    real = np.arange(FIRST)[None, :] < np.minimum(root_sizes(na[i[some]], share), FIRST)[:, None]
                    in_y = (x[:, :, None] == y[:, None, :]) & (
                        np.arange(FIRST)[None, :] < np.minimum(root_sizes(nb[j[some]], share), FIRST)[:, None])[:, None, :]
                    met[some] = (in_y.any(axis=2) & before & real).any(axis=1)
                i, j = i[~met], j[~met]
                if not len(i):
                    continue
                low, high = np.minimum(ca[i], cb[j]), np.maximum(ca[i], cb[j])
                _, group, sizes = np.unique(np.stack([low, high]), axis=1, return_inverse=True, return_counts=True)
                order = np.argsort(group.ravel(), kind="stable")
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                kept = place < tries
                i, j, low, high, more = i[kept], j[kept], low[kept], high[kept], (sizes > tries)[group.ravel()][kept]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (np.minimum(a[i], b[j]), np.maximum(a[i], b[j]), low, high, more)], ["a", "b", "low", "high", "more"])
    return released(run)


def _verified(pairs: DataFrame, source: DataFrame, sets: DataFrame, k: int, share: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link; the sets are taken from the texts again, for these pairs alone."""
    pairs = materialize(pairs, "pairs")
    needed = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    needed = needed.join(sets.select("node", "least", "s1"), "node")
    few = 2 * pairs.count() <= MAX_FETCH or needed.count() <= MAX_FETCH
    texts = source.join(F.broadcast(needed) if few else needed, F.col("id").eqNullSafe(F.col("least"))).select("node", "s1", "text")
    tokens = materialize(texts.mapInArrow(_tokens(k), "node long, n long, tokens array<long>").dropDuplicates(["node"]), "tokens")
    a = tokens.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    b = tokens.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    links = materialize(pairs.join(a, "a").join(b, "b").withColumn("both", both).where(
        F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * share).select("a", "b"), "links")
    discard(pairs, tokens)
    return links


def _open_pairs(placed_mixed: DataFrame, sets: DataFrame, a_maps: DataFrame, b_maps: DataFrame, share: int, tries: int) -> DataFrame:
    """Pairs (a, b) of sets in the classes ``low`` and ``high`` that may link: about ``tries`` for two classes, from the roots over
    more than one class. ``more`` or a ``place`` above ``tries`` marks classes with pairs that are not listed."""
    # A root of few sets is a leaf itself.
    tall = placed_mixed.where("tall")
    x, y = placed_mixed.where("not tall").alias("x"), placed_mixed.where("not tall").alias("y")
    low_pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.node") < F.col("y.node")) & (
        F.col("x.class") != F.col("y.class")) & _in_reach("x.", "y.", share)).select(
        F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.least("x.class", "y.class").alias("low"),
        F.greatest("x.class", "y.class").alias("high"), F.lit(False).alias("more"))

    room = F.col("n") - F.col("place")
    tall = tall.withColumn("inner", _needed(F.col("n"), F.col("n"), share) <= room)
    # Leaves of one class where a class is large, else of a few classes: pairs of one class are never opened.
    crowd = tall.groupBy("token", "band", "inner").agg(F.ceil(F.count(F.lit(1)) / LEAF).alias("leaves"))
    own = tall.groupBy("token", "band", "inner", "class").agg(F.ceil(F.count(F.lit(1)) / LEAF).alias("parts"))
    leaf = F.when(F.col("parts") > 1, F.xxhash64("class", F.pmod(F.xxhash64("node"), F.col("parts")))).otherwise(
        F.pmod(F.xxhash64("class"), F.col("leaves")))
    leaves = materialize(tall.join(crowd, ["token", "band", "inner"]).join(
        own, ["token", "band", "inner", "class"]).withColumn("leaf", leaf).join(
        sets.select("node", "bitmap", "fine", "hidden", F.slice("roots", 1, FIRST).alias("first")), "node").drop(
        "leaves", "parts"), "leaves")
    tree = materialize(leaves.groupBy("token", "band", "inner", "leaf").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("class").alias("low"), F.max("class").alias("high"),
        F.max(room).alias("room"), F.max("hidden").alias("hidden"),
        F.array(*[F.bit_or(F.col("bitmap")[i]) for i in range(PARTS)]).alias("bitmap")), "tree")
    x, y = tree.alias("x"), tree.alias("y")
    later = F.struct("y.band", "y.inner", "y.leaf") >= F.struct("x.band", "x.inner", "x.leaf")
    open_ = x.join(y, (F.col("x.token") == F.col("y.token")) & later & (F.col("y.band") - F.col("x.band") <= 1)
                   & nodes_may_link("x", "y", share)).select(
        F.col("x.token").alias("token"), F.col("x.band").alias("xb"), F.col("x.inner").alias("xi"),
        F.col("x.leaf").alias("xl"), F.col("y.band").alias("yb"), F.col("y.inner").alias("yi"), F.col("y.leaf").alias("yl"))
    # A stored tree is small, so one task may read it: node pairs are dealt to many before their sets are opened.
    open_ = open_.repartition(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), "token", "xb", "xi", "xl", "yb", "yi", "yl")
    # A leaf's sets as one row, so that open node pairs bring no more rows; the pairs of their sets are compared inside.
    one = F.struct("node", "n", "place", "class", "bitmap", F.transform(
        F.sequence(F.lit(1), F.lit(FIRST)), lambda i: F.coalesce(F.try_element_at("first", i), F.lit(0).cast("long"))).alias("first"))
    packed = materialize(leaves.groupBy("token", "band", "inner", "leaf").agg(F.collect_list(one).alias("sets")), "packed")

    def named(name: str) -> DataFrame:
        flat = [F.col(f"sets.{part}").alias(f"{name}_{part}") for part in ("node", "n", "place", "class")]
        flat += [F.flatten(f"sets.{part}").alias(f"{name}_{part}") for part in ("bitmap", "first")]
        return packed.select("token", *[F.col(c).alias(f"{name}{c[0]}") for c in ("band", "inner", "leaf")], *flat)

    parts = ("node", "n", "place", "class", "bitmap", "first")
    pairs = open_.join(named("x"), ["token", "xb", "xi", "xl"]).join(named("y"), ["token", "yb", "yi", "yl"]).select(
        "token", *[f"{name}_{part}" for name in "xy" for part in parts]).mapInArrow(
        _open_sets(share, tries), "a long, b long, low long, high long, more boolean")
    # Of all pairs between the same two classes a few are tried, too: those over are marked and looked at again, if need be.
    pairs = pairs.unionByName(low_pairs).groupBy("a", "b", "low", "high").agg(F.max("more").alias("more"))
    pairs = pairs.join(a_maps, "a").join(b_maps, "b").withColumn("may", sets_may_link("x", "y", share)).where("may or more")
    place = F.row_number().over(W.partitionBy("low", "high").orderBy("a", "b"))
    pairs = pairs.select("a", "b", "low", "high", "more", "may").withColumn("place", place).where(F.col("place") <= tries + 1)
    with small_batches(sets.sparkSession, LEAVES):
        stored = materialize(pairs, "tried")
    discard(leaves, tree, packed)
    return stored


def _tall(placed_mixed: DataFrame) -> tuple[int, int]:
    """Sets below tall roots, and how many pairs they make there."""
    tall = placed_mixed.where("tall")
    pairs = tall.groupBy("token", "band").agg(F.count(F.lit(1)).alias("sets")).agg(F.sum(F.col("sets") * F.col("sets"))).first()[0]
    return (tall.agg(F.count_distinct("node")).first()[0], pairs) if pairs else (0, 0)


def _linked(open_pairs: DataFrame, links: DataFrame, classes: DataFrame, source: DataFrame, sets: DataFrame, k: int,
            share: int) -> tuple[DataFrame, DataFrame]:
    """Links and classes after all pairs that may link: a set is compared with its few partners of the smallest classes
    first, as most pairs are one class after that."""
    open_pairs = materialize(open_pairs, "open-pairs")
    partners = STARS
    while not open_pairs.isEmpty():
        one = classes.select(F.col("node").alias("a"), F.col("component").alias("ca"))
        two = classes.select(F.col("node").alias("b"), F.col("component").alias("cb"))
        apart = materialize(open_pairs.join(one, "a", "left").join(two, "b", "left").select(
            "a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb")).where("ca <> cb"), "apart")
        if apart.isEmpty():
            discard(apart)
            break
        place = F.row_number().over(W.partitionBy("b").orderBy("ca", "a"))
        chosen = materialize(apart.withColumn("place", place).where(F.col("place") <= partners).select("a", "b"), "chosen")
        rest = materialize(apart.select("a", "b").join(chosen, ["a", "b"], "left_anti"), "open-pairs")
        links = links.unionByName(_verified(chosen, source, sets, k, share))
        classes = connected_components(links)
        discard(open_pairs, apart, chosen)
        open_pairs, partners = rest, partners * 4
    discard(open_pairs)
    return links, classes


def jaccard_classes(docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Link documents whose k-word shingle sets have a Jaccard similarity of at least ``percent``: doc_id, n_shingles,
    component_id (the smallest doc_id reachable by links).

    Equal sets are one set first, however many copies there are. The sets hang in a forest: a root is one
    shingle, and a set hangs below its first few shingles in one common order, so many that two linked sets
    always meet below a root (shingles of very many texts come last in the order, up to MAX_HEAVY of them;
    the order never changes the result). Two sets are compared below a root only where it may be the first they
    share: what follows it in each must be enough overlap, and their first few roots must not show an earlier one. Below a root, sets stand in leaves by size and by whether the
    root is early in them, and a node holds the OR-combined bitmap of its sets' shingles, their size range and their
    component range.

    Sets are first compared with the first set of their roots' size ranges; verified links give components. Below roots of many
    sets and more than one component, further sets are drawn to compare with, as long as that links many.
    Then only roots over more than one component are open: the dual traversal joins the nodes of a
    root with each other and drops node pairs that are one component, whose sizes don't fit or whose most
    possible overlap is too small, and goes on with the sets of the rest by the same bound. What is
    left is verified on whole sets. Pairs inside a component need no look, as only classes are asked for.

    Words are runs without ASCII white space, A to Z lower-cased. A text of fewer than k words is one
    shingle; a null text, or one without words, has no set and links with nothing. A null doc_id
    stays null, and is a class's id only if all its doc_ids are null. Repeated rows have equal sets. An empty table gives an
    empty table. Other columns are not read.
    """
    with small_batches(docs.sparkSession, BATCH):
        return _classes(docs, k, percent, doc_id, text)


def _classes(docs: DataFrame, k: int, percent: int, doc_id: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    heavy = source.select("text").mapInArrow(_root_counts(k, percent), "token long, n long").groupBy("token").agg(
        F.sum("n").alias("n")).where(F.col("n") > HEAVY).orderBy(F.desc("n"), "token").limit(MAX_HEAVY).toArrow()
    heavy = spark.sparkContext.broadcast(np.sort(np.asarray(heavy.column("token"), dtype=np.int64).view(np.uint64)))
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = materialize(source.mapInArrow(
        _signatures(k, percent, heavy),
        f"id {kind}, n long, s1 long, s2 long, roots array<long>, bitmap array<long>, hidden long, fine array<long>"), "signatures")
    sets = materialize(rows.where("n > 0").groupBy("s1", "s2", "n").agg(
        F.min("id").alias("least"), *[F.first(c).alias(c) for c in ("roots", "bitmap", "hidden", "fine")]).withColumn(
        "node", F.monotonically_increasing_id()), "sets")
    light = materialize(rows.select("id", "n", "s1", "s2"), "sizes")
    discard(rows)
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent))).cast("int")
    members = sets.select("node", "n", band.alias("band"), F.posexplode("roots").alias("place", "token"))
    shared = members.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1").select("token")
    members = materialize(members.join(shared, "token"), "members")

    maps = sets.select("node", "n", "bitmap", "fine", "hidden")

    a_maps = maps.select(F.col("node").alias("a"), F.struct("n", "bitmap", "fine").alias("x"))
    b_maps = maps.select(F.col("node").alias("b"), F.struct("n", "bitmap", "fine").alias("y"))

    # First every set with a few centres: the first sets below its roots that it may link with.
    links = _verified(_stars(members.withColumn("class", F.col("node")), a_maps, b_maps, percent, None), source, sets, k, percent)
    classes = connected_components(links)

    # Then the roots over more than one class. Below tall ones other centres are drawn where the sets make very many
    # pairs, until that links few sets more.
    n_sets, n_more, seed = sets.count(), links.count(), 0
    while True:
        placed_mixed = _mixed(members, classes)
        n_tall, n_pairs = _tall(placed_mixed)
        if n_pairs <= SPARSE * n_sets or n_more * FEW < n_tall:
            break
        seed += 1
        more = _verified(_stars(placed_mixed.where("tall"), a_maps, b_maps, percent, seed), source, sets, k, percent)
        n_more = more.count()
        if not n_more:
            break
        links = links.unionByName(more)
        classes = connected_components(links)
        discard(placed_mixed)
    tries = TRIES
    while True:
        tried = _open_pairs(placed_mixed, sets, a_maps, b_maps, percent, tries)
        discard(placed_mixed)
        open_pairs = tried.where(F.col("may") & (F.col("place") <= tries)).select("a", "b")
        n_open = open_pairs.count()
        if n_open > n_sets:
            links, classes = _linked(open_pairs, links, classes, source, sets, k, percent)
        elif n_open:  # few enough to be verified at once
            links = links.unionByName(_verified(open_pairs, source, sets, k, percent))
            classes = connected_components(links)
        # Classes with further pairs that no link has made one: they are looked at again, with more pairs.
        unseen = tried.where(F.col("more") | (F.col("place") > tries)).select("low", "high").distinct()
        one = classes.select(F.col("node").alias("low"), F.col("component").alias("cl"))
        two = classes.select(F.col("node").alias("high"), F.col("component").alias("ch"))
        done = unseen.isEmpty() or unseen.join(one, "low", "left").join(two, "high", "left").where(
            F.coalesce("cl", "low") != F.coalesce("ch", "high")).isEmpty()
        discard(tried)
        if done:
            break
        tries *= 16
        placed_mixed = _mixed(members, classes)
    discard(members)

    smallest = sets.select("node", "least").join(classes, "node").groupBy("component").agg(F.min("least").alias("smallest"))
    known = sets.select("node", "s1", "s2", "n", "least").join(classes, "node", "left").join(smallest, "component", "left").select(
        "s1", "s2", "n", F.coalesce("smallest", "least").alias("class_id"))
    known = materialize(known, "known")
    discard(sets)
    out = light.join(known, ["s1", "s2", "n"], "left")
    return out.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"),
                      F.coalesce("class_id", "id").alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each class the document with the smallest doc_id, with all its columns.

    Repeated rows of one doc_id and text are one document: one stays. Documents without words all stay.
    """
    classes = jaccard_classes(docs, k, percent, doc_id, text)
    kept = classes.where(F.col("component_id").eqNullSafe(F.col(doc_id))).select(F.col(doc_id).alias("__kept")).distinct()
    rows = docs.join(kept, F.col(doc_id).eqNullSafe(F.col("__kept")), "left_semi")
    return rows.withColumn("__text", F.xxhash64(F.col(text))).withColumn("__size", F.length(F.col(text))).dropDuplicates(
        [doc_id, "__text", "__size"]).drop("__text", "__size")
