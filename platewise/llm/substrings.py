"""Removal of repeated word sequences with suffix automata of reference shards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from platewise.llm.common import PRIME, Words, discard, materialize, mix, ragged, text_chunks

ANCHOR = 4  # words of an anchor
SHARD_WORDS = 100_000  # words of a reference shard, about
HOT = 1_000  # distinct passages below one anchor; beyond that its windows are matched one by one
NOWHERE = (1 << 63) - 1


def anchored_passages(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first word, words) of passages that cover every window of every text.

    A window's anchor is its word run of the smallest hash (the first of equal ones), so equal windows have
    equal anchors wherever they stand. A passage spans the consecutive windows of one anchor.
    """
    size = min(ANCHOR, window)
    grams, at = words.grams(size)
    reach = window - size + 1  # anchors a window chooses from
    if len(grams) < reach:
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none, none
    spans = np.lib.stride_tricks.sliding_window_view(mix(grams), reach)
    inside = np.flatnonzero(at[reach - 1:] - at[:len(at) - reach + 1] == reach - 1)
    inside = inside[words.doc[at[inside]] == words.doc[at[inside + reach - 1]]]
    best = inside + spans[inside].argmin(axis=1)
    new = np.ones(len(best), bool)
    new[1:] = (best[1:] != best[:-1]) | (inside[1:] != inside[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(best)))
    return grams[best[first]], at[inside[first]], count + window - 1


class SuffixAutomaton:
    """All factors of a shard's passages. ``least`` of a state: the smallest document that holds its factors."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.least = [-1], [0], [NOWHERE]

    def _state(self, length: int, next_: dict[int, int], link: int) -> int:
        self.next.append(next_)
        self.length.append(length)
        self.link.append(link)
        self.least.append(NOWHERE)
        return len(self.length) - 1

    def add(self, passage: list[int], document: int) -> None:
        last, nexts, link, length, least = 0, self.next, self.link, self.length, self.least
        for word in passage:
            known = nexts[last].get(word)
            if known is not None and length[known] == length[last] + 1:
                last = known
            else:
                p = last
                if known is None:
                    new = self._state(length[last] + 1, {}, 0)
                    while p >= 0 and word not in nexts[p]:
                        nexts[p][word] = new
                        p = link[p]
                    if p >= 0:
                        q = nexts[p][word]
                        link[new] = q if length[q] == length[p] + 1 else self._clone(p, q, word)
                else:
                    new = self._clone(last, known, word)
                last = new
            if document < least[last]:
                least[last] = document

    def _clone(self, p: int, q: int, word: int) -> int:
        twin = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = twin
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = twin
            p = self.link[p]
        return twin

    def settle(self) -> None:
        """A state's factors also end wherever those of the states that link to it end."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            up = self.link[state]
            if self.least[state] < self.least[up]:
                self.least[up] = self.least[state]

    def stream(self, passage: list[int], window: int) -> list[int]:
        """Matching statistics of a passage: for each window, the smallest document that holds it, or NOWHERE."""
        state, matched, out = 0, 0, []
        nexts, link, length, least = self.next, self.link, self.length, self.least
        for i, word in enumerate(passage):
            while state and word not in nexts[state]:
                state = link[state]
                matched = length[state]
            if word in nexts[state]:
                state = nexts[state][word]
                matched += 1
            while state and length[link[state]] >= window:
                state = link[state]
                matched = length[state]
            if i >= window - 1:
                out.append(least[state] if matched >= window else NOWHERE)
        return out


def _anchors(window: int):
    """Distinct anchors of each text."""
    def run(batches):
        for batch in batches:
            for a, b in text_chunks(batch.column("text")):
                words = Words(batch.column("text").slice(a, b - a))
                keys, first, _ = anchored_passages(words, window)
                doc = words.doc[first]
                order = np.lexsort((keys, doc))
                keys, doc = keys[order], doc[order]
                new = np.ones(len(keys), bool)
                new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
                bounds = np.searchsorted(doc[new], np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a), ragged(keys[new].view(np.int64), bounds)], ["id", "anchors"])
    return run


def _passages(window: int):
    """The passages of each text below anchors that the text shares with another one."""
    def run(batches):
        for batch in batches:
            for a, b in text_chunks(batch.column("text")):
                words = Words(batch.column("text").slice(a, b - a))
                keys, first, size = anchored_passages(words, window)
                lists = batch.column("anchors").slice(a, b - a)
                wanted = np.asarray(lists.flatten(), dtype=np.int64).view(np.uint64)
                owner = np.repeat(np.arange(b - a), np.asarray(pc.list_value_length(lists).fill_null(0)))
                doc = words.doc[first]
                mark = lambda k, d: mix(k ^ mix(d.astype(np.uint64)))
                some = np.flatnonzero(np.isin(mark(keys, doc), mark(wanted, owner)))
                keys, first, size, doc = keys[some], first[some], size[some], doc[some]
                bounds = np.concatenate([[0], np.cumsum(size)])
                place = np.repeat(first - bounds[:-1], size) + np.arange(bounds[-1])
                step = mix(words.hashes[place] + (np.arange(bounds[-1]) - np.repeat(bounds[:-1], size)).astype(np.uint64) * PRIME)
                content = np.add.reduceat(step, bounds[:-1]).view(np.int64) if len(size) else np.zeros(0, np.int64)
                ids = batch.column("id").slice(a, b - a).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array((first - words.bounds[doc]).astype(np.int32)), pa.array(size.astype(np.int32)),
                     pa.array(keys.view(np.int64)), pa.array(content)], ["id", "start", "size", "anchor", "content"])
    return run


def _symbols(batches):
    """The words (as 32-bit symbols) of the passages that are asked for of each text."""
    for batch in batches:
        for a, b in text_chunks(batch.column("text")):
            words = Words(batch.column("text").slice(a, b - a))
            lists = batch.column("asked").slice(a, b - a)
            asked, counts = lists.flatten(), np.asarray(pc.list_value_length(lists), dtype=np.int64)
            size = np.asarray(asked.field("size"), dtype=np.int64)
            first = np.asarray(asked.field("start"), dtype=np.int64) + np.repeat(words.bounds[:-1], counts)
            bounds = np.concatenate([[0], np.cumsum(size)])
            fits = first + size <= np.repeat(words.bounds[1:], counts)  # false in another row of the same doc_id
            place = np.repeat(first - bounds[:-1], size) + np.arange(bounds[-1])
            symbols = (words.hashes[np.minimum(place, max(len(words.hashes) - 1, 0))] >> np.uint64(32)).astype(np.uint32) \
                if len(words.hashes) else np.zeros(len(place), np.uint32)
            step = words.hashes[np.minimum(place, max(len(words.hashes) - 1, 0))] if len(words.hashes) else np.zeros(len(place), np.uint64)
            step = mix(step + (np.arange(bounds[-1]) - np.repeat(bounds[:-1], size)).astype(np.uint64) * PRIME)
            same = np.add.reduceat(step, bounds[:-1]).view(np.int64) if len(size) else np.zeros(0, np.int64)
            fits &= same == np.asarray(asked.field("content"), dtype=np.int64)
            rows = pa.RecordBatch.from_arrays(
                [asked.field(c) for c in ("anchor", "content", "least", "most")] + [ragged(symbols.view(np.int32), bounds)],
                ["anchor", "content", "least", "most", "words"])
            yield rows.filter(pa.array(fits))


def _match_shard(window: int):
    """Build the automaton of a shard's distinct passages and stream them through it."""
    def run(shard: pa.Table) -> pa.Table:
        least = np.asarray(shard.column("least"), dtype=np.int64).tolist()
        most = np.asarray(shard.column("most"), dtype=np.int64).tolist()
        passages = shard.column("words").to_pylist()
        automaton = SuffixAutomaton()
        for passage, document in zip(passages, least):
            automaton.add(passage, document)
        automaton.settle()
        keep, found = [], []
        for i, passage in enumerate(passages):
            documents = automaton.stream(passage, window)
            if min(documents) < most[i]:
                keep.append(i)
                found.append(documents)
        rows = shard.take(pa.array(keep, pa.int64()))
        return pa.table({"anchor": rows.column("anchor"), "content": rows.column("content"), "held_by": pa.array(found, pa.list_(pa.int64()))})
    return run


def _removal(window: int):
    def run(batches):
        for batch in batches:
            for a, b in text_chunks(batch.column("text")):
                words = Words(batch.column("text").slice(a, b - a))
                lists = batch.column("starts").slice(a, b - a)
                lengths = np.asarray(pc.list_value_length(lists).fill_null(0), dtype=np.int64)
                starts = np.asarray(lists.flatten(), dtype=np.int64) + np.repeat(words.bounds[:-1], lengths)
                n = len(words.starts)
                step = np.zeros(n + 1, np.int32)
                np.add.at(step, starts, 1)
                np.add.at(step, starts + window, -1)
                gone = np.cumsum(step[:n]) > 0
                total = np.diff(words.bounds)
                removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[words.bounds])
                kept = np.flatnonzero(~gone)
                size = words.ends[kept] - words.starts[kept] + 1  # with a space each
                upto = np.cumsum(size)
                source = np.append(words.raw, np.uint8(32))
                place = np.repeat(words.starts[kept] - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)
                body = source[place]
                body[upto - 1] = 32
                bounds = np.concatenate([[0], upto])[np.concatenate([[0], np.cumsum(~gone)])[words.bounds]]
                text = body.tobytes()
                out = [text[x:max(x, y - 1)].decode("utf-8") for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                # Maximal removed spans, in words of the document.
                edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
                cut = np.zeros(n + 1, bool)
                cut[words.bounds] = True
                begin = np.flatnonzero((edge[:n] == 1) | (gone & cut[:n]))
                after = np.append(gone[1:], False)
                end = np.flatnonzero(gone & (~after | cut[1:n + 1])) + 1
                doc = words.doc[begin] if n else begin
                spans = pa.StructArray.from_arrays(
                    [pa.array(begin - words.bounds[doc]), pa.array(end - words.bounds[doc])], ["start", "end"])
                span_bounds = np.searchsorted(doc, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a), pa.array(total), pa.array(removed.astype(np.int64)),
                     pa.array(out, pa.string()),
                     pa.ListArray.from_arrays(pa.array(span_bounds, pa.int32()), spans)],
                    ["id", "n_words", "n_removed", "kept", "spans"])
    return run


def remove_repeats(docs: DataFrame, window: int = 13, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Remove each word that lies in ``window`` consecutive words which also start in a document of smaller doc_id.

    Result: doc_id, n_words, n_removed, kept (the kept words joined by one space) and spans (maximal removed
    runs of words, end exclusive). All windows are judged on the input.

    Every text is cut into passages by anchors: equal windows lie below equal anchors, whatever surrounds
    them. Only passages below anchors of two or more documents go on, each distinct one once, with the smallest
    document that holds it; one that is alone below its anchor is settled by that. The others' anchors deal them to reference shards of about SHARD_WORDS words, and the task of a shard
    builds a suffix automaton over its passages and streams them through it: the matching statistics say
    for each window which smallest document holds it. So a passage meets the one automaton that can hold its
    windows, instead of every shard's; nothing is broadcast. Below an anchor of more than HOT distinct passages
    (a common passage in many surroundings) windows are matched one by one by aggregation, which needs no group in memory.

    Words are runs without ASCII white space, unchanged, known by hashes: 64 bits
    for anchors and passages, 32 bits for the single words inside passages of one anchor. A null or empty text has no words. A null
    doc_id is neither smaller nor larger: it keeps all words and takes none from others. Repeated rows of a
    doc_id don't remove each other's words, nor does a document its own. An empty table gives an empty table.
    Other columns are not read. doc_id must be a whole number.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    source = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    named = source.where("id is not null").withColumn("id", F.col("id").cast("long"))
    anchors = named.mapInArrow(_anchors(window), "id long, anchors array<long>").select("id", F.explode("anchors").alias("anchor"))
    shared = anchors.groupBy("anchor").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("anchor")
    mine = materialize(anchors.join(shared, "anchor").groupBy("id").agg(F.collect_set("anchor").alias("anchors")), "anchors")
    passages = materialize(named.join(mine, "id").select("id", "text", "anchors").mapInArrow(
        _passages(window), "id long, start int, size int, anchor long, content long"), "passages")
    discard(mine)
    contents = materialize(passages.groupBy("anchor", "content").agg(
        F.min("id").alias("least"), F.max("id").alias("most"), F.min_by(F.struct("start", "size"), "id").alias("place")), "contents")
    # A passage alone below its anchor shares its windows with no other passage: its smallest document holds them all.
    below = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.sum("place.size").alias("words")).where("n > 1")
    total = below.where(F.col("n") <= HOT).agg(F.sum("words")).first()[0] or 0
    shards = max(1, -(-total // SHARD_WORDS))
    below = below.select("anchor", (F.col("n") > HOT).alias("hot"))
    alone = contents.join(below, "anchor", "left_anti").where("least < most").select("anchor", "content", F.array_repeat(
        "least", F.col("place.size") - (window - 1)).alias("held_by"))
    asked = contents.join(below.select("anchor"), "anchor").groupBy(F.col("least").alias("id")).agg(F.collect_list(F.struct(
        "place.start", "place.size", "anchor", "content", "least", "most")).alias("asked"))
    worded = materialize(named.join(asked, "id").select("text", "asked").mapInArrow(
        _symbols, "anchor long, content long, least long, most long, words array<int>").dropDuplicates(["anchor", "content"]), "words")
    known = worded.join(below, "anchor")
    cold = known.where("not hot").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    matched = cold.select("shard", "anchor", "content", "least", "most", "words").groupBy("shard").applyInArrow(
        _match_shard(window), "anchor long, content long, held_by array<long>")
    single = known.where("hot").select("anchor", "content", "least", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.size("words") - (window - 1)), lambda i: F.slice("words", i, window))).alias("i", "w"))
    single = single.withColumn("w1", F.xxhash64("w")).withColumn("w2", F.xxhash64("w", F.lit(1))).drop("w")
    lowest = single.groupBy("w1", "w2").agg(F.min("least").alias("by"))
    one_by_one = single.join(lowest, ["w1", "w2"]).groupBy("anchor", "content").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "by"))), lambda x: x["by"]).alias("held_by"))
    held = materialize(matched.unionByName(one_by_one).unionByName(alone), "held")
    discard(contents, worded)
    starts = passages.select("id", "start", "anchor", "content").join(held, ["anchor", "content"]).select("id", F.expr(
        "transform(filter(sequence(0, size(held_by) - 1), i -> held_by[i] < id), i -> start + i)").alias("starts"))
    starts = materialize(starts.where(F.size("starts") > 0).groupBy("id").agg(
        F.array_distinct(F.flatten(F.collect_list("starts"))).alias("starts")), "starts")
    discard(passages, held)
    joined = source.join(starts.withColumnRenamed("id", "__id"), F.col("id") == F.col("__id"), "left").select("id", "text", "starts")
    out = joined.mapInArrow(
        _removal(window), f"id {kind}, n_words long, n_removed long, kept string, spans array<struct<start:long,end:long>>")
    return out.withColumnRenamed("id", doc_id)
