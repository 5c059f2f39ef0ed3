"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, functions as F

from platewise.llm.common import LOWER, SPACE, hash52, joined_bytes, release, shared, text_chunks

BUCKETS = 1 << 15
GRAMS = (2, 3, 4)  # bytes of a subword; white space marks the ends of words
MAX_LABELS = 1000
EMBED_RATE = 100.0  # a subword's share of a document is small: its embedding moves by this much more
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def subwords(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all subwords of a block of texts, and the text of each."""
    low = LOWER[raw]
    low = np.where(SPACE[low], np.uint8(32), low).astype(np.uint32)
    doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    buckets, docs = [], []
    h = low
    for k in range(2, max(GRAMS) + 1):
        n = len(low) - k + 1
        if n <= 0:
            break
        h = h[:n] * np.uint32(0x01000193) ^ low[k - 1:]
        if k in GRAMS:
            ok = doc[:n] == doc[k - 1:]
            x = (h + np.uint32(k)) * np.uint32(0x9E3779B1)
            buckets.append(((x ^ (x >> np.uint32(15)))[ok] & np.uint32(BUCKETS - 1)).astype(np.int32))
            docs.append(doc[:n][ok])
    if not buckets:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(buckets), np.concatenate(docs)


def has_letter(texts: pa.Array, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    ascii_letters = np.concatenate([[0], np.cumsum((LOWER[raw] >= 97) & (LOWER[raw] <= 122))])
    found = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
    for i in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[i] = _LETTER.search(texts[int(i)].as_py()) is not None
    return found


@dataclass
class LanguageModel:
    """``table``: for each bucket, its embedding times the softmax weights; the rest follows from the mean."""

    labels: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least_score: float = 0.0
    accuracy: float = 0.0

    def logits(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total = np.zeros((len(offsets) - 1, len(self.labels)))
        count = np.zeros(len(offsets) - 1)
        buckets, docs = subwords(raw, offsets)
        step = max(1024, (1 << 21) // len(self.labels))
        for a in range(0, len(buckets), step):
            b, d = buckets[a:a + step], docs[a:a + step]
            begin = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
            np.add.at(total, d[begin], np.add.reduceat(self.table[b], begin, axis=0))
            np.add.at(count, d[begin], np.diff(np.append(begin, len(d))))
        return total / np.maximum(count, 1)[:, None] + self.bias

    def predict(self, texts: pa.Array) -> pa.Array:
        """Struct array (lang, score, accepted)."""
        langs, scores = [], []
        names = np.array([*self.labels, UNKNOWN], dtype=object)
        for a, b in text_chunks(texts):
            part = texts.slice(a, b - a)
            raw, offsets = joined_bytes(part)
            if not self.labels:
                langs += [UNKNOWN] * (b - a)
                scores.append(np.zeros(b - a))
                continue
            p = softmax(self.logits(raw, offsets) / self.temperature)
            known = has_letter(part, raw, offsets)
            langs += names[np.where(known, p.argmax(axis=1), len(self.labels))].tolist()
            scores.append(np.where(known, p.max(axis=1), 0.0))
        score = np.concatenate(scores) if scores else np.zeros(0)
        accepted = (score >= self.least_score) & (np.array(langs, dtype=object) != UNKNOWN)
        return pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()), pa.array(score, pa.float64()), pa.array(accepted.astype(bool), pa.bool_())],
            ["lang", "score", "accepted"])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _sample_features(batches):
    release()
    for batch in batches:
        for a, b in text_chunks(batch.column("text")):
            raw, offsets = joined_bytes(batch.column("text").slice(a, b - a))
            buckets, docs = subwords(raw, offsets)
            pairs, counts = np.unique(docs.astype(np.int64) * BUCKETS + buckets, return_counts=True)
            bounds = np.searchsorted(pairs, np.arange(b - a + 1, dtype=np.int64) * BUCKETS)
            buckets = (pairs % BUCKETS).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").slice(a, b - a), batch.column("place").slice(a, b - a),
                 pa.array([packed(buckets[i:j], counts[i:j]) for i, j in zip(bounds, bounds[1:])], pa.binary())],
                ["label", "place", "bag"])


def packed(buckets: np.ndarray, counts: np.ndarray) -> bytes:
    """A document's distinct buckets and their counts: two bytes a bucket, and one a count where none is above 255."""
    small = int(counts.max(initial=0) < 256)
    return bytes([small]) + buckets.tobytes() + counts.astype(np.uint8 if small else np.float32).tobytes()


def unpacked(bag: bytes) -> tuple[np.ndarray, np.ndarray]:
    kind = np.uint8 if bag[0] else np.float32
    n = (len(bag) - 1) // (2 + np.dtype(kind).itemsize)
    return (np.frombuffer(bag, np.uint16, n, 1).astype(np.int32),
            np.frombuffer(bag[1 + 2 * n:], kind, n).astype(np.float32))


def train(docs: DataFrame, rows_per_label: int = 1500, text: str = "text", label: str = "lang", doc_id: str = "doc_id",
          dim: int = 16, epochs: int = 6, rate: float = 0.5, reject_share: float = 0.001, seed: int = 7) -> LanguageModel:
    """Fit the model on a bounded sample of the labelled rows of ``docs``.

    Of each label about ``rows_per_label`` rows are taken, those with the smallest hashes of doc_id (all, if
    there are fewer); tasks turn whole texts into bucket counts, and only these reach the driver. A fifth of
    the sample is held back: it sets the temperature that makes scores fit observed hits, and the least
    score, below which ``reject_share`` of these rows lie. Rows without a label or text take no part;
    without any, the model answers "und". More than MAX_LABELS labels raise an error.
    """
    rows = docs.select(F.col(text).cast("string").alias("text"), F.col(label).cast("string").alias("label"),
                       hash52(F.col(doc_id)).alias("place")).where("label is not null and text <> ''")
    sizes = rows.groupBy("label").count().limit(MAX_LABELS + 1).collect()
    if len(sizes) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    if not sizes:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0))
    share = F.create_map(*[x for r in sizes for x in (
        F.lit(r["label"]), F.lit(int(min(1.0, rows_per_label / r["count"]) * 2 ** 52)))])
    sample = rows.where(F.col("place") < share[F.col("label")]).mapInArrow(
        _sample_features, "label string, place long, bag binary").toArrow()
    order = pc.sort_indices(sample, [("place", "ascending"), ("label", "ascending")])
    labels = sorted({r["label"] for r in sizes})
    return fit(labels, sample, np.asarray(order), dim, epochs, rate, reject_share, seed)


def fit(labels: list[str], sample: pa.Table, order: np.ndarray, dim: int, epochs: int, rate: float, reject_share: float, seed: int) -> LanguageModel:
    """Stochastic gradient descent, one document a step, with a falling rate. The sample's rows count in ``order``; it is
    held packed, as it came, and never copied."""
    number = {x: i for i, x in enumerate(labels)}
    y = np.array([number[x] for x in sample.column("label").to_pylist()])[order]
    bags = sample.column("bag")
    chunks = bags.chunks
    starts = np.cumsum([0, *[len(c) for c in chunks]])

    def raw(i: int) -> bytes:
        chunk = int(np.searchsorted(starts, order[i], "right")) - 1
        return chunks[chunk][int(order[i] - starts[chunk])].as_py()

    keep = np.concatenate([np.asarray(pc.binary_length(c)) for c in chunks] or [np.zeros(0, int)])[order] > 1
    held = np.arange(len(y)) % 5 == 4
    rng = np.random.default_rng(seed)
    k = len(labels)
    embed = rng.normal(0, 0.1, (BUCKETS, dim)).astype(np.float32)
    weight = rng.normal(0, 0.1, (dim, k)).astype(np.float32)
    bias = np.zeros(k, np.float32)
    rows = np.flatnonzero(keep & ~held)
    steps, done = max(1, epochs * len(rows)), 0

    def bag(i: int) -> tuple[np.ndarray, np.ndarray]:
        buckets, share = unpacked(raw(i))
        return buckets, share / share.sum()  # a document's buckets are distinct

    for _ in range(epochs):
        for i in rng.permutation(rows):
            b, share = bag(i)
            own = embed[b]
            mean = share @ own
            z = mean @ weight + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            now = rate * (1 - done / steps)
            back = weight @ p
            weight -= now * np.outer(mean, p)
            bias -= 0.01 * now * p
            embed[b] = own - now * EMBED_RATE * np.outer(share, back)
            done += 1
    model = LanguageModel(labels, (embed @ weight).astype(np.float32), bias.astype(np.float64))
    test = np.flatnonzero(keep & held)
    if not len(test):
        test = rows
    if len(test):
        z = np.stack([share @ model.table[b] + model.bias for b, share in map(bag, test)])
        own = np.arange(len(test)), y[test]
        loss = {t: -np.log(np.maximum(softmax(z / t)[own], 1e-12)).mean() for t in np.geomspace(0.05, 8.0, 41)}
        model.temperature = float(min(loss, key=loss.get))
        top = softmax(z / model.temperature).max(axis=1)
        model.least_score = float(np.quantile(top, reject_share) * 0.8)
        model.accuracy = float((z.argmax(axis=1) == y[test]).mean())
    return model


def predictor(spark, model: LanguageModel):
    """A column function: text to struct<lang, score, accepted>. The broadcast is BUCKETS times the labels."""
    held = shared(spark, model)

    @F.arrow_udf("struct<lang:string,score:double,accepted:boolean>")
    def language(texts: pa.Array) -> pa.Array:
        return held().predict(texts)

    return language


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add lang_pred, score and accepted to every row, from its whole text.

    ``lang_pred`` is the likeliest label, or "und" where the text is null or holds no letter (score 0).
    ``accepted`` is false for "und" and for scores below the model's calibrated least score. Texts too short
    for a subword get the prior. No shuffle; input columns of these names are replaced.
    """
    found = docs.drop("lang_pred", "score", "accepted").withColumn(
        "__language", predictor(docs.sparkSession, model)(F.col(text).cast("string")))
    return found.withColumns({"lang_pred": F.col("__language.lang"), "score": F.col("__language.score"),
                              "accepted": F.col("__language.accepted")}).drop("__language")


def in_training(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 != 2
