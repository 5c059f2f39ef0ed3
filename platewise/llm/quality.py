"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from platewise.llm.common import PRIME, Words, hash52, hash_slices, materialize, mix, shared, text_chunks

STATISTICS = (
    "log_bytes", "log_words", "word_mean", "word_spread", "upper", "digit", "punct", "symbol", "white", "newline",
    "non_ascii", "distinct_words", "top_word", "repeated_pairs", "log_lines", "line_mean", "repeated_lines",
    "sentence_ends", "capital_words", "upper_words", "short_words", "long_words", "byte_entropy", "first_upper",
)


def _inside(raw: np.ndarray, low: int, high: int) -> np.ndarray:
    return (raw >= low) & (raw <= high)


def _distinct(doc: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, and the count of the most frequent one, of each document."""
    if not len(hashes):
        return np.zeros(n), np.zeros(n)
    keys = np.sort(mix(hashes ^ (doc.astype(np.uint64) * PRIME)) >> np.uint64(20) | (doc.astype(np.uint64) << np.uint64(44)))
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.append(begin, len(keys)))
    owner = (keys[begin] >> np.uint64(44)).astype(np.int64)
    most = np.zeros(n)
    np.maximum.at(most, owner, size)
    return np.bincount(owner, minlength=n).astype(float), most


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS per whole text; a null text counts as empty."""
    words = Words(texts)
    raw, offsets, n = words.raw, words.offsets, len(texts)

    def per(mask: np.ndarray, bounds: np.ndarray = offsets) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(mask)])[bounds]).astype(float)

    size = np.maximum(np.diff(offsets), 1).astype(float)
    n_words = np.diff(words.bounds).astype(float)
    some = np.maximum(n_words, 1)
    upper, low, digit = _inside(raw, 65, 90), _inside(raw, 97, 122), _inside(raw, 48, 57)
    white, far = raw <= 32, raw >= 128
    punct = np.isin(raw, np.frombuffer(b".,;:!?'\"()-", np.uint8))
    symbol = ~(upper | low | digit | white | far | punct)
    length = (words.ends - words.starts).astype(float)
    mean = per(length, words.bounds) / some
    spread = np.sqrt(np.maximum(per(length ** 2, words.bounds) / some - mean ** 2, 0))
    kinds, top = _distinct(words.doc, words.hashes, n)
    pairs, at = words.grams(2)
    pair_kinds, _ = _distinct(words.doc[at], pairs, n)
    n_pairs = np.bincount(words.doc[at], minlength=n).astype(float)
    # Lines: the stretches between line feeds.
    breaks = np.flatnonzero(raw == 10)
    line_start = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_start = line_start[line_start < len(raw)]
    doc_of = np.searchsorted(offsets, line_start, "right") - 1
    next_break = np.append(breaks, len(raw))[np.searchsorted(breaks, line_start)]
    line_end = np.minimum(next_break, offsets[np.minimum(doc_of + 1, n)])
    real = line_end > line_start
    line_start, line_end, doc_of = line_start[real], line_end[real], doc_of[real]
    lines = np.bincount(doc_of, minlength=n).astype(float)
    line_kinds, _ = _distinct(doc_of, hash_slices(raw, line_start, line_end), n)
    first = raw[words.starts] if len(words.starts) else np.zeros(0, np.uint8)
    last = raw[words.ends - 1] if len(words.starts) else first
    ups = np.concatenate([[0], np.cumsum(upper)])
    all_up = (ups[words.ends] - ups[words.starts] == length) & (length > 1)
    bytes_ = np.bincount(np.repeat(np.arange(n) * 256, np.diff(offsets)) + raw, minlength=n * 256).reshape(n, 256) / size[:, None]
    entropy = -(bytes_ * np.log2(np.maximum(bytes_, 1e-12))).sum(axis=1)
    head = np.zeros(n)
    full = np.diff(offsets) > 0
    head[full] = upper[offsets[:-1][full]]
    return np.column_stack([
        np.log1p(np.diff(offsets)), np.log1p(n_words), mean, spread, per(upper) / size, per(digit) / size, per(punct) / size,
        per(symbol) / size, per(white) / size, per(raw == 10) / size, per(far) / size, kinds / some, top / some,
        1 - pair_kinds / np.maximum(n_pairs, 1), np.log1p(lines), size / np.maximum(lines, 1),
        1 - line_kinds / np.maximum(lines, 1), per(np.isin(last, [33, 46, 63]), words.bounds) / some,
        per(_inside(first, 65, 90), words.bounds) / some, per(all_up, words.bounds) / some,
        per(length <= 2, words.bounds) / some, per(length >= 12, words.bounds) / some, entropy, head,
    ]) if n else np.zeros((0, len(STATISTICS)))


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def document_statistics(texts: pa.Array) -> pa.Array:
    parts = [statistics(texts.slice(a, b - a)) for a, b in text_chunks(texts)]
    rows = np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))
    flat = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), len(STATISTICS))
    return flat.cast(pa.list_(pa.float64()))


@dataclass
class Trees:
    """Boosted trees as flat arrays: node i goes to left[i] if feature[i] <= cut[i], else to left[i] + 1; leaves have left -1."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while True:
                child = self.left[at]
                moving = child >= 0
                if not moving.any():
                    break
                at = np.where(moving, child + (x[rows, self.feature[at]] > self.cut[at]), at)
            total += self.value[at]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
              least: int = 20, ridge: float = 1.0) -> Trees:
    """Histogram gradient boosting for the log loss; the histogram of a sibling is its parent's minus the other's."""
    rows, width = x.shape
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if rows else 0.5
    base = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)] if rows else []
    binned = np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)]) if rows else np.zeros((0, width), int)
    flat = binned + np.arange(width) * bins
    feature, cut, left, value, roots = [], [], [], [], []

    def node() -> int:
        for a, v in ((feature, 0), (cut, 0.0), (left, -1), (value, 0.0)):
            a.append(v)
        return len(left) - 1

    def histogram(some, g, h):
        where = flat[some].ravel()
        return np.stack([np.bincount(where, np.repeat(w, width), width * bins).reshape(width, bins)
                         for w in (g[some], h[some], np.ones(len(some)))])

    f = np.full(rows, base)
    for _ in range(rounds if rows and 0 < y.sum() < rows else 0):
        p = 1 / (1 + np.exp(-f))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        roots.append(node())
        todo = [(roots[-1], np.arange(rows), 0, histogram(np.arange(rows), g, h))]
        while todo:
            at, some, level, hist = todo.pop()
            value[at] = -rate * g[some].sum() / (h[some].sum() + ridge)
            if level < depth and len(some) >= 2 * least:
                gl, hl, nl = np.cumsum(hist, axis=2)
                gt, ht = g[some].sum(), h[some].sum()
                gain = gl ** 2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt ** 2 / (ht + ridge)
                gain[(nl < least) | (len(some) - nl < least)] = -1
                j, b = np.unravel_index(np.argmax(gain), gain.shape)
                if gain[j, b] > 1e-6 and b < len(cuts[j]):
                    goes = binned[some, j] <= b
                    lo, hi = node(), node()
                    feature[at], cut[at], left[at] = j, float(cuts[j][b]), lo
                    left_is_small = 2 * goes.sum() <= len(some)
                    part = histogram(some[goes] if left_is_small else some[~goes], g, h)
                    todo.append((lo, some[goes], level + 1, part if left_is_small else hist - part))
                    todo.append((hi, some[~goes], level + 1, hist - part if left_is_small else part))
                    continue
            f[some] += value[at]
    return Trees(base, *[np.array(a) for a in (roots, feature, cut, left, value)])


def with_statistics(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and ``stats`` of every row, written once: training and scoring read these light rows."""
    return materialize(docs.select(F.col(doc_id).alias("doc_id"),
                                   document_statistics(F.col(text).cast("string")).alias("stats")), "statistics")


def train(stats: DataFrame, labels: DataFrame, rows: int = 50_000, label: str = "quality") -> Trees:
    """Fit the trees on at most about ``rows`` labelled documents, those with the smallest hashes of doc_id.

    ``stats``: doc_id, stats. ``labels``: doc_id and a 0/1 label; null labels take no part. Only the
    sampled numbers reach the driver. Without labels every score is 0.5; with one class it is near that class.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where("y in (0, 1) and doc_id is not null")
    count = known.count()
    keep = int(min(1.0, rows / max(count, 1)) * 2 ** 52)
    known = known.withColumn("place", hash52(F.col("doc_id"))).where(F.col("place") < keep)
    sample = stats.join(known, "doc_id").select("place", "y", "stats").toArrow()
    sample = sample.take(pc.sort_indices(sample, [("place", "ascending"), ("y", "ascending")]))
    x = np.asarray(sample.column("stats").combine_chunks().flatten()).reshape(-1, len(STATISTICS))
    y = np.asarray(sample.column("y").combine_chunks()).astype(float)
    return fit_trees(x, y)


def score(stats: DataFrame, trees: Trees) -> DataFrame:
    """Add ``score`` (0 to 1, higher: label 1 likelier) to rows of ``with_statistics``; empty and null texts too."""
    held = shared(stats.sparkSession, trees)

    @F.arrow_udf("double")
    def trees_score(rows: pa.Array) -> pa.Array:
        x = np.asarray(rows.flatten()).reshape(-1, len(STATISTICS))
        return pa.array(held().score(x))

    return stats.withColumn("score", trees_score("stats"))
