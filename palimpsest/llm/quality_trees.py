"""A quality classifier: histogram gradient-boosted trees over document statistics, scored by numpy over flat arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import released, table

#: Labelled rows that the trees are fitted on, at most: those with the least hash of doc_id.
SAMPLE_ROWS = 20_000
FOLDS = 5
THRESHOLD = 0.3
TREES, DEPTH, BINS, RATE, L2, LEAST_ROWS = 60, 4, 64, 0.15, 1.0, 8

#: Byte classes, counted per byte of text.
CLASSES = {
    "lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58), "high": range(128, 256), "mark": b".,;:", "call": b"!?", "symbol": b"#*$%&|<>@^~=+_\\/{}[]", "line": b"\n",
}
STATISTICS = (*CLASSES, "log_bytes", "log_words", "word_bytes", "word_spread", "short_words", "long_words", "distinct_words", "top_word", "repeated_pairs", "line_bytes", "distinct_lines", "capital_words")
_CLASS_OF = np.zeros((256, len(CLASSES)), np.float32)
for _k, _members in enumerate(CLASSES.values()):
    _CLASS_OF[list(_members), _k] = 1


def _distinct(keys: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: its different keys, and the times of its most frequent one."""
    if not len(keys):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((keys, text))
    k, t = keys[order], text[order]
    first = np.ones(len(k), bool)
    first[1:] = (k[1:] != k[:-1]) | (t[1:] != t[:-1])
    at = np.flatnonzero(first)
    times = np.diff(np.append(at, len(k)))
    most = np.zeros(n)
    np.maximum.at(most, t[at], times)
    return np.bincount(t[at], minlength=n).astype(float), most


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of STATISTICS for each text, all finite; null texts are empty."""
    out = np.zeros((len(texts), len(STATISTICS)))
    for i, w in tokens.iter_words(texts):
        n, at = len(w.text_at) - 1, w.text_at
        size = np.diff(at).astype(float)
        by_byte = np.maximum(size, 1)
        rows = out[i : i + n]
        for k in range(len(CLASSES)):
            rows[:, k] = tokens.text_sums(_CLASS_OF[:, k][w.raw], at) / by_byte
        k = len(CLASSES)
        count = np.diff(w.word_at).astype(float)
        by_word = np.maximum(count, 1)
        length, text = (w.end - w.start).astype(float), w.text_of_word
        mean = tokens.text_sums(length, w.word_at) / by_word
        different, top = _distinct(w.hashes, text, n)
        pair = (text[1:] == text[:-1]) if len(text) > 1 else np.zeros(0, bool)
        pairs, _ = _distinct((w.hashes[:-1] * np.uint64(3) + w.hashes[1:])[pair], text[:-1][pair], n) if len(text) > 1 else (np.zeros(n), None)
        breaks = np.unique(np.concatenate([at, np.flatnonzero(w.raw == 10) + 1]))
        breaks = breaks[breaks < len(w.raw)]
        ends = np.append(breaks[1:], len(w.raw))
        of = np.searchsorted(at, breaks, "right") - 1
        lines, _ = _distinct(tokens.span_hashes(w.raw, breaks, ends), of, n)
        n_lines = np.maximum(np.bincount(of, minlength=n), 1)
        first = w.raw[w.start] if len(w.start) else np.zeros(0, np.uint8)
        rows[:, k:] = np.stack([
            np.log1p(size), np.log1p(count), mean, np.sqrt(np.maximum(0, tokens.text_sums(length**2, w.word_at) / by_word - mean**2)),
            tokens.text_sums((length <= 3).astype(float), w.word_at) / by_word, tokens.text_sums((length >= 14).astype(float), w.word_at) / by_word,
            different / by_word, top / by_word, 1 - pairs / np.maximum(count - 1, 1), np.log1p(size / n_lines), lines / n_lines,
            tokens.text_sums(((first >= 65) & (first < 91)).astype(float), w.word_at) / by_word,
        ], 1)
    return out


@dataclass
class Trees:
    """All trees in flat arrays: at a node, go to left + (value > cut); leaves point to themselves."""

    start: float
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    depth: int

    def margins(self, x: np.ndarray) -> np.ndarray:
        node = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            down = x[rows, self.feature[node]] > self.cut[node]
            node = self.left[node] + down
        return self.start + self.value[node].sum(1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([1 / (1 + np.exp(-np.clip(self.margins(part), -30, 30))) for part in np.array_split(x, max(1, len(x) // 4096))]) if len(x) else np.zeros(0)


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosted trees for log loss, split on histograms of at most BINS quantile bins. With one class or no rows, a constant."""
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    start = float(np.log(share / (1 - share)))
    feature, cut, left, value, roots = [0], [np.inf], [0], [0.0], []
    if not len(y) or y.min() == y.max():
        return Trees(start, np.zeros(1, int), np.array(feature), np.array(cut), np.array(left), np.array(value), 0)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
    margin = np.full(len(y), start)

    def leaf(rows: np.ndarray, node: int) -> None:
        feature[node], cut[node], left[node] = 0, np.inf, node
        value[node] = RATE * g[rows].sum() / (h[rows].sum() + L2)
        margin[rows] += value[node]

    def grow(rows: np.ndarray, node: int, level: int) -> None:
        gs, hs = g[rows].sum(), h[rows].sum()
        best = (1e-6, -1, -1)
        if level < depth and len(rows) >= 2 * LEAST_ROWS:
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                b = binned[rows, f]
                gl, hl, nl = (np.cumsum(np.bincount(b, v, len(c) + 1))[:-1] for v in (g[rows], h[rows], None))
                gain = gl**2 / (hl + L2) + (gs - gl) ** 2 / (hs - hl + L2) - gs**2 / (hs + L2)
                gain[(nl < LEAST_ROWS) | (len(rows) - nl < LEAST_ROWS)] = -1
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], f, k)
        if best[1] < 0:
            return leaf(rows, node)
        _, f, k = best
        child = len(feature)
        for part in (feature, cut, left, value):
            part.extend([0, 0])
        feature[node], cut[node], left[node] = f, cuts[f][k], child
        down = binned[rows, f] > k
        grow(rows[~down], child, level + 1)
        grow(rows[down], child + 1, level + 1)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        node = len(feature)
        for part in (feature, cut, left, value):
            part.append(0)
        roots.append(node)
        grow(np.arange(len(y)), node, 0)
    return Trees(start, np.array(roots), np.array(feature), np.array(cut, float), np.array(left), np.array(value, float), depth)


def fold(doc_id: Column, of: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % of


def learned(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Trees:
    """Trees fitted on the labelled documents outside fold 0, at most `rows` of them (a documented bound: those with the
    least hash of doc_id). Labels of no document or without a quality don't count; of several labels the largest holds, of
    several documents with one id the one with the least statistics."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), FOLDS) != 0))
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.int32()), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "quality", "x"])

    own = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "quality", "text")
    measured = own.mapInArrow(released(measure), "doc_id bigint, quality int, x array<double>")
    got = sorted(measured.groupBy("doc_id", "quality").agg(F.min("x").alias("x")).collect())
    x = np.array([r.x for r in got]).reshape(len(got), len(STATISTICS))
    return fit(x, np.array([float(r.quality >= 1) for r in got]))


def scored(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id and score (0 to 1) of every row, from its whole text; null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(trees.scores(statistics(batch.column(1))))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(released(run), "doc_id bigint, score double")


def kept(docs: DataFrame, trees: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score `threshold` or more, with their columns as they were."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(trees.scores(statistics(batch.column(names.index("text")))) >= threshold))

    return docs.mapInArrow(released(run), docs.schema)


def op8_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = scored(docs, learned(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op8_quality_trees": op8_quality_trees}
ORACLES: dict[str, str] = {}
