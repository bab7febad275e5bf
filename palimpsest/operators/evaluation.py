"""Metrics of cleaned pages against golden samples."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..functions import patterns as P
from ..functions.rx import count


def _along_diagonals(x: np.ndarray, y: np.ndarray, most: int) -> int | None:
    """Levenshtein distance of two code point arrays if it is at most `most`: the furthest place in x on each diagonal, edit by edit."""
    n, m, width = len(x), len(y), 16
    # different ends, so that no run goes beyond them
    x, y = np.append(x.astype(np.int64), np.full(width, -1)), np.append(y.astype(np.int64), np.full(width, -2))
    steps = np.arange(width)
    reach = np.full(2 * most + 5, -(2**40))
    for e in range(most + 1):
        k = np.arange(max(-e, -n), min(e, m) + 1)
        at = k + most + 2
        i = np.maximum(np.maximum(reach[at], reach[at + 1]) + 1, reach[at - 1]) if e else np.zeros(1, np.int64)
        i = np.minimum(i, np.minimum(n, m - k))
        rows = i[:, None] + steps
        differs = x[np.minimum(rows, n + width - 1)] != y[np.minimum(rows + k[:, None], m + width - 1)]
        run = np.where(differs.any(1), differs.argmax(1), width)
        i = i + np.minimum(run, np.minimum(n - i, m - k - i))
        for d in np.flatnonzero(run == width).tolist():
            here, shift, step = int(i[d]), int(k[d]), 256
            while size := min(step, n - here, m - shift - here):
                part = x[here : here + size] != y[here + shift : here + shift + size]
                if part.any():
                    here += int(part.argmax())
                    break
                here, step = here + size, step * 4
            i[d] = here
        reach[at] = i
        if -e <= m - n <= e and reach[m - n + most + 2] >= n:
            return e
    return None


def _bit_parallel(x: np.ndarray, y: np.ndarray) -> int:
    """Levenshtein distance of two code point arrays: a column of the table as bits of whole numbers (Myers, Hyyrö)."""
    x, y = (x, y) if len(x) <= len(y) else (y, x)
    n = len(x)
    places = {c: int.from_bytes(np.packbits(x == c, bitorder="little").tobytes(), "little") for c in np.unique(x).tolist()}
    whole, top, score = (1 << n) - 1, 1 << (n - 1), n
    up, down = whole, 0
    for c in y.tolist():
        equal = places.get(c, 0)
        v = equal | down
        h = (((equal & up) + up) ^ up) | equal
        rise, fall = down | (whole & ~(h | up)), up & h
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise = (rise << 1) | 1
        up, down = whole & ((fall << 1) | ~(v | rise)), whole & rise & v
    return score


def distance(a: str, b: str) -> int:
    """Levenshtein distance of whole texts of any length, in memory that grows with their length."""
    x, y = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in (a, b))
    for way in (1, -1):
        size = min(len(x), len(y))
        differs = np.flatnonzero(x[::way][:size] != y[::way][:size])
        same = int(differs[0]) if len(differs) else size
        x, y = (t[::way][same:][::way] for t in (x, y))
    if not len(x) or not len(y):
        return max(len(x), len(y))
    found = _along_diagonals(x, y, max(16, max(len(x), len(y)) // 64))
    return _bit_parallel(x, y) if found is None else found


@F.arrow_udf(returnType=LongType())
def _distances(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([None if x is None or y is None else distance(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.int64())


def edit_distance(expected: Column, actual: Column) -> Column:
    """Levenshtein distance per expected character, 4 places; null where nothing is expected but something is there."""
    return F.when((expected == "") & (actual == ""), F.lit(0.0)).when(expected != "", F.bround(_distances(expected, actual) / F.length(expected), 4))


def keyword_retention(keywords: Column, actual: Column) -> Column:
    kept = F.size(F.filter(keywords, lambda k: (k != "") & F.contains(F.lower(actual), F.lower(k))))
    return F.when(F.size(keywords) > 0, F.bround(kept / F.size(keywords), 4))


def structure_overreach(spans: Column, actual: Column) -> Column:
    kept = F.size(F.filter(spans, lambda s: (s != "") & F.contains(actual, s)))
    return F.when(F.size(spans) > 0, F.bround(1 - kept / F.size(spans), 4))


def anomalies(text: Column) -> Column:
    return F.struct(
        count(text, P.ANOMALY_MIXED).cast("bigint").alias("mixed_script_tokens"), count(text, P.ANOMALY_SPACED_HYPHEN).cast("bigint").alias("spaced_hyphen"),
        count(text, P.ANOMALY_SHORT_HYPHEN).cast("bigint").alias("compact_hyphen_short"),
    )


def misclassified(expected: Column, predicted: Column) -> Column:
    return F.when((F.coalesce(expected, F.lit("")) != "") & predicted.isNotNull(), F.when(expected == predicted, 0.0).otherwise(1.0))


def evaluated(samples: DataFrame) -> DataFrame:
    """samples (sample_id, expected_page_type, predicted_page_type, keywords, protected_spans, raw, expected, actual) with their metrics."""
    expected, actual = F.coalesce("expected", F.lit("")), F.coalesce("actual", F.lit(""))
    return samples.select(
        "sample_id", edit_distance(expected, actual).alias("normalized_edit_distance"), keyword_retention(F.col("keywords"), actual).alias("keyword_retention_rate"),
        structure_overreach(F.col("protected_spans"), actual).alias("structure_overreach_rate"), anomalies(actual).alias("anomalies"),
        misclassified(F.col("expected_page_type"), F.col("predicted_page_type")).alias("page_type_misclassification"),
        F.length(F.coalesce("raw", F.lit(""))).alias("raw_length"), F.length(expected).alias("expected_length"), F.length(actual).alias("actual_length"),
    )


def summary(results: DataFrame) -> DataFrame:
    """One row: the number of samples, means without nulls, and anomaly totals."""
    means = ("normalized_edit_distance", "keyword_retention_rate", "structure_overreach_rate", "page_type_misclassification")
    totals = ("mixed_script_tokens", "spaced_hyphen", "compact_hyphen_short")
    return results.agg(F.count("*").alias("sample_count"), *[F.bround(F.avg(m), 4).alias(f"avg_{m}") for m in means], *[F.coalesce(F.sum(f"anomalies.{t}"), F.lit(0)).alias(t) for t in totals])
