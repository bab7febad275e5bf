"""Words of Arrow text batches as numpy arrays: boundaries and 64-bit hashes, without a Python object for each word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer text goes alone.
SLICE_BYTES = 1 << 19
_SEED = np.random.Generator(np.random.PCG64(20250611))
#: A random 64-bit value for each byte value, and an odd multiplier: hash = mix(sum(value[byte_j] * multiplier ** j)).
_VALUE = _SEED.integers(0, 2**64, 256, dtype=np.uint64)
_MULTIPLIER = int(_SEED.integers(0, 2**64, dtype=np.uint64)) | 5
_INVERSE = pow(_MULTIPLIER, -1, 2**64)
_powers: dict[int, np.ndarray] = {}

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= 8 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Of consecutive texts: the bytes, each text's bounds in them, each word's bounds, the first word of each text, and word hashes."""

    raw: np.ndarray
    text_at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    word_at: np.ndarray
    hashes: np.ndarray

    @property
    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.text_at) - 1), np.diff(self.word_at))


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of raw[start:end] for each pair of bounds."""
    n = len(raw)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[raw] * powers(_MULTIPLIER, n), out=total[1:])
    return mix((total[end] - total[start]) * powers(_INVERSE, n + 1)[start] + (end - start).astype(np.uint64))


def slices(texts: pa.Array | pa.ChunkedArray, size: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, bytes, bounds) of runs of texts of about `size` bytes; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    _, bounds, data = texts.buffers()
    bounds = np.frombuffer(bounds, np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(bounds, bounds[i] + size, "right")) - 1
        j = min(n, max(i + 1, j))
        yield i, raw[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]
        i = j


def words_of(raw: np.ndarray, text_at: np.ndarray, lower: bool = False) -> Words:
    """The words of texts that lie one after the other in raw; lower: A to Z count as a to z."""
    if lower:
        raw = LOWER[raw]
    n = len(raw)
    solid = ~SPACE[raw]
    edge = np.zeros(n + 1, bool)
    edge[text_at] = True
    before = np.zeros(n, bool)
    before[1:] = solid[:-1]
    start = np.flatnonzero(solid & (~before | edge[:n]))
    after = np.zeros(n, bool)
    after[:-1] = solid[1:]
    end = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return Words(raw, text_at, start, end, np.searchsorted(start, text_at), span_hashes(raw, start, end))


def iter_words(texts: pa.Array | pa.ChunkedArray, lower: bool = False, size: int = SLICE_BYTES) -> Iterator[tuple[int, Words]]:
    for i, raw, bounds in slices(texts, size):
        yield i, words_of(raw, bounds, lower)


def run_starts(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin in a sorted array."""
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(first)


def text_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of values over [at[i], at[i + 1])."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[at[1:]] - total[at[:-1]]
