"""Language-model scores from an n-gram trie: Elias-Fano levels in memory-mapped files, built and queried in parallel.

Level 1 lists the words by their 64-bit hashes; a word's place in it is its id. Level 2 has, for each word, the ids of the
words that follow it, level 3 for each pair the ids that follow the pair. The ids of a level are kept as one monotone
sequence, each raised by the number of contexts before its own times the vocabulary, and so are the pointers to where
a context's successors begin. The levels are cut into shards by a hash of an n-gram's first two ids, which deals out hot
words; each shard is a file. Smoothed probabilities are quantised to two bytes.
"""

from __future__ import annotations

import json
import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import released, scratch, table, written

FOLDS, HELD_OUT = 7, 2
ORDER = 3
#: A word of count n gives n / (n + prior) to what followed it and the rest to single words; the prior is FACTOR * n ** POWER,
#: as frequent words go on meeting new ones.
FACTOR, POWER = 6.0, 0.9
#: A pair gives the words that followed it their counts less a discount, by count (the last for higher ones), and what that
#: leaves to the pair's second word. What was met once may be chance, what was met twice rarely is. These values come from
#: the training rows alone (learned from five of their folds, measured on the sixth).
DISCOUNTS = (0.8, 0.9, 1.0)
#: Tokens of a shard, about: their number grows with the corpus, their size doesn't.
SHARD_TOKENS = 2_000_000
#: Words of a vocabulary shard, at most on average.
SHARD_WORDS = 1_000_000
#: Bytes of text that are looked up at once: each look goes to all shards, so that there is much to look up in each.
SLICE_BYTES = 2 << 20
#: log10 probabilities are kept in steps of STEP down from 0.
STEP = 1 / 40
#: The token after the last word of a text: a hash that no word is likely to have.
END = np.uint64(0x5EED_0000_0000_0001)


def prior(count: np.ndarray) -> np.ndarray:
    return FACTOR * np.maximum(count, 1).astype(float) ** POWER


def discount(count: np.ndarray) -> np.ndarray:
    return np.array((0.0, *DISCOUNTS))[np.minimum(count, len(DISCOUNTS))]


# Elias-Fano sequences


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """values as bit fields of `width` bits in 64-bit words, with a spare word."""
    if not width:
        return np.zeros(1, np.uint64)
    at = np.arange(len(values), dtype=np.uint64) * np.uint64(width)
    out = np.zeros(len(values) * width // 64 + 2, np.uint64)
    word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    starts = tokens.run_starts(word) if len(word) else np.zeros(0, np.int64)
    if len(word):
        out[word[starts]] |= np.bitwise_or.reduceat(values << shift, starts)
        over = shift + np.uint64(width) > 64
        if over.any():
            np.bitwise_or.at(out, word[over] + 1, values[over] >> (np.uint64(64) - shift[over]))
    return out


def _fields(packed: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    if not width:
        return np.zeros(len(at), np.uint64)
    bit = at.astype(np.uint64) * np.uint64(width)
    word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
    high = np.where(shift > 0, packed[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
    return (packed[word] >> shift | high) & np.uint64(2**width - 1)


def _select(words: np.ndarray, r: np.ndarray) -> np.ndarray:
    """The place of the r-th (from 0) bit that is set in each word."""
    place = np.zeros(len(words), np.uint64)
    r = r.astype(np.int64)
    for step in (32, 16, 8, 4, 2, 1):
        ones = np.bitwise_count((words >> place) & np.uint64(2**step - 1)).astype(np.int64)
        on = ones <= r
        r = r - np.where(on, ones, 0)
        place = place + np.where(on, np.uint64(step), np.uint64(0))
    return place.astype(np.int64)


@dataclass
class EliasFano:
    """A monotone sequence: `width` low bits of each value packed, its high part in unary: value i is a one at place
    high + i, each zero ends a high part. zeros[k] counts the zeros before the k-th 64-bit word."""

    n: int
    width: int
    low: np.ndarray
    high: np.ndarray
    zeros: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        width = max(0, int(universe // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        high = (values >> np.uint64(width)).astype(np.int64)
        bits = np.zeros(-(-(n + (max(universe, 1) - 1 >> width) + 2) // 64) * 64, bool)
        bits[high + np.arange(n)] = True
        words = np.packbits(bits, bitorder="little").view(np.uint64)
        zeros = np.zeros(len(words) + 1, np.uint32)
        zeros[1:] = np.cumsum(64 - np.bitwise_count(words).astype(np.int64))
        return cls(n, width, _packed(values & np.uint64(2**width - 1), width), words, zeros)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """The place of the k-th zero (from 0)."""
        word = np.searchsorted(self.zeros, k.astype(np.uint32), "right") - 1
        return word * 64 + _select(~self.high[word], k - self.zeros[word])

    def _next_zero(self, place: np.ndarray) -> np.ndarray:
        """The first zero at or after each place; there is one."""
        word = place >> 6
        rest = ~self.high[word] >> (place & 63).astype(np.uint64) << (place & 63).astype(np.uint64)
        left = np.flatnonzero(rest == 0)
        while len(left):
            word[left] += 1
            rest[left] = ~self.high[word[left]]
            left = left[rest[left] == 0]
        return word * 64 + np.bitwise_count((rest & (~rest + np.uint64(1))) - np.uint64(1)).astype(np.int64)

    def find(self, values: np.ndarray) -> np.ndarray:
        """The place of each value, -1 where it isn't in the sequence: the successor among those with its high part."""
        if not self.n:
            return np.full(len(values), -1)
        values = values.astype(np.uint64)
        high = (values >> np.uint64(self.width)).astype(np.int64)
        inside = high < int(self.zeros[-1]) - 1
        high = np.where(inside, high, 0)
        low = values & np.uint64(2**self.width - 1)
        before = np.where(high > 0, self._zero(np.maximum(high - 1, 0)) + 1, 0)
        a = before - high
        end = np.where(inside, self._next_zero(before) - high, a)
        b = end.copy()
        left = np.flatnonzero(a < b)
        while len(left):
            mid = (a[left] + b[left]) >> 1
            less = _fields(self.low, mid, self.width) < low[left]
            a[left] = np.where(less, mid + 1, a[left])
            b[left] = np.where(less, b[left], mid)
            left = left[a[left] < b[left]]
        ok = a < end
        ok[ok] = _fields(self.low, a[ok], self.width) == low[ok]
        return np.where(ok, a, -1)

    def at(self, places: np.ndarray) -> np.ndarray:
        """The values at places."""
        ones = np.arange(len(self.zeros)) * 64 - self.zeros
        word = np.searchsorted(ones, places, "right") - 1
        bit = word * 64 + _select(self.high[word], places - ones[word])
        return ((bit - places).astype(np.uint64) << np.uint64(self.width)) | _fields(self.low, places, self.width)


# files in the shared folder


def _local(folder: str) -> str | None:
    """The path of a folder that is mounted, None for one in a store."""
    return folder.removeprefix("file://").removeprefix("file:") if folder.startswith(("/", "file:")) else None


def save(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """Arrays one after the other in one file, under a header line; written aside and renamed, so that a task may be run again."""
    at, header, parts = 0, {}, []
    for key, x in arrays.items():
        header[key] = (str(x.dtype), len(x), at)
        parts.append(np.ascontiguousarray(x).tobytes() + b"\0" * (-x.nbytes % 8))
        at += len(parts[-1])
    head = json.dumps(header).encode()
    data = b"".join([head + b" " * (-(len(head) + 1) % 8) + b"\n", *parts])
    aside = f"{name}.{os.getpid()}.{os.urandom(4).hex()}"
    if path := _local(folder):
        os.makedirs(path, exist_ok=True)
        with open(f"{path}/{aside}", "wb") as f:
            f.write(data)
        os.replace(f"{path}/{aside}", f"{path}/{name}")
    else:
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path)
        with store.open_output_stream(f"{path}/{aside}") as f:
            f.write(data)
        store.move(f"{path}/{aside}", f"{path}/{name}")


def mapped(folder: str, name: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped into memory; from a store, the file is first fetched to the worker's temporary folder, from which it goes when it is mapped."""
    path = _local(folder)
    fetched = not path
    if path:
        path = f"{path}/{name}"
    else:
        store, there = fs.FileSystem.from_uri(folder)
        path = os.path.join(tempfile.mkdtemp(), name)
        with store.open_input_stream(f"{there}/{name}") as f, open(path, "wb") as out:
            while part := f.read(1 << 22):
                out.write(part)
    with open(path, "rb") as f:
        head = f.readline()
    whole = np.memmap(path, np.uint8, "r")
    if fetched:  # the mapping holds the file until the worker ends
        os.unlink(path)
        os.rmdir(os.path.dirname(path))
    return {k: whole[len(head) + at : len(head) + at + n * np.dtype(kind).itemsize].view(kind).view(np.ndarray) for k, (kind, n, at) in json.loads(head).items()}


def _sequence(prefix: str, s: EliasFano) -> dict[str, np.ndarray]:
    return {f"{prefix}_meta": np.array([s.n, s.width], np.int64), f"{prefix}_low": s.low, f"{prefix}_high": s.high, f"{prefix}_zeros": s.zeros}


def _sequence_of(prefix: str, arrays: dict[str, np.ndarray]) -> EliasFano:
    n, width = (int(v) for v in arrays[f"{prefix}_meta"])
    return EliasFano(n, width, arrays[f"{prefix}_low"], arrays[f"{prefix}_high"], arrays[f"{prefix}_zeros"])


# the vocabulary


@dataclass
class Model:
    """Where the trie is and what it holds; small, so that tasks get it whole."""

    folder: str
    bits: int  # of a word's hash that name its vocabulary shard
    offsets: list[int]  # of the vocabulary shards' ids
    n_tokens: int
    n_texts: int
    shards: int

    @property
    def n_words(self) -> int:
        return self.offsets[-1]

    @property
    def begin(self) -> int:
        """The id of what is before a text; ids from 0 are words, the next one is nothing, in the place of a successor of END."""
        return self.n_words

    @property
    def universe(self) -> int:
        return self.n_words + 2


def _counted(texts: Iterator[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """Different word hashes and their counts, END once for each text."""
    keys, counts, fresh_keys, fresh_counts, size, n = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], [], 0, 0

    def merge():
        k, c = np.concatenate([keys, *fresh_keys]), np.concatenate([counts, *fresh_counts])
        order = np.argsort(k)
        k, c = k[order], c[order]
        at = tokens.run_starts(k)
        return k[at], np.add.reduceat(c, at) if len(at) else c

    for part in texts:
        n += len(part)
        for _, w in tokens.iter_words(part, lower=True, size=SLICE_BYTES):
            k, c = np.unique(w.hashes, return_counts=True)
            fresh_keys.append(k)
            fresh_counts.append(c)
            size += len(k)
        if size > max(500_000, len(keys)):
            keys, counts = merge()
            fresh_keys, fresh_counts, size = [], [], 0
    fresh_keys.append(np.array([END] * (n > 0), np.uint64))
    fresh_counts.append(np.array([n] * (n > 0), np.int64))
    return merge()


def _vocabulary(texts: DataFrame, folder: str) -> Model:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, c = _counted(b.column(0) for b in batches)
        for i in range(0, len(k), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(k[i : i + 100_000]).view(pa.int64()), pa.array(c[i : i + 100_000])], ["h", "c"])

    words = written(texts.mapInArrow(released(count), "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c")), "words")
    n_words, n_tokens, n_texts = words.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("h") == int(END.astype(np.int64)), F.col("c"))), F.lit(0))).first()
    bits = max(1, int(-(-n_words // SHARD_WORDS) - 1).bit_length())

    def build(t: pa.Table) -> pa.Table:
        h = t["h"].to_numpy().astype(np.int64).view(np.uint64)
        c = t["c"].to_numpy().astype(np.uint64)
        order = np.argsort(h)
        h, c = h[order], c[order]
        shard = int(h[0] >> np.uint64(64 - bits))
        width = int(c.max()).bit_length()
        level = EliasFano.of(h & np.uint64(2 ** (64 - bits) - 1), 2 ** (64 - bits))
        save(folder, f"words-{shard}", _sequence("words", level) | {"width": np.array([width], np.int64), "counts": _packed(c, width)})
        return pa.table({"shard": pa.array([shard], pa.int64()), "n": pa.array([len(h)], pa.int64())})

    shard = F.shiftrightunsigned("h", 64 - bits)
    built = dict(tuple(r) for r in words.withColumn("shard", shard).groupBy("shard").applyInArrow(build, "shard bigint, n bigint").collect())
    offsets = np.concatenate([[0], np.cumsum([built.get(i, 0) for i in range(2**bits)])]).tolist()
    if n_words >= 2**32 - 2:
        raise OverflowError(f"{n_words} words are beyond ids of 32 bits")
    return Model(folder, bits, offsets, int(n_tokens), int(n_texts), max(1, -(-int(n_tokens) // SHARD_TOKENS)))


class Reader:
    """The model in a worker: files are mapped when they are first asked for."""

    def __init__(self, model: Model):
        self.model = model
        self.words: dict[int, tuple[EliasFano, np.ndarray, int] | None] = {}
        self.shards: dict[int, Shard] = {}

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and counts of words."""
        m = self.model
        kinds, of = np.unique(hashes, return_inverse=True)
        ids, counts = np.full(len(kinds), -1), np.zeros(len(kinds), np.int64)
        top = (kinds >> np.uint64(64 - m.bits)).astype(np.int64)
        for s in np.unique(top).tolist():
            if m.offsets[s] == m.offsets[s + 1]:
                continue
            if s not in self.words:
                arrays = mapped(m.folder, f"words-{s}")
                self.words[s] = _sequence_of("words", arrays), arrays["counts"], int(arrays["width"][0])
            level, packed, width = self.words[s]
            a, b = np.searchsorted(top, [s, s + 1])
            at = level.find(kinds[a:b] & np.uint64(2 ** (64 - m.bits) - 1))
            seen = at >= 0
            ids[a:b] = np.where(seen, at + m.offsets[s], -1)
            counts[a:b][seen] = _fields(packed, at[seen], width)
        return ids[of], counts[of]

    def shard(self, s: int) -> Shard:
        if s not in self.shards:
            self.shards[s] = Shard.of(mapped(self.model.folder, f"grams-{s}"))
        return self.shards[s]

    def sequence(self, w: tokens.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids and counts of the words of texts, each text with its END, and where each text begins."""
        n = len(w.text_at) - 1
        end = np.full(n, END)
        hashes = np.insert(w.hashes, w.word_at[1:], end)
        ids, counts = self.lookup(hashes)
        return ids, counts, w.word_at + np.arange(n + 1)


def _shard_of(pair: np.ndarray, shards: int) -> np.ndarray:
    return (tokens.mix(pair) % np.uint64(shards)).astype(np.int64)


def _pairs(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return u.astype(np.uint64) << np.uint64(32) | v.astype(np.uint64)


# the n-gram levels


@dataclass
class Shard:
    """Level 1's words that begin pairs of this shard, level 2 and level 3 below them."""

    firsts: EliasFano
    seconds: EliasFano
    pointers: EliasFano  # where the successors of the i-th pair begin in level 3
    thirds: EliasFano
    p2: np.ndarray
    back: np.ndarray
    p3: np.ndarray

    @classmethod
    def of(cls, arrays: dict[str, np.ndarray]) -> Shard:
        return cls(*(_sequence_of(x, arrays) for x in ("firsts", "seconds", "pointers", "thirds")), arrays["p2"], arrays["back"], arrays["p3"])


def quantised(p: np.ndarray) -> np.ndarray:
    """Two bytes for each probability: steps of log10, rounded towards the lesser probability. They reach any quotient of counts."""
    return np.ceil(-np.log10(np.maximum(p, 1e-300)) / STEP - 1e-9).astype(np.uint16)


def _planes(x: np.ndarray) -> bytes:
    """The bytes of a 32-bit array, first all the lowest, then the next: zeros come together and compress."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplanes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def _summed(uv: np.ndarray, w: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((w, uv))
    uv, w, c = uv[order], w[order], c[order]
    first = np.ones(len(uv), bool)
    first[1:] = (uv[1:] != uv[:-1]) | (w[1:] != w[:-1])
    at = np.flatnonzero(first)
    return uv[at], w[at], np.add.reduceat(c, at) if len(at) else c


def _gram_blocks(model: Model, texts: Iterator[pa.Array], most: int = 1_500_000) -> Iterator[tuple[int, bytes]]:
    """(shard, block): counted n-grams of a part of the texts. A pair that ends a text has nothing (an id of its own) as its third."""
    reader = Reader(model)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def flush() -> Iterator[tuple[int, bytes]]:
        uv, w = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        uv, w, c = _summed(uv, w, np.ones(len(uv), np.int64))
        shard = _shard_of(uv, model.shards)
        order = np.argsort(shard, kind="stable")
        uv, w, c, shard = uv[order], w[order], c[order], shard[order]
        starts = tokens.run_starts(shard)
        for a, b in zip(starts, np.append(starts[1:], len(shard))):
            u = (uv[a:b] >> np.uint64(32)).astype(np.int64)
            yield int(shard[a]), b"".join(_planes(x) for x in (np.diff(u, prepend=0), uv[a:b] & np.uint64(2**32 - 1), w[a:b], c[a:b]))

    for part in texts:
        for _, words in tokens.iter_words(part, lower=True, size=SLICE_BYTES):
            ids, _, at = reader.sequence(words)
            before = np.insert(ids[:-1], 0, model.begin) if len(ids) else ids
            before[at[:-1]] = model.begin
            after = np.append(ids[1:], 0)
            after[at[1:] - 1] = model.n_words + 1
            held.append((_pairs(before, ids), after.astype(np.uint64)))
            size += len(ids)
            if size >= most:
                yield from flush()
                held, size = [], 0
    if size:
        yield from flush()


class _Merged:
    """Counted n-grams of one shard, merged as its blocks come: what is held grows with the different n-grams, not with the blocks."""

    def __init__(self, shard: int):
        self.shard, self.fresh, self.size, self.kinds = shard, [], 0, 0

    def add(self, block: bytes) -> None:
        n = len(block) // 16
        u, v, w, c = (_unplanes(block[i * 4 * n : (i + 1) * 4 * n]) for i in range(4))
        self.fresh.append((_pairs(np.cumsum(u.astype(np.int64)), v), w.astype(np.uint64), c.astype(np.int64)))
        self.size += n
        if self.size > max(1_000_000, 2 * self.kinds):
            self.fresh = [self.all()]
            self.size = self.kinds = len(self.fresh[0][0])

    def all(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _summed(*(np.concatenate([p[i] for p in self.fresh]) for i in range(3)))


def _levels(model: Model, uv: np.ndarray, w: np.ndarray, c: np.ndarray, totals) -> dict[str, np.ndarray]:
    pair_at = tokens.run_starts(uv)
    pair, pair_count = uv[pair_at], np.add.reduceat(c, pair_at)
    owner = np.repeat(np.arange(len(pair)), np.diff(np.append(pair_at, len(uv))))
    u, v = (pair >> np.uint64(32)).astype(np.int64), pair & np.uint64(2**32 - 1)
    first_at = tokens.run_starts(u)
    context = np.repeat(np.arange(len(first_at)), np.diff(np.append(first_at, len(u))))
    size = np.uint64(model.universe)
    if len(pair) * model.universe >= 2**64:
        raise OverflowError(f"a shard of {len(pair)} pairs over {model.universe} words is beyond 64 bits: take more shards")
    real = w < np.uint64(model.n_words)
    thirds = (owner.astype(np.uint64) * size + w)[real]
    starts = np.searchsorted(owner[real], np.arange(len(pair) + 1))
    context_count = totals(u[first_at])[context]
    p2 = pair_count / (context_count + prior(context_count))
    p3 = ((c - discount(c)) / pair_count[owner])[real]
    back = np.add.reduceat(discount(c), pair_at) / pair_count
    return (
        _sequence("firsts", EliasFano.of(u[first_at], model.universe))
        | _sequence("seconds", EliasFano.of(context.astype(np.uint64) * size + v, len(first_at) * model.universe))
        | _sequence("pointers", EliasFano.of(starts, len(thirds) + 1))
        | _sequence("thirds", EliasFano.of(thirds, len(pair) * model.universe))
        | {"p2": quantised(p2), "back": quantised(back), "p3": quantised(p3)}
    )


def _counts_of_ids(reader: Reader, ids: np.ndarray) -> np.ndarray:
    """How often each word (or, for the id of a beginning, a text) was counted."""
    m = reader.model
    out = np.full(len(ids), m.n_texts, np.int64)
    shard = np.searchsorted(np.array(m.offsets), ids, "right") - 1
    for s in np.unique(shard[ids < m.n_words]).tolist():
        if s not in reader.words:
            arrays = mapped(m.folder, f"words-{s}")
            reader.words[s] = _sequence_of("words", arrays), arrays["counts"], int(arrays["width"][0])
        mine = (shard == s) & (ids < m.n_words)
        out[mine] = _fields(reader.words[s][1], ids[mine] - m.offsets[s], reader.words[s][2])
    return out


def trained(texts: DataFrame, folder: str | None = None) -> Model:
    """The model of the texts in a column `text` (null: empty), its files in a folder that driver and executors share."""
    folder = folder or scratch(texts.sparkSession, "trie")
    texts = texts.select("text")
    model = _vocabulary(texts, folder)
    if not model.n_tokens:
        return model

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, block in _gram_blocks(model, (b.column(0) for b in batches)):
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([block], pa.binary())], ["shard", "block"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)

        def done(m: _Merged) -> pa.RecordBatch:
            arrays = _levels(model, *m.all(), lambda ids: _counts_of_ids(reader, ids))
            save(folder, f"grams-{m.shard}", arrays)
            return pa.RecordBatch.from_arrays([pa.array([m.shard], pa.int64()), pa.array([len(arrays["p2"])], pa.int64()), pa.array([sum(x.nbytes for x in arrays.values())], pa.int64())], ["shard", "pairs", "bytes"])

        merged = None
        for batch in batches:
            for shard, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                if merged and merged.shard != shard:
                    yield done(merged)
                    merged = None
                merged = merged or _Merged(shard)
                merged.add(block.as_py())
        if merged:
            yield done(merged)

    blocks = texts.mapInArrow(released(grams), "shard bigint, block binary").repartition("shard").sortWithinPartitions("shard")
    blocks.mapInArrow(released(build), "shard bigint, pairs bigint, bytes bigint").agg(F.count("*"), F.sum("bytes")).collect()
    return model


def text_scores(reader: Reader, w: tokens.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: its tokens, its known tokens, the sum of log10 of base probabilities, and the model's log10 probability."""
    m = reader.model
    ids, counts, at = reader.sequence(w)
    base = (counts + 1) / (m.n_tokens + m.n_words + 1)
    score = base
    if m.n_tokens:
        before = np.insert(ids[:-1], 0, m.begin)
        before[at[:-1]] = m.begin
        context_count = np.where(before == m.begin, m.n_texts, np.insert(counts[:-1], 0, 0))
        p2 = base * np.where(before >= 0, 1 - context_count / (context_count + prior(context_count)), 1.0)
        known = np.flatnonzero((before >= 0) & (ids >= 0))
        pair = _pairs(before[known], ids[known])
        shard = _shard_of(pair, m.shards)
        # in the order of the levels, so that what is looked up lies together
        order = np.argsort(pair)
        order = order[np.argsort(shard[order], kind="stable")]
        known, shard = known[order], shard[order]
        back = np.ones(len(ids) + 1)  # of the pair that ends before the token
        more = np.zeros(len(ids) + 1)
        starts = tokens.run_starts(shard)
        for a, b in zip(starts, np.append(starts[1:], len(shard))):
            s, here = reader.shard(int(shard[a])), known[a:b]
            context = s.firsts.find(before[here])
            here, context = here[context >= 0], context[context >= 0]
            place = s.seconds.find(context.astype(np.uint64) * np.uint64(m.universe) + ids[here].astype(np.uint64))
            here, place = here[place >= 0], place[place >= 0]
            p2[here] += _POWER[s.p2[place]]
            following = (here + 1 < len(ids)) & (ids[here] != _end_id(reader))
            here, place = here[following] + 1, place[following]
            back[here] = _POWER[s.back[place]]
            seen = ids[here] >= 0
            here, place = here[seen], place[seen]
            third = s.thirds.find(place.astype(np.uint64) * np.uint64(m.universe) + ids[here].astype(np.uint64))
            more[here[third >= 0]] = _POWER[s.p3[third[third >= 0]]]
        score = back[:-1] * p2 + more[:-1]
    return np.diff(at), tokens.text_sums((counts > 0).astype(np.int64), at), tokens.text_sums(np.log10(base), at), tokens.text_sums(np.log10(score), at)


_POWER = 10.0 ** (-STEP * np.arange(int(300 / STEP) + 1))


def _end_id(reader: Reader) -> int:
    return int(reader.lookup(np.array([END]))[0][0])


def held_out(docs: DataFrame):
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


SCHEMA = "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Scores of the whole text of each row (null: empty, which is an END)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            got = [text_scores(reader, w) for _, w in tokens.iter_words(batch.column(1), lower=True, size=SLICE_BYTES)]
            if got:
                columns = [np.concatenate([g[i] for g in got]) for i in range(4)]
                yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(c) for c in columns)], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return docs.select("doc_id", "text").mapInArrow(released(run), SCHEMA)


def op10_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = trained(docs.where(~held_out(docs)))
    out = scored(docs, model)
    return out.select("doc_id", held_out(out).alias("held_out"), "n_tokens", "n_known", F.lit(model.n_tokens).cast("bigint").alias("train_tokens"), "base_score", "score")


QUERIES = {"op10_ngram_trie": op10_ngram_trie}
ORACLES: dict[str, str] = {}
