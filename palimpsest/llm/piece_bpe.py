"""SentencePiece encoding and decoding for merge-type vocabularies: a score-ordered agenda of adjacent symbol pairs."""

from __future__ import annotations

import hashlib
import heapq
import re
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import released, table

MARK = "▁"
#: Words whose ids a task remembers, in each of two generations.
REMEMBERED = 150_000
#: Words of up to so many symbols go through the agenda together, one row each.
ROW_SYMBOLS = 40
DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_corrected bigint"
_CHUNKS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_loaded: dict[str, PieceBPE] = {}


class Memory(dict):
    """What is known of strings, in bounded size: two generations, of which the older goes when the newer is full."""

    def __init__(self, most: int = REMEMBERED):
        super().__init__()
        self.most, self.old = most, {}

    def missing(self, keys: set[str]) -> list[str]:
        """The keys that are in neither generation, in order; the others are in the newer one now."""
        out = []
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()
        for k in sorted(keys):
            if k in self:
                continue
            value = self.old.get(k)
            if value is None:
                out.append(k)
            else:
                self[k] = value
        return out


class PieceBPE:
    """An encoder of its own for one vocabulary file, with the library beside it for normalisation, checks and decoding."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        if any(sp.is_unused(i) for i in range(n)):
            raise ValueError("vocabularies with unused pieces aren't supported")
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.ids = {pieces[i]: i for i in plain}
        self.scores = {pieces[i]: sp.get_score(i) for i in plain}
        self.bytes = {int(pieces[i][3:-1], 16): i for i in range(n) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        # a merge never crosses from another symbol to a mark, so that words can be encoded on their own
        self.apart = not any(MARK in p[1:] and set(p) != {MARK} for p in self.ids)
        self.memory = Memory()
        self.corrected = 0
        # words for which the library's ids replace the agenda's
        self.wrong: set[str] = set()
        order = sorted(plain, key=lambda i: -sp.get_score(i))
        times = Counter(self.scores[p] for p in self.ids if len(p) > 1)
        # where pieces share a score, ties go by place: words that could hold such pieces are encoded one by one
        self.tied = sorted({p[:2] for p in self.ids if len(p) > 1 and times[self.scores[p]] > 1})
        self.piece_of_rank = np.array(order, np.int64)
        rank = {pieces[i]: r for r, i in enumerate(order)}
        pairs = [(self.ids[p[:k]] << 32 | self.ids[p[k:]], rank[p]) for p in self.ids for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids]
        pairs.sort()
        self.pair_keys = np.array([k for k, _ in pairs] or [-1], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs] or [n], np.int32)
        self.no_rank = np.int32(n)

    def agenda(self, chunk: str) -> list[int]:
        """The ids of a normalised string: of all adjacent pairs that are pieces, the best score (leftmost on ties) is merged, again and again."""
        ids, scores = self.ids, self.scores
        symbols: list[str | None] = list(chunk)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in scores:
                agenda.append((-scores[pair], i, pair))
        heapq.heapify(agenda)
        while agenda:
            _, i, pair = heapq.heappop(agenda)
            j = after[i]
            left = symbols[i]
            if left is None or j >= n or len(left) + len(symbols[j]) != len(pair) or left + symbols[j] != pair:
                continue
            symbols[i], symbols[j] = pair, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                new = pair + symbols[k]
                if new in scores:
                    heapq.heappush(agenda, (-scores[new], i, new))
            h = before[i]
            if h >= 0:
                new = symbols[h] + pair
                if new in scores:
                    heapq.heappush(agenda, (-scores[new], h, new))
        out: list[int] = []
        for s in symbols:
            if s is None:
                continue
            if s in ids:
                out.append(ids[s])
            elif self.bytes:
                out += [self.bytes[b] for b in s.encode("utf-8", "surrogatepass")]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | np.maximum(right, 0)
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == keys) & (left >= 0) & (right >= 0), self.pair_ranks[at], self.no_rank)

    def _rows(self, symbols: np.ndarray, out: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """The agenda for words of up to as many symbols as `symbols` has columns (-1: none): in each step, each word's
        best pair (leftmost on ties) is merged, and words without one leave. out gets (row numbers, their ids)."""
        rows, best_of = np.arange(len(symbols)), self._ranks(symbols[:, :-1], symbols[:, 1:])
        while len(rows):
            at = best_of.argmin(1) if best_of.shape[1] else np.zeros(len(rows), np.int64)
            best = best_of[np.arange(len(rows)), at] if best_of.shape[1] else np.full(len(rows), self.no_rank)
            over = best == self.no_rank
            if over.any():
                out.append((rows[over], symbols[over]))
                go = ~over
                rows, symbols, best_of, at, best = rows[go], symbols[go], best_of[go], at[go], best[go]
                if not len(rows):
                    break
            every = np.arange(len(rows))
            symbols[every, at] = self.piece_of_rank[best]
            columns = np.arange(symbols.shape[1] - 1)
            symbols = np.take_along_axis(symbols, columns + (columns > at[:, None]), 1)
            columns = columns[:-1]
            best_of = np.take_along_axis(best_of, columns + (columns >= at[:, None]), 1)
            last = symbols.shape[1] - 1
            some = at > 0
            best_of[every[some], at[some] - 1] = self._ranks(symbols[every[some], at[some] - 1], symbols[every[some], at[some]])
            some = at < last
            best_of[every[some], at[some]] = self._ranks(symbols[every[some], at[some]], symbols[every[some], at[some] + 1])

    def _together(self, chunks: list[str]) -> list[bytes]:
        """agenda() of many strings, packed."""
        points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), "<u4")
        length = np.fromiter(map(len, chunks), np.int64, len(chunks))
        start = np.zeros(len(chunks) + 1, np.int64)
        np.cumsum(length, out=start[1:])
        kinds, kind = np.unique(points, return_inverse=True)
        symbols = np.array([self.ids.get(chr(c), -1) for c in kinds], np.int64)[kind]
        tied = np.fromiter((any(x in c for x in self.tied) for c in chunks), bool, len(chunks))
        alone = tied | (length > ROW_SYMBOLS) | (np.add.reduceat(symbols < 0, start[:-1]) > 0)
        packed: list[bytes] = [b""] * len(chunks)
        for i in np.flatnonzero(alone):
            packed[i] = np.array(self.agenda(chunks[i]), "<u4").tobytes()
        least = 0
        for most in (8, 14, 22, ROW_SYMBOLS):
            mine = np.flatnonzero(~alone & (length > least) & (length <= most))
            least = most
            if not len(mine):
                continue
            columns = np.arange(most)
            inside = columns < length[mine][:, None]
            matrix = np.where(inside, symbols[np.minimum(start[mine][:, None] + columns, len(symbols) - 1)], -1)
            out: list[tuple[np.ndarray, np.ndarray]] = []
            self._rows(matrix, out)
            for rows, ids in out:
                n = (ids >= 0).sum(1) * 4
                raw, width = ids.astype("<u4").tobytes(), ids.shape[1] * 4
                for k, (i, m) in enumerate(zip(mine[rows].tolist(), n.tolist())):
                    packed[i] = raw[k * width : k * width + m]
        return packed

    def learn(self, keys: set[str]) -> None:
        """Encodes the words that aren't remembered, compares them with the library, and takes its ids where they differ."""
        fresh = self.memory.missing(keys)
        if not fresh:
            return
        packed = self._together([c if c[0] == MARK else MARK + c for c in fresh])
        given = self.library.encode([(c[1:] if c[0] == MARK else c).replace(MARK, " ") for c in fresh], num_threads=1)
        ends = np.cumsum([len(g) for g in given]) * 4
        raw = np.fromiter((i for g in given for i in g), "<u4", int(ends[-1]) // 4).tobytes()
        at = 0
        for chunk, own, end in zip(fresh, packed, ends.tolist()):
            right = raw[at:end]
            at = end
            if own != right and chunk != MARK:  # the library drops a lone mark at the start
                self.corrected += 1
                self.wrong.add(chunk)
                own = right
            self.memory[chunk] = own

    def chunks(self, text: str) -> list[str] | None:
        """The words of the normalised text: a mark and what follows, without the mark where it is one; None if the text must be taken whole."""
        norm = self.library.normalize(text)
        if not norm:
            return []
        if not self.apart or norm[0] != MARK:
            return None
        if MARK + MARK in norm or norm[-1] == MARK:
            return _CHUNKS.findall(norm)
        return norm[1:].split(MARK)

    def encode_counted(self, texts: list[str]) -> Iterator[tuple[bytes, int]]:
        """The ids of each text as little-endian unsigned 32-bit integers, without begin and end, and how many of its words
        the library's ids had to put right (for a text that is taken whole: 1 or 0)."""
        cut = [self.chunks(t) for t in texts]
        known = self.memory
        self.learn({x for c in cut if c for x in c})
        for t, c in zip(texts, cut):
            if c is None:
                right = np.array(self.library.encode(t), "<u4").tobytes()
                yield right, int(right != np.array(self.agenda(self.library.normalize(t)), "<u4").tobytes())
            else:
                yield b"".join([known[x] for x in c]), sum(x in self.wrong for x in c) if self.wrong else 0

    def encode_packed(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers, without begin and end."""
        return (packed for packed, _ in self.encode_counted(texts))

    def forget(self) -> None:
        """Drops what is known of words: a worker lives on after a task."""
        self.memory = Memory(self.memory.most)
        self.wrong = set()

    def encode(self, text: str, begin: bool = True, end: bool = True) -> list[int]:
        (packed,) = self.encode_packed([text])
        return [self.library.bos_id()] * begin + np.frombuffer(packed, "<u4").tolist() + [self.library.eos_id()] * end

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


def loaded(path: str) -> PieceBPE:
    if path not in _loaded:
        _loaded[path] = PieceBPE(path)
    return _loaded[path]


@contextmanager
def at_work(path: str) -> Iterator[PieceBPE]:
    """The encoder of a worker for one task, which leaves only the vocabulary behind."""
    coder = loaded(path)
    try:
        yield coder
    finally:
        coder.forget()


def _groups(texts: list[str], most: int = 2_000_000) -> Iterator[list[str]]:
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def encoded(docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids", begin: bool = True, end: bool = True, digest: str | None = None) -> DataFrame:
    """docs with the ids of each whole text in a column `ids` (which it replaces); a null text is empty, and has the begin and end ids only.

    digest: a column for the SHA-256 of what the ids decode to, which shows a round trip that lost something."""
    made = {ids, digest}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with at_work(path) as coder:
            head = np.array([coder.library.bos_id()] * begin, "<u4").tobytes()
            tail = np.array([coder.library.eos_id()] * end, "<u4").tobytes()
            for batch in batches:
                packed = [head + p + tail for g in _groups([t or "" for t in batch.column(text).to_pylist()]) for p in coder.encode_packed(g)]
                offsets = np.zeros(len(packed) + 1, np.int32)
                offsets[1:] = np.cumsum([len(p) // 4 for p in packed])
                columns = {f.name: c for f, c in zip(batch.schema, batch.columns) if f.name not in made}
                columns[ids] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), "<u4").astype(np.int32)))
                if digest:
                    texts = (coder.decode(np.frombuffer(p, "<u4").tolist()) for p in packed)
                    columns[digest] = pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in texts], pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

    fields = [f for f in docs.schema.fields if f.name not in made] + [StructField(ids, ArrayType(IntegerType(), True))]
    if digest:
        fields.append(StructField(digest, StringType()))
    return docs.mapInArrow(released(run), StructType(fields))


def decoded(df: DataFrame, path: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """df with the text of each list of ids (null: empty) in a column `text` (which it replaces)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = loaded(path)
        for batch in batches:
            texts = pa.array([coder.decode(x) if x else "" for x in batch.column(ids).to_pylist()], pa.string())
            rest = [(f, c) for f, c in zip(batch.schema, batch.columns) if f.name != text]
            yield pa.RecordBatch.from_arrays([c for _, c in rest] + [texts], [f.name for f, _ in rest] + [text])

    from pyspark.sql.types import StringType, StructField, StructType

    return df.mapInArrow(released(run), StructType([f for f in df.schema.fields if f.name != text] + [StructField(text, StringType())]))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """For each row of docs: the number of ids of its whole text, and digests of the ids and of the text that they decode to.

    Null texts are empty; rows that repeat are encoded each. n_corrected is the number of the row's words for which the
    library's ids had to replace the agenda's (0 if both agree).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with at_work(path) as coder:
            begin, end = np.array([coder.library.bos_id()], "<u4").tobytes(), np.array([coder.library.eos_id()], "<u4").tobytes()
            for batch in batches:
                rows = []
                for group in _groups([t or "" for t in batch.column(1).to_pylist()]):
                    for packed, corrected in coder.encode_counted(group):
                        packed = begin + packed + end
                        text = coder.decode(np.frombuffer(packed, "<u4").tolist())
                        rows.append((len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(), corrected))
                n, ids, texts, corrected = zip(*rows) if rows else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string()), pa.array(corrected, pa.int64())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_corrected"],
                )

    return docs.select("doc_id", "text").mapInArrow(released(run), DIGESTS)


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), model_path())


QUERIES = {"op3_sentencepiece": op3_sentencepiece}
ORACLES: dict[str, str] = {}
