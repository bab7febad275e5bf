"""Token counts of byte-level BPE vocabularies by dynamic programming over prefixes."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import released, table
from .piece_bpe import Memory, model_path

#: Words of which a worker remembers the counts, in each of two generations, with and without a space before them.
REMEMBERED = 400_000
#: Tokens above which a document is over the limit.
LIMIT = 1024
COUNTS = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
_PAIRED_SPACES = ("  ", " \n", "\n ", " \r", "\r ", " \t", "\t ")
_loaded: dict[str, PrefixCounter] = {}


def _byte_letters() -> dict[str, int]:
    """The letters by which such vocabularies write bytes: printable ones as themselves, the others from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Exact token counts of every prefix, for one vocabulary file of the tokenizers library (byte-level BPE)."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or model.get("dropout") or pre["type"] != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec.get("normalizer"):
            raise ValueError(f"{path} isn't a plain byte-level BPE vocabulary")
        letter = _byte_letters()
        raw = lambda s: bytes(letter[c] for c in s)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.words = regex.compile(public_tokenizers.PATTERN)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        #: Byte strings that are the result of their own encoding, by length, longest first in lookups.
        self.tokens = {x: None for x in (raw(t) for t in model["vocab"] if t not in special) if len(x) == 1 or self.merged(x) == [x]}
        self.longest = max(map(len, self.tokens))
        self.next_to: dict[tuple[bytes, bytes], bool] = {}
        self.after_space, self.bare = Memory(REMEMBERED), Memory(REMEMBERED)
        self.blank = regex.compile(r"\s+")
        self.odd_space = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")

    def merged(self, x: bytes) -> list[bytes]:
        """The tokens of a short byte string, by merging the pair of least rank again and again."""
        none, get = 1 << 60, self.rank.get
        parts = [x[i : i + 1] for i in range(len(x))]
        ranks = [get(p, none) for p in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) < none:
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = get((parts[at - 1], parts[at]), none)
            if at < len(ranks):
                ranks[at] = get((parts[at], parts[at + 1]), none)
        return parts

    def together(self, a: bytes, b: bytes) -> bool:
        """Whether b can follow a: their bytes together are encoded as these two."""
        known = self.next_to.get((a, b))
        if known is None:
            if len(self.next_to) > 2_000_000:
                self.next_to.clear()
            self.next_to[a, b] = known = self.merged(a + b) == [a, b]
        return known

    def prefixes(self, word: bytes) -> list[int]:
        """count[i]: tokens of word[:i]. The tokens of a prefix end with the one token that fits after those of what is
        before it, as what precedes a token in an encoding is the encoding of that prefix; so count[i] = count[i - size] + 1."""
        n, tokens, follows = len(word), self.tokens, self.next_to.get
        last: list[bytes] = [b""] * (n + 1)
        count = [0] * (n + 1)
        for i in range(1, n + 1):
            for j in range(max(0, i - self.longest), i):
                t = word[j:i]
                if t in tokens:
                    fits = j == 0 or follows((last[j], t))
                    if fits is None:
                        fits = self.together(last[j], t)
                    if fits:
                        last[i], count[i] = t, count[j] + 1
                        break
            else:
                raise AssertionError(f"no token ends at {i} of {word!r}")
        return count

    def count_word(self, word: str) -> int:
        return self.prefixes(word.encode("utf-8", "surrogatepass"))[-1]

    def _plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        if any(p in text for p in _PAIRED_SPACES) or text[-1:].isspace() or self.odd_space.search(text):
            return self._sum(self.words.findall(text), self.bare, self.count_word)
        # no space touches other white space: cut at spaces, each of which begins what follows it
        first, *rest = text.split(" ")
        cut = lambda w: sum(self.count_word(x) for x in self.words.findall(" " + w))
        return self._sum(self.words.findall(first), self.bare, self.count_word) + self._sum(rest, self.after_space, cut)

    def _sum(self, words: list[str], memory: Memory, count) -> int:
        try:
            return sum(map(memory.__getitem__, words))
        except KeyError:
            for w in memory.missing(set(words)):
                memory[w] = count(w)
            return sum(map(memory.__getitem__, words))

    def count(self, text: str) -> int:
        """Tokens of the whole text; a special string is one token."""
        if not self.special or not self.special.search(text):
            return self._plain(text)
        found = self.special.findall(text)
        return len(found) + sum(map(self._plain, self.special.split(text)))

    def prefix_counts(self, text: str) -> np.ndarray:
        """count[i]: tokens of text[:i] for each number of code points i, each as if the text ended there."""
        out = np.zeros(len(text) + 1, np.int64)
        done = at = 0
        for m in [*(self.special.finditer(text) if self.special else ()), None]:
            end = m.start() if m else len(text)
            self._fill(out, text, at, end, done)
            if m:
                # a special string that isn't whole yet is ordinary text
                for i in range(m.start() + 1, m.end()):
                    out[i] = done + self._plain(text[at:i])
                done = out[m.end()] = out[m.start()] + 1
                at = m.end()
        return out

    def _fill(self, out: np.ndarray, text: str, at: int, end: int, done: int) -> None:
        """The counts of prefixes that end in text[at:end], which holds no special string and starts after `done` tokens."""
        run, run_done = None, 0
        for m in self.words.finditer(text[at:end]):
            a, b = m.start() + at, m.end() + at
            word = m.group()
            counts = self.prefixes(word.encode("utf-8", "surrogatepass"))
            if self.blank.fullmatch(word):
                # where the text ends in white space, all of it since the last other character is one word
                if run is None:
                    run, run_done = a, done
                whole = self.prefixes(text[run:b].encode())
                for i in range(a + 1, b + 1):
                    out[i] = run_done + whole[len(text[run:i].encode())]
            else:
                size = 0
                for i, c in enumerate(word, a + 1):
                    size += len(c.encode("utf-8", "surrogatepass"))
                    out[i] = done + counts[size]
                if word[0] == " ":
                    start, since = (a, done) if run is None else (run, run_done)
                    out[a + 1] = since + self.count_word(text[start : a + 1])
                elif word in ("'re", "'ve", "'ll"):
                    out[a + 2] = done + self.count_word("'") + self.count_word(word[1])
                run = None
            done += counts[-1]

    def fits(self, counts: np.ndarray, budget: int) -> int:
        """Code points of the longest prefix of at most `budget` tokens."""
        return int(np.flatnonzero(counts <= budget)[-1]) if budget >= 0 else 0


def loaded(path: str) -> PrefixCounter:
    if path not in _loaded:
        _loaded[path] = PrefixCounter(path)
    return _loaded[path]


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Bytes and tokens of every whole text, and whether it has more than `limit` tokens. Null texts are empty; one row for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = loaded(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = np.array([counter.count(t) for t in texts], np.int64)
            sizes = pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), sizes, pa.array(tokens), pa.array(tokens > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(released(run), COUNTS)


def truncated(docs: DataFrame, path: str, budget: int) -> DataFrame:
    """doc_id, the longest prefix of the text with at most `budget` tokens, and its tokens. Null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = loaded(path)
        for batch in batches:
            texts, tokens = [], []
            for t in batch.column(1).to_pylist():
                counts = counter.prefix_counts(t or "")
                i = counter.fits(counts, budget)
                texts.append((t or "")[:i])
                tokens.append(int(counts[i]))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(texts, pa.string()), pa.array(tokens, pa.int64())], ["doc_id", "text", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(released(run), "doc_id bigint, text string, n_tokens bigint")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), model_path("byte_bpe_50k.json"))


QUERIES = {"op6_token_counts": op6_token_counts}
ORACLES: dict[str, str] = {}
