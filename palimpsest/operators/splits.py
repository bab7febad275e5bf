"""Words that a space broke, put together where a lexicon or an ending says so."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .post_clean import joined_splits

#: Entries of a lexicon, at most: it goes to every worker.
MOST_ENTRIES = 2_000_000

# Short words that stand alone, endings that don't, and roots that follow a prefix
ALONE = frozenset(
    "бы был была были было вас век вне все всех где года даже два для друг его ее если еще или им их как кто лет ли лишь мир мы над нам нас него ней не них но об одна одни одну она они оно от под по при про раз роль себе себя "
    "сил сила силы так тех то уже это эту этого этом".split()
)
ENDINGS = frozenset("ого его ому ими ыми ского скому скими ских ской скую ское ские ства стве ству ством ствии ствия ствием ся сь".split())
REFLEXIVE = frozenset(("ся", "сь"))
ROOTS = {"ис": ("след", "следов", "польз", "ключ", "чез", "черп", "прав", "кус", "ход"), "про": ("извод",)}
# How sure a lexicon must be of the whole word, by kind of break, and at most of a part
LONG, PREFIX, MIDDLE, PART = 0.65, 0.55, 0.7, 0.4

_BREAKS = tuple(re.compile(rf"\b([А-Яа-яЁё]{{{a}}})\s+([а-яё]{{{b}}})\b") for a, b in (("6,", "2,6"), ("2,4", "6,"), ("4,6", "3,8")))


class Joiner:
    """Decides on two neighbours by the scores of words (0 for a word that isn't known)."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores

    def score(self, word: str) -> float:
        return self.scores.get(word.lower(), 0.0)

    def doubtful(self, *parts: str) -> bool:
        return any(self.score(p) <= PART for p in parts)

    def stem(self, a: str, b: str) -> bool:
        end = b.lower()
        if end in ALONE or (len(end) == 2 and end not in REFLEXIVE):
            return False
        if self.score(a + b) >= LONG:
            return end in REFLEXIVE or self.doubtful(a, b)
        return end in ENDINGS

    def prefix(self, a: str, b: str) -> bool:
        return b.lower().startswith(ROOTS.get(a.lower(), ("\0",))) and self.score(a + b) >= PREFIX

    def middle(self, a: str, b: str) -> bool:
        return not {a.lower(), b.lower()} & ALONE and self.score(a + b) >= MIDDLE and self.doubtful(a, b)

    def joined(self, text: str) -> str:
        for pattern, test in zip(_BREAKS, (self.stem, self.prefix, self.middle)):
            text = pattern.sub(lambda m, test=test: m[1] + m[2] if test(m[1], m[2]) else m[0], text)
        return text


def without_splits(docs: DataFrame, lexicon: DataFrame | None = None, text: str = "text") -> DataFrame:
    """docs with broken words of a text put together. lexicon: (word, score); without one only endings tell, as for a word that isn't in it.

    The lexicon goes to every worker, so that it is refused beyond MOST_ENTRIES."""
    scores: dict[str, float] = {}
    if lexicon is not None:
        rows = lexicon.select(F.lower("word"), F.col("score").cast("double")).limit(MOST_ENTRIES + 1).collect()
        if len(rows) > MOST_ENTRIES:
            raise ValueError(f"a lexicon of more than {MOST_ENTRIES} words")
        for word, score in rows:
            scores[word] = max(score or 0.0, scores.get(word, 0.0))
    known = docs.sparkSession.sparkContext.broadcast(scores)
    names, at = docs.columns, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joiner = Joiner(known.value)
        for batch in batches:
            made = pa.array([None if t is None else joiner.joined(t) for t in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([made if k == at else c for k, c in enumerate(batch.columns)], names)

    return docs.withColumn(text, joined_splits(F.col(text))).mapInArrow(run, docs.schema)
