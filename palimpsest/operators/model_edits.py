"""Model stages: requests through a client of the caller's, and the guards that decide whether an answer is taken.

A client is made once in each worker by a picklable factory and turns a list of prompts into a list of answers (None: none).
Without one, pages pass as they are."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.rx import count, found, has, let, n_compact, one_of, solid_lines, strip, sub, tally, when_true
from .edit_plans import NOTE_LINE

# Heading markers, tags by what they allow, and the share of a page that must stay
MARKER = r"^[IVXLCDM]+\.\s+"
DROP_FLAGS = ("publisher_meta_page", "glossary_page", "toc_index_material", "reference_only_page")
NONBODY_TAGS = ("publisher_meta_left", "garbled_page", "empty_page_after_cleaning")
BLOCK_TAGS = ("endnote_block_left", "citation_url_left", "reference_suffix_left")
MARKER_TAGS = ("footnote_marker_left", "inline_note_marker_left")
LEAST = {"notes": 0.05, "nonbody": 0.01, "block": 0.12, "marker": 0.30, "other": 0.72}


class Client(Protocol):
    def complete(self, prompts: list[str]) -> list[str | None]: ...


class NoClient:
    """Answers nothing."""

    def complete(self, prompts: list[str]) -> list[str | None]:
        return [None] * len(prompts)


def asked(pages: DataFrame, prompt: str, make_client: Callable[[], Client] = NoClient, out: str = "answer", at_once: int | None = None, tries: int = 3, wait: float = 1.5) -> DataFrame:
    """pages with the answers to a column of prompts (null: not asked). at_once bounds the tasks, and so the requests in flight.

    A batch that fails is tried again after a growing wait; in the end its answers are null. Write the result before going
    on: a lost task asks again."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        client = make_client()
        for prompts in batches:
            wanted = prompts.dropna()
            answers: list[str | None] = [None] * len(wanted)
            for k in range(tries if len(wanted) else 0):
                try:
                    answers = client.complete(wanted.tolist())
                    break
                except OSError:
                    time.sleep(wait * 2**k)
            yield pd.Series(answers, index=wanted.index, dtype=object).reindex(prompts.index)

    dealt = pages.repartition(at_once) if at_once else pages
    return dealt.withColumn(out, run(F.col(prompt)))


def _any_of(tags: Column, names) -> Column:
    return F.coalesce(F.arrays_overlap(tags, F.array(*[F.lit(n) for n in names])), F.lit(False))


def is_note_page(text: Column) -> Column:
    return (tally(solid_lines(text), lambda x: has(x, r"^\[\d{1,3}\]")) >= 5) | (count(F.coalesce(text, F.lit("")), r"\[\d{1,3}\]") >= 8)


def missing_markers(raw: Column, cleaned: Column) -> Column:
    """Roman-numeral markers that begin lines of the raw text and are nowhere in the cleaned one."""
    markers = F.array_sort(F.array_distinct(F.transform(found(F.coalesce(raw, F.lit("")), MARKER, "im"), F.upper)))
    return F.filter(markers, lambda m: ~F.contains(F.upper(F.coalesce(cleaned, F.lit(""))), m))


def may_drop(flags: Column, note_page: Column, delete_notes: bool = True) -> Column:
    """Whether a model may empty a page: note pages, and pages flagged as no body text. flags: array of rule ids."""
    return (note_page & F.lit(delete_notes)) | _any_of(flags, DROP_FLAGS)


def guarded(raw: Column, before: Column, after: Column, dropped: Column, note_page: Column, delete_notes: bool = True) -> Column:
    """struct(text, status, notes): a model's text if it isn't empty, much shorter or without headings for no reason, else the text before."""
    free = dropped | (note_page & F.lit(delete_notes))
    empty = F.coalesce(after, F.lit("")) == ""
    raw = F.coalesce(raw, F.lit(""))
    first = F.when(empty & ~free, before).otherwise(F.coalesce(after, F.lit("")))

    def told(text: Column) -> Column:
        short = ~free & (n_compact(raw) >= 200) & (n_compact(text) < F.floor(n_compact(raw) * 0.72))
        kept = F.when(short, before).otherwise(text)
        lost = ~free & (F.size(missing_markers(raw, kept)) > 0)
        notes = when_true(model_marked_non_body_page=empty & dropped, note_page_removed=empty & free & ~dropped, empty_model_output_used_fallback=empty & ~free, model_output_too_short_used_fallback=short, missing_heading_markers_used_fallback=lost)
        fell = F.exists(notes, lambda n: n.endswith("used_fallback"))
        return F.struct(strip(F.when(lost, before).otherwise(kept)).alias("text"), F.when(fell, "fallback").otherwise("structured").alias("status"), notes.alias("notes"))

    return let(first, told)


def least_share(tags: Column, note_page: Column, delete_notes: bool = True) -> Column:
    """The share of a page that a repair must leave, by what is wrong with it."""
    return (
        F.when(note_page & F.lit(delete_notes), LEAST["notes"]).when(_any_of(tags, NONBODY_TAGS), LEAST["nonbody"]).when(_any_of(tags, BLOCK_TAGS), LEAST["block"])
        .when(_any_of(tags, MARKER_TAGS), LEAST["marker"]).otherwise(LEAST["other"])
    )


def may_shrink(tags: Column, note_page: Column, delete_notes: bool = True) -> Column:
    return (note_page & F.lit(delete_notes)) | _any_of(tags, ("footnote_marker_left", *BLOCK_TAGS, *NONBODY_TAGS))


def risk(known: Column, verdict: Column, llm_verdict: Column) -> Column:
    worst = lambda v: one_of(verdict, [v]) | one_of(llm_verdict, [v])
    return F.when(F.coalesce(known, F.lit("")) != "", known).when(worst("reject"), "high").when(worst("escalate"), "medium").otherwise("low")


def needs_repair(tags: Column, risk_level: Column, llm_verdict: Column) -> Column:
    return (F.size(tags) > 0) | one_of(risk_level, ["medium", "high"]) | one_of(llm_verdict, ["escalate", "reject"])


def _note_line(x: Column) -> Column:
    y = strip(x)
    return (y != "") & y.rlike("(?dU)" + NOTE_LINE.pattern)


def note_tail_cut(text: Column) -> Column:
    """The text before a tail of notes: the first note line among the last twenty with two or more note lines from it on."""

    def cut(x: Column) -> Column:
        at = F.get(F.filter(F.sequence(F.greatest(F.lit(0), F.size(x) - 20), F.size(x) - 1), lambda i: _note_line(F.get(x, i)) & (tally(F.slice(x, i + 1, F.size(x)), _note_line) >= 2)), 0)
        return let(at, lambda k: F.when(k.isNull(), text).otherwise(strip(F.array_join(F.slice(x, 1, k), "\n"))))

    return let(F.split(text, "\n"), cut)


def inline_notes_cut(text: Column) -> Column:
    t = sub(sub(text, P.BRACKET_NOTE, ""), r"(?<=[^\W\d_»”\")\]])\[\d{1,3}\]", "")
    return sub(sub(sub(t, r"(?<=[^\W\d_»”\")\]])\d{1,3}(?=(?:\s|[.,;:!?]))", ""), r"\s{2,}", " "), " +\n", "\n")


def notes_cut(text: Column, tags: Column, delete_notes: bool = True) -> Column:
    """What a repair does after a model, by tags: pages that aren't body text are emptied, note tails and markers go."""
    if not delete_notes:
        return text
    tail = F.when(_any_of(tags, BLOCK_TAGS), let(text, note_tail_cut)).otherwise(text)
    return F.when(_any_of(tags, NONBODY_TAGS), F.lit("")).otherwise(strip(let(tail, lambda t: F.when(_any_of(tags, MARKER_TAGS), inline_notes_cut(t)).otherwise(t))))


def provenance(**fields: Column | str | None) -> Column:
    """A note that says where a text comes from: name=value pairs, those without value left out."""
    parts = [F.when(c.isNotNull(), F.concat(F.lit(f"{k}="), c)) for k, v in fields.items() for c in [v if isinstance(v, Column) else F.lit(v).cast("string")]]
    return F.concat_ws(";", *parts)


__all__ = ["Client", "NoClient", "asked", "guarded", "least_share", "may_drop", "may_shrink", "missing_markers", "needs_repair", "notes_cut", "provenance", "risk"]
