"""Interpreter of structured edit plans: up to 24 operations on the numbered lines of a page, each checked before it is run.

A plan is JSON: {"drop_page": bool, "operations": [{"op", "line", "start_line", "end_line", "text", "pattern", "reason"}]}.
Operations change a list whose line numbers stay those of the original page, one after the other, so that the fold runs
in Arrow batches; pages without operations don't leave the JVM.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST = 24
RESULT = "struct<text:string,edits:array<struct<rule_id:string,action:string,before:string,after:string>>,notes:array<string>,drop_page:boolean>"

# Inline patterns by name with the rule that an edit by them is filed under
INLINE = {
    "angle_placeholders": (re.compile(r"<(?:…|\.{3})>"), "spacing_cleanup"),
    "bracket_note_markers": (re.compile(r"(?<=[A-Za-zА-Яа-яЁё])\[\d{1,3}\]"), "inline_note_marker_strip"),
    "inline_numeric_note_markers": (re.compile(r"(?<=[A-Za-zА-Яа-яЁё»”\")\]])\d{1,3}(?=(?:\s|[.,;:!?…])|$)"), "inline_note_marker_strip"),
    "return_to_index": (re.compile(r"(?im)^\s*ВЕРНУТЬСЯ\s+К\s+ИНДЕКСУ\s*$"), "isolated_ocr_noise"),
    "superscript_note_markers": (re.compile(r"(?<=[A-Za-zА-Яа-яЁё])[¹²³⁴⁵⁶⁷⁸⁹]"), "inline_note_marker_strip"),
}
# Lines that look like notes, invisible characters, and words of a reason that name notes
NOTE_LINE = re.compile(
    r"^\d{1,3}[.)]?\s+|^\[\d{1,3}\]\s+|https?://| // |//$|^(?:См\.|Ibid\.|Цит\. соч\.)|(?i:\b(?:см\.|цит\. по:|ibid\.|op\. cit\.|ргали\.|ф\.\s*\d+|оп\.\s*\d+|ед\.\s*хр\.|л\.\s*\d+|спб\.|м\.:|л\.;\s*м\.:|//)\b)"
)
INVISIBLE = re.compile("[­​-‍⁠﻿]")
REASONS = ("reference", "note", "citation", "footnote", "bibliograph")


class Refused(Exception):
    """An operation that isn't run; its message is noted."""


def number(value) -> int | None:
    try:
        n = int(value)
    except (TypeError, ValueError):
        return None
    return n if n > 0 else None


def glued(a: str, b: str) -> str:
    a, b = a.rstrip(), b.lstrip()
    if re.search(r"[A-Za-zА-Яа-яЁё]-$", a) and re.match(r"[A-Za-zА-Яа-яЁё]", b):
        return a[:-1] + b
    tight = not a or not b or a[-1] in "(«\"“" or b[0] in ",.;:!?)]»"
    return a + b if tight else f"{a} {b}"


class Sheet:
    """The lines of a page under their numbers. Each operation gives (rule, action, before, after)."""

    def __init__(self, text: str):
        self.rows = list(enumerate(text.split("\n"), 1))
        self.next = len(self.rows) + 1

    @property
    def text(self) -> str:
        return "\n".join(t for _, t in self.rows)

    def index(self, n: int) -> int | None:
        return next((k for k, (i, _) in enumerate(self.rows) if i == n), None)

    def delete_line_range(self, o: dict):
        a = number(o.get("start_line"))
        b = number(o.get("end_line")) or a
        if a is None:
            raise Refused("delete_line_range_missing_start_ignored")
        gone = [t for i, t in self.rows if a <= i <= b]
        if not gone:
            raise Refused(f"delete_line_range_missing_target:{a}-{b}")
        self.rows = [r for r in self.rows if not a <= r[0] <= b]
        noted = any(w in str(o.get("reason") or "").lower() for w in REASONS)
        return "trailing_reference_block_strip" if noted else "isolated_ocr_noise", "delete", "\n".join(gone), ""

    def merge_with_next(self, o: dict):
        n = number(o.get("line"))
        if n is None:
            raise Refused("merge_with_next_missing_line_ignored")
        k = self.index(n)
        if k is None or k + 1 == len(self.rows):
            raise Refused(f"merge_with_next_missing_target:{n}")
        a, b = self.rows[k][1], self.rows[k + 1][1]
        one = glued(a, b)
        self.rows[k : k + 2] = [(n, one)]
        return "line_end_hyphenation" if a.endswith("-") and len(one) >= 6 else "fake_paragraph_breaks", "merge", f"{a}\n{b}", one

    def _split(self, o: dict, name: str, place: Callable[[str, str, int], int]):
        n, marker = number(o.get("line")), str(o.get("text") or "")
        if n is None or not marker:
            raise Refused(f"{name}_missing_args_ignored")
        k = self.index(n)
        if k is None:
            raise Refused(f"{name}_missing_target:{n}")
        line = self.rows[k][1]
        at = place(line, marker, n)
        a, b = line[:at].rstrip(), line[at:].lstrip()
        self.rows[k : k + 1] = [(n, a), (self.next, b)]
        self.next += 1
        return "heading_structure_repair", "split", line, f"{a}\n{b}".strip()

    def split_before_text(self, o: dict):
        def place(line: str, marker: str, n: int) -> int:
            at = line.find(marker)
            if at <= 0:
                raise Refused(f"split_before_text_marker_not_found:{n}")
            return at

        return self._split(o, "split_before_text", place)

    def split_after_text(self, o: dict):
        def place(line: str, marker: str, n: int) -> int:
            at = line.find(marker)
            if at < 0:
                raise Refused(f"split_after_text_marker_not_found:{n}")
            if at + len(marker) >= len(line):
                raise Refused(f"split_after_text_marker_at_end:{n}")
            return at + len(marker)

        return self._split(o, "split_after_text", place)

    def remove_inline_pattern(self, o: dict):
        name = str(o.get("pattern") or "").strip()
        if name not in INLINE:
            raise Refused(f"unsupported_inline_pattern_ignored:{name or 'missing'}")
        pattern, rule = INLINE[name]
        only = number(o.get("line"))
        changed = []
        for k, (i, t) in enumerate(self.rows):
            new = pattern.sub("", t)
            new = new.strip() if name == "return_to_index" else new
            if new != t and only in (None, i):
                changed.append((t, new))
                self.rows[k] = i, new
        if not changed:
            raise Refused(f"inline_pattern_noop:{name}")
        return rule, "replace", *("\n".join(c) for c in zip(*changed))

    def strip_trailing_reference_block(self, o: dict):
        solid = lambda k: [t for _, t in self.rows[k:] if t.strip()]
        notes = lambda k: sum(bool(NOTE_LINE.search(t.strip())) for t in solid(k))
        told = number(o.get("start_line"))
        k = self.index(told) if told else None
        cut = k if k is not None and notes(k) >= 2 else next((k for k in range(max(0, len(self.rows) - 20), len(self.rows)) if notes(k) >= 2 and NOTE_LINE.search(solid(k)[0].strip())), None)
        if cut is None or len(self.rows) < 2:
            raise Refused("strip_trailing_reference_block_noop")
        gone = "\n".join(t for _, t in self.rows[cut:]).strip()
        self.rows = self.rows[:cut]
        return "trailing_reference_block_strip", "delete", gone, ""

    def normalize_spacing(self, o: dict):
        before = self.text
        tidy = [(i, re.sub(r"\s+([,.;:!?])", r"\1", re.sub("[ \t ]{2,}", " ", INVISIBLE.sub("", t))).strip()) for i, t in self.rows]
        self.rows = [r for k, r in enumerate(tidy) if r[1] or k == 0 or tidy[k - 1][1]]
        if self.text == before:
            raise Refused("normalize_spacing_noop")
        return "spacing_cleanup", "normalize", before, self.text


# Names of operations
OPERATIONS = ("delete_line_range", "merge_with_next", "normalize_spacing", "remove_inline_pattern", "split_after_text", "split_before_text", "strip_trailing_reference_block")


def parsed(answer: str | None) -> dict:
    """The first JSON object in a model's answer, which may stand in a code fence; empty if there is none."""
    text = re.sub(r"^```[a-zA-Z]*\s*|\s*```$", "", (answer or "").strip())
    for m in re.finditer(r"\{", text):
        try:
            found, _ = json.JSONDecoder().raw_decode(text[m.start() :])
        except ValueError:
            continue
        return found
    return {}


def executed(text: str | None, plan: dict, allow_drop: bool = False, most: int = MOST) -> dict:
    """The page after a plan: text, the edits made, notes on what was refused, and whether it was dropped."""
    text = (text or "").replace("\r\n", "\n").replace("\r", "\n")
    notes, edits = [], []
    drop, operations = bool(plan.get("drop_page")), plan.get("operations", [])
    if drop and not allow_drop:
        notes.append("model_drop_page_ignored")
    if not isinstance(operations, list):
        notes.append("invalid_operations_list_ignored")
        operations = []
    if len(operations) > most:
        notes.append(f"operation_count_capped:{len(operations)}->{most}")
    record = lambda *x: dict(zip(("rule_id", "action", "before", "after"), x))
    if drop and allow_drop:
        return {"text": "", "edits": [record("llm_non_body_page_drop", "drop_page", text.strip(), "")], "notes": notes, "drop_page": True}
    sheet = Sheet(text)
    for o in operations[:most]:
        try:
            if not isinstance(o, dict):
                raise Refused("non_object_operation_ignored")
            name = str(o.get("op", "")).strip().lower()
            if name not in OPERATIONS:
                raise Refused(f"unsupported_operation_ignored:{name or 'missing'}")
            edits.append(record(*getattr(sheet, name)(o)))
        except Refused as why:
            notes.append(str(why))
    out = re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+\n", "\n", sheet.text)).strip()
    return {"text": out, "edits": edits, "notes": notes, "drop_page": False}


def applied(pages: DataFrame, text: str, plan: str, allow_drop: Column | None = None, out: str = "edited") -> DataFrame:
    """pages with the result of the plan (JSON text; null: none) on a text in a column `out`."""

    @F.pandas_udf(RESULT)
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, plans, drops in batches:
            yield pd.DataFrame([executed(t, parsed(p), bool(d)) for t, p, d in zip(texts, plans, drops)], columns=["text", "edits", "notes", "drop_page"])

    return pages.withColumn(out, run(F.col(text), F.col(plan), F.coalesce(allow_drop, F.lit(False)) if allow_drop is not None else F.lit(False)))
