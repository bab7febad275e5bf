"""Regular expressions and lines as the cleaning rules mean them: Unicode classes, line feeds as the only line ends."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache
from re import _constants as K
from re import _parser

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What ends a line besides a line feed, and any line end; a line feed that a carriage return stands before belongs to it.
ODD_ENDS, SEPARATORS = "\r\x0b\x0c\x1c-\x1e\x85", "\u2028\u2029"
LINE_END = f"[\n{ODD_ENDS}{SEPARATORS}](?:(?<=\r)\n)?"
#: The characters of \\s as rx() means it.
BLANKS = "".join(map(chr, (0x20, *range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
STRINGS = "array<string>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once for each row, whatever the optimizer inlines."""
    return F.element_at(F.transform(F.array(value), body), 1)


_BLANK, _DIGIT = r"\s", r"\p{Nd}"
#: Letters beyond a case's two that fold to one of these.
_FOLDS = {"s": "ſ", "k": "\u212a", "i": "İı"}


def _starts(items) -> tuple[set[str] | None, bool]:
    """The characters (or classes) that a match of a parsed pattern may begin with, None if they can't be told; and whether a match may be empty."""
    out: set[str] = set()
    for op, a in items:
        if op in (K.AT, K.ASSERT, K.ASSERT_NOT):
            continue
        own: set[str] | None = set()
        empty = False
        if op is K.LITERAL:
            own = {chr(a)}
        elif op is K.IN:
            for kind, b in a:
                if kind is K.LITERAL:
                    own.add(chr(b))
                elif kind is K.RANGE and b[1] - b[0] < 100:
                    own |= {chr(c) for c in range(b[0], b[1] + 1)}
                elif kind is K.CATEGORY and b in (K.CATEGORY_SPACE, K.CATEGORY_DIGIT):
                    own.add(_BLANK if b is K.CATEGORY_SPACE else _DIGIT)
                else:
                    return None, False
        elif op is K.BRANCH:
            parts = [_starts(x) for x in a[1]]
            own = None if any(x is None for x, _ in parts) else set().union(*(x for x, _ in parts))
            empty = any(e for _, e in parts)
        elif op is K.SUBPATTERN and not a[1] and not a[2]:
            own, empty = _starts(a[3])
        elif op in (K.MAX_REPEAT, K.MIN_REPEAT):
            own, empty = _starts(a[2])
            empty = empty or a[0] == 0
        else:
            return None, False
        if own is None:
            return None, False
        out |= own
        if not empty:
            return out, False
    return out, True


@lru_cache(None)
def lead(pattern: str, flags: str = "") -> str:
    """A look-ahead for the characters that matches begin with, which spares the places where a boundary or a list of words would be tried
    in vain; empty where it can't be told or would hold nearly everywhere."""
    try:
        tree = list(_parser.parse(pattern))
    except re.error:
        return ""
    op, a = tree[0] if tree else (None, None)
    simple = op in (K.LITERAL, K.IN) or (op, a) == (K.AT, K.AT_BEGINNING) or (op is K.MAX_REPEAT and a[0] > 0 and a[2][0][0] in (K.LITERAL, K.IN))
    first, empty = _starts(tree)
    if simple or not first or empty:
        return ""
    if "i" in flags:
        first |= {x for c in first if len(c) == 1 for x in (c.lower(), c.upper(), *_FOLDS.get(c.lower(), ""))}
    signs = {c for c in first if len(c) == 1}
    cyrillic = {c for c in signs if "\u0400" <= c <= "\u04ff"}
    if sum(c.isascii() and c.isalpha() for c in signs) > 30 or any(c.isalpha() and not c.isascii() and c not in "ſ\u212aİı" for c in signs - cyrillic):
        return ""
    more = ("\u0400-\u04ff\u1c80-\u1c88" if cyrillic else "") + "".join(sorted(first - signs))
    return "(?-i:(?=[" + "".join(rf"\x{{{ord(c):x}}}" for c in sorted(signs - cyrillic)) + more + "]))"


def rx(pattern: str, flags: str = "") -> str:
    start = lead(pattern, flags)
    return f"(?dU{flags}){start}(?:{pattern})" if start else f"(?dU{flags}){pattern}"


def has(c: Column, pattern: str, flags: str = "") -> Column:
    return F.coalesce(c, F.lit("")).rlike(rx(pattern, flags))


def full(c: Column, pattern: str, flags: str = "") -> Column:
    return has(c, rf"^(?:{pattern})\z", flags)


def sub(c: Column, pattern: str, to: str, flags: str = "") -> Column:
    return F.regexp_replace(c, rx(pattern, flags), to)


def count(c: Column, pattern: str, flags: str = "") -> Column:
    return F.regexp_count(c, F.lit(rx(pattern, flags)))


def found(c: Column, pattern: str, flags: str = "", group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(rx(pattern, flags)), F.lit(group))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(BLANKS))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(BLANKS))


def blank(c: Column) -> Column:
    return lstrip(F.coalesce(c, F.lit(""))) == ""


def compact(c: Column) -> Column:
    """White space runs as one space, none at the ends. Single spaces, which most of them are, stay untouched."""
    return sub(strip(c), r"\s(?:\s+|(?<! ))", " ")


def n_compact(c: Column) -> Column:
    """Characters that aren't white space."""
    return F.length(sub(F.replace(F.replace(c, F.lit(" "), F.lit("")), F.lit("\n"), F.lit("")), r"\s+", ""))


def lines(c: Column) -> Column:
    """The lines of a text; a line end at the end of the text starts no line."""
    odd = lambda t: t.contains(SEPARATORS[0]) | t.contains(SEPARATORS[1]) | t.rlike(f"[{ODD_ENDS}]")
    parts = let(F.coalesce(c, F.lit("")), lambda t: F.when(odd(t), F.split(t, LINE_END)).otherwise(F.split(t, "\n")))
    return let(parts, lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, 1, F.size(p) - 1)).otherwise(p))


def solid_lines(c: Column) -> Column:
    """The lines with something in them, stripped."""
    return F.filter(F.transform(lines(c), strip), lambda x: x != "")


def joined(c: Column, by: str = "\n") -> Column:
    return F.array_join(c, by)


def tally(array: Column, test: Callable[[Column], Column]) -> Column:
    """How many elements pass a test."""
    return F.size(F.filter(array, test))


def n_words(c: Column) -> Column:
    return let(compact(F.coalesce(c, F.lit(""))), lambda x: F.when(x == "", 0).otherwise(F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1))


def folded(array: Column, start: Column, kind: str, merge: Callable[[Column, Column], Column]) -> Column:
    """All that merge() adds to the field `out` of a state (of type kind) over an array. Pieces of about the square root of its length are
    folded one after the other, so that what a step copies stays small."""
    size = F.ceil(F.sqrt(F.size(array))).cast("int")
    pieces = F.transform(F.sequence(F.lit(1), F.size(array), size), lambda i: F.slice(array, i, size))
    whole = f"struct<outs:array<{STRINGS}>,state:{kind}>"

    def piece(s: Column, part: Column) -> Column:
        done = F.aggregate(part, s["state"].withField("out", F.array().cast(STRINGS)).cast(kind), merge)
        return let(done, lambda d: F.struct(F.concat(s["outs"], F.array(d["out"])).alias("outs"), d.alias("state")).cast(whole))

    begin = F.struct(F.array().cast(f"array<{STRINGS}>").alias("outs"), start.alias("state")).cast(whole)
    return F.when(F.size(array) > 0, F.aggregate(pieces, begin, piece, lambda s: F.flatten(s["outs"]))).otherwise(F.array().cast(STRINGS))


def strings(*values: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(STRINGS)


def one_of(c: Column, values) -> Column:
    return F.coalesce(c, F.lit("")).isin(*values)


def first_of(a: Column, b: Column) -> Column:
    """a, or b where a is null or empty."""
    return F.when((a.isNull()) | (a == ""), b).otherwise(a)


def when_true(**tests: Column) -> Column:
    """The names of the tests that hold, in order."""
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()]))
