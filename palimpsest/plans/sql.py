"""Small pieces of SQL that state the rules of lines and pages for the comparison engine.

It has no look-around, and its word boundaries know ASCII only, so that words are cut out first or stand between what
isn't a letter, digit or underscore."""

from __future__ import annotations

from ..functions import patterns as P

CYRILLIC = "[А-Яа-яЁё]"
LETTER = "[A-Za-zА-Яа-яЁё]"
EDGE = r"[^\p{L}\p{N}_]"


def quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


def has(c: str, pattern: str, flags: str = "") -> str:
    return f"regexp_matches({c}, '{f'(?{flags})' if flags else ''}{quoted(pattern)}')"


def full(c: str, pattern: str, flags: str = "") -> str:
    return has(c, rf"^(?:{pattern})\z", flags)


def words(pattern: str) -> str:
    """A pattern written with word boundaries at both ends, or the start, as one with edges."""
    out = pattern
    if out.startswith(r"\b"):
        out = rf"(?:^|{EDGE})" + out[2:]
    if out.endswith(r")\b"):  # what follows the group follows its alternatives
        out = out[:-2].replace(r"\b", "") + r"\b"
    return out.replace(r"\b", rf"(?:$|{EDGE})")


def sub(c: str, pattern: str, to: str = "", flags: str = "") -> str:
    return f"regexp_replace({c}, '{f'(?{flags})' if flags else ''}{quoted(pattern)}', '{quoted(to)}', 'g')"


def n(c: str, pattern: str, flags: str = "") -> str:
    return f"len(regexp_extract_all({c}, '{f'(?{flags})' if flags else ''}{quoted(pattern)}'))"


def strip(c: str) -> str:
    return sub(c, r"^\s+|\s+$")


def compact(c: str) -> str:
    return sub(strip(c), r"\s+", " ")


def tally(x: str, test, name: str = "y") -> str:
    """How many of a list pass a test, a function from the element's SQL name to SQL."""
    return f"len(list_filter({x}, lambda {name}: {test(name)}))"


def any_of(x: str, test) -> str:
    return f"({tally(x, test)} > 0)"


def lines(c: str = "text") -> str:
    """A line end at the end of the text starts no line."""
    return f"(CASE WHEN {c} LIKE '%' || chr(10) OR {c} = '' THEN string_split({c}, chr(10))[:-2] ELSE string_split({c}, chr(10)) END)"


def solid(c: str = "text") -> str:
    return f"list_filter(list_transform({lines(c)}, lambda y: {strip('y')}), lambda y: y <> '')"


def n_words(c: str) -> str:
    return n(c, r"\S+")


def n_compact(c: str) -> str:
    return f"length({sub(c, chr(92) + 's+')})"


def joined(x: str, by: str = "chr(10)") -> str:
    return f"coalesce(list_aggregate({x}, 'string_agg', {by}), '')"


def heading(y: str) -> str:
    return full(compact(y), P.HEADING)


def fragment(y: str) -> str:
    return f"({compact(y)} <> '' AND length({compact(y)}) <= 40 AND length({sub(y, '[^A-ZА-ЯЁ]')}) >= 4)"


def noise(y: str) -> str:
    singles = ", ".join(f"'{s}'" for s in P.NOISE_SINGLES)
    return f"({y} <> '' AND ({full(y, P.NOISE)} OR {y} IN ({singles}) OR {full(y, '[0-9]{1,3}')} OR ({full(y, P.ROMAN, 'i')} AND length({y}) <= 6) OR (length({y}) = 1 AND NOT {has(y, '[' + chr(92) + 'p{L}' + chr(92) + 'p{N}]')})))"


def reference(y: str) -> str:
    numbered = f"({has(y, P.NUMBERED_LINE)} AND ({has(y, P.BACKMATTER_REFERENCE.replace(chr(92) + 'b', '(?:$|' + EDGE + ')'), 'i')} OR {has(y, P.YEAR)} OR length({y}) >= 60))"
    return f"({y} <> '' AND ({numbered} OR {has(y, P.REFERENCE_CUE, 'i')}))"


def ends_sentence(y: str) -> str:
    return has(y, P.SENTENCE_END)


def word_list(c: str) -> str:
    """Runs of letters, digits and underscores."""
    return f"regexp_extract_all({c}, '[\\p{{L}}\\p{{N}}_]+')"


def case(tests: list[tuple[str, str]], otherwise: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {t} THEN {v}" for t, v in tests) + f" ELSE {otherwise} END"
