"""Text normalisation as column functions; each takes and gives a text."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .rx import blank, compact, full, has, joined, let, lines, rstrip, solid_lines, strip, sub


def normalized(text: Column) -> Column:
    """Line ends, trailing blanks and blank-line runs of extracted text."""
    t = sub(sub(F.coalesce(text, F.lit("")), "\x00", " "), r"\r\n?", "\n")
    return strip(sub(sub(t, r"[ \t]+\n", "\n"), r"\n{3,}", "\n\n"))


def marks_spaced(text: Column) -> Column:
    """No white space before closing punctuation or after opening brackets."""
    return sub(sub(sub(text, P.BEFORE_MARK, "$1"), P.AFTER_OPENER, "$1"), P.BEFORE_CLOSER, "$1")


def spacing(text: Column) -> Column:
    return marks_spaced(sub(sub(text, " ", " "), P.SPACE_RUN, " "))


def bullets(text: Column) -> Column:
    """A letter x that begins a line before a word is a list dash."""
    return joined(F.transform(lines(text), lambda x: F.regexp_replace(rstrip(x), "(?dU)" + P.OCR_BULLET, "- ")))


def note_markers(text: Column) -> Column:
    return sub(sub(sub(text, P.BRACKET_NOTE, ""), P.SUPERSCRIPT_NOTE, ""), P.SUFFIX_NOTE, "")


def repair_spacing(text: Column) -> Column:
    """The repair stage's variant: bracket and digit notes go, and all white space runs are one space."""
    return strip(sub(marks_spaced(sub(sub(text, P.BRACKET_NOTE, ""), P.SUFFIX_NOTE, "")), r"\s+", " "))


def list_breaks(text: Column) -> Column:
    """Dashes after a semicolon begin lines of their own."""
    return sub(text, r";\s+-\s+(?=\S)", ";\n- ")


def stitch_line(text: Column) -> Column:
    t = F.regexp_replace(F.replace(text, F.lit(P.SOFT_HYPHEN), F.lit("")), "(?dU)" + P.OCR_BULLET, "- ")
    return strip(marks_spaced(compact(t)))


def sample_text(text: Column) -> Column:
    return compact(sub(text, "\x00", " "))


def without_blank_lines(text: Column) -> Column:
    kept = F.transform(F.filter(lines(text), lambda x: ~blank(x)), rstrip)
    return let(strip(joined(kept)), lambda t: F.when(t == "", t).otherwise(F.concat(t, F.lit("\n"))))


def single_blank_lines(text: Column) -> Column:
    """Of blank lines in a row, one stays."""
    return let(lines(text), lambda x: joined(F.filter(x, lambda line, i: ~blank(line) | (i == 0) | ~blank(F.get(x, i - 1)))))


def numbered(text: Column) -> Column:
    """Lines with their numbers, three digits at least."""
    label = lambda i: F.lpad((i + 1).cast("string"), 3, "0")
    return joined(F.transform(lines(text), lambda x, i: F.concat(F.when(i < 999, label(i)).otherwise((i + 1).cast("string")), F.lit("| "), x)))


def stem(path: Column, most: int = 140) -> Column:
    """A safe name from a path: the file's stem, with what isn't a letter, digit, dash or underscore as underscores."""
    base = F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
    safe = F.btrim(F.regexp_replace(F.substring(base, 1, most), r"[^\p{L}\p{N}_-]", "_"), F.lit("_"))
    return F.when(safe == "", F.lit("book")).otherwise(safe)


def unescaped(text: Column) -> Column:
    """Character references of HTML decoded once: numeric ones, and the named ones that Python's html.entities lists; others stay."""
    named = F.create_map(*[F.lit(x) for name, code in name2codepoint.items() for x in (name, chr(code))])
    point = lambda hexadecimal: F.decode(F.unhex(F.lpad(hexadecimal, 8, "0")), "UTF-32")

    def one(p: Column) -> Column:
        body = F.substr(p, F.lit(2), F.length(p) - 2)
        number = F.conv(F.when(body.startswith("#x") | body.startswith("#X"), F.substr(body, F.lit(3))).otherwise(F.conv(F.substr(body, F.lit(2)), 10, 16)), 16, 10).cast("bigint")
        legal = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        decoded = F.when(body.startswith("#"), F.when(legal, point(F.hex(number))).otherwise("\ufffd")).otherwise(F.coalesce(named[body], p))
        return F.when(p.startswith("&") & p.endswith(";") & (F.length(p) > 2), decoded).otherwise(p)

    parts = F.regexp_extract_all(text, F.lit(r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});|(?s:[^&]+|&)"), F.lit(0))
    return F.when(text.contains("&"), F.array_join(F.transform(parts, one), "")).otherwise(text)


def html_text(html: Column) -> Column:
    """Text of an HTML part: no scripts, styles and tags, character references decoded, white space as one space."""
    t = sub(F.coalesce(html, F.lit("")), r"<(script|style)\b[^>]*>.*?</\1>", " ", "is")
    return compact(let(sub(t, r"<[^>]+>", " "), unescaped))


def homoglyphs(text: Column) -> Column:
    """struct(text, detected, auto_fixed, warned, samples): Latin letters in Cyrillic words, put right where every one has a look-alike.

    Words are runs of four or more letters, digits, underscores and dashes."""

    def word(w: Column) -> Column:
        mixed = full(w, r"[\w-]{4,}") & has(w, P.CYRILLIC) & has(w, P.LATIN)
        safe = full(w, rf"[^A-Za-z]*(?:[{P.LOOK_LATIN}][^A-Za-z]*)+") & ~((F.length(w) <= 4) & (F.upper(w) == w)) & ~has(w, r"^(?:http|www)")
        kind = F.when(safe, "auto_fix").when(has(w, f"[{P.SUSPICIOUS_LATIN}]"), "warn_suspicious").otherwise("warn")
        after = F.when(mixed & safe, F.translate(w, P.LOOK_LATIN, P.LOOK_CYRILLIC)).otherwise(w)
        return F.struct(F.when(mixed, kind).alias("kind"), w.alias("before"), after.alias("after"))

    def audited(words: Column) -> Column:
        found = F.filter(words, lambda x: x["kind"].isNotNull())
        fixed = F.size(F.filter(found, lambda x: x["kind"] == "auto_fix"))
        return F.struct(
            F.array_join(F.transform(words, lambda x: x["after"]), "").alias("text"), F.size(found).alias("detected"), fixed.alias("auto_fixed"),
            (F.size(found) - fixed).alias("warned"), F.slice(found, 1, 12).alias("samples"),
        )

    parts = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?dU)\b[\w-]{4,}\b|(?s:.)"), F.lit(0))
    return let(F.transform(parts, word), audited)


def headings_kept(text: Column) -> Column:
    """The lines of a text that look like headings, stripped."""
    return F.filter(solid_lines(text), lambda x: full(x, P.REVIEW_HEADING))
