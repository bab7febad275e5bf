"""What a line, a pair of lines or a page of lines looks like."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .normalize import marks_spaced
from .rx import blank, compact, count, first_of, full, has, joined, let, lines, lstrip, n_compact, n_words, rstrip, solid_lines, strip, sub, tally


#: Least characters of a heading in capitals.
HEADING_CHARS = 12


def is_heading(line: Column) -> Column:
    return full(line, P.HEADING_MARKS) & full(compact(line), P.HEADING)


def is_heading_fragment(line: Column) -> Column:
    return let(compact(line), lambda x: (x != "") & (F.length(x) <= 40) & (F.length(sub(x, "[^A-ZА-ЯЁ]+", "")) >= 4))


def is_noise(line: Column) -> Column:
    """Runs of marks, numbers of up to three digits, Roman ones of up to six, and single marks."""
    return (line != "") & full(line, rf"{P.NOISE}|[{''.join(P.NOISE_SINGLES)}]|\p{{Nd}}{{1,3}}|(?=.{{1,6}}\z)(?i:{P.ROMAN})|[^\p{{L}}\p{{N}}]")


def is_reference(line: Column) -> Column:
    def told(x: Column) -> Column:
        numbered = has(x, P.NUMBERED_LINE)
        return (numbered & (has(x, P.BACKMATTER_REFERENCE, "i") | has(x, P.YEAR) | (F.length(x) >= 60))) | has(x, P.REFERENCE_CUE, "i")

    return let(strip(line), lambda x: (x != "") & told(x))


def ends_sentence(x: Column) -> Column:
    return has(x, P.SENTENCE_END)


def starts_apart(x: Column) -> Column:
    return has(x, P.BULLET_START) | has(x, P.FIGURE, "i")


def goes_on(current: Column, following: Column) -> Column:
    """Whether a line break is a false one as far as the two lines that meet there tell."""

    def told(a: Column, b: Column) -> Column:
        apart = (F.length(a) <= 2) | (F.length(b) <= 2) | has(a, r"[.!?:;]\z") | starts_apart(b) | has(b, r"^(?:\p{Nd}|[A-ZА-ЯЁ]{3,})") | full(a, "[A-ZА-ЯЁ]{4,}")
        return (a != "") & (b != "") & ~apart

    return let(F.struct(strip(current).alias("a"), strip(following).alias("b")), lambda s: told(s["a"], s["b"]))


def continues(current: Column, following: Column) -> Column:
    """Whether a line break between what was gathered of a paragraph and the next line is a false one."""
    return goes_on(current, following) & ~is_heading(strip(current))


def continues_short(current: Column, following: Column) -> Column:
    """Whether two short lines of a block are one."""

    def told(a: Column, b: Column) -> Column:
        listed = has(a, r":\z") & b.startswith("-")
        short = (F.length(a) <= 3) | (F.length(b) <= 3) | (~ends_sentence(a) & ((F.length(a) <= 18) | has(b, P.LOWER_START)))
        never = (a == "") | (b == "") | starts_apart(b) | is_noise(a) | is_noise(b) | (is_heading_fragment(a) & ~is_heading_fragment(b))
        return (short | listed) & ~never

    return let(F.struct(strip(current).alias("a"), strip(following).alias("b")), lambda s: told(s["a"], s["b"]))


def one_line(parts: Column) -> Column:
    """Lines joined by spaces, with punctuation spaced."""
    return strip(marks_spaced(joined(F.filter(F.transform(parts, strip), lambda x: x != ""), " ")))


def is_flat_block(block: Column) -> Column:
    size = F.transform(block, F.length)
    inner = F.slice(block, 2, F.greatest(F.size(block) - 2, F.lit(0)))
    tiny = tally(size, lambda n: n <= 3) >= 2
    short = (tally(size, lambda n: n <= 24) >= F.greatest(F.lit(3), F.size(block) - 1)) & (tally(block, ends_sentence) <= 1)
    words = (F.array_max(size) <= 80) & F.exists(inner, lambda x: n_words(x) == 1)
    return (F.size(block) >= 3) & (tiny | short | words)


def is_substantive(text: Column) -> Column:
    """At least three prose lines among the first eighteen."""
    prose = lambda x: (n_words(x) >= 8) & (ends_sentence(x) | has(x, r"[\p{L}\p{N}]\z"))
    return let(solid_lines(text), lambda x: (F.size(x) >= 3) & (tally(F.slice(x, 1, 18), prose) >= 3))


def is_garbled_token(token: Column) -> Column:
    bare = F.btrim(token, F.lit(".,;:!?()[]{}«»\"'"))
    return let(bare, lambda x: (F.length(x) >= 4) & (has(x, P.ODD_LATIN) | (has(x, P.LATIN) & has(x, P.CYRILLIC)) | has(x, r"[{}|\\$]") | has(x, "0ОО|О00|00О")))


def n_garbled(text: Column) -> Column:
    return tally(F.regexp_extract_all(text, F.lit(r"(?dU)\S+"), F.lit(0)), is_garbled_token)


# pages


def is_toc(raw: Column, cleaned: Column) -> Column:
    def told(r: Column, t: Column, x: Column) -> Column:
        leaders = count(r, P.DOT_LEADER) + count(t, P.DOT_LEADER)
        entries = count(r, P.TOC_ENTRY, "m") + count(t, P.TOC_ENTRY, "m")
        numbered = tally(x, lambda y: has(y, P.PAGE_NUMBER_END))
        listed = tally(F.slice(x, 1, 40), lambda y: F.length(y).between(8, 140))
        return (F.size(x) >= 4) & ((leaders >= 2) | (entries >= 4) | (numbered >= 4) | ((listed >= 8) & (numbered >= 3)))

    r = F.coalesce(raw, F.lit(""))
    heading = lambda s: has(s["r"], P.TOC_HEADING, "im") | has(s["t"], P.TOC_HEADING, "im")
    return let(F.struct(r.alias("r"), first_of(cleaned, r).alias("t")), lambda s: heading(s) & ~blank(s["t"]) & let(solid_lines(s["r"]), lambda x: told(s["r"], s["t"], x)))


def is_title_page(page_number: Column, raw: Column, cleaned: Column) -> Column:
    def told(x: Column) -> Column:
        size = F.length(joined(x, " "))
        shouted = lambda y: is_heading(y) | is_heading_fragment(y) | (~has(y, "[a-zа-яё]") & has(y, r"\p{L}") & (F.upper(y) == y) & (F.lower(y) != y))
        sentences = tally(x, lambda y: (n_words(y) >= 6) & ends_sentence(y))
        cue = has(first_of(cleaned, raw), P.FRONT_MATTER, "i")
        fits = F.size(x).between(1, 20) & (size < 320) & (sentences < 2)
        return fits & (((page_number <= 2) & cue) | ((page_number <= 4) & (tally(x, shouted) >= 2)) | ((F.size(x) <= 12) & cue & (sentences == 0)))

    return (page_number <= 6) & let(solid_lines(raw), told)


_META = {"isbn": P.ISBN, "email": P.EMAIL, "phone": P.PHONE, "publisher": P.PUBLISHER, "imprint": P.IMPRINT, "front": P.FRONT_MATTER}
_NO_CASE = {"isbn", "publisher", "imprint", "front"}


def _meta(c: Column) -> dict[str, Column]:
    found = {k: has(c, p, "i" if k in _NO_CASE else "") for k, p in _META.items()}
    return found | {"email": F.coalesce(c.contains("@"), F.lit(False)) & found["email"]}  # looked for only where its sign stands


def is_publisher_page(raw: Column, cleaned: Column) -> Column:
    def any_cue(y: Column) -> Column:
        out = F.lit(False)
        for c in _meta(y).values():
            out = out | c
        return out

    def told(t: Column, cues: Column) -> Column:
        def fits(x: Column) -> Column:
            meta, n, size = tally(x, any_cue), F.size(x), n_compact(t)
            return (
                ((n_cues >= 2) & (meta >= F.greatest(F.lit(3), F.floor(n * 0.6)))) | (cues["isbn"] & (n <= 3) & (size <= 220)) | (cues["imprint"] & (meta >= 2) & (size <= 800))
                | (cues["front"] & (n <= 20) & (meta >= 2) & (size <= 900))
            )

        n_cues = sum((cues[k].cast("int") for k in _META), F.lit(0))
        # a cheap test first: case is folded only where one of the phrases may stand
        purchase = has(t, P.PURCHASE_LETTERS) & (F.lower(t).contains(P.PURCHASE[0]) | F.lower(t).contains(P.PURCHASE[1]))
        return ~blank(t) & (((n_cues >= 1) & let(solid_lines(t), fits)) | (purchase & (n_compact(t) <= 900)))

    cues = lambda t: F.struct(*[c.alias(k) for k, c in _meta(t).items()])
    return let(first_of(cleaned, raw), lambda t: let(cues(t), lambda c: told(t, c)))


def is_garbled(raw: Column, cleaned: Column, source: Column) -> Column:
    def told(t: Column, odd: Column) -> Column:
        cyrillic, latin, bad = count(t, P.CYRILLIC), count(t, P.LATIN), n_garbled(t)
        fallback, read = source == "extract_fallback", source.isin("extract_fallback", "ocr")
        return (F.length(t) >= 40) & (
            (has(t, P.ARCHIVE, "i") & (bad >= 2)) | (fallback & t.contains("://") & (bad >= 3)) | (read & (odd >= 2) & (cyrillic <= 12) & (bad >= 3))
            | ((odd >= 4) & (cyrillic <= 20) & (latin >= 20) & (bad >= 4)) | (fallback & (bad >= 4) & (F.size(lines(t)) <= 8))
        )

    return let(strip(first_of(cleaned, raw)), lambda t: F.coalesce(let(count(t, P.ODD_LATIN), lambda odd: told(t, odd)), F.lit(False)))


def is_reference_page(raw: Column, cleaned: Column) -> Column:
    def told(x: Column, references: Column, numbered: Column) -> Column:
        n = F.size(x)
        cues, urls = tally(x, lambda y: has(y, P.BACKMATTER_REFERENCE, "i")), tally(x, lambda y: has(y, r"https?://|www\."))
        long_ = tally(x, lambda y: (F.length(y) >= 140) & ~has(y, P.NUMBERED_LINE))
        many = (references >= F.greatest(F.lit(4), F.floor(n * 0.6))) | ((references >= 3) & (urls >= 2))
        listed = ((numbered >= 6) & (cues >= 4) & (long_ <= 2)) | ((numbered >= 10) & (long_ <= 1))
        return many | listed

    def counted(x: Column) -> Column:
        tallies = F.struct(tally(x, is_reference).alias("references"), tally(x, lambda y: has(y, P.NUMBERED_LINE)).alias("numbered"))
        return (F.size(x) >= 4) & let(tallies, lambda k: told(x, k["references"], k["numbered"]))

    return let(first_of(cleaned, raw), lambda t: has(t, P.ABBREVIATIONS_HEADING, "im") | let(solid_lines(t), counted))


def is_glossary_page(raw: Column, cleaned: Column) -> Column:
    entries = lambda t: (count(t, P.GLOSSARY_ENTRY, "m") >= 6) & (F.size(solid_lines(t)) <= 40)
    return let(first_of(cleaned, raw), lambda t: ~blank(t) & (has(t, P.GLOSSARY_HEADING, "im") | entries(t)))


# the OCR stage's own tests, with thresholds of their own


def skip_reason(text: Column) -> Column:
    """Why an extracted page needs no OCR, or null."""

    def told(t: Column, x: Column) -> Column:
        n = F.size(x)
        third = F.greatest(F.lit(3), F.floor(n / 3))

        def references(numbered: Column) -> Column:
            cues = tally(x, lambda y: has(y, P.OCR_REFERENCE_CUE, "i"))
            mean = F.aggregate(x, F.lit(0), lambda s, y: s + F.length(y)) / F.greatest(n, F.lit(1))
            return (numbered >= third) | ((mean >= 55) & (cues >= third))

        toc = has(t, P.OCR_TOC_HEADING, "im") | (count(t, P.OCR_TOC_ENTRY, "m") >= 5)
        glossary = has(t, P.OCR_GLOSSARY, "im") | (tally(x, lambda y: has(y, P.OCR_GLOSSARY_ENTRY)) >= 8)
        publisher = (n <= 25) & has(t, P.OCR_PUBLISHER, "i") & (n_compact(t) <= 600)
        listed = (n >= 4) & let(tally(x, lambda y: has(y, P.NUMBERED_LINE)), references)
        return F.when(toc, "toc_index_page").when(listed, "reference_only_page").when(glossary, "glossary_page").when(publisher, "publisher_meta_page")

    t = strip(F.coalesce(text, F.lit("")))
    return let(t, lambda t: F.when(t != "", let(solid_lines(t), lambda x: told(t, x))))


def is_mojibake(text: Column) -> Column:
    def line(y: Column) -> Column:
        odd, cyrillic, latin = count(y, P.ODD_LATIN), count(y, P.OCR_CYRILLIC), count(y, P.LATIN)
        return (odd >= 6) & (n_compact(y) >= 8) & (((odd >= 8) & (latin <= 2)) | ((cyrillic >= 4) & (odd >= F.greatest(F.lit(6), F.floor(cyrillic * 0.45)))))

    def told(t: Column, odd: Column) -> Column:
        return (odd >= 6) & (n_compact(t) >= 80) & (((odd >= 12) & (odd > count(t, P.OCR_CYRILLIC) * 0.35)) | F.exists(solid_lines(t), line))

    return let(F.coalesce(text, F.lit("")), lambda t: let(count(t, P.ODD_LATIN), lambda odd: told(t, odd)))


def is_low_quality(text: Column) -> Column:
    def told(t: Column, k: Column) -> Column:
        mixed, marks, fragments, banners = (k[c] for c in ("mixed", "marks", "fragments", "banners"))
        noisy = mixed + marks + fragments
        share = noisy / F.greatest(F.lit(1), count(t, r"\b\S+\b"))
        return (mixed >= 4) | ((fragments >= 3) & (marks >= 1)) | ((banners >= 2) & (noisy >= 2)) | ((noisy >= 8) & (share >= 0.035))

    def counted(t: Column) -> Column:
        kinds = {"mixed": P.MIXED_TOKEN, "marks": P.INNER_MARK, "fragments": P.LATIN_FRAGMENT, "banners": P.ARTIFACT_BANNER}
        return let(F.struct(*[count(t, p).alias(k) for k, p in kinds.items()]), lambda k: told(t, k))

    return let(F.coalesce(text, F.lit("")), lambda t: (count(t, P.OCR_CYRILLIC) >= 60) & (n_compact(t) >= 120) & counted(t))


def begins_inside(x: Column) -> Column:
    """Whether solid lines begin in the middle of a sentence."""

    def told(x: Column) -> Column:
        def open_(letters: Column) -> Column:
            capitals = F.length(sub(x, "[^A-ZА-ЯЁ]+", ""))
            return (letters > 0) & (capitals <= F.floor(letters * 0.45))

        listed = has(x, P.OCR_BODYISH) & has(x, "[,;:]")
        letters = F.length(sub(x, "[^A-Za-zА-Яа-яЁё]+", ""))
        return (F.length(x) >= 12) & (has(x, P.LOWER_START) | listed | (~has(x, r"[.!?]\z") & let(letters, open_)))

    return F.when(F.size(x) == 0, F.lit(False)).otherwise(let(compact(F.get(x, 0)), told))


def is_continuation(text: Column) -> Column:
    """Whether a text begins in the middle of a sentence."""
    return let(solid_lines(text), begins_inside)


def hyphen_glued(left: Column, right: Column) -> Column:
    """Two texts as one where the first ends in a hyphen that broke a word; null elsewhere."""
    a, b = rstrip(left), lstrip(right)
    tail, head = F.regexp_extract(a, P.TAIL_HYPHEN, 1), F.regexp_extract(b, P.WORD_HEAD, 1)
    glue = F.when((F.length(tail) >= 3) & (F.length(head) >= 3), F.lit("")).otherwise(F.lit("-"))
    return F.when((tail != "") & (head != "") & has(b, P.LOWER_START), F.concat(F.substr(a, F.lit(1), F.length(a) - 1), glue, b))
