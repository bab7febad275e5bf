"""The rule engine for pages: repeated edges of a book, twelve cleaning steps in order, flags, and pages that are dropped.

Input columns: a book key, page_number, source, selected_text, body_text, notes_text, reference_text, page_type. Every step
is a column expression over one page; only the repeated edges look across the pages of a book.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import line_rules as L
from ..functions import normalize as N
from ..functions import patterns as P
from ..functions.rx import STRINGS, blank, compact, count, first_of, found, full, has, joined, let, lines, n_words, rstrip, solid_lines, strip, sub

EDITS = "array<struct<rule_id:string,action:string,before:string,after:string>>"
FLAGS = "array<struct<rule_id:string,evidence:string>>"
STEP = f"struct<text:string,edits:{EDITS}>"
#: Longest line that can be a running header or footer.
EDGE_CHARS = 120
#: Books of which the running edges are sent to every task; a book has a few of EDGE_CHARS at most. More books are joined with their pages.
MOST_BOOKS = 10_000


def edit(rule: str, action: str, before: Column, after: Column) -> Column:
    return F.struct(F.lit(rule).alias("rule_id"), F.lit(action).alias("action"), before.alias("before"), after.alias("after"))


def flag(rule: str, evidence: Column) -> Column:
    return F.struct(F.lit(rule).alias("rule_id"), evidence.alias("evidence"))


def step(text: Column, edits: Column) -> Column:
    return F.struct(text.alias("text"), edits.cast(EDITS).alias("edits")).cast(STEP)


def no_edits() -> Column:
    return F.array().cast(EDITS)


def page_text(body: Column, selected: Column) -> Column:
    return first_of(body, F.coalesce(selected, F.lit("")))


# repeated edges


def edges(pages: DataFrame, book: str, text: Column) -> DataFrame:
    """(book, headers, footers): line keys that begin or end at least max(2, half) of a book's pages, empty pages counted."""
    ends = pages.select(F.col(book).alias("book"), F.filter(F.transform(lines(text), rstrip), lambda x: ~blank(x)).alias("x"))
    size = ends.groupBy("book").agg(F.count("*").alias("n_pages"))
    key = lambda i: compact(F.element_at("x", i))
    solid = ends.where(F.size("x") > 0)
    keyed = solid.select("book", F.explode(F.array(F.struct(F.lit("header").alias("edge"), key(1).alias("key")), F.struct(F.lit("footer").alias("edge"), key(-1).alias("key")))).alias("e"))
    often = keyed.where(F.length("e.key").between(1, EDGE_CHARS)).groupBy("book", "e.edge", "e.key").count().join(size, "book").where(F.col("count") >= F.greatest(F.lit(2), F.floor(F.col("n_pages") / 2)))
    of = lambda edge: F.array_sort(F.collect_set(F.when(F.col("edge") == edge, F.col("key"))))
    return often.groupBy("book").agg(of("header").alias("headers"), of("footer").alias("footers"))


def without_edges(text: Column, headers: Column, footers: Column) -> Column:
    """Drops a first line that is a known header and a last line that is a known footer."""

    def run(x: Column) -> Column:
        solid = F.filter(F.transform(x, lambda y, i: F.struct(i.alias("i"), y.alias("y"))), lambda s: ~blank(s["y"]))

        def cut(s: Column) -> Column:
            first, last = F.get(s, 0), F.element_at(s, -1)
            head = F.coalesce(F.array_contains(headers, compact(first["y"])), F.lit(False))
            rest = F.size(s) - head.cast("int")
            foot = (rest > 0) & F.coalesce(F.array_contains(footers, compact(last["y"])), F.lit(False))
            keep = F.filter(x, lambda y, i: ~((head & (i == first["i"])) | (foot & (i == last["i"]))))
            gone = F.array_compact(F.array(F.when(head, edit("repeated_headers_footers", "delete", first["y"], F.lit(""))), F.when(foot, edit("repeated_headers_footers", "delete", last["y"], F.lit("")))))
            return F.when(head | foot, step(joined(keep), gone)).otherwise(step(text, no_edits()))

        return F.when(F.size(solid) == 0, step(text, no_edits())).otherwise(let(solid, cut))

    return let(F.transform(lines(text), rstrip), run)


# steps on one text


def removed(rule: str, pattern: str) -> Callable[[Column], Column]:
    """Every match goes, each with an edit."""

    def run(t: Column) -> Column:
        return step(sub(t, pattern, ""), F.transform(found(t, pattern), lambda m: edit(rule, "normalize", m, F.lit(""))))

    return run


def bullet_step(t: Column) -> Column:
    hits = F.filter(F.transform(lines(t), rstrip), lambda x: has(x, P.OCR_BULLET))
    return step(N.bullets(t), F.transform(hits, lambda x: edit("ocr_bullet_marker_normalization", "normalize", x, F.regexp_replace(x, "(?dU)" + P.OCR_BULLET, "- "))))


_RIGHT_4 = r"([А-Яа-яЁё]{3,})[-‐‑]\s*\n\s*([А-Яа-яЁё]{4,})"
_RIGHT_3 = r"([А-Яа-яЁё]{3,}[-‐‑]\s*\n\s*[А-Яа-яЁё]{3}(?![А-Яа-яЁё]))"


def hyphen_step(t: Column) -> Column:
    """Words that a line end broke are one; where three letters follow, the break stays. One pass, so that no match feeds another."""
    shown = lambda m: F.replace(m, F.lit("\n"), F.lit("\\n"))
    hits = F.filter(found(t, f"{_RIGHT_4}|{_RIGHT_3}"), lambda m: full(m, _RIGHT_4))
    return step(sub(t, f"{_RIGHT_4}|{_RIGHT_3}", "$1$2$3"), F.transform(hits, lambda m: edit("line_end_hyphenation", "normalize", shown(m), sub(m, _RIGHT_4, "$1$2"))))


def hyphen_flags(t: Column) -> Column:
    hits = F.filter(found(t, f"{_RIGHT_4}|{_RIGHT_3}"), lambda m: ~full(m, _RIGHT_4))
    return F.transform(hits, lambda m: flag("line_end_hyphenation_ambiguous", F.replace(m, F.lit("\n"), F.lit("\\n"))))


def _parts(x: Column, flags: Column, made: Callable[[Column], Column], rule: str, glue: Callable[[Column, Column], Column]) -> Column:
    """struct(out, edits): lines of which the i-th joins those before it where flags has a 1 at i. The evidence of an edit is the two
    lines that meet, not all that was gathered before them, so that it grows with the text."""
    starts = F.filter(F.sequence(F.lit(1), F.size(x)), lambda i: F.substr(flags, i, F.lit(1)) == "0")
    out = let(starts, lambda s: F.transform(s, lambda i, k: made(F.slice(x, i, F.coalesce(F.get(s, k + 1), F.size(x) + 1) - i))))
    met = F.filter(F.sequence(F.lit(1), F.size(x)), lambda i: F.substr(flags, i, F.lit(1)) == "1")
    line = lambda i: F.get(x, i - 1)
    edits = F.transform(met, lambda i: edit(rule, "normalize", F.concat(line(i - 1), F.lit("\\n"), line(i)), glue(line(i - 1), line(i))))
    return F.when(F.size(x) > 0, F.struct(out.alias("out"), edits.cast(EDITS).alias("edits"))).otherwise(F.struct(F.array().cast(STRINGS).alias("out"), no_edits().alias("edits")))


def paragraph_step(t: Column) -> Column:
    """Lines go on a paragraph as long as L.continues() holds of what was gathered and the next line. Of what was gathered that test sees
    its last line and, of lines in capitals, whether they are a heading together: the fold keeps only these."""
    glue = lambda a, b: F.concat(rstrip(a), F.lit(" "), F.regexp_replace(b, r"(?U)^\s+", ""))

    def told(x: Column) -> Column:
        capitals = lambda c: F.when(full(c, P.CAPITALS), F.length(c)).otherwise(-1)
        size = lambda y, cut: F.when(full(y, P.CAPITAL_MARKS), let(cut(compact(y)), capitals)).otherwise(-1)
        made = F.transform(x, lambda y, i: F.struct(
            F.when(i > 0, L.goes_on(F.get(x, i - 1), y)).otherwise(F.lit(False)).alias("goes_on"), size(y, lambda c: c).alias("n"),
            size(y, lambda c: sub(c, r"^[IVXLCDM]+\.\s+", "")).alias("first"),
        ))
        kind = "struct<flags:string,n:int>"
        start = F.struct(F.lit("").alias("flags"), F.lit(-1).alias("n")).cast(kind)

        def add(s: Column, y: Column) -> Column:
            both = F.when((s["n"] >= 0) & (y["n"] >= 0), s["n"] + 1 + y["n"]).otherwise(-1)
            joins = y["goes_on"] & (s["n"] < L.HEADING_CHARS)
            return F.struct(F.concat(s["flags"], F.when(joins, "1").otherwise("0")).alias("flags"), F.when(joins, both).otherwise(y["first"]).alias("n")).cast(kind)

        return F.aggregate(made, start, add, lambda s: s["flags"])

    def merged(x: Column) -> Column:
        one = lambda g: F.when(F.size(g) == 1, F.get(g, 0)).otherwise(F.array_join(F.transform(g, lambda y, i: F.when(i > 0, F.regexp_replace(y, r"(?U)^\s+", "")).otherwise(y)), " "))
        return let(let(told(x), lambda f: _parts(x, f, one, "fake_paragraph_breaks", glue)), lambda s: step(joined(s["out"]), s["edits"]))

    parts = F.transform(F.transform(lines(t), rstrip), lambda x: F.when(blank(x), F.lit("")).otherwise(x))
    return F.when(t == "", step(t, no_edits())).otherwise(let(parts, merged))


#: Of what was gathered of a block, so many characters at its end tell whether a short line goes on.
SEEN_CHARS = 400


def short_lines(x: Column) -> Column:
    """Flags of the lines of a block that L.continues_short() joins to what was gathered before them."""
    kind = "struct<flags:string,held:string>"
    start = F.struct(F.lit("").alias("flags"), F.lit(None).cast("string").alias("held")).cast(kind)
    # a letter in front stands for what was cut off: what is gathered is neither short nor noise
    cut = lambda y: F.when(F.length(y) <= SEEN_CHARS, y).otherwise(F.concat(F.lit("a"), F.right(y, F.lit(SEEN_CHARS))))

    def add(s: Column, y: Column) -> Column:
        joins = s["held"].isNotNull() & F.coalesce(L.continues_short(s["held"], y), F.lit(False))
        held = F.when(joins, cut(L.one_line(F.array(s["held"], y)))).when(L.is_noise(y), y).otherwise(cut(y))
        return F.struct(F.concat(s["flags"], F.when(joins, "1").otherwise("0")).alias("flags"), held.alias("held")).cast(kind)

    return F.aggregate(x, start, add, lambda s: s["flags"])


def spacing_step(t: Column) -> Column:
    note = lambda after: F.when(after != t, F.array(edit("spacing_cleanup", "normalize", F.substring(t, 1, 160), F.substring(after, 1, 160)))).otherwise(no_edits())
    return let(N.spacing(t), lambda after: step(after, note(after)))


def without_noise(parts: Column, bare: Callable[[Column], Column] = strip) -> Column:
    """The lines that aren't noise once they are bare."""
    return F.filter(parts, lambda y: ~let(bare(y), L.is_noise))


def noise_step(t: Column) -> Column:
    gone = lambda x: F.filter(x, lambda y: let(strip(y), L.is_noise))
    kept = lambda x, hits: F.when(F.size(hits) > 0, without_noise(x)).otherwise(x)
    cut = lambda x, hits: step(joined(kept(x, hits)), F.transform(hits, lambda y: edit("isolated_ocr_noise", "delete", y, F.lit(""))))
    return let(F.transform(lines(t), rstrip), lambda x: let(gone(x), lambda hits: cut(x, hits)))


def block_step(t: Column) -> Column:
    """Blocks between blank lines: short wrapped ones become one line (a heading stays apart), short lines of others are merged."""

    def flat(x: Column) -> Column:
        tail = L.one_line(F.slice(x, 2, F.greatest(F.size(x) - 1, F.lit(0))))
        headed = F.when(tail != "", F.concat(strip(F.get(x, 0)), F.lit("\n"), tail)).otherwise(strip(F.get(x, 0)))
        return F.when((F.size(x) >= 2) & L.is_heading(F.get(x, 0)), headed).otherwise(L.one_line(x))

    def one(x: Column) -> Column:
        made = let(flat(x), lambda y: step(y, F.when(y != joined(x), F.array(edit("short_block_reflow", "normalize", joined(F.slice(x, 1, 12), "\\n"), F.substring(y, 1, 240)))).otherwise(no_edits())))
        together = lambda g: F.when(F.size(g) == 1, F.get(g, 0)).otherwise(L.one_line(g))
        parts = let(short_lines(x), lambda f: _parts(x, f, together, "short_line_reflow", lambda a, b: L.one_line(F.array(a, b))))
        merged = let(parts, lambda s: step(joined(s["out"]), s["edits"]))
        return F.when(L.is_flat_block(x), made).otherwise(merged)

    blocks = F.filter(F.transform(F.split(t, r"(?dU)\n\s*\n"), solid_lines), lambda x: F.size(x) > 0)
    return let(F.transform(blocks, one), lambda b: step(joined(F.transform(b, lambda s: s["text"]), "\n\n"), F.flatten(F.transform(b, lambda s: s["edits"]))))


def note_step(t: Column) -> Column:
    gone = lambda m: edit("inline_note_marker_strip", "delete", m, F.lit(""))

    def cut(a: Column, b: Column) -> Column:
        hits = F.concat(found(t, P.BRACKET_NOTE), found(a, P.SUPERSCRIPT_NOTE), found(b, P.SUFFIX_NOTE))
        return step(sub(b, P.SUFFIX_NOTE, ""), F.transform(hits, gone))

    return let(sub(t, P.BRACKET_NOTE, ""), lambda a: let(sub(a, P.SUPERSCRIPT_NOTE, ""), lambda b: cut(a, b)))


def tail_cut(x: Column) -> Column:
    """The index of the line at which a reference tail begins, among the last twenty; null if there is none."""

    def starts(i: Column) -> Column:
        rest = F.filter(F.slice(x, i + 1, F.size(x)), lambda y: ~blank(y))
        references = F.size(F.filter(rest, L.is_reference))
        return L.is_reference(F.get(x, i)) & (references >= F.greatest(F.lit(2), F.floor(F.size(rest) * 0.6)))

    places = F.sequence(F.greatest(F.lit(0), F.size(x) - 20), F.size(x) - 2)
    return F.when(F.size(x) >= 4, F.get(F.filter(places, starts), 0))


def _trimmed(x: Column) -> Column:
    """Lines without blank ones at the end."""
    last = F.array_max(F.transform(x, lambda y, i: F.when(~blank(y), i)))
    return F.when(last.isNull(), F.array().cast(STRINGS)).otherwise(F.slice(x, 1, last + 1))


def reference_step(t: Column) -> Column:
    def cut(x: Column, i: Column) -> Column:
        tail = F.substring(joined(F.slice(x, i + 1, F.size(x))), 1, 400)
        return F.when(i.isNull(), step(t, no_edits())).otherwise(step(joined(_trimmed(F.slice(x, 1, i))), F.array(edit("trailing_reference_block_strip", "delete", tail, F.lit("")))))

    return let(lines(t), lambda x: let(tail_cut(x), lambda i: cut(x, i)))


def may_cut_references(page_type: Column, body: Column, notes: Column, references: Column, text: Column) -> Column:
    """Not on pages with enough body text, whose notes the layout stage has set apart already."""
    apart = (n_words(notes) >= 40) | (n_words(references) >= 40)
    n = n_words(body)
    keep = (n >= 120) | ((page_type == "body_with_notes") & (n >= 80) & apart) | ((n >= 90) & L.is_substantive(text))
    return ~(F.coalesce(page_type, F.lit("")).isin("body_with_notes", "body_only") & F.coalesce(keep, F.lit(False)))


def front_step(t: Column, page_number: Column) -> Column:
    def cut(after: Column) -> Column:
        note = F.array(edit("leading_front_matter_trim", "delete", F.substring(t, 1, 400), F.substring(after, 1, 400)))
        return F.when(after.isNull() | (after == ""), step(t, no_edits())).otherwise(step(after, note))

    def after(x: Column) -> Column:
        start = F.array_min(F.transform(x, lambda y, i: F.when(has(strip(y), P.BODY_HEADING, "i"), i)))
        place = F.regexp_instr(t, F.lit("(?dUi)" + P.BODY_INLINE))
        inline = F.when(place > 80, strip(F.substr(t, place)))
        return let(start, lambda s: F.when(s.isNull(), inline).when(s > 0, strip(joined(F.slice(x, s + 1, F.size(x))))))

    return F.when((page_number <= 8) & has(t, P.FRONT_MATTER, "i"), let(let(lines(t), after), cut)).otherwise(step(t, no_edits()))


#: The addresses among protected spans.
ADDRESS = r"|\b\S+@\S+\b"


def protected_hits(t: Column) -> Column:
    named = lambda rule: lambda m: flag(rule, m)
    # an address is looked for at every word, so only where its sign stands
    hits = lambda p: F.when(t.contains("@"), found(t, p)).otherwise(found(t, p.replace(ADDRESS, ""))) if ADDRESS in p else found(t, p)
    return F.concat(*[F.transform(hits(p), named(rule)) for rule, p in P.PROTECTED.items()]).cast(FLAGS)


def conditional_flags(t: Column) -> Column:
    solid = F.filter(F.transform(lines(t), rstrip), lambda x: ~blank(x))
    references = F.filter(F.transform(solid, strip), L.is_reference)
    once = lambda test, rule, evidence: F.when(test, F.array(flag(rule, evidence))).otherwise(F.array().cast(FLAGS))
    return F.concat(
        F.transform(found(t, P.FOOTNOTE), lambda m: flag("footnote_markers", m)),
        F.transform(found(t, P.CITATION), lambda m: flag("citations_and_bibliographic_refs", m)),
        let(references, lambda r: once(F.size(r) >= 2, "reference_suffix_material", F.substring(joined(F.slice(r, 1, 3), " | "), 1, 160))),
        once(has(t, P.DOT_LEADER), "toc_index_material", F.lit("dot_leaders")),
        F.transform(F.filter(solid, lambda x: has(x, P.FIGURE, "i")), lambda x: flag("figure_table_formula_labels", F.substring(x, 1, 120))),
        F.transform(found(t, P.VALUE), lambda m: flag("number_and_date_formatting", m)),
    ).cast(FLAGS)


#: The steps that need the text alone, in order, up to the reference tail.
STEPS: tuple[tuple[str, Callable[[Column], Column]], ...] = (
    ("soft_hyphen", removed("soft_hyphen", P.SOFT_HYPHEN)), ("zero_width", removed("zero_width_chars", P.ZERO_WIDTH)), ("bullets", bullet_step), ("hyphens", hyphen_step),
    ("paragraphs", paragraph_step), ("spacing", spacing_step), ("noise", noise_step), ("blocks", block_step), ("notes", note_step),
)


def cleaned(pages: DataFrame, book: str = "book") -> DataFrame:
    """Each page with raw_text, cleaned_text, edits, flags, protected_hits, drop_page, drop_reason and allow_empty_output."""
    text = page_text(F.col("body_text"), F.col("selected_text"))
    known = edges(pages, book, text).withColumnRenamed("book", "_book").cache()
    if known.limit(MOST_BOOKS + 1).count() <= MOST_BOOKS:
        known = F.broadcast(known)
    p = pages.join(known, F.equal_null(book, "_book"), "left").drop("_book").withColumn("_raw", text)
    none = F.array().cast(STRINGS)
    p = p.withColumn("_s", without_edges(F.col("_raw"), F.coalesce("headers", none), F.coalesce("footers", none))).drop("headers", "footers")
    p = p.withColumn("_text", F.col("_s.text")).withColumn("_edits", F.col("_s.edits")).withColumn("_flags", F.array().cast(FLAGS))

    def apply(p: DataFrame, made: Column) -> DataFrame:
        p = p.withColumn("_s", made)
        return p.withColumn("_text", F.col("_s.text")).withColumn("_edits", F.concat("_edits", "_s.edits"))

    for name, run in STEPS:
        if name == "hyphens":
            p = p.withColumn("_flags", let(F.col("_text"), hyphen_flags).cast(FLAGS))
        p = apply(p, let(F.col("_text"), run))
    may = may_cut_references(F.col("page_type"), F.col("body_text"), F.col("notes_text"), F.col("reference_text"), F.col("_text"))
    p = apply(p, F.when(may, let(F.col("_text"), reference_step)).otherwise(step(F.col("_text"), no_edits())))
    p = apply(p, let(F.col("_text"), lambda t: front_step(t, F.col("page_number"))))
    p = p.withColumn("protected_hits", let(F.col("_text"), protected_hits)).withColumn("_flags", F.concat("_flags", let(F.col("_text"), conditional_flags)))
    return dropped(p).drop("_s", "_raw", "_text", "_edits", "_flags")


def dropped(p: DataFrame) -> DataFrame:
    """Pages that aren't body text are emptied, the first reason that holds counts; others may be flagged and stay."""
    raw, t = F.coalesce("selected_text", F.lit("")), F.col("_text")
    heavy = F.col("page_type").isin("body_with_notes", "body_only") & (n_words(F.col("body_text")) >= 80)
    apart = (n_words(F.col("body_text")) >= 120) & ((n_words(F.col("notes_text")) >= 40) | (n_words(F.col("reference_text")) >= 40))
    stays = F.coalesce(heavy & (L.is_substantive(t) | apart), F.lit(False))
    reason = (
        F.when(L.is_toc(raw, t), "toc_index_page").when(L.is_garbled(raw, t, F.coalesce("source", F.lit(""))), "garbled_page")
        .when(L.is_reference_page(raw, t) & ~stays, "reference_only_page").when(L.is_glossary_page(raw, t), "glossary_page")
    )
    p = p.withColumn("drop_reason", reason).withColumn("drop_page", F.col("drop_reason").isNotNull())
    evidence = F.substring(first_of(t, raw), 1, 160)
    late = F.coalesce(F.col("drop_reason") != "toc_index_page", F.lit(True))
    rule = F.when(F.col("drop_reason") == "toc_index_page", "toc_index_material").otherwise(F.col("drop_reason"))
    more = F.array_compact(F.array(
        F.when(late & L.is_title_page(F.col("page_number"), raw, t), flag("front_matter_title_page", evidence)),
        F.when(late & L.is_publisher_page(raw, t), flag("publisher_meta_page", evidence)),
        F.when(F.col("drop_page"), F.struct(rule.alias("rule_id"), evidence.alias("evidence"))),
    ))
    return (
        p.withColumn("flags", F.concat("_flags", more.cast(FLAGS))).withColumn("edits", F.col("_edits")).withColumn("raw_text", F.col("_raw"))
        .withColumn("cleaned_text", F.when(F.col("drop_page"), F.lit("")).otherwise(strip(t))).withColumn("allow_empty_output", F.col("drop_page"))
    )


__all__ = ["cleaned", "conditional_flags", "count", "edges", "hyphen_step", "protected_hits", "without_edges"]
