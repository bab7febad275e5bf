"""Pages to documents: paragraphs within a page, pages in order, no blank lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.line_rules import ends_sentence, hyphen_glued
from ..functions.normalize import stitch_line, without_blank_lines
from ..functions.rx import STRINGS, blank, compact, full, has, joined, let, lines, lstrip, n_words, rstrip, strip, sub

#: Paragraphs of so many characters are whole.
LONG = 300


def _is_heading(x: Column) -> Column:
    return full(compact(x), P.STITCH_HEADING)


def _is_fragment(x: Column) -> Column:
    return let(compact(x), lambda c: (c != "") & (F.length(c) <= 40) & (F.length(sub(c, "[^A-ZА-ЯЁ]", "")) >= 4))


def starts_paragraph(previous: Column, line: Column) -> Column:
    """Whether a line begins a paragraph after the line before it (null: none)."""
    return previous.isNull() | _is_heading(line) | line.startswith("-") | ((F.length(line) <= 25) & line.endswith(":"))


def fold_lines(parts: Column) -> Column:
    """Lines as one, with broken words put together."""
    return strip(F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.get(parts, 0), lambda a, x: F.coalesce(hyphen_glued(a, x), F.concat(rstrip(a), F.lit(" "), lstrip(x)))))


def paragraph(parts: Column) -> Column:
    """The lines of a paragraph as one; a heading with its fragments keeps a line of its own."""

    def headed(n: Column) -> Column:
        head, tail = joined(F.slice(parts, 1, n), " "), F.slice(parts, n + 1, F.size(parts))
        return F.when(F.size(tail) > 0, F.concat(head, F.lit("\n"), fold_lines(tail))).otherwise(head)

    first_plain = F.array_min(F.transform(parts, lambda x, i: F.when((i > 0) & ~_is_fragment(x), i)))
    return F.when((F.size(parts) > 1) & _is_heading(F.get(parts, 0)), let(F.coalesce(first_plain, F.size(parts)), headed)).otherwise(fold_lines(parts))


def paragraphs(text: Column) -> Column:
    """The paragraphs of a page: blocks between blank lines, split where a line begins one."""

    def cut(x: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(x) - 1), lambda i: starts_paragraph(F.when(i > 0, F.get(x, i - 1)), F.get(x, i)))
        return let(starts, lambda s: F.transform(s, lambda a, k: paragraph(F.slice(x, a + 1, F.coalesce(F.get(s, k + 1), F.size(x)) - a))))

    solid = lambda b: F.transform(F.filter(lines(b), lambda x: ~blank(x)), stitch_line)
    blocks = F.filter(F.transform(F.split(text, r"(?dU)\n\s*\n"), solid), lambda x: F.size(x) > 0)
    return F.filter(F.flatten(F.transform(blocks, lambda x: let(x, cut))), lambda x: x != "")


def merged_paragraphs(parts: Column) -> Column:
    """Paragraphs that go on in the next one are joined with it, unless either is long."""
    kind = f"struct<out:{STRINGS},held:string>"
    start = F.struct(F.array().cast(STRINGS).alias("out"), F.lit(None).cast("string").alias("held")).cast(kind)

    def merge(s: Column, x: Column) -> Column:
        a, b = rstrip(s["held"]), lstrip(x)
        colon = has(a, r":\z")
        apart = (F.length(a) >= LONG) | (F.length(b) >= LONG) | (colon & b.startswith("-"))
        goes_on = ~apart & has(b, P.LOWER_START) & (colon | ~ends_sentence(a))
        glued = F.coalesce(hyphen_glued(a, b), F.when(goes_on, F.concat(a, F.lit(" "), b)))
        out = F.struct(F.concat(s["out"], F.array(s["held"])).alias("out"), b.alias("held")).cast(kind)
        return F.when(s["held"].isNull(), F.struct(s["out"].alias("out"), x.alias("held")).cast(kind)).when(glued.isNotNull(), F.struct(s["out"].alias("out"), glued.alias("held")).cast(kind)).otherwise(out)

    done = lambda s: F.filter(F.when(s["held"].isNull(), s["out"]).otherwise(F.concat(s["out"], F.array(s["held"]))), lambda x: ~blank(x))
    return F.aggregate(parts, start, merge, done)


def page_block(text: Column) -> Column:
    t = strip(F.coalesce(text, F.lit("")))
    return let(t, lambda x: joined(let(paragraphs(x), merged_paragraphs)))


def epub_block(text: Column) -> Column:
    """Lines as they are, but for broken words."""
    parts = F.filter(F.transform(F.filter(lines(F.coalesce(text, F.lit(""))), lambda x: ~blank(x)), stitch_line), lambda x: x != "")
    kind = STRINGS

    def merge(out: Column, x: Column) -> Column:
        glued = hyphen_glued(F.element_at(out, -1), x)
        more = F.concat(out, F.array(x))
        return F.when(F.size(out) == 0, F.array(x)).when(glued.isNotNull(), F.concat(F.slice(out, 1, F.size(out) - 1), F.array(glued))).otherwise(more).cast(kind)

    return joined(F.aggregate(parts, F.array().cast(kind), merge))


def stitched(pages: DataFrame, book: str, order: str, text: str, epub: bool = False) -> DataFrame:
    """(book, text, n_pages): each book's pages in order as one text without blank lines. Pages are shaped in parallel; a book's blocks meet in one row."""
    block = epub_block(F.col(text)) if epub else page_block(F.col(text))
    made = pages.select(F.col(book).alias("book"), F.col(order).alias("at"), block.alias("block")).where("block <> ''")
    parts = made.groupBy("book").agg(F.array_sort(F.collect_list(F.struct("at", "block"))).alias("p"))
    return parts.select(F.col("book").alias(book), without_blank_lines(joined(F.transform("p", lambda x: x["block"]))).alias("text"), F.size("p").cast("bigint").alias("n_pages"))


__all__ = ["epub_block", "merged_paragraphs", "n_words", "page_block", "paragraphs", "starts_paragraph", "stitched"]
