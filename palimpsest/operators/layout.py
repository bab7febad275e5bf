"""Layout geometry: labels, reading order, block roles, and text blocks kept by detected regions.

Boxes are arrays [left, top, right, bottom]."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.line_rules import begins_inside
from ..functions.rx import compact, full, has, let, solid_lines, strip, sub, tally

#: Heights of the rows by which blocks are read.
ROW = 32.0
#: A page this much wider than high is two.
WIDE = 1.35
LEAST_HALF = 32


def label(raw: Column) -> Column:
    """What a detector's label stands for; unknown ones are body text."""
    x = F.lower(strip(F.coalesce(raw, F.lit(""))))
    known = F.create_map(*[F.lit(v) for kv in P.LAYOUT_LABELS.items() for v in kv])

    def told(y: Column) -> Column:
        out = F.lit("body")
        for name, words in reversed(P.LAYOUT_WORDS):
            out = F.when(has(y, words), name).otherwise(out)
        return F.coalesce(known[y], out)

    return let(sub(x, r"[\s_-]+", " "), told)


def action(kind: Column) -> Column:
    return F.when(kind.isin(*P.LAYOUT_KEEP), "keep").otherwise("mask")


def reading_order(blocks: DataFrame, page: list[str]) -> DataFrame:
    """blocks with mapped_label, action and `place`, their order on the page: rows from the top, in each from the left."""
    kind = label(F.col("raw_label"))
    top, left = F.col("bbox")[1], F.col("bbox")[0]
    w = W.partitionBy(*page).orderBy(F.bround(top / ROW), top, left, "order")
    return blocks.withColumn("mapped_label", kind).withColumn("action", action(F.col("mapped_label"))).withColumn("place", F.row_number().over(w))


def page_texts(regions: DataFrame, page: list[str]) -> DataFrame:
    """The texts of a page's titles and body regions in reading order."""
    kept = regions.where(F.col("mapped_label").isin(*P.LAYOUT_KEEP) & (strip(F.coalesce("text", F.lit(""))) != ""))
    return kept.groupBy(*page).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", strip(F.col("text")).alias("text")))), lambda x: x["text"]), "\n").alias("text"))


def area(box: Column) -> Column:
    return F.greatest(F.lit(0.0), box[2] - box[0]) * F.greatest(F.lit(0.0), box[3] - box[1])


def overlap(box: Column, boxes: Column) -> Column:
    """The largest share of a box that lies in one of the boxes; 0 for an empty box or none."""
    inner = lambda b: F.greatest(F.lit(0.0), F.least(box[2], b[2]) - F.greatest(box[0], b[0])) * F.greatest(F.lit(0.0), F.least(box[3], b[3]) - F.greatest(box[1], b[1]))
    return F.when(area(box) <= 0, 0.0).otherwise(F.coalesce(F.array_max(F.transform(boxes, inner)) / area(box), F.lit(0.0)))


def centred(box: Column, boxes: Column) -> Column:
    x, y = (box[0] + box[2]) / 2, (box[1] + box[3]) / 2
    return F.exists(boxes, lambda b: x.between(b[0], b[2]) & y.between(b[1], b[3]))


def is_kept(box: Column, keep: Column, mask: Column) -> Column:
    """Whether a block that lies in these regions is main text; blocks that no region speaks for are."""
    inside = overlap(box, keep)
    dropped = (centred(box, mask) & (inside < 0.05)) | ((overlap(box, mask) >= 0.72) & (inside < 0.10))
    return centred(box, keep) | (inside >= 0.25) | ~dropped


def filtered_blocks(pages: DataFrame) -> DataFrame:
    """Pages with their blocks kept and removed by regions, and the text of the kept ones.

    Columns: width, height (of the regions' image), page_width, page_height, blocks array<struct<text,bbox>>, regions
    array<struct<bbox,action>>. Boxes of blocks are scaled to the image."""
    sized = (F.col("width") > 0) & (F.col("height") > 0) & (F.col("page_width") > 0) & (F.col("page_height") > 0)
    x, y = F.col("width") / F.col("page_width"), F.col("height") / F.col("page_height")
    of = lambda kind: F.transform(F.filter("regions", lambda r: r["action"] == kind), lambda r: r["bbox"])
    scaled = lambda b: F.array(b["bbox"][0] * x, b["bbox"][1] * y, b["bbox"][2] * x, b["bbox"][3] * y)
    speak = sized & (F.size(of("keep")) + F.size(of("mask")) > 0)
    kept = F.when(speak, F.filter("blocks", lambda b: let(scaled(b), lambda box: is_kept(box, of("keep"), of("mask"))))).otherwise(F.col("blocks"))
    p = pages.withColumn("kept_blocks", kept).withColumn("n_removed", (F.size("blocks") - F.size("kept_blocks")).cast("bigint"))
    text = F.array_join(F.filter(F.transform("kept_blocks", lambda b: strip(b["text"])), lambda t: t != ""), "\n")
    note = F.when(speak, F.concat(F.lit("layout_extract_filter_applied:kept="), F.size("kept_blocks"), F.lit(",removed="), F.col("n_removed"))).when(~sized, "layout_extract_filter_missing_dimensions")
    return p.withColumn("kept_text", F.when(speak, text).otherwise("")).withColumn("note", note)


def reads_like_references(x: Column) -> Column:
    """Whether the solid lines of a block are references."""
    cues, years = tally(x, lambda y: has(y, P.OCR_REFERENCE_CUE, "i")), tally(x, lambda y: has(y, P.YEAR))
    of = lambda numbered: (numbered >= 2) | ((F.size(x) >= 2) & (cues >= 2)) | ((numbered >= 1) & ((cues >= 1) | (years >= 2)))
    return let(tally(x, lambda y: has(y, P.NUMBERED_LINE)), of)


def is_reference_block(text: Column) -> Column:
    return let(solid_lines(text), reads_like_references)


def is_heading_block(text: Column, font: Column, n_lines: Column, body_font: Column) -> Column:
    def told(x: Column) -> Column:
        letters, capitals = F.length(sub(x, "[^A-Za-zА-Яа-яЁё]+", "")), F.length(sub(x, "[^A-ZА-ЯЁ]+", ""))
        shouted = (F.length(x) <= 180) & let(letters, lambda n: (n >= 10) & (capitals >= F.floor(n * 0.85)))
        large = (body_font > 0) & (font >= body_font * 1.15) & (n_lines <= 4) & (F.length(x) <= 220)
        return (x != "") & (has(x, P.OCR_HEADING_START, "i") | large | shouted)

    return let(compact(text), told)


def block_roles(blocks: DataFrame, page: list[str]) -> DataFrame:
    """blocks with their role on the page. Columns: page key, bbox, text, char_count, line_count, avg_font_size, page_height.

    The body font is the median of the fonts of blocks of 40 characters or more; what lies low, is small, set apart,
    or reads like notes adds to a score, from 4 on a block is a footnote or reference block."""
    on_page, down = W.partitionBy(*page), W.partitionBy(*page).orderBy(F.col("bbox")[1], F.col("bbox")[0])
    b = blocks.withColumn("_text", strip(F.coalesce("text", F.lit("")))).withColumn("_top", F.col("bbox")[1].cast("double")).withColumn("_bottom", F.col("bbox")[3].cast("double"))
    font = F.coalesce("avg_font_size", F.lit(0.0))

    def told(x: Column) -> Column:
        note = F.exists(x, lambda y: has(y, P.OCR_FOOTNOTE_START))
        return F.struct(F.size(x).alias("n"), reads_like_references(x).alias("reference"), note.alias("note"), begins_inside(x).alias("open"))

    b = b.withColumn("_font", F.coalesce(F.median(F.when((F.col("char_count") >= 40) & (font > 0), font)).over(on_page), F.lit(0.0)))
    b = b.withColumn("_start", F.min("_top").over(on_page)).withColumn("_size", F.greatest(F.lit(1.0), F.max("_bottom").over(on_page) - F.col("_start")))
    b = b.withColumn("_gap", F.greatest(F.lit(0.0), F.col("_top") - F.coalesce(F.lag("_bottom").over(down), F.col("_start"))))
    high, low = (F.col("_top") - F.col("_start")) / F.col("_size"), (F.col("_bottom") - F.col("_start")) / F.col("_size")
    # what the text tells is found once for a block, before it is weighed
    b = b.withColumn("_told", let(solid_lines(F.col("_text")), told))
    n = F.col("_told.n")
    few = (F.length("_text") <= 140) & (n <= 2)
    on = lambda test, points: F.when(test, points).otherwise(0)
    body_font, reference = F.col("_font"), F.col("_told.reference")
    score = (
        F.when(high >= 0.70, 2).when(high >= 0.58, 1).otherwise(0) + F.when(low >= 0.88, 2).when(low >= 0.78, 1).otherwise(0)
        + on((body_font > 0) & (font > 0) & (font < body_font * 0.92), 1)
        + on((F.col("_gap") >= F.greatest(F.lit(10.0), F.when(body_font > 0, body_font * 0.9).otherwise(12.0))) & (high >= 0.55), 1)
        + on((n >= 3) & (high >= 0.58), 1) + on(F.col("_text").startswith("(") & (n >= 2) & (high >= 0.55), 2)
        + on((F.col("char_count") >= 180) & (F.col("_gap") >= 18) & (high >= 0.55), 1)
        + on(F.col("_told.note"), 2) + on(reference, 2)
    )
    open_ = F.col("_told.open")
    page_top, page_low = F.col("_top") / F.col("page_height"), F.col("_bottom") / F.col("page_height")
    role = (
        F.when((low >= 0.96) & full(sub(F.col("_text"), r"\s+", ""), P.OCR_PAGE_NUMBER), "page_number")
        .when(is_heading_block(F.col("_text"), font, F.col("line_count"), body_font), "heading").when((page_top <= 0.10) & few & ~open_, "header")
        .when((page_low >= 0.90) & few & ~reference & ~open_, "footer").when((score >= 4) & reference, "reference_block").when(score >= 4, "footnote_body").otherwise("body")
    )
    return b.withColumn("note_score", score).withColumn("role", role).drop("_text", "_told", "_top", "_bottom", "_font", "_start", "_size", "_gap")


def halves(pages: DataFrame, ratio: float = WIDE) -> DataFrame:
    """Wide pages as two rows, left then right, others as one; `box` is the part of the page."""
    w, h = F.col("width"), F.col("height")
    middle = F.floor(w / 2)
    wide = (h > 0) & (w / h >= ratio) & (middle >= LEAST_HALF)
    zero = F.lit(0).cast("double")
    box = lambda a, b: F.array(a.cast("double"), zero, b.cast("double"), h.cast("double"))
    parts = F.when(wide, F.array(box(zero, middle), box(middle, w))).otherwise(F.array(box(zero, w)))
    return pages.select("*", F.posexplode(parts).alias("part", "box"))
