"""The manifest: what the sampled pages of a book say about its text layer, layout and route."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rx import count, has, solid_lines, when_true

# Thresholds and note markers
NONEMPTY_CHARS, STRONG_CHARS, SHORT_LINE, SHORT_SHARE = 40, 400, 48, 0.58
NOTE = r"(?:\[\d{1,3}\]|\(\d{1,3}\)|\b\d{1,3}\)(?=\s+\S))"
LEADER = r"\.{4,}"
LONG_BOOK, LARGE_SCAN = 500, 300


def sample_pages(n: Column, most: int) -> Column:
    """Page numbers (from 1) to sample of a book of n pages: at its start, quarters and end, thinned to `most` with the last one kept."""
    places = F.array(*[p.cast("int") for p in (F.lit(0), F.lit(1), F.lit(2), F.floor(n / 4), F.floor(n / 2), F.floor(3 * n / 4), n - 3, n - 2, n - 1)])
    all_ = F.array_sort(F.array_distinct(F.filter(places, lambda p: (p >= 0) & (p < n))))
    every = F.greatest(F.lit(1), F.floor(F.size(all_) / most)).cast("int")
    thin = F.slice(F.filter(all_, lambda p, i: i % every == 0), 1, most)
    last = F.element_at(all_, -1)
    kept = F.when(F.array_contains(thin, last), thin).otherwise(F.concat(F.slice(thin, 1, F.size(thin) - 1), F.array(last)))
    chosen = F.when(F.size(all_) <= most, all_).otherwise(F.array_sort(F.array_distinct(kept)))
    return F.when(n > 0, F.transform(chosen, lambda p: p + 1)).otherwise(F.array().cast("array<int>"))


def _level(score: Column) -> Column:
    return F.when(score <= 1, "low").when(score <= 3, "medium").otherwise("high")


def analysed(samples: DataFrame, books: DataFrame, key: str = "relative_path") -> DataFrame:
    """books (key, page_count) with what their sampled pages (key, text) tell; books without samples have status unknown.

    One aggregation by book; line lengths come from an explode, so that the median is Spark's."""
    t = F.coalesce("text", F.lit(""))
    size = F.length(F.replace(t, F.lit(" "), F.lit("")))
    pages = samples.groupBy(key).agg(
        F.count("*").alias("n"), F.sum(size).alias("chars"), F.count_if(size >= NONEMPTY_CHARS).alias("nonempty"), F.count_if(size >= STRONG_CHARS).alias("strong"),
        F.sum(count(t, NOTE)).alias("notes_found"), F.sum(count(t, LEADER)).alias("leaders"),
    )
    rows = samples.select(key, F.explode(F.transform(solid_lines(t), F.length)).alias("x")).groupBy(key).agg(F.median("x").alias("middle"), F.avg((F.col("x") <= SHORT_LINE).cast("int")).alias("short"))
    b = books.join(pages, key, "left").join(rows, key, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    status = F.when(F.col("n") == 0, "unknown").when(F.col("nonempty") == 0, "image_only").when(F.col("nonempty") < F.col("n"), "mixed").when(F.col("strong") >= F.greatest(F.lit(1), F.floor(F.col("n") / 2)), "text_rich").otherwise("text_sparse")
    b = b.withColumn("text_layer_status", status)
    some = F.coalesce("page_count", F.lit(0))
    b = b.withColumn("possible_multi_column", F.coalesce((F.col("middle") <= SHORT_LINE) & (F.col("short") >= SHORT_SHARE), F.lit(False)))
    b = b.withColumn("possible_footnotes", (F.col("n") > 0) & (F.col("notes_found") >= F.greatest(F.lit(2), F.col("n")))).withColumn("possible_toc_or_index", F.coalesce(F.col("leaders") >= 2, F.lit(False)))
    route = F.when(status.isin("text_rich", "text_sparse"), "pdf_extract_then_clean").when(status == "mixed", "pdf_mixed_extract_plus_ocr").otherwise("pdf_ocr_then_clean")
    mixed = F.col("text_layer_status") == "mixed"
    one = lambda c, points=1: F.when(c, points).otherwise(0)
    score = one(mixed, 2) + one(F.col("possible_multi_column"), 2) + one(F.col("possible_footnotes")) + one(F.col("possible_toc_or_index")) + one(some >= LONG_BOOK)
    b = b.withColumn("route", route).withColumn("needs_ocr", F.col("route") != "pdf_extract_then_clean").withColumn("layout_risk", _level(score))
    high = ((F.col("route") == "pdf_ocr_then_clean") & (some >= LARGE_SCAN)) | (F.col("layout_risk") == "high")
    b = b.withColumn("review_priority", F.when(high, "high").when(mixed | (F.col("layout_risk") == "medium"), "medium").otherwise("low"))
    name = F.regexp_extract(key, "([^/]*)$", 1)
    bilingual = has(name, "[А-Яа-яЁё]") & has(name, "[A-Za-z]")
    notes = when_true(bilingual_name_hint=bilingual, long_book=some >= LONG_BOOK, partial_text_layer=mixed, possible_footnotes=F.col("possible_footnotes"), possible_multi_column=F.col("possible_multi_column"), possible_toc_or_index=F.col("possible_toc_or_index"))
    for c in ("layout_risk", "review_priority"):
        b = b.withColumn(c, F.when(bilingual & (F.col(c) == "low"), "medium").otherwise(F.col(c)))
    return b.select(
        *books.columns, "text_layer_status", "route", "needs_ocr", "layout_risk", (F.col("layout_risk") != "low").alias("needs_layout_review"), "review_priority", "possible_multi_column", "possible_footnotes", "possible_toc_or_index",
        F.col("chars").alias("sample_text_chars"), F.col("nonempty").alias("sample_nonempty_pages"), F.bround(F.col("chars") / F.col("n"), 1).alias("avg_chars_per_sampled_page"), F.array_join(notes, ";").alias("notes"),
    )
