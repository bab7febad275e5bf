"""Routing: how a page is read, what risk it carries, which later stages it needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.line_rules import is_continuation
from ..functions.rx import blank, first_of, has, one_of, strip, tally

PLAN = "struct<source:string,difficulty:string,reason:string,high_scale:boolean>"


def ocr_plan(route: Column, text: Column, n_chars: Column, skip: Column, mojibake: Column, low_quality: Column, blocks: Column, backend: Column) -> Column:
    """How a page is to be read: struct(source, difficulty, reason, high_scale), by the first rule that fits.

    blocks: array<struct<text:string,bbox:array<double>>>."""
    solid = F.filter(blocks, lambda b: ~blank(b["text"]))
    short = F.when(F.size(solid) > 0, tally(solid, lambda b: F.length(strip(b["text"])) <= 70) / F.size(solid)).otherwise(F.lit(0.0))
    top = F.array_min(F.transform(solid, lambda b, i: F.struct(b["bbox"][1].alias("y"), i.alias("i"), b["text"].alias("text"))))
    height = F.greatest(F.lit(1.0), F.array_max(F.transform(solid, lambda b: b["bbox"][3])))
    top_open = F.coalesce((top["y"] / height <= 0.12) & is_continuation(top["text"]), F.lit(False))
    plan = lambda source, difficulty, reason, high: F.struct(F.lit(source).alias("source"), F.lit(difficulty).alias("difficulty"), (reason if isinstance(reason, Column) else F.lit(reason)).alias("reason"), F.lit(high).alias("high_scale")).cast(PLAN)
    mixed = route == "pdf_mixed_extract_plus_ocr"
    rules = (
        (skip.isNotNull() & (F.coalesce(text, F.lit("")) != ""), plan("ocr_skipped_nonbody", "skip_nonbody", skip, False)),
        (backend == "extract_only", plan("extract", "extract_only", "backend_extract_only", False)),
        (backend.isin("tesseract", "gemini", "google_documentai"), plan("ocr", "forced_ocr", F.concat(F.lit("backend_"), backend), True)),
        (route == "pdf_ocr_then_clean", plan("ocr", "hard_scan", "route_pdf_ocr_then_clean", True)),
        (mojibake | low_quality, plan("ocr", "dirty_extract", "extract_quality_risky", True)),
        (n_chars < 80, plan("ocr", "sparse_text", "extract_sparse", True)),
        (top_open & (n_chars < 260), plan("ocr", "top_body_risk", "top_block_looks_like_body_continuation", True)),
        ((F.size(blocks) >= 14) & (short >= 0.70), plan("ocr", "layout_complex", "many_short_blocks", True)),
        (mixed & (n_chars >= 260) & (short < 0.65), plan("extract", "easy_extract", "mixed_route_extract_good", False)),
        (mixed, plan("ocr", "mixed_risky", "mixed_route_needs_ocr", False)),
        ((n_chars >= 260) & (short < 0.60), plan("extract", "easy_extract", "extract_quality_good", False)),
        (route == "pdf_extract_then_clean", plan("extract", "extract_default", "route_pdf_extract_then_clean", False)),
        (n_chars < 160, plan("ocr", "fallback", "default_route", False)),
    )
    out = plan("extract", "fallback", "default_route", False)
    for test, made in reversed(rules):
        out = F.when(test, made).otherwise(out)
    return out


def route(source: Column, page_type: Column, layout_status: Column, n_chars: Column) -> Column:
    """struct(decision, risk, note)."""
    made = lambda decision, risk, note: F.struct(F.lit(decision).alias("decision"), F.lit(risk).alias("risk"), note.alias("note"))
    risky = one_of(page_type, ["body_with_notes"]) | one_of(layout_status, ["text_fallback"]) | (F.coalesce(n_chars, F.lit(0)) < 260)
    return (
        F.when(one_of(page_type, P.NONBODY_TYPES), made("skip_nonbody_page", "low", F.concat(F.lit("page_type="), page_type)))
        .when(one_of(source, ["ocr", "extract_fallback"]), made("hard_ocr_page", "high", F.concat(F.lit("ocr_source="), source)))
        .when(one_of(source, ["ocr_skipped_nonbody", "epub_skip_nonbody"]), made("skip_nonbody_page", "low", F.concat(F.lit("source="), source)))
        .when(one_of(source, ["extract", "epub_extract"]) & risky, made("risky_extract_page", "medium", F.lit("extract_with_layout_risk")))
        .when(one_of(source, ["extract", "epub_extract"]), made("easy_page", "low", F.lit("extract_looks_safe")))
        .otherwise(made("risky_extract_page", "medium", F.lit("default_route")))
    )


def _overlap(a: Column, values) -> Column:
    return F.coalesce(F.arrays_overlap(a, F.array(*[F.lit(v) for v in values])), F.lit(False))


def primary_cleaning(p: DataFrame) -> Column:
    """struct(action, reason) for pages with source, page_type, layout_status, extracted_char_count and, from the rules, flags, cleaned_text, drop_page."""
    run = lambda reason: F.struct(F.lit("run_primary_cleaning").alias("action"), reason.alias("reason"))
    skip = lambda reason: F.struct(F.lit("skip_primary_cleaning").alias("action"), F.lit(reason).alias("reason"))
    flags = F.transform(p["flags"], lambda f: f["rule_id"])
    risky = F.array_sort(F.array_intersect(flags, F.array(*[F.lit(x) for x in P.COMMANDER_FLAGS])))
    return (
        F.when(p["flags"].isNull(), run(F.lit("missing_rule_page"))).when(p["drop_page"], skip("dropped_by_rules")).when(blank(p["cleaned_text"]), skip("empty_after_rules"))
        .when(one_of(p["source"], ["ocr", "extract_fallback"]), run(F.concat(F.lit("ocr_source:"), p["source"])))
        .when(one_of(p["page_type"], ["body_with_notes", "notes_only"]), run(F.concat(F.lit("page_type:"), p["page_type"])))
        .when(one_of(p["layout_status"], ["text_fallback"]) & ~one_of(p["source"], ["extract"]), run(F.lit("layout_text_fallback")))
        .when(F.size(risky) > 0, run(F.concat(F.lit("risky_flags:"), F.array_join(F.slice(risky, 1, 4), ","))))
        .when(F.coalesce(p["extracted_char_count"], F.lit(0)) < 240, run(F.lit("short_extract_page"))).otherwise(skip("rules_look_sufficient"))
    )


def escalates_cleaning(tags: Column, status: Column, source: Column, flags: Column) -> Column:
    read = one_of(source, ["ocr", "extract_fallback"]) & (F.size(tags) > 0)
    return _overlap(tags, P.CLEANING_TAGS) | one_of(status, ["fallback"]) | read | (F.size(F.array_intersect(flags, F.array(*[F.lit(f) for f in P.ESCALATION_FLAGS]))) >= 2)


def escalates_repair(tags: Column, status: Column, source: Column, ratio: Column) -> Column:
    some = F.size(tags) > 0
    return _overlap(tags, P.REPAIR_TAGS) | (one_of(status, ["fallback"]) & some) | (one_of(source, ["ocr", "extract_fallback"]) & (ratio > 0.25) & some)


def restores_structure(tags: Column, repair_status: Column, repair_tags: Column, raw: Column, cleaned: Column, risky_only: bool = True) -> Column:
    if not risky_only:
        return F.lit(True)
    lost = has(raw, P.RESTORE_HEADING, "m") & ~has(cleaned, P.RESTORE_HEADING, "m")
    return _overlap(tags, P.STRUCTURE_TAGS) | (one_of(repair_status, ["fallback"]) & _overlap(repair_tags, ["heading_structure_risky"])) | lost


def early_exit(p: DataFrame, llm_review: bool = False) -> Column:
    """struct(exits, reason) for reviewed pages: the first guard that fails is the reason."""
    said = lambda name, c: F.concat(F.lit(f"{name}="), F.coalesce(first_of(c, F.lit("unknown")), F.lit("unknown")))
    guards = (
        (F.lit(llm_review), F.lit("gemini_review_enabled")),
        (blank(p["cleaned_text"]) | F.coalesce(p["drop_page"], F.lit(False)), F.lit("empty_or_dropped_page")),
        (~one_of(p["route_decision"], ["easy_page"]), said("route_decision", p["route_decision"])),
        (~one_of(p["source"], ["extract", "epub_extract"]), said("ocr_source", p["source"])),
        (~one_of(p["page_type"], ["body_only"]), said("page_type", p["page_type"])),
        (one_of(p["layout_status"], ["text_fallback"]), F.lit("layout_status=text_fallback")),
        (~one_of(p["page_verdict"], ["approve"]), said("review_verdict", p["page_verdict"])),
        (p["risk_level"].isNotNull() & ~one_of(p["risk_level"], ["low"]), said("risk_level", p["risk_level"])),
        (F.size(p["issue_tags"]) > 0, F.lit("issue_tags_present")),
        (one_of(p["status"], ["fallback"]), F.lit("primary_cleaning_fallback")),
        (_overlap(F.transform(p["flags"], lambda f: f["rule_id"]), P.EARLY_EXIT_FLAGS), F.lit("risky_flags_present")),
        (F.coalesce(p["homoglyphs_warned"], F.lit(0)) > 0, F.lit("homoglyph_warnings_present")),
        (F.length(strip(p["cleaned_text"])) < 200, F.lit("cleaned_text_too_short")),
    )
    reason = F.lit("easy_extract_body_only_review_approve")
    exits = F.lit(True)
    for test, why in reversed(guards):
        reason, exits = F.when(test, why).otherwise(reason), F.when(test, False).otherwise(exits)
    return F.struct(exits.alias("exits"), reason.alias("reason"))


def ocr_breaker(attempts: DataFrame, book: str = "book", least: int = 20, ratio: float = 0.10, streak: int = 12) -> DataFrame:
    """attempts (book, page_number, success) with ocr_disabled: pages after the one at which OCR of the book was given up, as
    after `least` attempts less than `ratio` had succeeded or the last `streak` were empty."""
    w = W.partitionBy(book).orderBy("page_number").rowsBetween(W.unboundedPreceding, 0)
    a = attempts.withColumn("_n", F.count("*").over(w)).withColumn("_ok", F.sum(F.col("success").cast("int")).over(w))
    a = a.withColumn("_last_ok", F.max(F.when(F.col("success"), F.col("_n"))).over(w))
    stop = (F.col("_n") >= least) & ((F.col("_ok") / F.col("_n") < ratio) | (F.col("_n") - F.coalesce("_last_ok", F.lit(0)) >= streak))
    first = F.min(F.when(stop, F.col("page_number"))).over(W.partitionBy(book))
    return a.withColumn("ocr_disabled", F.coalesce(F.col("page_number") > first, F.lit(False))).drop("_n", "_ok", "_last_ok")
