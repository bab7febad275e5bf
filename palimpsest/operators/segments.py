"""Pages cut into body, notes and references, by the roles of their blocks or, without blocks, by what the text is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.line_rules import skip_reason
from ..functions.normalize import normalized
from ..functions.rx import strip

# Page types by the reason for which a page needs no OCR, and where its text goes
TYPES = {"toc_index_page": "toc_or_index", "reference_only_page": "reference_only", "glossary_page": "glossary_page", "publisher_meta_page": "publisher_meta"}
AS_REFERENCE = ("reference_only_page", "glossary_page")
PARTS = {"body_text": ("body", "heading"), "notes_text": ("footnote_body",), "reference_text": ("reference_block",)}


def segmented(pages: DataFrame, blocks: DataFrame | None, page: list[str], text: str = "selected_text") -> DataFrame:
    """pages with body_text, notes_text, reference_text, page_type and layout_status.

    blocks: (page key, place, text, role). A page that a test of its text sets apart has no body; a page without blocks is
    all body. One aggregation by page; the parts of a page meet in one row, as the page does."""
    status = "pdf_blocks" if blocks is not None else "text_fallback"
    apart = "page_classifier" if blocks is not None else "text_classifier"
    t = F.coalesce(F.col(text), F.lit(""))
    p = pages
    if blocks is not None:
        kept = blocks.select(*page, "place", strip(F.coalesce("text", F.lit(""))).alias("text"), "role")
        of = lambda roles: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("role").isin(*roles) & (F.col("text") != ""), F.struct("place", "text")))), lambda x: x["text"]), "\n\n")
        made = kept.groupBy(*page).agg(*[of(roles).alias(f"_{name}") for name, roles in PARTS.items()], F.lit(True).alias("_blocks"))
        p = p.join(made, page, "left")
    else:
        p = p.select("*", *[F.lit("").alias(f"_{name}") for name in PARTS], F.lit(None).cast("boolean").alias("_blocks"))
    p = p.withColumn("_why", skip_reason(t))
    body, notes, references = (normalized(F.col(f"_{name}")) for name in PARTS)
    some = (notes != "") | (references != "")
    by_blocks = F.when((body == "") & some, "notes_only").when((body != "") & some, "body_with_notes").when(body != "", "body_only").otherwise("empty")
    by_text = F.when(t != "", "body_only").otherwise("empty")
    reason = F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv])[F.col("_why")]
    known, have = F.col("_why").isNotNull(), F.coalesce("_blocks", F.lit(False))
    return p.select(
        *pages.columns,
        F.when(known, "").when(have & (body != ""), body).otherwise(t).alias("body_text"),
        F.when(known | ~have, "").otherwise(notes).alias("notes_text"),
        F.when(F.col("_why").isin(*AS_REFERENCE), t).when(known | ~have, "").otherwise(references).alias("reference_text"),
        F.when(known, reason).when(have, by_blocks).otherwise(by_text).alias("page_type"),
        F.when(known, apart).when(have, status).otherwise("text_fallback").alias("layout_status"),
    )


def source_type(path: Column) -> Column:
    """What a file is, by its suffix."""
    suffix = F.lower(F.regexp_extract(path, r"(?<=[^/])\.([^./]*)$", 1))
    return F.when(suffix == "", "unknown").otherwise(suffix)


def state_of_source(source: Column) -> Column:
    """The state that a page is in after reading."""
    return F.when(source.isin("ocr", "extract_fallback"), "OCR_DONE").otherwise("EXTRACTED")
