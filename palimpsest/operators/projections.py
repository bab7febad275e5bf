"""Page states seen by stage: what a stage gets of a page when its own document is missing, states restored from stage documents, and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.normalize import homoglyphs
from ..functions.rx import blank, first_of
from .model_edits import provenance
from .review import higher_risk, risk_of
from .states import at_least, effective, export_reason, export_text

EMPTY_LIST = "array<string>"
# Statuses of a structure stage whose text is a model's own
MODEL_STATUSES = ("gemini", "deepseek")


def _or(value: Column, default: Column) -> Column:
    return F.coalesce(value, default)


def rule_page(payload: Column, s: DataFrame) -> Column:
    """The rule-cleaned page of a state: its own document, field by field, or what the state tells."""
    field = lambda name, default: F.when(payload.isNotNull(), payload[name]).otherwise(default).alias(name)
    return F.struct(field("raw_text", s["raw_text"]), field("cleaned_text", s["rule_cleaned_text"]), field("drop_page", F.lit(False)), field("allow_empty_output", F.lit(False)), field("drop_reason", F.lit("")))


def primary_text(s: DataFrame) -> Column:
    """The text of the first model stage: its own, else the rules'."""
    return first_of(s["primary_clean_text"], s["rule_cleaned_text"])


def repaired_text(s: DataFrame) -> Column:
    """The text of the repair stage: its own, else that of the stages before."""
    return first_of(s["repaired_text"], primary_text(s))


def review_verdict(s: DataFrame) -> Column:
    """The verdict that a page's risk and tags stand for when its review is missing."""
    return F.when(s["risk_level"] == "high", "reject").when(F.size(_or(s["review_tags"], F.array().cast(EMPTY_LIST))) > 0, "escalate").otherwise("approve")


def structure_status(s: DataFrame) -> Column:
    """struct(status, final_text_source) of the structure stage, with defaults."""
    plan = s["structure_plan"]
    return F.struct(_or(plan["status"], F.lit("state_fallback")).alias("status"), _or(plan["final_text_source"], F.lit("repaired_passthrough")).alias("final_text_source"))


def is_empty_or_dropped(drop: Column, allow_empty: Column, text: Column) -> Column:
    return F.coalesce(drop, F.lit(False)) | (F.coalesce(allow_empty, F.lit(False)) & blank(text))


def reached(states: DataFrame, key: list[str], target: str) -> DataFrame:
    """(key, n, reached): how many pages there are, and how many got as far as a state."""
    at = at_least(effective(F.col("current_state"), F.col("last_success_state")), target)
    return states.groupBy(*key).agg(F.count("*").alias("n"), F.count_if(at).alias("reached"))


def audited(states: DataFrame, text: str = "rule_cleaned_text", audit: str = "homoglyph_audit") -> DataFrame:
    """states whose rule-cleaned text was audited for look-alike letters, once: those that have an audit stay as they are.

    Columns audit: struct<detected,auto_fixed,warned> (null: not yet) and a note on where the text comes from."""
    kind = "struct<detected:int,auto_fixed:int,warned:int>"
    done = states.withColumn("_h", F.when(F.col(audit).isNull() & F.col(text).isNotNull(), homoglyphs(F.col(text))))
    made = F.struct(*[F.col(f"_h.{c}").alias(c) for c in ("detected", "auto_fixed", "warned")]).cast(kind)
    note = provenance(detected=F.col("_h.detected").cast("string"), auto_fixed=F.col("_h.auto_fixed").cast("string"), warned=F.col("_h.warned").cast("string"))
    return done.withColumn("audit_note", F.when(F.col("_h.detected") > 0, note)).withColumn(text, F.coalesce("_h.text", text)).withColumn(audit, F.when(F.col("_h").isNotNull(), made).otherwise(F.col(audit))).drop("_h")


def backfilled(states: DataFrame, reviews: DataFrame, repairs: DataFrame, structures: DataFrame, key: list[str]) -> DataFrame:
    """states brought up to what older stage documents hold: a review, a repair or a restored structure lifts a page that isn't as far yet.

    reviews: key, issue_tags, page_verdict; repairs: key, repaired_text; structures: key, restored_text, status,
    final_text_source (null: by the status, a model's own text or the repaired one)."""
    r = reviews.select(*key, F.col("issue_tags").alias("_tags"), risk_of(F.col("page_verdict")).alias("_risk"))
    p = repairs.select(*key, F.col("repaired_text").alias("_repaired"), F.lit(True).alias("_has_repair"))
    made_by_model = F.col("status").isin(*MODEL_STATUSES)
    source = F.coalesce("final_text_source", F.when(made_by_model, "structure_restore_generated").otherwise("repaired_passthrough"))
    t = structures.select(*key, F.coalesce("restored_text", F.lit("")).alias("_final"), F.coalesce("status", F.lit("legacy_restored")).alias("_status"), source.alias("_source"))
    s = states.join(r, key, "left").join(p, key, "left").join(t, key, "left")
    reviewed, restored = F.col("_tags").isNotNull(), F.col("_final").isNotNull()
    repaired = F.coalesce("_has_repair", F.lit(False))
    now = effective(F.col("current_state"), F.col("last_success_state"))
    lifted = F.when(restored & ~at_least(now, "STRUCTURE_RESTORED"), "STRUCTURE_RESTORED").when(repaired & ~at_least(now, "REPAIRED"), "REPAIRED").when(reviewed & ~at_least(now, "REVIEWED"), "REVIEWED")
    fresh = restored & ~at_least(now, "STRUCTURE_RESTORED")
    values = {
        "review_tags": F.when(reviewed, F.col("_tags")).otherwise(F.col("review_tags")), "risk_level": F.when(reviewed, higher_risk(F.col("risk_level"), F.col("_risk"))).otherwise(F.col("risk_level")),
        "repaired_text": F.when(repaired, first_of(F.col("_repaired"), F.col("repaired_text"))).otherwise(F.col("repaired_text")), "final_text": F.when(fresh, F.col("_final")).otherwise(F.col("final_text")),
        "structure_plan": F.when(fresh, F.struct(F.col("_status").alias("status"), F.col("_source").alias("final_text_source"))).otherwise(F.col("structure_plan")),
        "current_state": F.coalesce(lifted, "current_state"), "last_success_state": F.coalesce(lifted, "last_success_state"),
    }
    return s.select(*[values[c].alias(c) if c in values else F.col(c) for c in states.columns])


def passed_through(states: DataFrame) -> DataFrame:
    """Pages that need no structure stage: the repaired text is the final one, and a plan says so."""
    skipped = F.struct(F.lit("skipped").alias("status"), F.lit("repaired_passthrough").alias("final_text_source"))
    return states.withColumn("final_text", repaired_text(states)).withColumn("structure_plan", skipped).withColumn("current_state", F.lit("STRUCTURE_RESTORED")).withColumn("last_success_state", F.lit("STRUCTURE_RESTORED"))


def export_documents(pages: DataFrame, book: str) -> DataFrame:
    """(book, n_pages, n_exported, text): the exported texts of each book's pages in order, one blank line between them.

    Pages as states.export_text and states.export_reason ask for them; the pages of a book meet in one row, as the book does."""
    p = export_reason(export_text(pages).withColumn("text", F.col("export_text")), book)
    kept = F.when(F.col("filter_reason").isNull(), F.struct("page_number", "text"))
    made = p.groupBy(book).agg(F.count("*").alias("n_pages"), F.array_sort(F.collect_list(kept)).alias("_p"))
    return made.select(book, "n_pages", F.size("_p").cast("bigint").alias("n_exported"), F.array_join(F.transform("_p", lambda x: x["text"]), "\n\n").alias("text"))


def book_summaries(pages: DataFrame, key: list[str]) -> DataFrame:
    """(key, pages, edits, flags, protected_hits, sources, verdicts): what a trial run did with each book. sources, verdicts: name=count, in order of the names.

    pages: reviewed pages with source, page_verdict, edits, flags, protected_hits."""
    counts = pages.groupBy(*key).agg(F.count("*").alias("pages"), *[F.sum(F.size(c)).cast("bigint").alias(c) for c in ("edits", "flags", "protected_hits")])
    for name, c in (("sources", "source"), ("verdicts", "page_verdict")):
        each = pages.groupBy(*key, F.coalesce(c, F.lit("unknown")).alias("_v")).agg(F.count("*").alias("_n"))
        one = each.groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_v", "_n"))), lambda x: F.concat(x["_v"], F.lit("="), x["_n"].cast("string"))), ",").alias(name))
        counts = counts.join(one, key)
    return counts


__all__ = [
    "P", "audited", "backfilled", "book_summaries", "export_documents", "is_empty_or_dropped", "passed_through", "primary_text", "reached", "repaired_text", "review_verdict", "rule_page", "structure_status",
]
