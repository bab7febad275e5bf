"""The stages that ask a model, each a function from pages to pages: who is asked, what, and whether the answer is taken.

Stages get a client factory (model_edits.Client) and add their columns; write a stage's pages before the next one, as a lost task
asks again. Without a client pages pass as they are."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import list_breaks, normalized
from ..functions.rx import blank, first_of, let, n_compact, strip, when_true
from . import edit_plans
from .model_edits import Client, NoClient, asked, is_note_page, least_share, may_drop, may_shrink, missing_markers, needs_repair, notes_cut, provenance, risk
from .review import higher_risk, risk_of
from .routing import early_exit, primary_cleaning, restores_structure, route

#: Characters and items of a page that a review is shown.
SHOWN_CHARS, SHOWN_ITEMS = 3000, 20
ANSWER = "page_verdict string, summary string, concerns array<string>"


@dataclass(frozen=True)
class Settings:
    """What the model stages of a run are to do. Tiers name what a caller's client factory makes of them."""

    cleaning: str = "economy"
    cleaning_again: str = "economy"
    repair: str = "economy"
    repair_again: str = "economy"
    structure: str = "economy"
    structure_risky_only: bool = True
    delete_notes: bool = True
    at_once: int | None = 4


# Names of profiles, and whether structure is restored on risky pages only
PROFILES = {"balanced_cost": Settings(), "max_quality": Settings(cleaning="fast", cleaning_again="strong", repair="fast", repair_again="strong", structure="strong", structure_risky_only=False)}


def settings(profile: str = "balanced_cost", **given) -> Settings:
    """A profile's settings with what is given in their place."""
    return replace(PROFILES[profile], **given)


def _asked(pages: DataFrame, prompt: Column, make_client: Callable[[], Client], at_once: int | None) -> DataFrame:
    return asked(pages.withColumn("_prompt", prompt), "_prompt", make_client, "_answer", at_once).drop("_prompt")


def bootstrapped(books: DataFrame, pages: Column) -> DataFrame:
    """The first states of the pages of books (doc_id, source_path, source_type): one row for each page number in an array."""
    none = F.lit(None).cast("string")
    p = books.select("doc_id", "source_path", "source_type", F.explode(pages).alias("page_number"))
    return p.select("*", F.lit("NEW").alias("current_state"), F.lit("NEW").alias("last_success_state"), none.alias("route_decision"), none.alias("risk_level"), F.lit("").alias("raw_text"))


def commanded(pages: DataFrame, stage: str) -> DataFrame:
    """pages with what the commander decides at a stage, and a note on it: `ocr_route` or `primary_cleaning`."""
    if stage == "ocr_route":
        made = route(F.col("source"), F.col("page_type"), F.col("layout_status"), F.col("extracted_char_count"))
        p = pages.withColumn("_r", made)
        return p.withColumn("route_decision", F.col("_r.decision")).withColumn("risk_level", F.col("_r.risk")).withColumn("note", F.col("_r.note")).drop("_r")
    if stage == "primary_cleaning":
        p = pages.withColumn("primary_cleaning_plan", primary_cleaning(pages))
        return p.withColumn("note", F.concat_ws(":", "primary_cleaning_plan.action", "primary_cleaning_plan.reason"))
    raise ValueError(f"no such stage: {stage}")


# prompts


def notes_policy(delete_notes: bool) -> str:
    return "Footnotes, endnotes and reference lists are to go." if delete_notes else "Footnotes, endnotes and reference lists are to stay."


def edit_prompt(task: str, raw: Column, text: Column, tags: Column, delete_notes: bool) -> Column:
    """Asks for an edit plan for a page of numbered lines."""
    told = f"{task} Change no wording. {notes_policy(delete_notes)} Answer with JSON of the form {{\"drop_page\": false, \"operations\": [...]}}; operations are {', '.join(edit_plans.OPERATIONS)}."
    return F.concat_ws("\n\n", F.lit(told), F.concat(F.lit("Found so far: "), F.array_join(tags, ", ")), F.concat(F.lit("Page as read:\n"), raw), F.concat(F.lit("Page to edit:\n"), text))


def structure_prompt(raw: Column, text: Column) -> Column:
    told = "Put the paragraphs, headings and lists of the page below as they stand in the page as read. Change no wording. Answer with the text only."
    return F.concat_ws("\n\n", F.lit(told), F.concat(F.lit("Page as read:\n"), raw), F.concat(F.lit("Page:\n"), text))


def review_prompt(p: DataFrame) -> Column:
    shown = lambda c: F.substring(F.coalesce(p[c], F.lit("")), 1, SHOWN_CHARS)
    items = lambda c: F.to_json(F.slice(p[c], 1, SHOWN_ITEMS))
    told = "Say whether the cleaned page below keeps what the page as read says. Hyphens in words, abbreviations, numbers and values must stay. Answer with JSON: page_verdict (approve, reject or escalate), summary, concerns."
    return F.concat_ws("\n\n", F.lit(told), F.concat(F.lit("Page as read:\n"), shown("raw_text")), F.concat(F.lit("Cleaned page:\n"), shown("cleaned_text")), *[F.concat(F.lit(f"{c}:\n"), items(c)) for c in ("edits", "flags", "protected_hits")])


# stages


def model_reviewed(pages: DataFrame, make_client: Callable[[], Client] = NoClient, at_once: int | None = None) -> DataFrame:
    """Reviewed pages with llm_verdict, llm_summary, llm_concerns and the risk raised by the verdict.

    Approved pages without flags aren't asked about and are approved; an answer that is missing, unreadable or names no
    verdict escalates. Columns: raw_text, cleaned_text, edits, flags, protected_hits, page_verdict, risk_level."""
    sure = (F.col("page_verdict") == "approve") & (F.size("flags") == 0)
    p = _asked(pages, F.when(~sure, review_prompt(pages)), make_client, at_once)
    braces = F.regexp_extract("_answer", r"(?s)(\{.*\})", 1)
    p = p.withColumn("_said", F.from_json(F.when(braces != "", F.regexp_replace(braces, r"[\x00-\x1f]+", " ")), ANSWER)).withColumn("_sure", sure)
    read = F.col("_said").isNotNull() & ~(F.col("_said.page_verdict").isNull() & F.col("_said.summary").isNull() & F.col("_said.concerns").isNull())
    verdict = F.when(F.col("_sure"), "approve").when(read & F.col("_said.page_verdict").isin("approve", "reject", "escalate"), F.col("_said.page_verdict")).otherwise("escalate")
    none = F.array().cast("array<string>")
    return p.select(
        *[c for c in pages.columns if c != "risk_level"], verdict.alias("llm_verdict"), F.when(F.col("_sure"), "").when(read, F.coalesce("_said.summary", F.lit(""))).otherwise("no readable answer").alias("llm_summary"),
        F.when(read & ~F.col("_sure"), F.coalesce("_said.concerns", none)).otherwise(none).alias("llm_concerns"), higher_risk(F.col("risk_level"), risk_of(verdict)).alias("risk_level"),
    )


def _edited(pages: DataFrame, base: Column, wanted: Column, prompt: Column, drop: Column, make_client: Callable[[], Client], at_once: int | None) -> DataFrame:
    """pages with `_base`, `_wanted`, `_answered` and, in `_edited`, the base text after the plan that was answered."""
    p = _asked(pages.withColumn("_base", base).withColumn("_wanted", wanted).withColumn("_drop", drop), F.when(wanted, prompt), make_client, at_once)
    p = p.withColumn("_answered", F.col("_wanted") & F.col("_answer").isNotNull())
    return edit_plans.applied(p, "_base", "_answer", F.col("_drop"), "_edited")


def model_cleaned(pages: DataFrame, make_client: Callable[[], Client] = NoClient, s: Settings = Settings()) -> DataFrame:
    """Pages after the first model stage: primary_clean_text, primary_status and primary_notes.

    Pages whose plan is to run are asked for edits; an answer that empties, shortens or unheads a page for no reason isn't
    taken. Columns: raw_text, cleaned_text, flags, review tags as issue_tags, primary_cleaning_plan."""
    raw, base = F.coalesce("raw_text", F.lit("")), F.coalesce("cleaned_text", F.lit(""))
    note, ids = is_note_page(raw), F.transform("flags", lambda f: f["rule_id"])
    wanted = (F.col("primary_cleaning_plan.action") == "run_primary_cleaning") & ~blank(base)
    prompt = edit_prompt("Remove what reading a printed page left in it.", raw, F.col("cleaned_text"), F.col("issue_tags"), s.delete_notes)
    p = _edited(pages, base, wanted, prompt, may_drop(ids, note, s.delete_notes), make_client, s.at_once)
    after, dropped = normalized(F.col("_edited.text")), F.col("_edited.drop_page")
    free = dropped | (note & F.lit(s.delete_notes))
    empty, short = (after == "") & ~free, ~free & (n_compact(raw) >= 200) & (n_compact(after) < F.floor(n_compact(raw) * 0.72))
    lost = ~free & (F.size(missing_markers(raw, after)) > 0)
    bad = empty | short | lost
    why = when_true(request_failed_used_fallback=F.col("_wanted") & ~F.col("_answered"), empty_model_output_used_fallback=empty, model_output_too_short_used_fallback=short, missing_heading_markers_used_fallback=lost)
    status = F.when(~F.col("_wanted"), "skipped").when(~F.col("_answered") | bad, "fallback").otherwise("structured")
    taken = F.col("_answered") & ~bad
    return p.select(*pages.columns, F.when(taken, after).otherwise(F.col("_base")).alias("primary_clean_text"), status.alias("primary_status"), F.when(F.col("_wanted"), F.array_union(F.col("_edited.notes"), why)).otherwise(F.array().cast("array<string>")).alias("primary_notes"))


def model_repaired(pages: DataFrame, make_client: Callable[[], Client] = NoClient, s: Settings = Settings(), risky_only: bool = True) -> DataFrame:
    """Pages after the repair stage: repaired_text and repair_status (cleaned_empty, skipped, structured or fallback).

    Columns: raw_text, cleaned_text, allow_empty_output, issue_tags, page_verdict, llm_verdict, risk_level. Notes that tags
    name are cut after the answer as well; then a page must keep its least share and, unless it may shrink, its headings."""
    raw, cleaned, tags = F.coalesce("raw_text", F.lit("")), F.coalesce("cleaned_text", F.lit("")), F.coalesce("issue_tags", F.array().cast("array<string>"))
    base = first_of(cleaned, raw)
    note = is_note_page(raw) | is_note_page(cleaned)
    level = risk(F.col("risk_level"), F.col("page_verdict"), F.col("llm_verdict"))
    emptied = F.coalesce("allow_empty_output", F.lit(False)) & blank(cleaned)
    wanted = ~emptied & (F.lit(not risky_only) | needs_repair(tags, level, F.col("llm_verdict")))
    prompt = edit_prompt("Repair what a review found on a page.", raw, base, tags, s.delete_notes)
    drop = F.coalesce(F.arrays_overlap(tags, F.array(F.lit("publisher_meta_left"), F.lit("garbled_page"), F.lit("empty_page_after_cleaning"))), F.lit(False)) | (note & F.lit(s.delete_notes))
    p = _edited(pages, base, wanted, prompt, drop, make_client, s.at_once)
    tidy = lambda t: let(notes_cut(t, tags, s.delete_notes), list_breaks)
    dropped, answer = F.col("_edited.drop_page"), normalized(F.col("_edited.text"))
    some = F.when((answer == "") & ~dropped & ~(note & F.lit(s.delete_notes)), F.col("_base")).otherwise(answer)
    p = p.withColumn("_after", tidy(F.when(F.col("_answered"), some).otherwise(F.col("_base"))))
    size = n_compact(F.col("_base"))
    short = (size >= 200) & (n_compact(F.col("_after")) < F.floor(size * least_share(tags, note, s.delete_notes))) & ~dropped
    p = p.withColumn("_short", short).withColumn("_after", F.when(short, tidy(F.col("_base"))).otherwise(F.col("_after")))
    lost = (F.size(missing_markers(raw, F.col("_after"))) > 0) & ~may_shrink(tags, note, s.delete_notes) & ~dropped
    fell = ~F.col("_answered") | F.col("_short") | lost | ((answer == "") & (F.col("_after") != "") & F.col("_answered"))
    status = F.when(emptied, "cleaned_empty").when(~F.col("_wanted"), "skipped").when(fell, "fallback").otherwise("structured")
    text = F.when(~F.col("_wanted"), cleaned).when(lost, F.col("_base")).otherwise(strip(F.col("_after")))
    return p.select(*pages.columns, text.alias("repaired_text"), status.alias("repair_status"))


def structure_restored(pages: DataFrame, make_client: Callable[[], Client] = NoClient, s: Settings = Settings()) -> DataFrame:
    """Pages after the structure stage: final_text, structure_status and final_text_source. Any doubt about an answer keeps the repaired text.

    Columns: raw_text, repaired_text, issue_tags, repair_status, allow_empty_output."""
    raw, repaired = strip(F.coalesce("raw_text", F.lit(""))), strip(F.coalesce("repaired_text", F.lit("")))
    emptied = F.coalesce("allow_empty_output", F.lit(False)) & (repaired == "")
    wanted = ~emptied & (first_of(repaired, raw) != "") & restores_structure(F.col("issue_tags"), F.col("repair_status"), F.col("issue_tags"), raw, repaired, s.structure_risky_only)
    p = _asked(pages.withColumn("_wanted", wanted), F.when(wanted, structure_prompt(raw, repaired)), make_client, s.at_once)
    answer = normalized(F.coalesce("_answer", F.lit("")))
    doubt = F.col("_answer").isNull() | (answer == "") | ((n_compact(raw) >= 200) & (n_compact(answer) < F.floor(n_compact(raw) * 0.72))) | (F.size(missing_markers(raw, answer)) > 0)
    taken = F.col("_wanted") & ~doubt
    status = F.when(emptied, "repaired_empty").when(first_of(repaired, raw) == "", "empty").when(~F.col("_wanted"), "skipped").when(doubt, "fallback").otherwise("restored")
    return p.select(*pages.columns, F.when(taken, answer).when(emptied, "").otherwise(first_of(repaired, raw)).alias("final_text"), status.alias("structure_status"), F.when(taken, "structure_restore_generated").otherwise("repaired_passthrough").alias("final_text_source"))


def exited_early(pages: DataFrame) -> DataFrame:
    """Reviewed pages that need nothing more: repaired and final text are the cleaned one, their state says so, and a note says why. Others stay as they are.

    Columns: those of routing.early_exit, repaired_text, final_text, current_state, last_success_state."""
    p = pages.withColumn("_e", early_exit(pages))
    out = F.col("_e.exits")
    values = {"repaired_text": F.col("cleaned_text"), "final_text": F.col("cleaned_text"), "current_state": F.lit("STRUCTURE_RESTORED"), "last_success_state": F.lit("STRUCTURE_RESTORED")}
    for name, value in values.items():
        p = p.withColumn(name, F.when(out, value).otherwise(F.col(name)))
    note = provenance(source="repaired_passthrough", status="early_exit_passthrough", reason=F.col("_e.reason"))
    return p.withColumn("early_exit", out).withColumn("exit_note", F.when(out, note)).drop("_e")


__all__ = ["PROFILES", "Settings", "bootstrapped", "commanded", "exited_early", "model_cleaned", "model_repaired", "model_reviewed", "settings", "structure_restored"]
