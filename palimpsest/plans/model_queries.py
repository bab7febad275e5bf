"""Queries that run the model stages with a client that answers by a rule, and SQL that states what comes of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import model_stages, page_cleaning, review
from . import noise, sql
from .decision_queries import _REVIEW, _note_page, _reviewable
from .queries import query
from .rule_queries import S

B = chr(92)


class Reviewer:
    """Rejects pages that name a book number, says nothing on urls, and is unreadable on prizes of any kind."""

    def complete(self, prompts: list[str]) -> list[str | None]:
        def one(p: str) -> str | None:
            page = p[p.index("Cleaned page:\n") : p.index("edits:\n")]
            if "ISBN" in page:
                return '```json\n{"page_verdict": "reject", "summary": "a\nnumber", "concerns": ["isbn"]}\n```'
            if "http" in page:
                return None
            return '{"page_verdict": "maybe"}' if "Глава" in page else 'Here: {"page_verdict": "approve", "summary": "fine"}' if "слово" in page else "no braces"

        return [one(p) for p in prompts]


_SHOWN = "left(c, 3000)"
_SAID = sql.case([("sure", "'sure'"), (f"contains({_SHOWN}, 'ISBN')", "'reject'"), (f"contains({_SHOWN}, 'http')", "'none'"), (f"contains({_SHOWN}, 'Глава')", "'maybe'"), (f"contains({_SHOWN}, 'слово')", "'fine'")], "'none'")


@query(f"""{_REVIEW}, q AS (SELECT *, doc_id % 3 = 0 AND NOT flagged AS sure FROM (SELECT *, doc_id % 2 = 0 AS flagged FROM t)), said AS (SELECT *, {_SAID} AS said FROM q)
 SELECT doc_id, part, CASE said WHEN 'sure' THEN 'approve' WHEN 'reject' THEN 'reject' WHEN 'fine' THEN 'approve' ELSE 'escalate' END AS llm_verdict, CASE said WHEN 'sure' THEN '' WHEN 'reject' THEN 'a number' WHEN 'fine' THEN 'fine' WHEN 'maybe' THEN '' ELSE 'no readable answer' END AS llm_summary,
 (said = 'reject')::INT AS n_concerns, CASE said WHEN 'reject' THEN 'high' WHEN 'sure' THEN 'low' WHEN 'fine' THEN 'low' ELSE 'medium' END AS risk_level FROM said""")
def model_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a model's review makes of pages; every third without flags isn't asked about."""
    s = _reviewable(spark, sf_dir).withColumn("page_verdict", F.when(F.col("doc_id") % 3 == 0, "approve").otherwise("escalate")).withColumn("risk_level", F.lit("low"))
    s = s.withColumn("flags", F.when(F.col("doc_id") % 2 == 0, F.array(page_cleaning.flag("a", F.lit("b")))).otherwise(F.array()).cast(page_cleaning.FLAGS)).withColumn("edits", F.array().cast(page_cleaning.EDITS)).withColumn("protected_hits", F.array().cast(page_cleaning.FLAGS))
    r = model_stages.model_reviewed(s, Reviewer)
    return r.select("doc_id", "part", "llm_verdict", "llm_summary", F.size("llm_concerns").alias("n_concerns"), "risk_level")


class Restorer:
    """Gives a page back with its lines turned about, shortens those with a price, and keeps silent on addresses."""

    def complete(self, prompts: list[str]) -> list[str | None]:
        def one(p: str) -> str | None:
            page = p[p.index("\n\nPage:\n") + 8 :]
            return None if "@" in page else page[:10] if "№" in page else "\n".join(reversed(page.split("\n")))

        return [one(p) for p in prompts]


_normal = lambda c: sql.strip(sql.sub(sql.sub(c, "[ " + B + "t]+\n", "\n"), "\n{3,}", "\n\n"))
_restored = lambda c: sql.has(c, "^(?:Глава" + B + "s+" + B + "d+|[IVXLCDM]+" + B + "." + B + "s+.+)$", "m")
_markers = lambda a, b: f"len(list_filter(list_transform(regexp_extract_all({a}, '(?im)^[IVXLCDM]+{B}.{B}s+'), lambda m: upper(m)), lambda m: NOT contains(upper({b}), m))) > 0"
_turned = "list_aggregate(list_reverse(string_split(t, chr(10))), 'string_agg', chr(10))"


@query(f"""{_REVIEW}, q AS (SELECT doc_id, part, tags, {sql.strip('text')} AS r, CASE WHEN doc_id % 13 = 0 THEN '' ELSE {sql.strip('c')} END AS t0, doc_id % 26 = 0 AS may_be_empty FROM t), base AS (SELECT *, CASE WHEN t0 = '' THEN r ELSE t0 END AS f, t0 AS t FROM q),
 w AS (SELECT *, may_be_empty AND t = '' AS emptied, f <> '' AND (list_contains(tags, 'heading_structure_risky') OR list_contains(tags, 'excessive_blank_lines') OR ({_restored('r')} AND NOT {_restored('t')})) AS risky FROM base),
 answered AS (SELECT *, NOT emptied AND risky AS wanted, CASE WHEN contains(t, '@') THEN NULL WHEN contains(t, '№') THEN {_normal('left(t, 10)')} ELSE {_normal(_turned)} END AS answer FROM w),
 d AS (SELECT *, answer IS NULL OR answer = '' OR ({sql.n_compact('r')} >= 200 AND {sql.n_compact('answer')} < floor({sql.n_compact('r')} * 0.72)) OR {_markers('r', 'answer')} AS doubt FROM answered)
 SELECT doc_id, part, md5(CASE WHEN wanted AND NOT doubt THEN answer WHEN emptied THEN '' ELSE f END) AS final_text, CASE WHEN emptied THEN 'repaired_empty' WHEN f = '' THEN 'empty' WHEN NOT wanted THEN 'skipped' WHEN doubt THEN 'fallback' ELSE 'restored' END AS structure_status,
 CASE WHEN wanted AND NOT doubt THEN 'structure_restore_generated' ELSE 'repaired_passthrough' END AS final_text_source FROM d""")
def restored_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a model's restored structure makes of pages that need it."""
    s = _reviewable(spark, sf_dir)
    s = s.withColumn("issue_tags", review.issue_tags(F.col("raw_text"), F.col("cleaned_text"), review.rule_ids(F.col("flags")))).withColumn("repair_status", F.lit("structured"))
    s = s.withColumn("repaired_text", F.when(F.col("doc_id") % 13 == 0, "").otherwise(F.col("cleaned_text"))).withColumn("allow_empty_output", F.col("doc_id") % 26 == 0)
    r = model_stages.structure_restored(s, Restorer)
    return r.select("doc_id", "part", F.md5("final_text").alias("final_text"), "structure_status", "final_text_source")


class Cutter:
    """Deletes the first line of a page, drops pages with a colon in it, and has no answer on pages of a garden."""

    def complete(self, prompts: list[str]) -> list[str | None]:
        def one(p: str) -> str | None:
            first = p[p.index("Page to edit:\n") + 14 :].split("\n")[0]
            return None if "город" in p else '{"drop_page": true}' if ":" in first else '{"operations": [{"op": "delete_line_range", "start_line": 1}]}'

        return [one(p) for p in prompts]


_PLANNED = "doc_id % 2 = 0"


@query(f"""{S}, n AS (SELECT *, {_note_page('text')} AS note, CASE WHEN doc_id % 7 = 0 THEN ['glossary_page'] ELSE ['number_and_date_formatting'] END AS ids, ({sql.lines()})[1] AS first FROM sheets),
 q AS (SELECT *, {_PLANNED} AND {sql.strip('text')} <> '' AS wanted, contains(text, 'город') AS silent, contains(first, ':') AS drops, note OR list_contains(ids, 'glossary_page') AS may_drop FROM n),
 a AS (SELECT *, wanted AND NOT silent AS answered, CASE WHEN drops THEN CASE WHEN may_drop THEN '' ELSE {_normal('text')} END ELSE {_normal(sql.joined('(string_split(text, chr(10)))[2:]'))} END AS edited, drops AND may_drop AS dropped FROM q),
 g AS (SELECT *, dropped OR note AS free FROM a), d AS (SELECT *, (NOT free AND edited = '') OR (NOT free AND {sql.n_compact('text')} >= 200 AND {sql.n_compact('edited')} < floor({sql.n_compact('text')} * 0.72)) OR (NOT free AND {_markers('text', 'edited')}) AS bad FROM g)
 SELECT doc_id, part, md5(CASE WHEN answered AND NOT bad THEN edited ELSE text END) AS primary_clean_text, CASE WHEN NOT wanted THEN 'skipped' WHEN NOT answered OR bad THEN 'fallback' ELSE 'structured' END AS primary_status FROM d""")
def model_cleanings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a model's edit plans make of pages that are to be cleaned."""
    s = noise.sheets(spark, sf_dir).withColumn("raw_text", F.col("text")).withColumn("cleaned_text", F.col("text")).withColumn("issue_tags", F.array(F.lit("x")))
    ids = F.when(F.col("doc_id") % 7 == 0, "glossary_page").otherwise("number_and_date_formatting")
    s = s.withColumn("flags", F.array(page_cleaning.flag("", F.lit("")).withField("rule_id", ids)))
    action = F.when(F.col("doc_id") % 2 == 0, "run_primary_cleaning").otherwise("skip_primary_cleaning")
    s = s.withColumn("primary_cleaning_plan", F.struct(action.alias("action"), F.lit("").alias("reason")))
    r = model_stages.model_cleaned(s, Cutter)
    return r.select("doc_id", "part", F.md5("primary_clean_text").alias("primary_clean_text"), "primary_status")
