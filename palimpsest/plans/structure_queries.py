"""Queries over segments, rectangles, projections of states, exports, paragraphs and edit plans, and SQL that states them."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import line_rules as L
from ..functions import patterns as P
from ..functions.rx import solid_lines
from ..operators import edit_plans, geometry, page_cleaning, post_clean, projections, segments, splits
from ..sources.tables import table
from . import noise, sql
from .decision_queries import _ORDER, _SKIP
from .queries import query
from .rule_queries import _COUNTS, SOLID, S, _doc_heading, _shout

B = chr(92)

# segments: lines are blocks, and what they are tells their roles

_role = lambda y: f"CASE WHEN {sql.reference(y)} THEN 'reference_block' WHEN {sql.noise(y)} THEN 'page_number' WHEN {sql.has(y, B + '[[0-9]{1,3}' + B + ']')} THEN 'footnote_body' WHEN {sql.heading(y)} THEN 'heading' ELSE 'body' END"
_normal = lambda c: sql.strip(sql.sub(sql.sub(c, "[ " + B + "t]+\n", "\n"), "\n{3,}", "\n\n"))
_part = lambda roles: _normal(f"coalesce(string_agg(y, chr(10) || chr(10) ORDER BY i) FILTER (role IN ({', '.join(repr(r) for r in roles)})), '')")
_TYPE = "CASE skip WHEN 'toc_index_page' THEN 'toc_or_index' WHEN 'reference_only_page' THEN 'reference_only' WHEN 'glossary_page' THEN 'glossary_page' WHEN 'publisher_meta_page' THEN 'publisher_meta' END"


@query(f"""{_COUNTS}, k AS (SELECT doc_id, text, x, {_SKIP} AS skip FROM c WHERE part = 0), l AS (SELECT doc_id, i, y, {_role('y')} AS role FROM (SELECT doc_id, unnest(x) AS y, unnest(range(len(x))) AS i FROM k WHERE doc_id % 4 <> 0)),
 a AS (SELECT doc_id, {_part(('body', 'heading'))} AS body, {_part(('footnote_body',))} AS notes, {_part(('reference_block',))} AS refs FROM l GROUP BY doc_id),
 j AS (SELECT k.*, body, coalesce(notes, '') AS notes, coalesce(refs, '') AS refs, a.doc_id IS NOT NULL AS have FROM k LEFT JOIN a ON k.doc_id = a.doc_id)
 SELECT doc_id, md5(CASE WHEN skip IS NOT NULL THEN '' WHEN have AND body <> '' THEN body ELSE text END) AS body_text, md5(CASE WHEN skip IS NOT NULL OR NOT have THEN '' ELSE notes END) AS notes_text,
 md5(CASE WHEN skip IN ('reference_only_page', 'glossary_page') THEN text WHEN skip IS NOT NULL OR NOT have THEN '' ELSE refs END) AS reference_text,
 CASE WHEN skip IS NOT NULL THEN {_TYPE} WHEN NOT have THEN 'body_only' WHEN body = '' AND notes || refs <> '' THEN 'notes_only' WHEN body <> '' AND notes || refs <> '' THEN 'body_with_notes' WHEN body <> '' THEN 'body_only' ELSE 'empty' END AS page_type,
 CASE WHEN skip IS NOT NULL THEN 'page_classifier' WHEN have THEN 'pdf_blocks' ELSE 'text_fallback' END AS layout_status FROM j""")
def page_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Body, notes and references of made pages; every fourth has no blocks."""
    p = noise.sheets(spark, sf_dir).where("part = 0").select("doc_id", F.col("text").alias("selected_text"))
    b = p.where("doc_id % 4 <> 0").select("doc_id", F.posexplode(solid_lines(F.col("selected_text"))).alias("place", "text"))
    t = F.col("text")
    role = F.when(L.is_reference(t), "reference_block").when(L.is_noise(t), "page_number").when(t.rlike(r"\[\d{1,3}\]"), "footnote_body").when(L.is_heading(t), "heading").otherwise("body")
    s = segments.segmented(p, b.withColumn("role", role), ["doc_id"])
    return s.select("doc_id", *[F.md5(c).alias(c) for c in ("body_text", "notes_text", "reference_text")], "page_type", "layout_status")


@query(f"""{_COUNTS}, k AS (SELECT *, {_SKIP} AS skip FROM c)
 SELECT doc_id, part, CASE WHEN skip IS NULL THEN 'body_only' ELSE {_TYPE} END AS page_type, md5(CASE WHEN skip IS NULL THEN text ELSE '' END) AS body_text, md5(CASE WHEN skip IN ('reference_only_page', 'glossary_page') THEN text ELSE '' END) AS reference_text,
 CASE WHEN skip IS NULL THEN 'text_fallback' ELSE 'text_classifier' END AS layout_status, (['pdf', 'epub', 'txt', 'unknown'])[doc_id % 4 + 1] AS source_type, CASE WHEN doc_id % 3 = 0 THEN 'OCR_DONE' ELSE 'EXTRACTED' END AS read_state FROM k""")
def text_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of pages of which only the text is known, and what their files and sources stand for."""
    s = segments.segmented(noise.sheets(spark, sf_dir).withColumnRenamed("text", "selected_text"), None, ["doc_id", "part"])
    name = F.get(F.array(*[F.lit(x) for x in ("a.b/Book.PDF", "x/y.z.epub", "c.txt", "d.e/f")]), (F.col("doc_id") % 4).cast("int"))
    source = F.get(F.array(*[F.lit(x) for x in ("ocr", "extract", "epub_extract")]), (F.col("doc_id") % 3).cast("int"))
    return s.select("doc_id", "part", "page_type", F.md5("body_text").alias("body_text"), F.md5("reference_text").alias("reference_text"), "layout_status", segments.source_type(name).alias("source_type"), segments.state_of_source(source).alias("read_state"))


# rectangles on a grid of ten pixels: what is painted is counted cell by cell

_REGIONS = 6
_side = lambda k, m, r: f"10 * ((doc_id * {k} + r * {m}) % {r})"


@query(f"""WITH r AS (SELECT doc_id, r, {_side(7, 13, 17)} AS x, {_side(11, 5, 9)} AS y, {_side(3, 19, 8)} + 20 AS w, {_side(5, 7, 4)} + 10 AS h, (doc_id + r) % 3 = 0 AS keep FROM documents, range({_REGIONS}) AS t(r)),
 b AS (SELECT doc_id, keep, r, least(x, 199) AS x1, least(y, 99) AS y1, least(x + w, 200) AS x2, least(y + h, 100) AS y2 FROM r),
 c AS (SELECT b.doc_id, b.r, i, j FROM b, range(20) AS u(i), range(10) AS v(j) WHERE NOT keep AND i * 10 >= x1 AND i * 10 < x2 AND j * 10 >= y1 AND j * 10 < y2),
 k AS (SELECT c.* FROM c WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.doc_id = c.doc_id AND b.keep AND i * 10 >= x1 AND i * 10 < x2 AND j * 10 >= y1 AND j * 10 < y2))
 SELECT d.doc_id, coalesce(count(k.r) * 100, 0)::DOUBLE AS painted FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id GROUP BY d.doc_id""")
def painted_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of a page of 200 by 100 pixels is painted over, region by region, less what kept regions hold."""
    d, side = F.col("doc_id"), lambda r, k, m, n: (10 * ((F.col("doc_id") * k + r * m) % n)).cast("double")

    def region(r: Column) -> Column:
        x, y = side(r, 7, 13, 17), side(r, 11, 5, 9)
        box = F.array(x, y, x + side(r, 3, 19, 8) + 20, y + side(r, 5, 7, 4) + 10)
        return F.struct(box.alias("bbox"), F.when((d + r) % 3 == 0, "keep").otherwise("mask").alias("action"))

    docs = table(spark, sf_dir, "documents").select("doc_id")
    rest = geometry.painted(F.transform(F.sequence(F.lit(0), F.lit(_REGIONS - 1)), region), F.lit(200.0), F.lit(100.0))
    return docs.select("doc_id", F.aggregate(F.transform(rest, lambda b: (b[2] - b[0]) * (b[3] - b[1])), F.lit(0.0), lambda s, a: s + a).alias("painted"))


@query("""WITH p AS (SELECT source AS book, doc_id % 7 * 100.0 + 300 AS w, doc_id % 5 * 100.0 + 200 AS h FROM documents), s AS (SELECT book, w / h >= 1.35 AS wide FROM p)
 SELECT book, count(*)::BIGINT AS input_pages, (count(*) + count(*) FILTER (wide))::BIGINT AS output_pages, count(*) FILTER (wide)::BIGINT AS split_pages, count(*) FILTER (NOT wide)::BIGINT AS copied_pages FROM s GROUP BY book""")
def split_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of each book before and after wide ones are split."""
    return geometry.split_summary(_sized(spark, sf_dir), ["book"])


def _sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.col("source").alias("book"), (F.col("doc_id") % 7 * 100.0 + 300).alias("width"), (F.col("doc_id") % 5 * 100.0 + 200).alias("height"))


@query("""WITH p AS (SELECT doc_id, doc_id % 7 * 100.0 + 300 AS w, doc_id % 5 * 100.0 + 200 AS h FROM documents), s AS (SELECT *, w / h >= 1.35 AS wide FROM p)
 SELECT doc_id, 0 AS part, (CASE WHEN wide THEN w / 2 ELSE 0 END)::DOUBLE AS x1, w::DOUBLE AS x2, h::DOUBLE AS y2, (CASE WHEN wide THEN w / 2 ELSE 0 END + 10)::DOUBLE AS on_page FROM s UNION ALL SELECT doc_id, 1, 0.0, (w / 2)::DOUBLE, h::DOUBLE, 10.0 FROM s WHERE wide""")
def page_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of pages that are read from the right, and where a box of a part lies on the whole page."""
    parts = geometry.split_pages(_sized(spark, sf_dir), order=geometry.RIGHT_LEFT)
    inner = geometry.around(F.array(F.array(F.lit(30.0), F.lit(5.0)), F.array(F.lit(10.0), F.lit(25.0)), F.array(F.lit(20.0), F.lit(15.0))))
    return parts.select("doc_id", "part", F.col("clip")[0].alias("x1"), F.col("clip")[2].alias("x2"), F.col("clip")[3].alias("y2"), geometry.moved(inner, F.col("clip")[0], F.col("clip")[1])[0].alias("on_page"))


# states by stage

_STATE_OF = f"({_ORDER} || ['FAILED'])[(doc_id + part) % {len(P.STATES) + 1} + 1]"
_PAGES = f"{S}, p AS (SELECT doc_id, part, book, text, {_STATE_OF} AS state, ({_ORDER})[doc_id % {len(P.STATES)} + 1] AS last, CASE WHEN doc_id % 2 = 0 THEN 'primary ' || doc_id ELSE '' END AS primary_clean_text, CASE WHEN doc_id % 3 = 0 THEN 'repaired ' || doc_id END AS repaired_text, CASE doc_id % 5 WHEN 0 THEN 'high' WHEN 1 THEN 'low' END AS risk, doc_id % 4 = 0 AS tagged FROM sheets)"
_rank = lambda c: f"(coalesce(list_position({_ORDER}, {c}), 0) - 1)"
_eff = "CASE WHEN state = 'FAILED' THEN last ELSE state END"


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda values, n: F.get(F.array(*[F.lit(v) for v in values]), n.cast("int"))
    d, s = F.col("doc_id"), noise.sheets(spark, sf_dir)
    s = s.withColumn("current_state", at((*P.STATES, P.FAILED), (d + F.col("part")) % (len(P.STATES) + 1))).withColumn("last_success_state", at(P.STATES, d % len(P.STATES)))
    s = s.withColumn("primary_clean_text", F.when(d % 2 == 0, F.concat(F.lit("primary "), d)).otherwise("")).withColumn("repaired_text", F.when(d % 3 == 0, F.concat(F.lit("repaired "), d)))
    s = s.withColumn("risk_level", F.when(d % 5 == 0, "high").when(d % 5 == 1, "low")).withColumn("review_tags", F.when(d % 4 == 0, F.array(F.lit("glossary_left"))).otherwise(F.array().cast("array<string>")))
    s = s.withColumn("structure_plan", F.when(d % 6 == 0, F.struct(F.lit("structured").alias("status"), F.lit("structure_restore_generated").alias("final_text_source"))))
    return s.withColumn("rule_cleaned_text", F.col("text")).withColumn("raw_text", F.col("text")).withColumn("final_text", F.lit(None).cast("string")).drop("text")


@query(f"""{_PAGES} SELECT doc_id, part, md5(CASE WHEN primary_clean_text <> '' THEN primary_clean_text ELSE text END) AS primary_text, md5(CASE WHEN coalesce(repaired_text, '') <> '' THEN repaired_text WHEN primary_clean_text <> '' THEN primary_clean_text ELSE text END) AS repaired,
 CASE WHEN risk = 'high' THEN 'reject' WHEN tagged THEN 'escalate' ELSE 'approve' END AS verdict, CASE WHEN doc_id % 6 = 0 THEN 'structured' ELSE 'state_fallback' END AS structure, CASE WHEN doc_id % 6 = 0 THEN 'structure_restore_generated' ELSE 'repaired_passthrough' END AS final_source,
 md5(CASE WHEN doc_id % 7 = 0 THEN 'own' ELSE text END) AS rule_text, (doc_id % 7 = 0 OR (doc_id % 7 = 1 AND {sql.strip('text')} = ''))::BOOLEAN AS dropped FROM p""")
def stage_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each stage gets of pages whose own stage document is there or missing."""
    s = _states(spark, sf_dir)
    own = F.when(F.col("doc_id") % 7 == 0, F.struct(F.col("raw_text"), F.lit("own").alias("cleaned_text"), F.lit(True).alias("drop_page"), F.lit(True).alias("allow_empty_output"), F.lit("why").alias("drop_reason")))
    s = s.withColumn("rule", projections.rule_page(own, s)).withColumn("plan", projections.structure_status(s))
    dropped = projections.is_empty_or_dropped(F.col("rule.drop_page"), F.col("doc_id") % 7 == 1, F.col("rule.cleaned_text"))
    return s.select(
        "doc_id", "part", F.md5(projections.primary_text(s)).alias("primary_text"), F.md5(projections.repaired_text(s)).alias("repaired"), projections.review_verdict(s).alias("verdict"), F.col("plan.status").alias("structure"),
        F.col("plan.final_text_source").alias("final_source"), F.md5("rule.cleaned_text").alias("rule_text"), dropped.alias("dropped"),
    )


@query(f"{_PAGES} SELECT book, count(*)::BIGINT AS n, count(*) FILTER ({_rank(_eff)} >= {P.STATES.index('REVIEWED')})::BIGINT AS reached FROM p GROUP BY book")
def reached_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many pages of each book were reviewed."""
    return projections.reached(_states(spark, sf_dir), ["book"], "REVIEWED")


_higher = "CASE WHEN coalesce(list_position(['low', 'medium', 'high'], risk), 0) >= coalesce(list_position(['low', 'medium', 'high'], new_risk), 0) THEN risk ELSE new_risk END"


@query(f"""{_PAGES}, q AS (SELECT *, {_rank(_eff)} AS reach, doc_id % 2 = 0 AS reviewed, doc_id % 5 = 1 AS repaired, doc_id % 7 = 2 AS restored, CASE WHEN doc_id % 4 = 0 THEN 'reject' ELSE 'approve' END AS v FROM p), z AS (SELECT *, CASE v WHEN 'reject' THEN 'high' ELSE 'low' END AS new_risk FROM q)
 SELECT doc_id, part, {sql.case([('restored AND reach < 7', "'STRUCTURE_RESTORED'"), ('repaired AND reach < 6', "'REPAIRED'"), ('reviewed AND reach < 5', "'REVIEWED'")], 'state')} AS current_state, CASE WHEN reviewed THEN {_higher} ELSE risk END AS risk_level,
 CASE WHEN repaired AND doc_id % 3 = 0 THEN 'new' WHEN repaired THEN 'new' ELSE repaired_text END AS repaired_text, CASE WHEN restored AND reach < 7 THEN 'restored ' || doc_id END AS final_text,
 CASE WHEN restored AND reach < 7 THEN CASE WHEN doc_id % 3 = 0 THEN 'structure_restore_generated' ELSE 'repaired_passthrough' END WHEN doc_id % 6 = 0 THEN 'structure_restore_generated' END AS final_source FROM z""")
def backfilled_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States lifted by older stage documents."""
    s, key = _states(spark, sf_dir), ["doc_id", "part"]
    ids = s.select(*key)
    reviews = ids.where("doc_id % 2 = 0").withColumn("issue_tags", F.array(F.lit("glossary_left"))).withColumn("page_verdict", F.when(F.col("doc_id") % 4 == 0, "reject").otherwise("approve"))
    repairs = ids.where("doc_id % 5 = 1").withColumn("repaired_text", F.lit("new"))
    structures = ids.where("doc_id % 7 = 2").withColumn("restored_text", F.concat(F.lit("restored "), F.col("doc_id"))).withColumn("status", F.when(F.col("doc_id") % 3 == 0, "deepseek")).withColumn("final_text_source", F.lit(None).cast("string"))
    b = projections.backfilled(s, reviews, repairs, structures, key)
    return b.select(*key, "current_state", "risk_level", "repaired_text", "final_text", F.col("structure_plan.final_text_source").alias("final_source"))


@query(f"""{SOLID}, p AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY doc_id, part) AS page, count(*) OVER (PARTITION BY book) AS total, {sql.strip('text')} AS t,
  ({sql.tally(sql.word_list('text'), lambda w: sql.full(w, sql.CYRILLIC + '{4,}'), 'w')} >= 25 OR {sql.n('text', '[.!?…]')} >= 3) AS body FROM s),
 r AS (SELECT *, doc_id % 17 <> 0 AND t <> '' AND NOT (total >= 20 AND page <= 4 AND ({sql.has('t', sql.words(P.EXPORT_FRONT), 'i')} OR NOT body)) AND NOT (total >= 20 AND page >= total - 3 AND {sql.has('t', sql.words(P.EXPORT_BACK), 'i')}) AS kept FROM p)
 SELECT book, count(*)::BIGINT AS n_pages, count(*) FILTER (kept)::BIGINT AS n_exported, md5(coalesce(string_agg(text, chr(10) || chr(10) ORDER BY page) FILTER (kept), '')) AS text FROM r GROUP BY book""")
def export_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exported text of each book."""
    from pyspark.sql import Window as W

    s = noise.sheets(spark, sf_dir).withColumn("page_number", F.row_number().over(W.partitionBy("book").orderBy("doc_id", "part"))).withColumnRenamed("text", "raw_text")
    none = F.lit(None).cast("string")
    s = s.withColumn("current_state", F.lit("NEW")).withColumn("last_success_state", F.lit("NEW")).withColumn("page_type", F.lit("body_only")).withColumn("review_tags", F.array().cast("array<string>"))
    for c in ("final_text", "repaired_text", "legacy_restored", "legacy_repaired", "legacy_cleaned", "primary_clean_text", "rule_cleaned_text"):
        s = s.withColumn(c, none)
    s = s.withColumn("has_structure_plan", F.lit(False)).withColumn("has_repair_plan", F.lit(False)).withColumn("route_decision", F.when(F.col("doc_id") % 17 == 0, "skip_nonbody_page"))
    return projections.export_documents(s, "book").withColumn("text", F.md5("text"))


# words, paragraphs, headings

_BROKEN = " Британск ого слова; оказал ся там; историческ ими следами и деревянн был дом; ис следовательница; дере вянный"
_LEXICON = (("исследовательница", 0.9), ("деревянный", 0.8), ("дере", 0.1), ("вянный", 0.1), ("оказался", 0.9))
_ends = "|".join(sorted(splits.ENDINGS, key=lambda e: (-len(e), e)))
_joined = sql.sub(sql.sub(sql.sub(f"text || '{_BROKEN}'", f"(^|{sql.EDGE})({sql.CYRILLIC}{{6,}}){B}s+({_ends})($|{sql.EDGE})", f"{B}1{B}2{B}3{B}4"), f"(^|{sql.EDGE})(ис){B}s+(следовательница)($|{sql.EDGE})", f"{B}1{B}2{B}3{B}4"), f"(^|{sql.EDGE})(дере){B}s+(вянный)($|{sql.EDGE})", f"{B}1{B}2{B}3{B}4")


@query(f"{S} SELECT doc_id, part, md5({_joined}) AS joined FROM sheets")
def split_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken words put together by endings and a small lexicon."""
    lexicon = spark.createDataFrame(list(_LEXICON), "word string, score double")
    s = noise.sheets(spark, sf_dir).select("doc_id", "part", F.concat("text", F.lit(_BROKEN)).alias("text"))
    return splits.without_splits(s, lexicon).select("doc_id", "part", F.md5("text").alias("joined"))


_goes_on = (
    f"(a <> '' AND b <> '' AND NOT ({sql.has('b', P.BULLET_START)} OR {sql.has('b', P.FIGURE, 'i')} OR {sql.has('a', '[.!?:;]$')} OR length(a) <= 2 OR length(b) <= 2 OR {sql.heading('a')} OR {sql.has('b', '^[0-9]')} OR {sql.full('a', '[A-ZА-ЯЁ]{4,}')} OR {sql.has('b', '^[A-ZА-ЯЁ]{3,}')}))"
)


@query(f"""{S.replace('WITH pool', 'WITH RECURSIVE pool', 1)}, l AS (SELECT doc_id, part, list_transform({sql.lines()}, lambda y: CASE WHEN {sql.strip('y')} = '' THEN '' ELSE {sql.sub('y', B + 's+$')} END) AS x FROM sheets),
 f AS (SELECT doc_id, part, 1::BIGINT AS k, x[1] AS held, []::VARCHAR[] AS out, 0::BIGINT AS merged FROM l WHERE len(x) > 0 UNION ALL
  SELECT doc_id, part, k + 1, CASE WHEN ok THEN {sql.sub('held', B + 's+$')} || ' ' || {sql.sub('y', '^' + B + 's+')} ELSE y END, CASE WHEN ok THEN out ELSE list_append(out, held) END, merged + ok::INT
  FROM (SELECT *, {_goes_on} AS ok FROM (SELECT f.doc_id, f.part, f.k, f.held, f.out, f.merged, l.x[f.k + 1] AS y, {sql.strip('f.held')} AS a, {sql.strip('l.x[f.k + 1]')} AS b FROM f JOIN l ON f.doc_id = l.doc_id AND f.part = l.part WHERE f.k < len(l.x))))
 SELECT doc_id, part, md5(list_aggregate(list_append(out, held), 'string_agg', chr(10))) AS paragraphs, merged AS n_merged FROM f QUALIFY k = max(k) OVER (PARTITION BY doc_id, part)""")
def merged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of pages merged to paragraphs."""
    s = noise.sheets(spark, sf_dir).withColumn("p", page_cleaning.paragraph_step(F.col("text")))
    return s.select("doc_id", "part", F.md5("p.text").alias("paragraphs"), F.size("p.edits").cast("bigint").alias("n_merged"))


_open = lambda y: f"({y} IS NOT NULL AND {y} <> '' AND NOT ({_doc_heading(y)} OR {sql.has(y, post_clean.BOUNDARY)}) AND NOT {sql.has(y, post_clean.TERMINAL)})"
_starts = lambda p, y: f"({p} IS NULL OR {_doc_heading(p)} OR {sql.has(p, post_clean.BOUNDARY)} OR {_doc_heading(y)} OR {sql.has(y, post_clean.BOUNDARY)} OR (NOT ({sql.has(y, '^' + B + 'p{Ll}')} OR {sql.has(p, '[,;:—(' + B + '-]$')}) AND {sql.has(p, post_clean.TERMINAL)}))"


@query(f"""{SOLID}, l AS (SELECT doc_id, part, unnest(x) AS y, unnest(range(len(x))) AS i FROM s), n AS (SELECT *, lag(y) OVER w AS before, lead(y) OVER w AS after FROM l WINDOW w AS (PARTITION BY doc_id, part ORDER BY i)),
 a AS (SELECT *, before IS NOT NULL AND after IS NOT NULL AND {_doc_heading('y')} AND {_open('before')} AND {sql.has('after', post_clean.CONTINUES)} AS intrudes, {_starts('before', 'y')} AS starts FROM n),
 g AS (SELECT *, sum(starts::INT) OVER (PARTITION BY doc_id, part ORDER BY i) AS p FROM a), o AS (SELECT doc_id, part, p, {sql.strip(sql.sub("string_agg(y, ' ' ORDER BY i)", P.SPACE_RUN, ' '))} AS t FROM g GROUP BY doc_id, part, p),
 t AS (SELECT doc_id, part, md5(string_agg(t, chr(10) ORDER BY p)) AS paragraphs FROM o GROUP BY doc_id, part), h AS (SELECT doc_id, part, count(*) FILTER (intrudes)::BIGINT AS intrusions FROM a GROUP BY doc_id, part)
 SELECT t.doc_id, t.part, paragraphs, intrusions FROM t JOIN h ON t.doc_id = h.doc_id AND t.part = h.part""")
def document_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs of documents, and headings that stand between two halves of a sentence."""
    s = noise.sheets(spark, sf_dir).withColumn("x", solid_lines(F.col("text")))
    inner = F.filter("x", lambda y, i: (i > 0) & (i < F.size("x") - 1) & post_clean.is_heading(y) & post_clean.is_open(F.get("x", i - 1)) & F.get(F.col("x"), i + 1).rlike("(?dU)" + post_clean.CONTINUES))
    return s.select("doc_id", "part", F.md5(F.array_join(post_clean.restored_paragraphs(F.col("x")), "\n")).alias("paragraphs"), F.size(inner).cast("bigint").alias("intrusions"))


_tokens = f"string_split_regex(y, '{B}s+')"
_first = f"coalesce(list_filter(range(len(t)), lambda i: NOT {_shout('trim(t[i + 1], ' + chr(39) + '«»' + chr(34) + chr(39) * 2 + '“”„()[]{}:;,.!?—–-' + chr(39) + ')')})[1], len(t))"


@query(f"""{SOLID}, l AS (SELECT doc_id, part, unnest(x) AS y, unnest(range(len(x))) AS i FROM s), k AS (SELECT *, {_tokens} AS t FROM l), n AS (SELECT *, {_first} AS n FROM k), h AS (SELECT *, coalesce(list_aggregate(t[1:n], 'string_agg', ' '), '') AS head FROM n)
 SELECT doc_id, part, md5(string_agg(CASE WHEN n >= 3 AND n < len(t) AND {sql.has('t[n + 1]', '^[А-ЯЁA-Z][а-яёa-z]')} AND length(head) >= 18 AND NOT {sql.has('y', '^(?:Глава|ГЛАВА|Часть|ЧАСТЬ|Chapter|CHAPTER|Part|PART) ')} THEN head || chr(10) || list_aggregate(t[n + 1:], 'string_agg', ' ') ELSE y END, chr(10) ORDER BY i)) AS lines FROM h GROUP BY doc_id, part""")
def caps_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which a run of capital words at the start is cut off."""
    s = noise.sheets(spark, sf_dir).withColumn("x", solid_lines(F.col("text")))
    return s.select("doc_id", "part", F.md5(F.array_join(post_clean.split_caps_headings(F.col("x")), "\n")).alias("lines"))


# edit plans on made pages, one operation each

_PLANS = (
    {"operations": [{"op": "delete_line_range", "start_line": 2, "end_line": 3, "reason": "notes"}]}, {"operations": [{"op": "merge_with_next", "line": 5}]}, {"operations": [{"op": "remove_inline_pattern", "pattern": "bracket_note_markers"}]},
    {"operations": [{"op": "normalize_spacing"}]}, {"drop_page": True, "operations": []}, {"operations": [{"op": "split_before_text", "line": 1, "text": " "}]}, {"operations": [{"op": "delete_line_range", "start_line": 90}, {"op": "unknown"}]},
)
_tail = lambda c: sql.strip(sql.sub(sql.sub(c, "[ " + B + "t]+\n", "\n"), "\n{3,}", "\n\n"))
_glue = f"CASE WHEN {sql.has('a', sql.LETTER + '-$')} AND {sql.has('b', '^' + sql.LETTER)} THEN left(a, length(a) - 1) || b WHEN a = '' OR b = '' OR {sql.has('a', '[(«“' + chr(34) + ']$')} OR {sql.has('b', '^[,.;:!?)' + B + ']»]')} THEN a || b ELSE a || ' ' || b END"
_spaced = sql.joined(f"list_filter(list_transform(x, lambda y: {sql.strip(sql.sub(sql.sub('y', '[ ' + B + 't' + chr(160) + ']{2,}', ' '), B + 's+([,.;:!?])', B + '1'))}), lambda y: true)")
_EDITED = sql.case([
    ("m = 0", sql.joined("x[:1] || x[4:]")), ("m = 1", sql.joined(f"x[:4] || [{_glue}] || x[7:]")), ("m = 2", sql.sub("text", rf"({sql.LETTER})\[\d{{1,3}}\]", B + "1")), ("m = 3", _spaced), ("m = 4", "text"),
    ("m = 5", f"CASE WHEN contains(x[1], ' ') AND NOT starts_with(x[1], ' ') THEN {sql.sub('split_part(x[1], chr(32), 1)', B + 's+$')} || chr(10) || {sql.sub('substr(x[1], strpos(x[1], chr(32)))', '^' + B + 's+')} || chr(10) || {sql.joined('x[2:]')} ELSE text END"),
], "text")
_NOTES = sql.case([
    ("m = 2", f"CASE WHEN {sql.has('text', sql.LETTER + B + '[[0-9]{1,3}' + B + ']')} THEN '' ELSE 'inline_pattern_noop:bracket_note_markers' END"), ("m = 3", f"CASE WHEN {_spaced} = text THEN 'normalize_spacing_noop' ELSE '' END"), ("m = 4", "'model_drop_page_ignored'"),
    ("m = 5", "CASE WHEN contains(x[1], ' ') AND NOT starts_with(x[1], ' ') THEN '' ELSE 'split_before_text_marker_not_found:1' END"), ("m = 6", "'delete_line_range_missing_target:90-90,unsupported_operation_ignored:unknown'"),
], "''")


@query(f"""{S}, p AS (SELECT doc_id, text, string_split(text, chr(10)) AS x, doc_id % {len(_PLANS)} AS m FROM sheets WHERE part = 0), q AS (SELECT *, {sql.sub('x[5]', B + 's+$')} AS a, {sql.sub('x[6]', '^' + B + 's+')} AS b FROM p)
 SELECT doc_id, md5({_tail(f'({_EDITED})')}) AS text, ({_NOTES}) AS notes FROM q""")
def single_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made pages after an edit plan of one operation, by document."""
    plan = F.get(F.array(*[F.lit(json.dumps(p)) for p in _PLANS]), (F.col("doc_id") % len(_PLANS)).cast("int"))
    p = edit_plans.applied(noise.sheets(spark, sf_dir).where("part = 0").withColumn("plan", plan), "text", "plan")
    return p.select("doc_id", F.md5("edited.text").alias("text"), F.array_join("edited.notes", ",").alias("notes"))

