"""The rule engine over made pages, and its steps one after the other in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..operators import page_cleaning
from . import noise, sql
from .queries import query
from .rule_queries import _COUNTS, S
from .run_queries import _flat, _line, _lstrip, _marks, _rstrip, _short
from .structure_queries import _goes_on

B = chr(92)
_lines = sql.lines("t")
_edges = f"""{S.replace('WITH pool', 'WITH RECURSIVE pool', 1).replace('sheets AS', 'pages AS', 1)}, e0 AS (SELECT doc_id, part, book, text AS raw, list_transform({sql.lines('text')}, lambda y: {_rstrip('y')}) AS x FROM pages),
 e1 AS (SELECT *, list_filter(range(len(x)), lambda i: {sql.strip('x[i + 1]')} <> '') AS solid FROM e0), keys AS (SELECT book, 'h' AS edge, {sql.compact('x[solid[1] + 1]')} AS key FROM e1 WHERE len(solid) > 0 UNION ALL SELECT book, 'f', {sql.compact('x[solid[-1] + 1]')} FROM e1 WHERE len(solid) > 0),
 sizes AS (SELECT book, count(*) AS n FROM e1 GROUP BY book), often AS (SELECT k.book, edge, key FROM keys k JOIN sizes s ON k.book = s.book WHERE length(key) BETWEEN 1 AND 120 GROUP BY k.book, edge, key, n HAVING count(*) >= greatest(2, n // 2)),
 known AS (SELECT book, list(key) FILTER (edge = 'h') AS hs, list(key) FILTER (edge = 'f') AS fs FROM often GROUP BY book),
 e2 AS (SELECT e1.*, len(solid) > 0 AND coalesce(list_contains(hs, {sql.compact('x[solid[1] + 1]')}), false) AS head, fs FROM e1 LEFT JOIN known ON e1.book = known.book),
 e3 AS (SELECT *, len(solid) > head::INT AND coalesce(list_contains(fs, {sql.compact('x[solid[-1] + 1]')}), false) AS foot FROM e2),
 t0 AS (SELECT doc_id, part, book, raw, CASE WHEN head OR foot THEN {sql.joined('list_transform(list_filter(range(len(x)), lambda i: NOT ((head AND i = solid[1]) OR (foot AND i = solid[-1]))), lambda i: x[i + 1])')} ELSE raw END AS t FROM e3)"""
_bullets = sql.joined(f"list_transform({_lines}, lambda y: {sql.sub(_rstrip('y'), f'^{B}s*[xхXХ]{B}s+({sql.LETTER})', f'- {B}1')})")
_hyphens = sql.sub("t", r"([А-Яа-яЁё]{3,})[-‐‑]\s*\n\s*([А-Яа-яЁё]{4,})", f"{B}1{B}2")
_spacing = _marks(sql.sub("replace(t, chr(160), ' ')", "[ " + B + "t]{2,}", " "))
_quiet = sql.joined(f"list_filter(list_transform({_lines}, lambda y: {_rstrip('y')}), lambda y: NOT {sql.noise(sql.strip('y'))})")
_notes = sql.sub(sql.sub(sql.sub("t", rf"({sql.LETTER})\[\d{{1,3}}\]", B + "1"), rf"({sql.LETTER})[¹²³⁴⁵⁶⁷⁸⁹]", B + "1"), rf"({sql.LETTER})\d{{1,3}}(\s|[.,;:!?…]|$)", f"{B}1{B}2")
_tail = f"list_filter(range(greatest(0, len(x) - 20), len(x) - 1), lambda i: {sql.reference(sql.strip('x[i + 1]'))} AND {sql.tally(f'list_filter(list_transform(x[i + 1:], lambda z: {sql.strip("z")}), lambda z: z <> {chr(39) * 2})', sql.reference, 'v')} >= greatest(2, floor(len(list_filter(x[i + 1:], lambda z: {sql.strip('z')} <> '')) * 0.6)))[1]"
_start = f"list_filter(range(len(x)), lambda i: {sql.has(sql.strip('x[i + 1]'), P.BODY_HEADING, 'i')})[1]"
_inline = rf"(?:предисловие|введение|глава\s+\d+|chapter\s+\d+|часть\s+\d+|part\s+\d+)(?:$|{sql.EDGE})"
_step = lambda name, before, made: f", {name} AS (SELECT doc_id, part, book, raw, {made} AS t FROM {before})"
_STEPS = (
    _edges + _step("t1", "t0", sql.sub("replace(t, chr(173), '')", "[" + B + "x{200B}-" + B + "x{200D}" + B + "x{2060}" + B + "x{FEFF}]")) + _step("t2", "t1", _bullets) + _step("t3", "t2", _hyphens)
    + f""", l4 AS (SELECT doc_id, part, t, list_transform({_lines}, lambda y: CASE WHEN {sql.strip('y')} = '' THEN '' ELSE {_rstrip('y')} END) AS x FROM t3),
 f4 AS (SELECT doc_id, part, 1::BIGINT AS k, x[1] AS held, []::VARCHAR[] AS out FROM l4 WHERE len(x) > 0 UNION ALL
  SELECT doc_id, part, k + 1, CASE WHEN ok THEN {_rstrip('held')} || ' ' || {_lstrip('y')} ELSE y END, CASE WHEN ok THEN out ELSE list_append(out, held) END
  FROM (SELECT *, {_goes_on} AS ok FROM (SELECT f4.*, l4.x[f4.k + 1] AS y, {sql.strip('f4.held')} AS a, {sql.strip('l4.x[f4.k + 1]')} AS b FROM f4 JOIN l4 ON f4.doc_id = l4.doc_id AND f4.part = l4.part WHERE f4.k < len(l4.x)))),
 d4 AS (SELECT doc_id, part, list_aggregate(list_append(out, held), 'string_agg', chr(10)) AS t FROM f4 QUALIFY k = max(k) OVER (PARTITION BY doc_id, part)),
 t4 AS (SELECT t3.doc_id, t3.part, book, raw, coalesce(d4.t, '') AS t FROM t3 LEFT JOIN d4 ON t3.doc_id = d4.doc_id AND t3.part = d4.part)"""
    + _step("t5", "t4", _spacing) + _step("t6", "t5", _quiet)
    + f""", k7 AS (SELECT doc_id, part, unnest(x) AS block, unnest(range(len(x))) AS bi FROM (SELECT doc_id, part, string_split_regex(t, '\n{B}s*\n') AS x FROM t6)), m7 AS (SELECT *, {_flat} AS flat FROM (SELECT doc_id, part, bi, {sql.solid('block')} AS x FROM k7) WHERE len(x) > 0),
 f7 AS (SELECT doc_id, part, bi, 1::BIGINT AS k, x[1] AS held, []::VARCHAR[] AS out FROM m7 WHERE NOT flat UNION ALL SELECT doc_id, part, bi, k + 1, CASE WHEN ok THEN {sql.strip(_marks("held || ' ' || y"))} ELSE y END, CASE WHEN ok THEN out ELSE list_append(out, held) END
  FROM (SELECT *, {_short} AS ok FROM (SELECT f7.*, m7.x[f7.k + 1] AS y, {sql.strip('f7.held')} AS a, m7.x[f7.k + 1] AS b FROM f7 JOIN m7 USING (doc_id, part, bi) WHERE f7.k < len(m7.x)))),
 e7 AS (SELECT doc_id, part, bi, list_aggregate(list_append(out, held), 'string_agg', chr(10)) AS t FROM f7 QUALIFY k = max(k) OVER (PARTITION BY doc_id, part, bi)
  UNION ALL SELECT doc_id, part, bi, CASE WHEN {sql.heading('x[1]')} THEN x[1] || CASE WHEN {_line('x[2:]')} <> '' THEN chr(10) || {_line('x[2:]')} ELSE '' END ELSE {_line('x')} END FROM m7 WHERE flat),
 d7 AS (SELECT doc_id, part, string_agg(t, chr(10) || chr(10) ORDER BY bi) AS t FROM e7 GROUP BY doc_id, part), t7 AS (SELECT t6.doc_id, t6.part, book, raw, coalesce(d7.t, '') AS t FROM t6 LEFT JOIN d7 ON t6.doc_id = d7.doc_id AND t6.part = d7.part)"""
    + _step("t8", "t7", _notes)
    + f""", c9 AS (SELECT *, {_lines} AS x FROM t8), g9 AS (SELECT *, CASE WHEN len(x) >= 4 THEN {_tail} END AS cut FROM c9), t9 AS (SELECT doc_id, part, book, raw, CASE WHEN cut IS NULL THEN t ELSE {sql.sub(sql.joined('x[1:cut]'), '(' + chr(10) + B + 's*)+$')} END AS t FROM g9),
 c10 AS (SELECT *, {_lines} AS x FROM t9), g10 AS (SELECT *, {_start} AS start, length(regexp_extract(t, '(?is)^(.*?(?:^|{sql.EDGE})){_inline}', 1)) + 1 AS place, {sql.has('t', f'(?:^|{sql.EDGE}){_inline}', 'i')} AS body FROM c10),
 h10 AS (SELECT *, CASE WHEN doc_id % 12 <= 8 AND {sql.has('t', sql.words(P.FRONT_MATTER), 'i')} THEN CASE WHEN start IS NULL THEN CASE WHEN body AND place > 80 THEN {sql.strip('substr(t, place)')} END WHEN start > 0 THEN {sql.strip(sql.joined('x[start + 1:]'))} END END AS cut FROM g10),
 t10 AS (SELECT doc_id, part, book, raw, CASE WHEN coalesce(cut, '') = '' THEN t ELSE cut END AS t FROM h10)"""
)
_SHEETS = f"{_STEPS}, sheets AS (SELECT doc_id, part, book, raw, t AS made, CASE WHEN t = '' THEN raw ELSE t END AS text, {sql.solid('raw')} AS rx FROM t10)"
_toc = f"len(rx) >= 4 AND {sql.strip('text')} <> '' AND ({sql.has('raw', P.TOC_HEADING, 'im')} OR {sql.has('text', P.TOC_HEADING, 'im')}) AND ({sql.n('raw', P.DOT_LEADER)} + leaders >= 2 OR {sql.n('raw', P.TOC_ENTRY, 'm')} + entries >= 4 OR {sql.tally('rx', lambda y: sql.has(y, P.PAGE_NUMBER_END))} >= 4 OR ({sql.tally('rx[1:40]', lambda y: f'length({y}) BETWEEN 8 AND 140')} >= 8 AND {sql.tally('rx', lambda y: sql.has(y, P.PAGE_NUMBER_END))} >= 3))"
_garbled = f"length(t) >= 40 AND (({sql.has('t', sql.words(P.ARCHIVE), 'i')} AND bad >= 2) OR (odd >= 4 AND cyr <= 20 AND lat >= 20 AND bad >= 4))"
_references = f"{sql.has('text', P.ABBREVIATIONS_HEADING, 'im')} OR (n >= 4 AND (refs >= greatest(4, floor(n * 0.6)) OR (refs >= 3 AND urls >= 2) OR (numbered >= 6 AND back >= 4 AND longs <= 2) OR (numbered >= 10 AND longs <= 1)))"
_glossary = f"t <> '' AND ({sql.has('text', P.GLOSSARY_HEADING, 'im')} OR (terms >= 6 AND n <= 40))"
_REASON = sql.case([(_toc, "'toc_index_page'"), (_garbled, "'garbled_page'"), (_references, "'reference_only_page'"), (_glossary, "'glossary_page'")])


@query(f"{_COUNTS.replace(S, _SHEETS, 1)}, r AS (SELECT *, {_REASON} AS drop_reason FROM c) SELECT doc_id, part, drop_reason, md5(CASE WHEN drop_reason IS NULL THEN {sql.strip('made')} ELSE '' END) AS cleaned_text FROM r")
def engine_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made pages after the whole rule engine, and why pages were dropped."""
    s = noise.sheets(spark, sf_dir).withColumn("page_number", (F.col("doc_id") % 12).cast("int")).withColumnRenamed("text", "selected_text").withColumn("source", F.lit("extract")).withColumn("page_type", F.lit("body_only"))
    for c in ("body_text", "notes_text", "reference_text"):
        s = s.withColumn(c, F.lit(""))
    return page_cleaning.cleaned(s).select("doc_id", "part", "drop_reason", F.md5("cleaned_text").alias("cleaned_text"))
