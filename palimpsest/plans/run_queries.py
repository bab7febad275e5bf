"""Queries over blocks, boundaries, reports, resumed runs and regions of made pages, and SQL that states them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import line_rules as L
from ..functions import normalize as N
from ..functions import patterns as P
from ..functions.rx import let, solid_lines
from ..operators import edit_plans, evaluation, layout, model_edits, model_stages, page_cleaning, post_clean, projections, reports, review, states
from . import noise, sql
from .decision_queries import _GUARDS, _PICKS, _REVIEW, _box, _centred, _FLAGGED, _keep, _mask, _over, _pick, _reviewable, _samples
from .queries import NOISY_SQL, ORACLES, query
from .rule_queries import SOLID, S
from .structure_queries import _glue
from .text_queries import homoglyph_words

B = chr(92)
_marks = lambda c: sql.sub(sql.sub(sql.sub(c, P.BEFORE_MARK, B + "1"), P.AFTER_OPENER, B + "1"), P.BEFORE_CLOSER, B + "1")
_rstrip, _lstrip = lambda c: sql.sub(c, r"\s+$"), lambda c: sql.sub(c, r"^\s+")

# blocks of short lines

_line = lambda x: sql.strip(_marks(sql.joined(f"list_filter(list_transform({x}, lambda y: {sql.strip('y')}), lambda y: y <> '')", "' '")))
_flat = (
    f"(len(x) >= 3 AND ({sql.tally('x', lambda y: f'length({y}) <= 3')} >= 2 OR ({sql.tally('x', lambda y: f'length({y}) <= 24')} >= greatest(3, len(x) - 1) AND {sql.tally('x', sql.ends_sentence)} <= 1)"
    f" OR ({sql.tally('x[2:-2]', lambda y: f'{sql.n_words(y)} = 1')} > 0 AND list_max(list_transform(x, lambda y: length(y))) <= 80)))"
)
_apart = f"({sql.has('b', P.BULLET_START)} OR {sql.has('b', P.FIGURE, 'i')})"
_short = (
    f"(a <> '' AND b <> '' AND NOT {sql.noise('a')} AND NOT {sql.noise('b')} AND NOT ({sql.fragment('a')} AND NOT {sql.fragment('b')}) AND NOT {_apart}"
    f" AND ((a LIKE '%:' AND b LIKE '-%') OR length(a) <= 3 OR length(b) <= 3 OR (length(a) <= 18 AND NOT {sql.ends_sentence('a')}) OR (NOT {sql.ends_sentence('a')} AND {sql.has('b', P.LOWER_START)})))"
)


@query(f"""{S.replace('WITH pool', 'WITH RECURSIVE pool', 1)}, k AS (SELECT doc_id, part, unnest(x) AS block, unnest(range(len(x))) AS bi FROM (SELECT doc_id, part, string_split_regex(replace(text, 'Введение', chr(10) || chr(10) || 'Введение'), '\n{B}s*\n') AS x FROM sheets)),
 o AS (SELECT doc_id, part, bi, {sql.solid('block')} AS x FROM k), m AS (SELECT *, {_flat} AS flat FROM o WHERE len(x) > 0),
 f AS (SELECT doc_id, part, bi, 1::BIGINT AS k, x[1] AS held, []::VARCHAR[] AS out, 0::BIGINT AS merged FROM m WHERE NOT flat UNION ALL
  SELECT doc_id, part, bi, k + 1, CASE WHEN ok THEN {sql.strip(_marks("held || ' ' || y"))} ELSE y END, CASE WHEN ok THEN out ELSE list_append(out, held) END, merged + ok::INT
  FROM (SELECT *, {_short} AS ok FROM (SELECT f.*, m.x[f.k + 1] AS y, {sql.strip('f.held')} AS a, m.x[f.k + 1] AS b FROM f JOIN m USING (doc_id, part, bi) WHERE f.k < len(m.x)))),
 e AS (SELECT doc_id, part, bi, list_aggregate(list_append(out, held), 'string_agg', chr(10)) AS t FROM f QUALIFY k = max(k) OVER (PARTITION BY doc_id, part, bi)
  UNION ALL SELECT doc_id, part, bi, CASE WHEN {sql.heading('x[1]')} THEN x[1] || CASE WHEN {_line('x[2:]')} <> '' THEN chr(10) || {_line('x[2:]')} ELSE '' END ELSE {_line('x')} END FROM m WHERE flat)
 SELECT doc_id, part, md5(string_agg(t, chr(10) || chr(10) ORDER BY bi)) AS blocks FROM e GROUP BY doc_id, part""")
def short_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks between blank lines: wrapped ones on one line, short lines of others merged."""
    s = noise.sheets(spark, sf_dir).withColumn("text", F.replace("text", F.lit("Введение"), F.lit("\n\nВведение")))
    return s.select("doc_id", "part", F.md5(let(F.col("text"), page_cleaning.block_step)["text"]).alias("blocks"))


# boundaries between lines

_tail, _head = f"regexp_extract(a, '({sql.LETTER}+)[-‐‑]$', 1)", f"regexp_extract(b, '^({sql.LETTER}+)', 1)"
_hyphen = f"CASE WHEN {_tail} <> '' AND {_head} <> '' AND {sql.has('b', P.LOWER_START)} THEN left(a, length(a) - 1) || CASE WHEN length({_tail}) >= 3 AND length({_head}) >= 3 THEN '' ELSE '-' END || b END"


@query(f"""{S}, l AS (SELECT doc_id, part, x, unnest(range(1, len(x))) AS i FROM (SELECT doc_id, part, string_split(replace(text, 'дом', 'до-'), chr(10)) AS x FROM sheets WHERE part = 0)), p AS (SELECT doc_id, i, {_rstrip('x[i]')} AS a, {_lstrip('x[i + 1]')} AS b FROM l)
 SELECT doc_id, md5(string_agg(coalesce({_hyphen}, '~'), chr(10) ORDER BY i)) AS words, md5(string_agg({_glue}, chr(10) ORDER BY i)) AS lines FROM p GROUP BY doc_id""")
def glued_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each two neighbouring lines of made pages are together, where a word is broken and as an edit plan merges them."""
    s = noise.sheets(spark, sf_dir).where("part = 0").withColumn("x", F.split(F.replace("text", F.lit("дом"), F.lit("до-")), "\n"))
    plan = F.transform(F.sequence(F.lit(1), F.size("x") - 1), lambda i: F.struct(F.get(F.col("x"), i - 1).alias("a"), F.get(F.col("x"), i).alias("b")))
    p = s.select("doc_id", F.posexplode(plan).alias("i", "p")).select("doc_id", "i", F.coalesce(L.hyphen_glued(F.col("p.a"), F.col("p.b")), F.lit("~")).alias("w"), F.concat_ws("\n", "p.a", "p.b").alias("text"))
    p = edit_plans.applied(p.withColumn("plan", F.lit('Plan: ```json\n{"operations": [{"op": "merge_with_next", "line": 1}]}\n```')), "text", "plan")
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", c))), lambda r: r["c"]), "\n")
    merged = F.get("edited.edits", 0)["after"]
    return p.groupBy("doc_id").agg(F.md5(joined(F.col("w").alias("c"))).alias("words"), F.md5(joined(merged.alias("c"))).alias("lines"))


# markers, headers and numbers in documents

_ADDED = "\nВЕРНУТЬСЯ К ИНДЕКСУ <...> и <слово> —> по- ДОБЫЧА УГЛЯ ложили Список литературы: конец 17 Глава 5. Начало\n 118 ЧАСТЬ II: дальше 7 РОСПУСК"
_HEAD = r"(?:Глава|Часть|ЧАСТЬ)\s+[IVXLCDM0-9]+(?:[.:]\s*|$)|РОСПУСК(?:$|[^\p{L}\p{N}_])|ПРОЛОГ(?:$|[^\p{L}\p{N}_])|ЭПИЛОГ(?:$|[^\p{L}\p{N}_])"
_marker = f"replace({sql.sub(sql.sub(sql.sub('t', post_clean.INDEX_MARKER, '', 'i'), post_clean.PLACEHOLDER), post_clean.ANGLE_TEXT, B + '1')}, '—>', '—')"
_inner = sql.sub("t", r"([А-Яа-яЁё]{2,}-)\s+(?:[A-ZА-ЯЁ]{4,}(?:\s+[A-ZА-ЯЁ]{2,}){0,4})\s+([а-яё]{2,})", f"{B}1 {B}2")
_books = sql.sub("t", rf"(^|{sql.EDGE})Список литературы(?:[:.]\s*|\s+|$)", B + "1", "i")
_numbers = sql.sub(sql.sub("t", rf"^\s*\d{{1,4}}\s+({_HEAD})", B + "1", "m"), rf"(^|[^\n])[ \t]+\d{{1,4}}\s+({_HEAD})", f"{B}1\n{B}2")


@query(f"{S}, a AS (SELECT doc_id, part, text || '{_ADDED}' AS t FROM sheets) SELECT doc_id, part, md5({_marker}) AS markers, md5({_inner}) AS inner_headers, md5({_books}) AS bibliography, md5({_numbers}) AS page_numbers FROM a")
def document_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without markers, running headers inside words, bibliography headings and page numbers before headings."""
    s = noise.sheets(spark, sf_dir).withColumn("t", F.concat("text", F.lit(_ADDED)))
    steps = {"markers": post_clean.without_markers, "inner_headers": post_clean.without_inner_headers, "bibliography": post_clean.without_bibliography_headings, "page_numbers": post_clean.without_page_numbers}
    return s.select("doc_id", "part", *[F.md5(let(F.col("t"), f)).alias(k) for k, f in steps.items()])


_front_cue = sql.has("text", sql.words(P.FRONT_MATTER), "i")
_start = f"list_filter(range(len(x)), lambda i: {sql.has(sql.strip('x[i + 1]'), P.BODY_HEADING, 'i')})[1]"
_cut = f"CASE WHEN start IS NULL THEN CASE WHEN place > 80 THEN {sql.strip('substr(text, place)')} END WHEN start > 0 THEN {sql.strip(sql.joined('x[start + 1:]'))} END"
_where = f"CASE WHEN {sql.has('text', B + 'x{1}')} THEN 0 ELSE length(regexp_extract(text, '(?is)^(.*?(?:^|{sql.EDGE}))(?:предисловие|введение|глава{B}s+{B}d+|chapter{B}s+{B}d+|часть{B}s+{B}d+|part{B}s+{B}d+)(?:$|{sql.EDGE})', 1)) + 1 END"
_found = sql.has("text", rf"(?:^|{sql.EDGE})(?:предисловие|введение|глава\s+\d+|chapter\s+\d+|часть\s+\d+|part\s+\d+)(?:$|{sql.EDGE})", "i")


@query(f"""{S}, a AS (SELECT doc_id, part, text, {sql.lines()} AS x FROM sheets), b AS (SELECT *, {_start} AS start, CASE WHEN {_found} THEN {_where} ELSE 0 END AS place FROM a), c AS (SELECT *, CASE WHEN doc_id % 10 <= 8 AND {_front_cue} THEN {_cut} END AS cut FROM b),
 w AS (SELECT *, {sql.n_words('text')} AS n, (['body_only', 'body_with_notes', 'notes_only'])[doc_id % 3 + 1] AS kind, CASE WHEN doc_id % 2 = 0 THEN 50 ELSE 10 END AS noted, {sql.tally(f"({sql.solid()})[1:18]", lambda y: f'({sql.n_words(y)} >= 8 AND ({sql.ends_sentence(y)} OR {sql.has(y, "[" + B + "p{L}" + B + "p{N}]$")}))')} >= 3 AND len({sql.solid()}) >= 3 AS prose FROM c)
 SELECT doc_id, part, md5(CASE WHEN coalesce(cut, '') = '' THEN text ELSE cut END) AS trimmed, (NOT (kind IN ('body_only', 'body_with_notes') AND (n >= 120 OR (kind = 'body_with_notes' AND n >= 80 AND noted >= 40) OR (n >= 90 AND prose))))::BOOLEAN AS may_cut FROM w""")
def front_matter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without what stands before their body, and whether references may be cut from them."""
    s = noise.sheets(spark, sf_dir).withColumn("p", let(F.col("text"), lambda t: page_cleaning.front_step(t, F.col("doc_id") % 10)))
    kind = F.get(F.array(F.lit("body_only"), F.lit("body_with_notes"), F.lit("notes_only")), (F.col("doc_id") % 3).cast("int"))
    notes = F.when(F.col("doc_id") % 2 == 0, F.repeat(F.lit("note "), F.lit(50))).otherwise(F.repeat(F.lit("note "), F.lit(10)))
    return s.select("doc_id", "part", F.md5("p.text").alias("trimmed"), page_cleaning.may_cut_references(kind, F.col("text"), notes, F.lit(""), F.col("text")).alias("may_cut"))


_note = f"({sql.has('y', '^' + B + 'd{1,3}[.)]?' + B + 's+|^' + B + '[' + B + 'd{1,3}' + B + ']' + B + 's+|https?://| // |//$|^(?:См' + B + '.|Ibid' + B + '.|Цит' + B + '. соч' + B + '.)')} OR {sql.has('y', f'(?:^|{sql.EDGE})(?:см{B}.|цит{B}. по:|ibid{B}.|op{B}. cit{B}.|ргали{B}.|спб{B}.|м{B}.:|л{B}.;{B}s*м{B}.:)[{B}p{{L}}{B}p{{N}}_]', 'i')} OR {sql.has('y', f'(?:^|{sql.EDGE})(?:ф{B}.{B}s*{B}d+|оп{B}.{B}s*{B}d+|ед{B}.{B}s*хр{B}.|л{B}.{B}s*{B}d+)(?:$|{sql.EDGE})', 'i')} OR {sql.has('y', f'[{B}p{{L}}{B}p{{N}}_]//[{B}p{{L}}{B}p{{N}}_]')})"
_is_note = lambda y: f"({y} <> '' AND {_note.replace('regexp_matches(y,', f'regexp_matches({y},')})"
_note_at = f"list_filter(range(greatest(0, len(x) - 20), len(x)), lambda i: {_is_note('z[i + 1]')} AND {sql.tally('z[i + 1:]', _is_note, 'v')} >= 2)[1]"
_TAIL = f"{S}, a AS (SELECT doc_id, part, text, string_split(text, chr(10)) AS x, list_transform(string_split(text, chr(10)), lambda y: {sql.strip('y')}) AS z FROM sheets), b AS (SELECT *, {_note_at} AS cut FROM a)"


@query(f"""{_TAIL} SELECT doc_id, part, md5(CASE WHEN cut IS NULL THEN text ELSE {sql.strip(sql.joined('x[1:cut]'))} END) AS without_notes, {sql.tally('z', _is_note)}::BIGINT AS note_lines FROM b""")
def note_tails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without the notes at their end, and how many lines look like notes."""
    s = noise.sheets(spark, sf_dir)
    n = F.size(F.filter(F.split("text", "\n"), model_edits._note_line)).cast("bigint")
    return s.select("doc_id", "part", F.md5(model_edits.note_tail_cut(F.col("text"))).alias("without_notes"), n.alias("note_lines"))


_normal = lambda c: sql.strip(sql.sub(sql.sub(c, "[ " + B + "t]+\n", "\n"), "\n{3,}", "\n\n"))


@query(f"""{_TAIL} SELECT doc_id, part, md5(CASE WHEN cut IS NULL OR len(x) < 2 THEN {_normal('text')} ELSE {_normal(sql.joined('x[1:cut]'))} END) AS text, CASE WHEN cut IS NULL OR len(x) < 2 THEN 'strip_trailing_reference_block_noop' ELSE '' END AS notes FROM b WHERE part = 0""")
def stripped_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made pages after an edit plan that strips the references at their end."""
    p = noise.sheets(spark, sf_dir).where("part = 0").withColumn("plan", F.lit('{"operations": [{"op": "strip_trailing_reference_block"}]}'))
    p = edit_plans.applied(p, "text", "plan")
    return p.select("doc_id", "part", F.md5("edited.text").alias("text"), F.array_join("edited.notes", ",").alias("notes"))


# reports

_RUN = "SELECT doc_id, source AS book, (['ocr', 'extract', 'epub_extract'])[doc_id % 3 + 1] AS src, CASE doc_id % 4 WHEN 0 THEN 'approve' WHEN 1 THEN 'escalate' WHEN 2 THEN 'reject' END AS verdict, doc_id % 3 AS edits, doc_id % 5 AS flags, doc_id % 2 AS hits FROM documents"


def _run(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = noise.pages(spark, sf_dir)
    at = lambda values, k: F.get(F.array(*[F.lit(v) for v in values]), (F.col("doc_id") % k).cast("int"))
    times = lambda k, item: F.when(F.col("doc_id") % k > 0, F.array_repeat(item, (F.col("doc_id") % k).cast("int")))
    flag = page_cleaning.flag("footnote_markers", F.lit("[1]"))
    d = d.withColumn("source", at(("ocr", "extract", "epub_extract"), 3)).withColumn("page_verdict", at(("approve", "escalate", "reject", None), 4))
    d = d.withColumn("edits", F.coalesce(times(3, page_cleaning.edit("soft_hyphen", "normalize", F.lit("a"), F.lit("b"))), page_cleaning.no_edits())).withColumn("flags", F.coalesce(times(5, flag), F.array().cast(page_cleaning.FLAGS)))
    return d.withColumn("protected_hits", F.coalesce(times(2, flag), F.array().cast(page_cleaning.FLAGS))).withColumn("issue_tags", F.when(F.col("doc_id") % 6 == 0, F.array(F.lit("glossary_left"))).otherwise(F.array().cast("array<string>")))


_counted = lambda c: f"(SELECT book, string_agg(v || '=' || n, ',' ORDER BY v) AS s FROM (SELECT book, coalesce({c}, 'unknown') AS v, count(*) AS n FROM r GROUP BY 1, 2) GROUP BY book)"


@query(f"WITH r AS ({_RUN}), g AS (SELECT book, count(*)::BIGINT AS pages, sum(edits)::BIGINT AS edits, sum(flags)::BIGINT AS flags, sum(hits)::BIGINT AS protected_hits FROM r GROUP BY book) SELECT g.*, a.s AS sources, b.s AS verdicts FROM g JOIN {_counted('src')} a ON g.book = a.book JOIN {_counted('verdict')} b ON g.book = b.book")
def trial_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a trial run did with each book."""
    return projections.book_summaries(_run(spark, sf_dir), ["book"])


@query(f"""WITH r AS ({_RUN}) SELECT book, 'source' AS metric, src AS key, count(*)::BIGINT AS n FROM r GROUP BY 1, 2, 3 UNION ALL SELECT book, 'verdict', coalesce(verdict, 'unknown'), count(*)::BIGINT FROM r GROUP BY 1, 2, 3 UNION ALL SELECT book, 'pages', 'all', count(*)::BIGINT FROM r GROUP BY 1
 UNION ALL SELECT book, 'edit', 'soft_hyphen', sum(edits)::BIGINT FROM r GROUP BY 1 HAVING sum(edits) > 0 UNION ALL SELECT book, 'flag', 'footnote_markers', sum(flags)::BIGINT FROM r GROUP BY 1 HAVING sum(flags) > 0 UNION ALL SELECT book, 'tag', 'glossary_left', count(*)::BIGINT FROM r WHERE doc_id % 6 = 0 GROUP BY 1""")
def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources, verdicts, edits, flags and tags of a run, by book."""
    return reports.run_summary(_run(spark, sf_dir))


_after = f"{_marks(sql.sub('replace(text, chr(160), chr(32))', '[ ' + B + 't]{2,}', ' '))}"


@query(f"""{S}, p AS (SELECT doc_id, part, text, {_after} AS a FROM sheets) SELECT doc_id, part, length(text)::BIGINT AS before_chars, len({sql.lines()})::BIGINT AS before_lines, {sql.n('text', 'https?://')}::BIGINT AS before_urls,
 length(a)::BIGINT AS after_chars, len({sql.lines('a')})::BIGINT AS after_lines, {sql.n('a', 'https?://')}::BIGINT AS after_urls FROM p""")
def file_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters, lines and links of texts before and after a cleaning."""
    s = noise.sheets(spark, sf_dir).withColumn("after", N.spacing(F.col("text")))
    return reports.file_report(s, "text", "after").drop("text", "after", "book")


ORACLES["sample_summary"] = f"""WITH m AS ({ORACLES['sample_metrics']}) SELECT count(*)::BIGINT AS sample_count, round_even(avg(normalized_edit_distance), 4)::DOUBLE AS avg_normalized_edit_distance, round_even(avg(keyword_retention_rate), 4)::DOUBLE AS avg_keyword_retention_rate,
 round_even(avg(structure_overreach_rate), 4)::DOUBLE AS avg_structure_overreach_rate, round_even(avg(page_type_misclassification), 4)::DOUBLE AS avg_page_type_misclassification, 0::BIGINT AS mixed_script_tokens FROM m"""


@query(ORACLES["sample_summary"])
def sample_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of the metrics of samples."""
    s = noise.sheets(spark, sf_dir).where("part = 0").select("doc_id", F.regexp_replace("text", r"[^\x00-\x7F]", "?").alias("expected"))
    return evaluation.summary(evaluation.evaluated(_samples(s))).drop("spaced_hyphen", "compact_hyphen_short")


# resumed runs, audits, pairs of pages, early exits


@query(f"""{S} SELECT doc_id, part, CASE WHEN doc_id % 3 = 0 AND doc_id % 2 = 0 THEN 'checkpoint ' || doc_id WHEN doc_id % 5 = 0 THEN 'legacy ' || doc_id END AS raw_text, (doc_id % 3 <> 0)::BOOLEAN AS missing FROM sheets""")
def resumed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted pages with what checkpoints, then older stage documents, know of them; and which have no checkpoint."""
    wanted, key = noise.sheets(spark, sf_dir).select("doc_id", "part"), ["doc_id", "part"]
    kept = wanted.where("doc_id % 3 = 0").withColumn("raw_text", F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("checkpoint "), "doc_id")))
    legacy = wanted.where("doc_id % 5 = 0").withColumn("raw_text", F.concat(F.lit("legacy "), "doc_id"))
    gone = states.missing_pages(wanted, kept, key).withColumn("missing", F.lit(True))
    return states.resumed(wanted, kept, legacy, key, ["raw_text"]).join(gone, key, "left").select(*key, "raw_text", F.coalesce("missing", F.lit(False)).alias("missing"))


@query(f"""{S}, a AS (SELECT doc_id, part, text AS raw FROM sheets WHERE doc_id % 4 <> 0) SELECT doc_id, part, md5(CASE WHEN doc_id % 2 = 0 THEN 'body' ELSE raw END) AS raw_text FROM a WHERE doc_id % 7 <> 0""")
def paired_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned pages with the raw text of the page they come from, where both are there."""
    s = noise.sheets(spark, sf_dir).withColumn("book", F.col("part").cast("string")).withColumn("page_number", F.col("doc_id"))
    ocr = s.where("doc_id % 4 <> 0").select("book", "page_number", F.when(F.col("doc_id") % 2 == 0, "body").otherwise("").alias("body_text"), F.col("text").alias("selected_text"))
    pairs = review.review_pairs(ocr, s.where("doc_id % 7 <> 0").select("book", "page_number", F.lit("x").alias("cleaned_text")))
    return pairs.select(F.col("page_number").alias("doc_id"), F.col("book").cast("int").alias("part"), F.md5("raw_text").alias("raw_text"))


@query(ORACLES[homoglyph_words.__name__].rsplit(" SELECT doc_id, part, len(bare)", 1)[0] + f""", c AS (SELECT doc_id, part, len(bare) AS n, {sql.tally('bare', lambda w: f"(NOT {sql.has(sql.sub(w, f'[{P.LOOK_LATIN}]'), '[A-Za-z]')} AND NOT (length({w}) <= 4 AND upper({w}) = {w}) AND NOT {sql.has(w, '^(?:http|www)')})", 'w')} AS fixed FROM k)
 SELECT doc_id, part, CASE WHEN doc_id % 3 = 0 THEN 99 ELSE n END::INT AS detected, CASE WHEN doc_id % 3 <> 0 AND n > 0 THEN 'detected=' || n || ';auto_fixed=' || fixed || ';warned=' || (n - fixed) END AS note FROM c""")
def homoglyph_audits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits of look-alike letters, made where a page has none yet, with the note they leave."""
    done = F.when(F.col("doc_id") % 3 == 0, F.struct(F.lit(99).alias("detected"), F.lit(0).alias("auto_fixed"), F.lit(0).alias("warned")))
    a = projections.audited(noise.sheets(spark, sf_dir).withColumn("rule_cleaned_text", F.col("text")).withColumn("homoglyph_audit", done))
    return a.select("doc_id", "part", F.col("homoglyph_audit.detected").alias("detected"), F.col("audit_note").alias("note"))


@query(f"""{_REVIEW}, d AS (SELECT *, {_FLAGGED} AS flags, {', '.join(f'{_pick(v, f"(doc_id * {k} + part) % {len(v)}")} AS {name}' for name, (v, k) in _PICKS.items())}, 0 AS warned FROM t),
 x AS (SELECT *, {sql.case([(t, 'false') for t, _ in _GUARDS], 'true')} AS exits FROM d)
 SELECT doc_id, part, exits::BOOLEAN AS early_exit, md5(CASE WHEN exits THEN c ELSE 'kept' END) AS final_text, CASE WHEN exits THEN 'STRUCTURE_RESTORED' ELSE 'REVIEWED' END AS current_state, CASE WHEN exits THEN 'source=repaired_passthrough;status=early_exit_passthrough;reason=easy_extract_body_only_review_approve' END AS exit_note FROM x""")
def early_exits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed pages that are done: their texts, state and note."""
    s = _reviewable(spark, sf_dir)
    names = {"decision": "route_decision", "kind": "page_type", "layout": "layout_status", "verdict": "page_verdict", "risk": "risk_level"}
    for name, (values, k) in _PICKS.items():
        s = s.withColumn(names.get(name, name), F.get(F.array(*[F.lit(v) for v in values]), ((F.col("doc_id") * k + F.col("part")) % len(values)).cast("int")))
    s = s.withColumn("issue_tags", review.issue_tags(F.col("raw_text"), F.col("cleaned_text"), review.rule_ids(F.col("flags")))).withColumn("drop_page", F.col("doc_id") % 23 == 0).withColumn("homoglyphs_warned", F.lit(0))
    s = s.withColumn("repaired_text", F.lit("kept")).withColumn("final_text", F.lit("kept")).withColumn("current_state", F.lit("REVIEWED")).withColumn("last_success_state", F.lit("REVIEWED"))
    return model_stages.exited_early(s).select("doc_id", "part", "early_exit", F.md5("final_text").alias("final_text"), "current_state", "exit_note")


# blocks by regions, and texts of regions

_scaled = "[2 * (50.0 + (i * 37 + doc_id) % 300) / 2, i * 20.0, 200.0 + (i * 53 + doc_id) % 350, i * 20.0 + 16]"
_stays = f"({_centred('b', _keep)} OR ({_over('b', _keep)}) >= 0.25 OR NOT (({_centred('b', _mask)} AND ({_over('b', _keep)}) < 0.05) OR (({_over('b', _mask)}) >= 0.72 AND ({_over('b', _keep)}) < 0.10)))"


@query(f"""{SOLID}, l AS (SELECT doc_id, i, y, {_scaled} AS b FROM (SELECT doc_id, unnest(x) AS y, unnest(range(len(x))) AS i FROM s WHERE part = 0)), k AS (SELECT *, doc_id % 5 = 0 AS unsized, {_stays} AS stays FROM l)
 SELECT doc_id, count(*) FILTER (NOT unsized AND NOT stays)::BIGINT AS n_removed, md5(CASE WHEN any_value(unsized) THEN '' ELSE coalesce(string_agg(y, chr(10) ORDER BY i) FILTER (stays), '') END) AS kept_text,
 CASE WHEN any_value(unsized) THEN 'layout_extract_filter_missing_dimensions' ELSE 'layout_extract_filter_applied:kept=' || count(*) FILTER (stays) || ',removed=' || count(*) FILTER (NOT stays) END AS note FROM k GROUP BY doc_id""")
def sanitized_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of made pages kept by detected regions; every fifth page has no size."""
    s = noise.sheets(spark, sf_dir).where("part = 0").withColumn("blocks", F.transform(solid_lines(F.col("text")), lambda y, i: F.struct(y.alias("text"), F.transform(_box(i, F.col("doc_id")), lambda v: v / 2).alias("bbox"))))
    box = lambda r, action: F.struct(F.array(*[F.lit(v) for v in r]).alias("bbox"), F.lit(action).alias("action"))
    regions = F.array(box([0.0, 0.0, 250.0, 120.0], "keep"), box([300.0, 100.0, 500.0, 160.0], "keep"), box([200.0, 0.0, 600.0, 90.0], "mask"), box([0.0, 130.0, 320.0, 400.0], "mask"))
    s = s.withColumn("regions", regions).withColumn("width", F.lit(600.0)).withColumn("height", F.lit(400.0)).withColumn("page_width", F.when(F.col("doc_id") % 5 != 0, 300.0).otherwise(0.0)).withColumn("page_height", F.lit(200.0))
    f = layout.filtered_blocks(s)
    return f.select("doc_id", "n_removed", F.md5("kept_text").alias("kept_text"), "note")


@query(f"""{SOLID}, l AS (SELECT doc_id, y, i, [50.0 + (i * 37 + doc_id) % 300, i * 20.0] AS b, (['title', 'footnote', 'text', 'figure'])[(doc_id + i) % 4 + 1] AS label FROM (SELECT doc_id, unnest(x) AS y, unnest(range(len(x))) AS i FROM s WHERE part = 0)),
 o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round_even(b[2] / 32.0, 0), b[2], b[1], i) AS place FROM l) SELECT doc_id, md5(string_agg(y, chr(10) ORDER BY place)) AS text FROM o WHERE label IN ('title', 'text') GROUP BY doc_id""")
def region_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of the titles and body regions of made pages in reading order."""
    s = noise.sheets(spark, sf_dir).where("part = 0").select("doc_id", F.posexplode(solid_lines(F.col("text"))).alias("i", "text"))
    label = F.get(F.array(*[F.lit(x) for x in ("title", "footnote", "text", "figure")]), ((F.col("doc_id") + F.col("i")) % 4).cast("int"))
    s = layout.reading_order(s.withColumn("bbox", _box(F.col("i"), F.col("doc_id"))).withColumn("order", F.col("i")).withColumn("raw_label", label), ["doc_id"])
    return layout.page_texts(s, ["doc_id"]).select("doc_id", F.md5("text").alias("text"))


# the audit of noisy pages by its rule
_NOISY_WORDS = ORACLES[homoglyph_words.__name__].replace(S, f"{NOISY_SQL}, sheets AS (SELECT doc_id, 0 AS part, book, text FROM pages_)", 1)
ORACLES["homoglyph_audit"] = f"WITH a AS ({_NOISY_WORDS}), p AS (SELECT doc_id, {noise.NOISY} AS text FROM documents) SELECT a.doc_id, detected, auto_fixed, warned, contains(p.text, 'Poccия')::BOOLEAN AS had_latin FROM a JOIN p ON a.doc_id = p.doc_id"
