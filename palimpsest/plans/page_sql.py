"""SQL for the queries over noisy pages and conversations that need more than one expression."""

from __future__ import annotations

from ..functions import patterns as P
from . import sql
from .decision_queries import _LOW, _MOJI, _SKIP, _noted, replayed_states
from .queries import NOISY_SQL, ORACLES, QUERIES
from .rule_queries import _COUNTS, S, _flags, _protected, page_tests
from .run_queries import _is_note, _lstrip, _rstrip
from .structure_queries import _glue

B = chr(92)
#: Noisy pages in the place of made ones.
NOISY = f"{NOISY_SQL}, sheets AS (SELECT doc_id, 0 AS part, book, text FROM pages_)"
_PAGES = _COUNTS.replace(S, NOISY, 1)


def _test(name: str) -> str:
    """The expression of a column of the query of page tests."""
    told = ORACLES[page_tests.__name__]
    return told[: told.index(f")::BOOLEAN AS {name}")].rsplit(", (" if name != "toc" else "part, (", 1)[1]


# page classes and what is counted by book

ORACLES["page_classes"] = f"{_PAGES} SELECT doc_id, " + ", ".join(f"({_test(test)})::BOOLEAN AS {name}" for name, test in (("toc", "toc"), ("title", "title_page"), ("publisher", "publisher"), ("garbled", "garbled"), ("references", "reference_page"), ("glossary", "glossary"))) + " FROM c"
_by_rule = lambda counts: " UNION ALL ".join(f"SELECT book, '{rule}' AS rule_id, sum({q})::BIGINT AS n FROM s GROUP BY book HAVING sum({q}) > 0" for rule, q in counts.items())
_LISTED = f"{NOISY}, s AS (SELECT *, {sql.solid()} AS x, {sql.lines()} AS x0 FROM sheets)"
ORACLES["protected_hits"] = f"{_LISTED} {_by_rule(_protected)}"
ORACLES["conditional_flags"] = f"{_LISTED} {_by_rule(_flags)}"

# routes of noisy pages

_first = sql.compact("x[1]")
_open = f"(length({_first}) >= 12 AND ({sql.has(_first, P.LOWER_START)} OR ({sql.has(_first, P.OCR_BODYISH)} AND {sql.has(_first, '[,;:]')}) OR ({sql.n('x[1]', sql.LETTER)} > 0 AND {sql.n('x[1]', '[A-ZА-ЯЁ]')} <= floor({sql.n('x[1]', sql.LETTER)} * 0.45) AND NOT {sql.has(_first, '[.!?]$')})))"
_RUNGS = (
    ("skip IS NOT NULL AND text <> ''", "ocr_skipped_nonbody", "skip_nonbody", "skip"), ("moji OR low", "ocr", "dirty_extract", "'extract_quality_risky'"), ("packed < 80", "ocr", "sparse_text", "'extract_sparse'"),
    ("open_top AND packed < 260", "ocr", "top_body_risk", "'top_block_looks_like_body_continuation'"), ("nb >= 14 AND short >= 0.70", "ocr", "layout_complex", "'many_short_blocks'"), ("packed >= 260 AND short < 0.65", "extract", "easy_extract", "'mixed_route_extract_good'"),
)
_case = lambda k, last: sql.case([(r[0], r[k] if k == 3 else f"'{r[k]}'") for r in _RUNGS], last)
ORACLES["ocr_routes"] = f"""{_PAGES}, q AS (SELECT *, {_SKIP} AS skip, {_LOW} AS low, {_MOJI} AS moji, len({sql.lines()}) AS nb, CASE WHEN n > 0 THEN {sql.tally('x', lambda y: f'length({y}) <= 70')} / n ELSE 0 END AS short,
 coalesce({sql.strip(f'({sql.lines()})[1]')} <> '' AND {_open}, false) AS open_top FROM c), p AS (SELECT *, {_case(1, "'ocr'")} AS source, {_case(2, "'mixed_risky'")} AS difficulty, {_case(3, "'mixed_route_needs_ocr'")} AS reason FROM q)
 SELECT doc_id, skip, source, difficulty, reason, CASE source WHEN 'ocr' THEN 'hard_ocr_page' WHEN 'ocr_skipped_nonbody' THEN 'skip_nonbody_page' ELSE CASE WHEN packed < 260 THEN 'risky_extract_page' ELSE 'easy_page' END END AS decision,
 CASE source WHEN 'ocr' THEN 'high' WHEN 'ocr_skipped_nonbody' THEN 'low' ELSE CASE WHEN packed < 260 THEN 'medium' ELSE 'low' END END AS risk FROM p"""

# exports of noisy pages

ORACLES["export_filter"] = f"""{NOISY}, s AS (SELECT *, {sql.solid()} AS x, {sql.strip('text')} AS t FROM sheets), p AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY doc_id) AS page_number, count(*) OVER (PARTITION BY book) AS total, len(x) AS n, {sql.tally('x', _noted)} AS noted,
 ({sql.tally(sql.word_list('text'), lambda w: sql.full(w, sql.CYRILLIC + '{4,}'), 'w')} >= 25 OR {sql.n('text', '[.!?…]')} >= 3) AS body, {sql.has('text', B + '[[0-9]{1,3}' + B + ']')} AS tagged FROM s)
 SELECT doc_id, page_number::INT AS page_number, {sql.case([("doc_id % 17 = 0", "'filtered_nonbody_page'"), ("t = ''", "'filtered_empty_page'"), ("tagged AND n >= 3 AND noted >= greatest(3, n // 2)", "'filtered_note_heavy_page'"),
  (f"total >= 20 AND page_number <= 4 AND ({sql.has('t', sql.words(P.EXPORT_FRONT), 'i')} OR NOT body)", "'filtered_frontmatter_page'"), (f"total >= 20 AND page_number >= total - 3 AND {sql.has('t', sql.words(P.EXPORT_BACK), 'i')}", "'filtered_backmatter_page'")])} AS filter_reason FROM p"""

# states of users

ORACLES["state_replay"] = ORACLES.pop(replayed_states.__name__)
QUERIES.pop(replayed_states.__name__)

# roles of blocks

_letters, _capitals = sql.n("text", sql.LETTER), sql.n("text", "[A-ZА-ЯЁ]")
_line = sql.compact("text")
_goes_on = f"(length({_line}) >= 12 AND ({sql.has(_line, P.LOWER_START)} OR ({sql.has(_line, P.OCR_BODYISH)} AND {sql.has(_line, '[,;:]')}) OR ({_letters} > 0 AND {_capitals} <= floor({_letters} * 0.45) AND NOT {sql.has(_line, '[.!?]$')})))"
_heading = f"({sql.has(_line, P.OCR_HEADING_START.replace(B + 'b', f'(?:$|{sql.EDGE})'), 'i')} OR ({_letters} >= 10 AND {_capitals} >= floor({_letters} * 0.85) AND length({_line}) <= 180) OR (body_font > 0 AND font >= body_font * 1.15 AND length({_line}) <= 220))"
_points = (
    "CASE WHEN high >= 0.70 THEN 2 WHEN high >= 0.58 THEN 1 ELSE 0 END + CASE WHEN low >= 0.88 THEN 2 WHEN low >= 0.78 THEN 1 ELSE 0 END + (body_font > 0 AND font < body_font * 0.92)::INT"
    " + (gap >= greatest(10.0, CASE WHEN body_font > 0 THEN body_font * 0.9 ELSE 12.0 END) AND high >= 0.55)::INT + (length(text) >= 180 AND gap >= 18 AND high >= 0.55)::INT"
    f" + 2 * {sql.has('text', P.OCR_FOOTNOTE_START)}::INT + 2 * reference::INT"
)
ORACLES["layout_roles"] = f"""{NOISY}, l AS (SELECT doc_id, unnest(x) AS text, unnest(range(len(x))) AS i FROM (SELECT doc_id, {sql.solid()} AS x FROM sheets)),
 b AS (SELECT *, i * 20.0 AS top, i * 20.0 + 16 AS bottom, CASE WHEN i % 5 = 4 THEN 8.0 ELSE 10.0 END AS font, {sql.has('text', P.NUMBERED_LINE)} AND {sql.has('text', P.OCR_REFERENCE_CUE, 'i')} AS reference FROM l),
 w AS (SELECT *, coalesce(median(font) FILTER (length(text) >= 40) OVER p, 0) AS body_font, greatest(1.0, max(bottom) OVER p - min(top) OVER p) AS size, min(top) OVER p AS start, greatest(0.0, top - coalesce(lag(bottom) OVER (PARTITION BY doc_id ORDER BY top), 0.0)) AS gap FROM b WINDOW p AS (PARTITION BY doc_id)),
 h AS (SELECT *, (top - start) / size AS high, (bottom - start) / size AS low, length(text) <= 140 AS few, top / 842.0 AS page_top, bottom / 842.0 AS page_low FROM w), s AS (SELECT *, {_points} AS score, {_goes_on} AS goes_on FROM h)
 SELECT {sql.case([(f"{sql.full(sql.sub('text', B + 's+'), P.OCR_PAGE_NUMBER)} AND low >= 0.96", "'page_number'"), (_heading, "'heading'"), ("page_top <= 0.10 AND few AND NOT goes_on", "'header'"), ("page_low >= 0.90 AND few AND NOT reference AND NOT goes_on", "'footer'"),
  ("score >= 4 AND reference", "'reference_block'"), ("score >= 4", "'footnote_body'")], "'body'")} AS role, count(*)::BIGINT AS n FROM s GROUP BY 1"""

# conversations stitched: lines to paragraphs, paragraphs to pages, pages to texts

_marks = lambda c: sql.sub(sql.sub(sql.sub(c, P.BEFORE_MARK, B + "1"), P.AFTER_OPENER, B + "1"), P.BEFORE_CLOSER, B + "1")
_stitch = lambda y: sql.strip(_marks(sql.compact(sql.sub(f"replace({y}, chr(173), '')", rf"^\s*[xхXХ]\s+({sql.LETTER})", f"- {B}1"))))
_big = lambda y: sql.full(sql.compact(y), P.STITCH_HEADING)
_fold = lambda x: sql.strip(f"replace({sql.sub(sql.sub(sql.sub(f'list_aggregate({x}, {chr(39)}string_agg{chr(39)}, chr(1))', f'({sql.LETTER}{{3,}})[-‐‑]{chr(1)}([a-zа-яё]{sql.LETTER}{{2,}})', f'{B}1{B}2'), f'({sql.LETTER}{{3,}})[-‐‑]{chr(1)}([a-zа-яё]{sql.LETTER}{{2,}})', f'{B}1{B}2'), f'({sql.LETTER}+)[-‐‑]{chr(1)}([a-zа-яё])', f'{B}1-{B}2')}, chr(1), ' ')")
_tail, _head = f"regexp_extract(a, '({sql.LETTER}+)[-‐‑]$', 1)", f"regexp_extract(b, '^({sql.LETTER}+)', 1)"
_glued = f"CASE WHEN {_tail} <> '' AND {_head} <> '' AND {sql.has('b', P.LOWER_START)} THEN left(a, length(a) - 1) || CASE WHEN length({_tail}) >= 3 AND length({_head}) >= 3 THEN '' ELSE '-' END || b WHEN NOT (length(a) >= 300 OR length(b) >= 300 OR (a LIKE '%:' AND b LIKE '-%')) AND {sql.has('b', P.LOWER_START)} AND (a LIKE '%:' OR NOT {sql.ends_sentence('a')}) THEN a || ' ' || b END"
ORACLES["stitched_conversations"] = f"""WITH RECURSIVE b AS (SELECT conv_id, turn, unnest(x) AS block, unnest(range(len(x))) AS bi FROM (SELECT conv_id, turn, string_split_regex({sql.strip('text')}, '\n{B}s*\n') AS x FROM conversations)),
 l AS (SELECT conv_id, turn, bi, unnest(x) AS y, unnest(range(len(x))) AS i FROM (SELECT conv_id, turn, bi, list_transform(list_filter(string_split(block, chr(10)), lambda y: {sql.strip('y')} <> ''), lambda y: {_stitch('y')}) AS x FROM b)),
 s AS (SELECT *, lag(y) OVER w IS NULL OR {_big('y')} OR y LIKE '-%' OR (length(y) <= 25 AND y LIKE '%:') AS starts FROM l WINDOW w AS (PARTITION BY conv_id, turn, bi ORDER BY i)),
 g AS (SELECT *, sum(starts::INT) OVER (PARTITION BY conv_id, turn, bi ORDER BY i) AS p FROM s), q AS (SELECT conv_id, turn, bi, p, list(y ORDER BY i) AS x FROM g GROUP BY conv_id, turn, bi, p),
 h AS (SELECT *, coalesce(list_filter(range(1, len(x)), lambda i: NOT {sql.fragment('x[i + 1]')})[1], len(x)) AS n FROM q),
 t AS (SELECT conv_id, turn, bi, p, CASE WHEN len(x) > 1 AND {_big('x[1]')} THEN {sql.joined('x[1:n]', "' '")} || CASE WHEN n < len(x) THEN chr(10) || {_fold('x[n + 1:]')} ELSE '' END ELSE {_fold('x')} END AS t FROM h),
 o AS (SELECT conv_id, turn, list(t ORDER BY bi, p) AS x FROM t WHERE t <> '' GROUP BY conv_id, turn),
 f AS (SELECT conv_id, turn, 1::BIGINT AS k, x[1] AS held, []::VARCHAR[] AS out FROM o UNION ALL SELECT conv_id, turn, k + 1, coalesce(glued, b), CASE WHEN glued IS NULL THEN list_append(out, held) ELSE out END
  FROM (SELECT *, {_glued} AS glued FROM (SELECT f.*, {sql.sub('f.held', B + 's+$')} AS a, {sql.sub('o.x[f.k + 1]', '^' + B + 's+')} AS b FROM f JOIN o ON f.conv_id = o.conv_id AND f.turn = o.turn WHERE f.k < len(o.x)))),
 e AS (SELECT conv_id, turn, {sql.joined(f"list_filter(list_append(out, held), lambda y: {sql.strip('y')} <> '')")} AS block FROM f QUALIFY k = max(k) OVER (PARTITION BY conv_id, turn)),
 j AS (SELECT conv_id, string_agg(block, chr(10) ORDER BY turn, block) AS text, count(*)::BIGINT AS n_pages FROM e WHERE block <> '' GROUP BY conv_id)
 SELECT conv_id, {sql.strip(sql.joined(f"list_transform(list_filter(string_split(text, chr(10)), lambda y: {sql.strip('y')} <> ''), lambda y: {sql.sub('y', B + 's+$')})"))} || chr(10) AS text, n_pages FROM j"""

# edit plans of three operations, or of a merge and an unknown one

_clean = lambda y: sql.strip(sql.sub(sql.sub(sql.sub(y, "[" + B + "x{AD}" + B + "x{200B}-" + B + "x{200D}" + B + "x{2060}" + B + "x{FEFF}]"), "[ " + B + "t" + chr(160) + "]{2,}", " "), B + "s+([,.;:!?])", B + "1"))
_normal = lambda c: sql.strip(sql.sub(sql.sub(c, "[ " + B + "t]+\n", "\n"), "\n{3,}", "\n\n"))
_cut = f"list_filter(range(greatest(0, len(r) - 20), len(r)), lambda i: {sql.tally('r[i + 1:]', _is_note, 'v')} >= 2 AND {_is_note('list_filter(r[i + 1:], lambda u: u <> ' + chr(39) * 2 + ')[1]')})[1]"
ORACLES["edit_plans_applied"] = f"""{NOISY_SQL}, p AS (SELECT doc_id, doc_id % 3 <> 0 AS three, {sql.sub('text', B + 'r' + B + 'n?', chr(10))} AS text FROM pages_), x AS (SELECT *, string_split(text, chr(10)) AS x FROM p),
 o AS (SELECT *, list_transform(x[2:], lambda y: {_clean('y')}) AS tidy, {_rstrip('x[1]')} AS a, {_lstrip('x[2]')} AS b FROM x), r AS (SELECT *, list_transform(list_filter(range(len(tidy)), lambda i: tidy[i + 1] <> '' OR i = 0 OR tidy[i] <> ''), lambda i: tidy[i + 1]) AS r FROM o),
 c AS (SELECT *, CASE WHEN len(r) >= 2 THEN {_cut} END AS cut, {sql.joined('r')} = {sql.joined('x[2:]')} AS same FROM r),
 n AS (SELECT *, CASE WHEN three THEN list_filter([CASE WHEN same THEN 'normalize_spacing_noop' END, CASE WHEN cut IS NULL THEN 'strip_trailing_reference_block_noop' END], lambda v: v IS NOT NULL) ELSE list_filter([CASE WHEN len(x) < 2 THEN 'merge_with_next_missing_target:1' END, 'unsupported_operation_ignored:unknown'], lambda v: v IS NOT NULL) END AS notes,
  CASE WHEN three THEN CASE WHEN cut IS NULL THEN {sql.joined('r')} ELSE {sql.joined('r[1:cut]')} END WHEN len(x) < 2 THEN text ELSE {sql.joined(f'[{_glue}] || x[3:]')} END AS made FROM c)
 SELECT doc_id, {_normal('made')} AS text, (CASE WHEN three THEN 3 ELSE 2 END - len(notes))::INT AS n_edits, array_to_string(notes, ',') AS notes FROM n"""
