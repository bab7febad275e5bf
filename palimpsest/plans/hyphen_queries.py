"""Broken and compound words of documents, and headings that stand inside sentences; and SQL that states them.

Without look-around, what must stay is put under a mark first and comes back at the end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rx import compact, let, solid_lines
from ..operators import post_clean
from . import noise, sql
from .queries import query
from .rule_queries import SOLID, S, _doc_heading
from .structure_queries import _open

B = chr(92)
MARK = chr(2)
_L, _l, _D, _C = sql.LETTER, "[a-zа-яё]", "[-‐‑]", sql.CYRILLIC
_ADDED = (
    " понимаю-\nщий человек и вы-\nход; толь- ко из- за него, инфекцио- нными и благо- творительность. ин-фекционной из-за большинст-ва как-то кто-то при-вет экс-мэр во-первых он-де кое-что да-же ма-ма слово-то город-ок "
    "ПО- прежнему лейб-гвар социально- экономических по-пробуй в-третьих не-го"
)


def _marked(c: str, pattern: str, flags: str = "") -> str:
    """The hyphen between the second and the third group of a pattern under a mark; twice, as neighbours share what is between them."""
    once = lambda x: sql.sub(x, pattern, f"{B}1{B}2{MARK}{B}3{B}4", flags)
    return once(once(c))


def _joined(c: str, pattern: str) -> str:
    once = lambda x: sql.sub(x, pattern, f"{B}1{B}2{B}3{B}4")
    return once(once(c))


_STEPS: list[str] = []
# a word at the end of a line
_STEPS.append(sql.sub(sql.sub("t", f"({_L}{{3,}}){_D}{B}s*\n{B}s*({_l}{_L}{{2,}})", f"{B}1{B}2"), f"({_L}+){_D}{B}s*\n{B}s*({_l}{_L}*)", f"{B}1-{B}2"))
# a word with a space after its hyphen
_spaced = sql.sub("t", f"({_L}{{7,}}[оеОЕ]){_D}{B}s+({_l}{_L}{{5,}})", f"{B}1{MARK}{B}2")
for _pair in post_clean.PAIRS:
    _a, _b = _pair.split("-")
    _spaced = sql.sub(_spaced, f"(^|{sql.EDGE})({_a}){_D}{B}s+({_b})($|[^A-Za-zА-Яа-яЁё])", f"{B}1{B}2{MARK}{B}3{B}4", "i")
_STEPS.append(f"replace({sql.sub(_spaced, f'({_L}+){_D}{B}s+({_l}{_L}*)', f'{B}1{B}2')}, chr(2), '-')")
# a short start
_short = "t"
for _pair in post_clean.PAIRS:
    _a, _b = _pair.split("-")
    _short = _marked(_short, f"(^|{sql.EDGE})({_a}){_D}({_b})($|{sql.EDGE})", "i")
_STEPS.append(f"replace({_joined(_short, f'(^|{sql.EDGE})({_L}{{1,3}}){_D}({_l}{{4,}})($|{sql.EDGE})')}, chr(2), '-')")
# a short end
_STEPS.append(f"replace({_joined(_marked('t', f'()({_L}){_D}(то)($|{sql.EDGE})'), f'(^|{sql.EDGE})({_L}{{4,}}){_D}({_l}{{1,3}})($|{sql.EDGE})')}, chr(2), '-')")
# short starts and ends
_inner = "t"
for _pair in (*post_clean.PAIRS, *post_clean.INNER_PAIRS):
    _a, _b = _pair.split("-")
    _inner = _marked(_inner, f"(^|{sql.EDGE})({_a}){_D}({_b})($|{sql.EDGE})", "i")
_inner = _marked(_inner, f"(^|{sql.EDGE})({'|'.join(post_clean.INNER_LEFTS)}){_D}()({_C})", "i")
_inner = _marked(_inner, f"(^|{sql.EDGE})({_C}{{2}}){_D}([а-яё]{{2}})($|{sql.EDGE})")
_inner = _marked(_inner, f"()({_C}){_D}({'|'.join(post_clean.INNER_RIGHTS)})($|{sql.EDGE})")
_STEPS.append(f"replace({_joined(_inner, f'(^|{sql.EDGE})({_C}{{2,5}}){_D}([а-яё]{{2,4}})($|{sql.EDGE})')}, chr(2), '-')")
_ROUNDS = "".join(f", r{n * len(_STEPS) + k + 1} AS (SELECT doc_id, {step} AS t FROM r{n * len(_STEPS) + k})" for n in range(4) for k, step in enumerate(_STEPS))


@query(f"{S}, r0 AS (SELECT doc_id, text || '{_ADDED}' AS t FROM sheets WHERE part = 0){_ROUNDS} SELECT doc_id, md5(t) AS joined FROM r{4 * len(_STEPS)}")
def unhyphenated_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made pages with the words put together that reading or line ends broke at hyphens."""
    s = noise.sheets(spark, sf_dir).where("part = 0").withColumn("t", F.concat("text", F.lit(_ADDED)))
    return s.select("doc_id", F.md5(post_clean.unhyphenated(F.col("t"))).alias("joined"))


_rest = f"regexp_extract(y, '{sql.quoted(post_clean.INLINE_HEADING)}', 1)"


@query(f"""{SOLID}, l AS (SELECT doc_id, part, unnest(x) AS y, unnest(range(len(x))) AS i FROM s), n AS (SELECT *, lag(y) OVER w AS before, lead(y) OVER w AS after FROM l WINDOW w AS (PARTITION BY doc_id, part ORDER BY i)),
 k AS (SELECT * FROM n WHERE NOT (before IS NOT NULL AND after IS NOT NULL AND {_doc_heading('y')} AND {_open('before')} AND coalesce({sql.has('after', post_clean.CONTINUES)}, false))),
 m AS (SELECT doc_id, part, i, y, lag(y) OVER (PARTITION BY doc_id, part ORDER BY i) AS before FROM k)
 SELECT doc_id, part, md5(string_agg(CASE WHEN before IS NOT NULL AND {_open('before')} AND {_rest} <> '' THEN {_rest} ELSE y END, chr(10) ORDER BY i)) AS lines FROM m GROUP BY doc_id, part""")
def intrusive_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without headings between two halves of a sentence."""
    s = noise.sheets(spark, sf_dir).withColumn("x", solid_lines(F.col("text")))
    return s.select("doc_id", "part", F.md5(F.array_join(let(F.col("x"), post_clean.without_intrusions), "\n")).alias("lines"))


# titles met before, line by line


_figure = sql.has("y", f"{post_clean.FIGURE}", "i")
_bare = f"CASE WHEN fig THEN {sql.sub(sql.sub('y', post_clean.SECTION_BEFORE_FIGURE.replace('(?=', '('), B + '1', 'i'), post_clean.AUTHOR_BEFORE_FIGURE.replace('(?=', '('), B + '1', 'i')} ELSE y END"
_title = f"(NOT fig AND length(w) <= 180 AND ({_doc_heading('w')} OR {sql.full('w', post_clean.TITLE)} OR {sql.full('w', post_clean.AUTHOR_TITLE)}))"


@query(f"""{S.replace('WITH pool', 'WITH RECURSIVE pool', 1)}, l AS (SELECT doc_id, list_transform({sql.solid()}, lambda y: {sql.compact('y')}) AS x FROM sheets WHERE part = 0),
 f AS (SELECT doc_id, 0::BIGINT AS k, []::VARCHAR[] AS out, []::VARCHAR[] AS seen FROM l UNION ALL
  SELECT doc_id, k + 1, list_append(out, CASE WHEN title THEN raw ELSE w END), CASE WHEN title AND NOT list_contains(seen, w) THEN list_append(seen, w) ELSE seen END
  FROM (SELECT *, {_title} AS title FROM (SELECT doc_id, k, out, seen, raw, fig, CASE WHEN head IS NOT NULL AND rest <> '' AND (fig OR NOT {_doc_heading('rest')}) THEN rest ELSE b END AS w
   FROM (SELECT *, {sql.strip('substr(b, length(head) + 1)')} AS rest FROM (SELECT *, list_filter(list_reverse(list_sort(list_transform(seen, lambda h: lpad(length(h)::VARCHAR, 5, '0') || h))), lambda h: starts_with(b, substr(h, 6) || ' '))[1][6:] AS head
    FROM (SELECT doc_id, k, out, seen, y AS raw, fig, {sql.strip(_bare)} AS b FROM (SELECT *, {_figure} AS fig FROM (SELECT f.*, l.x[f.k + 1] AS y FROM f JOIN l ON f.doc_id = l.doc_id WHERE f.k < len(l.x)))))))))
 SELECT doc_id, md5(coalesce(list_aggregate(out, 'string_agg', chr(10)), '')) AS lines FROM f QUALIFY k = max(k) OVER (PARTITION BY doc_id)""")
def repeated_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of made pages without titles met before at their start."""
    s = noise.sheets(spark, sf_dir).where("part = 0").withColumn("x", F.transform(solid_lines(F.col("text")), compact))
    return s.select("doc_id", F.md5(F.array_join(post_clean.without_repeated_headings(F.col("x")), "\n")).alias("lines"))
