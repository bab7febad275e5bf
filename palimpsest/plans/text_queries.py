"""Queries that run the steps on texts and documents over made pages (noise.sheets), and SQL that states each step.

Texts are compared by their digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import line_rules as L
from ..functions import normalize as N
from ..functions import patterns as P
from ..functions.rx import has, joined, let, lines, n_compact, n_words, solid_lines, tally
from ..operators import page_cleaning, post_clean
from . import noise, sql
from .queries import query
from .rule_queries import SOLID, S, _doc_reference

B = chr(92)


def _digests(spark: SparkSession, sf_dir: str, steps: dict) -> DataFrame:
    made = {k: F.md5(F.coalesce(let(F.col("text"), f), F.lit("~"))).alias(k) for k, f in steps.items()}
    return noise.sheets(spark, sf_dir).select("doc_id", "part", *made.values())


def _digest_sql(steps: dict[str, str], head: str = S, of: str = "sheets") -> str:
    return f"{head} SELECT doc_id, part, " + ", ".join(f"md5(coalesce({q}, '~')) AS {k}" for k, q in steps.items()) + f" FROM {of}"


_marks = lambda c: sql.sub(sql.sub(sql.sub(c, P.BEFORE_MARK, B + "1"), P.AFTER_OPENER, B + "1"), P.BEFORE_CLOSER, B + "1")
_bullet = lambda c: sql.sub(c, rf"^\s*[xхXХ]\s+({sql.LETTER})", f"- {B}1")
_brackets = lambda c: sql.sub(c, rf"({sql.LETTER})\[\d{{1,3}}\]", B + "1")
_suffixes = lambda c: sql.sub(c, rf"({sql.LETTER})\d{{1,3}}(\s|[.,;:!?…]|$)", f"{B}1{B}2")
_each_line = lambda f, by="chr(10)": f"coalesce(list_aggregate(list_transform({sql.lines()}, lambda y: {f('y')}), 'string_agg', {by}), '')"
_rstrip = lambda c: sql.sub(c, r"\s+$")

_NORMAL = {
    "normalized": sql.strip(sql.sub(sql.sub(sql.sub("text", r"\r\n?", "\n"), r"[ \t]+\n", "\n"), r"\n{3,}", "\n\n")),
    "bullets": _each_line(lambda y: _bullet(_rstrip(y))),
    "repair_spacing": sql.strip(sql.sub(_marks(_suffixes(_brackets("text"))), r"\s+", " ")),
    "stitch_line": sql.strip(_marks(sql.compact(_bullet("replace(text, chr(173), '')")))),
    "sample_text": sql.compact("text"),
    "single_blank_lines": f"(SELECT coalesce(string_agg(x[i], chr(10) ORDER BY i), '') FROM (SELECT {sql.lines()} AS x), unnest(range(1, len(x) + 1)) AS u(i) WHERE {sql.strip('x[i]')} <> '' OR i = 1 OR {sql.strip('x[i - 1]')} <> '')",
    "numbered": f"(SELECT coalesce(string_agg(CASE WHEN i < 1000 THEN lpad(i::VARCHAR, 3, '0') ELSE i::VARCHAR END || '| ' || x[i], chr(10) ORDER BY i), '') FROM (SELECT {sql.lines()} AS x), unnest(range(1, len(x) + 1)) AS u(i))",
    "stem": "coalesce(nullif(trim(regexp_replace('Книга №' || doc_id || ' ' || book || '.v2', '[^" + B + "p{L}" + B + "p{N}_-]', '_', 'g'), '_'), ''), 'book')",
    # the references that were put in come out as what they stood for
    "html_text": sql.compact("text || ' ЯЯ é…'"),
}


@query(_digest_sql(_NORMAL))
def normal_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normalisations of texts, lines, paths and HTML."""
    escaped = lambda t: F.concat(F.lit("<p>"), F.replace(F.replace(F.replace(t, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit("</p>&#1071;&#x42F;&nbsp;&eacute;&hellip;"))
    path = F.concat(F.lit("a/b.c/Книга №"), F.col("doc_id"), F.lit(" "), F.col("book"), F.lit(".v2.pdf"))
    return _digests(spark, sf_dir, {
        "normalized": N.normalized, "bullets": N.bullets, "repair_spacing": N.repair_spacing, "stitch_line": N.stitch_line, "sample_text": N.sample_text, "single_blank_lines": N.single_blank_lines, "numbered": N.numbered,
        "stem": lambda _: N.stem(path), "html_text": lambda t: N.html_text(escaped(t)),
    })


# what is counted of texts


@query(f"""{SOLID} SELECT doc_id, part, len({sql.lines()})::BIGINT AS n_lines, len(x)::BIGINT AS n_solid, {sql.n_compact('text')}::BIGINT AS n_compact, {sql.n_words('text')}::BIGINT AS n_words,
 {sql.has('text', sql.CYRILLIC)}::BOOLEAN AS has_cyrillic, {sql.has('text', '[A-Za-z]')}::BOOLEAN AS has_latin, (x[1] IS NOT NULL AND length({sql.compact('x[1]')}) >= 12 AND ({sql.has(sql.compact('x[1]'), P.LOWER_START)}
 OR ({sql.has(sql.compact('x[1]'), P.OCR_BODYISH)} AND {sql.has(sql.compact('x[1]'), '[,;:]')}) OR ({sql.n('x[1]', sql.LETTER)} > 0 AND {sql.n('x[1]', '[A-ZА-ЯЁ]')} <= floor({sql.n('x[1]', sql.LETTER)} * 0.45) AND NOT {sql.has(sql.compact('x[1]'), '[.!?]$')})))::BOOLEAN AS is_continuation,
 md5({sql.joined(f"list_filter(x, lambda y: {sql.full('y', P.REVIEW_HEADING)})")}) AS review_headings FROM s""")
def text_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, words and characters of texts, their scripts, whether they begin in a sentence, and their headings."""
    t = F.col("text")
    return noise.sheets(spark, sf_dir).select(
        "doc_id", "part", F.size(lines(t)).cast("bigint").alias("n_lines"), F.size(solid_lines(t)).cast("bigint").alias("n_solid"), n_compact(t).cast("bigint").alias("n_compact"), n_words(t).cast("bigint").alias("n_words"),
        has(t, P.CYRILLIC).alias("has_cyrillic"), has(t, P.LATIN).alias("has_latin"), L.is_continuation(t).alias("is_continuation"), F.md5(joined(N.headings_kept(t))).alias("review_headings"),
    )


# words and letters


def _mapped(table: dict[str, str], c: str) -> str:
    keys = ", ".join(f"'{k.lower()}'" for k in table)
    values = ", ".join(f"'{v}'" for v in table.values())
    to = f"map([{keys}], [{values}])[lower(w)]"
    cased = sql.case([(f"upper(w) = w AND lower(w) <> w", f"upper({to})"), (sql.has("w", r"^\p{Lu}"), f"upper(left({to}, 1)) || substr({to}, 2)")], to)
    return f"coalesce(list_aggregate(list_transform(regexp_extract_all({c}, '[{B}p{{L}}{B}p{{N}}_]+|[^{B}p{{L}}{B}p{{N}}_]+'), lambda w: CASE WHEN lower(w) IN ({keys}) THEN {cased} ELSE w END), 'string_agg', ''), '')"


_WRONG = " Всетаки ПОРАЗНОМУ ктото траурногозала Троицкогособора опре деления ИСТО РИИ"


def _splits(c: str) -> str:
    for wrong, right in post_clean.SPLITS.items():
        for f in (str, str.capitalize, str.upper):
            c = sql.sub(c, f"(^|{sql.EDGE}){f(wrong)}($|{sql.EDGE})", f"{B}1{f(right)}{B}2")
    return c


_DICTIONARY = {"compounds": _mapped(post_clean.COMPOUNDS, f"text || '{_WRONG}'"), "joined": _mapped(post_clean.JOINED, f"text || '{_WRONG}'"), "splits": _splits(f"text || '{_WRONG}'")}


@query(_digest_sql(_DICTIONARY))
def dictionary_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compounds, joined words and split words put right by tables, in the case of the word."""
    wrong = lambda f: lambda t: let(F.concat(t, F.lit(_WRONG)), f)
    return _digests(spark, sf_dir, {"compounds": wrong(lambda t: post_clean.replaced_words(t, post_clean.COMPOUNDS)), "joined": wrong(lambda t: post_clean.replaced_words(t, post_clean.JOINED)), "splits": wrong(lambda t: post_clean.joined_splits(t))})


_look = ", ".join(f"'{a}'" for a in P.LOOK_LATIN)
_word_ok = lambda w: f"({sql.has(w, P.CYRILLIC)} AND {sql.has(w, P.LATIN)} AND length({w}) >= 4)"
_word_safe = lambda w: f"(NOT {sql.has(sql.sub(w, f'[{P.LOOK_LATIN}]'), '[A-Za-z]')} AND NOT (length({w}) <= 4 AND upper({w}) = {w}) AND NOT {sql.has(w, '^(?:http|www)')})"


@query(f"""{S}, w AS (SELECT doc_id, part, text, list_filter(regexp_extract_all(text, '[{B}p{{L}}{B}p{{N}}_-]+'), lambda w: {_word_ok(f"trim(w, '-')")}) AS found FROM sheets),
 k AS (SELECT *, list_transform(found, lambda w: trim(w, '-')) AS bare FROM w)
 SELECT doc_id, part, len(bare)::BIGINT AS detected, {sql.tally('bare', _word_safe, 'w')}::BIGINT AS auto_fixed, {sql.tally('bare', lambda w: f'NOT {_word_safe(w)}', 'w')}::BIGINT AS warned,
 md5({sql.joined(f"list_transform(bare, lambda w: CASE WHEN {_word_safe('w')} THEN translate(w, '{P.LOOK_LATIN}', '{P.LOOK_CYRILLIC}') ELSE w END)", "','")}) AS words FROM k""")
def homoglyph_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latin letters in Cyrillic words: how many words, how many put right, and what all of them become."""
    s = noise.sheets(spark, sf_dir).withColumn("h", N.homoglyphs(F.col("text")))
    parts = F.filter(F.regexp_extract_all("text", F.lit(r"(?dU)\b[\w-]{4,}\b"), F.lit(0)), lambda w: has(w, P.CYRILLIC) & has(w, P.LATIN))
    made = F.transform(parts, lambda w: N.homoglyphs(w)["text"])
    return s.select("doc_id", "part", *[F.col(f"h.{k}").cast("bigint").alias(k) for k in ("detected", "auto_fixed", "warned")], F.md5(F.array_join(made, ",")).alias("words"))


# documents


def _clean_sentence(x: str) -> str:
    y = f"replace({sql.sub(sql.sub(sql.sub(x, post_clean.URL, '', 'i'), post_clean.PLACEHOLDER), post_clean.ANGLE_TEXT, B + '1')}, '—>', '—')"
    y = sql.sub(y, rf'([\p{{L}}\p{{N}}_»”")])(?:\?{{0,2}}\d+(?:[!?])?|\?{{2}})\)', B + "1")
    y = sql.sub(sql.sub(y, r"\s+//\s+https?://\S+", "", "i"), r"\s+\(\s*\)")
    y = f"trim({sql.strip(sql.sub(sql.sub(y, r'\s+([.,;:!?…])', B + '1'), P.SPACE_RUN, ' '))}, ';:,')"
    return f"CASE WHEN {x} LIKE '- %' THEN {sql.strip('(' + chr(39) + '- ' + chr(39) + ' || ' + sql.strip(sql.sub(y, '^[- ]+')) + ')')} ELSE {sql.strip(y)} END"


_CUT = "CASE WHEN contains(y, 'Источник:') THEN " + sql.strip(sql.sub("y", rf"(?:^|{sql.EDGE})Источник:({sql.EDGE}.*)?$", "", "i")) + " ELSE y END"
_FATE = f"""{SOLID}, f AS (SELECT doc_id, part, list_transform(x, lambda y: y) AS x FROM s),
 w AS (SELECT doc_id, part, i, y, {_clean_sentence('y')} AS made, CASE WHEN {sql.has('y', post_clean.PROMO, 'i')} THEN 'promo' WHEN {_doc_reference('y')} AND {sql.has('y', post_clean.NOTE_LINE)} THEN 'note_like' WHEN {_doc_reference('y')} THEN 'reference_like' END AS why
  FROM (SELECT doc_id, part, unnest(x) AS y, unnest(range(len(x))) AS i FROM f)),
 k AS (SELECT *, CASE WHEN why IS NULL AND length(made) <= 2 THEN 'short' ELSE why END AS fate FROM w)"""


@query(f"""{_FATE} SELECT doc_id, part, count(fate)::BIGINT AS removed, count(*) FILTER (fate = 'promo')::BIGINT AS promos, count(*) FILTER (fate = 'note_like')::BIGINT AS note_like,
 count(*) FILTER (fate IN ('note_like', 'reference_like'))::BIGINT AS reference_like, md5(coalesce(string_agg(made, chr(10) ORDER BY i) FILTER (fate IS NULL), '')) AS kept FROM k GROUP BY doc_id, part""")
def line_fates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents cleaned sentence by sentence, and how many go and why."""
    s = noise.sheets(spark, sf_dir).withColumn("l", F.transform(solid_lines(F.col("text")), post_clean.line_fate))
    why = lambda *names: tally(F.col("l"), lambda x: x["why"].isin(*names)).cast("bigint")
    kept = F.transform(F.filter("l", lambda x: x["why"].isNull()), lambda x: x["text"])
    return s.select("doc_id", "part", tally(F.col("l"), lambda x: x["why"].isNotNull()).cast("bigint").alias("removed"), why("promo").alias("promos"), why("note_like").alias("note_like"), why("note_like", "reference_like").alias("reference_like"), F.md5(joined(kept)).alias("kept"))


_HEADER = sql.strip(sql.sub(sql.sub("upper(z)", "[`'\"“”„<>|=+_~*.,:;!?-]+", " "), P.SPACE_RUN, " "))
for _wrong, _right in post_clean.HEADER_WORDS:
    _HEADER = sql.sub(_HEADER, f"(^|{sql.EDGE}){_wrong}($|{sql.EDGE})", f"{B}1{_right}{B}2")
_TIDY = sql.strip(sql.sub(sql.sub(sql.strip("y"), post_clean.HEADER_NOISE, " "), P.SPACE_RUN, " "))


@query(f"""{S}, l AS (SELECT doc_id, part, unnest({sql.lines()}) AS y, unnest(range(len({sql.lines()}))) AS i FROM sheets), t AS (SELECT *, {_TIDY} AS z, {sql.strip('y')} = '' AS blank FROM l)
 SELECT doc_id, part, md5(coalesce(string_agg(CASE WHEN blank THEN '' ELSE z END, chr(10) ORDER BY i), '')) AS without_headers FROM t
 WHERE blank OR (z <> '' AND NOT (z IN ('БЕЛОЕ ДВИЖЕНИЕ', 'К. С. Веселовский') OR {sql.full(_HEADER, post_clean.RUNNING_HEADER)}) AND NOT {sql.full('z', post_clean.NOISE_ONLY)}) GROUP BY doc_id, part""")
def running_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without running headers and symbol noise."""
    return _digests(spark, sf_dir, {"without_headers": post_clean.without_headers})


def _back(first: str, starts: str, leak: bool) -> str:
    """The text before the first line from `first` on that begins back matter."""
    y = sql.strip("x[i + 1]")
    told = f"({sql.has('z', post_clean.BACK_MATTER.replace(B + 'b', f'(?:$|{sql.EDGE})'), 'i')} OR {sql.has('z', post_clean.REFERENCES_START.replace(B + 'b', f'(?:$|{sql.EDGE})'), 'i')} OR {_doc_reference('z')} OR (length(z) <= 100 AND NOT {sql.has('z', post_clean.TERMINAL)}))"
    sample = f"list_filter(list_transform(x[i + 1:], lambda z: {sql.strip('z')}), lambda z: z <> '')[1:40]"
    support = f"{sql.tally(sample, lambda z: told, 'z')} >= 0.7 * len({sample})"
    probable = f"(n <= 1 OR CASE WHEN n <= 40 THEN i >= greatest(1, floor(n / 3)) ELSE i >= floor(n * 0.9) OR (i >= floor(n * 0.75) AND {support}) END)"
    leaks = f"{sql.has(y, post_clean.PROMPT_LEAK, 'i')} OR " if leak else ""
    return f"list_filter(range({first}, n), lambda i: {leaks}({sql.has(y, starts.replace(B + 'b', f'(?:$|{sql.EDGE})'), 'i')} AND {probable}))[1]"


_TAIL = " || chr(10) || 'СВЕДЕНИЯ ОБ АВТОРАХ' || chr(10) || 'Иванов И.' || chr(10) || 'References' || chr(10) || '1. http://x.org'"
_CUTS = f"""{S}, l AS (SELECT doc_id, part, text{_TAIL} AS text FROM sheets), n AS (SELECT *, {sql.lines()} AS x, len({sql.lines()}) AS n FROM l),
 c AS (SELECT *, {_back('greatest(1, CASE WHEN n <= 40 THEN floor(n / 3) ELSE floor(n * 0.6) END)::BIGINT', post_clean.BACK_MATTER, True)} AS a, {_back('greatest(1, floor(n * 0.75))::BIGINT', post_clean.REFERENCES_START, False)} AS b FROM n)"""


@query(f"""{_CUTS} SELECT doc_id, part, md5(CASE WHEN a IS NULL THEN text ELSE {_rstrip(sql.joined('x[1:a]'))} END) AS back_matter, md5(CASE WHEN b IS NULL THEN text ELSE {_rstrip(sql.joined('x[1:b]'))} END) AS reference_tail FROM c""")
def document_tails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut where back matter or a list of references begins."""
    tailed = lambda f: lambda t: let(F.concat_ws("\n", t, F.lit("СВЕДЕНИЯ ОБ АВТОРАХ"), F.lit("Иванов И."), F.lit("References"), F.lit("1. http://x.org")), f)
    return _digests(spark, sf_dir, {"back_matter": tailed(post_clean.without_back_matter), "reference_tail": tailed(post_clean.without_reference_tail)})


# references at the end of a page, and front matter at its start


@query(f"""{S}, l AS (SELECT doc_id, part, text, {sql.lines()} AS x FROM sheets), n AS (SELECT *, len(x) AS n FROM l),
 c AS (SELECT *, CASE WHEN n >= 4 THEN list_filter(range(greatest(0, n - 20), n - 1), lambda i: {sql.reference(sql.strip('x[i + 1]'))} AND
  {sql.tally(f"list_filter(list_transform(x[i + 1:], lambda z: {sql.strip('z')}), lambda z: z <> '')", sql.reference, 'v')} >= greatest(2, floor(len(list_filter(x[i + 1:], lambda z: {sql.strip('z')} <> '')) * 0.6)))[1] END AS cut FROM n)
 SELECT doc_id, part, md5(CASE WHEN cut IS NULL THEN text ELSE {sql.sub(sql.joined('x[1:cut]'), '(' + chr(10) + B + 's*)+$')} END) AS without_references, coalesce(cut, -1)::BIGINT AS cut_at FROM c""")
def reference_tails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without the references at their end, and the line at which these begin (-1: none)."""
    s = noise.sheets(spark, sf_dir)
    made = let(F.col("text"), page_cleaning.reference_step)["text"]
    cut = let(lines(F.col("text")), page_cleaning.tail_cut)
    return s.select("doc_id", "part", F.md5(made).alias("without_references"), F.coalesce(cut, F.lit(-1)).cast("bigint").alias("cut_at"))

