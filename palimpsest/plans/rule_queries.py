"""Queries that run the rules of lines and pages over made pages (noise.sheets), and SQL that states each rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import line_rules as L
from ..functions import patterns as P
from ..functions.rx import has, let, solid_lines, tally
from ..operators import model_edits, page_cleaning, post_clean
from . import noise, sql
from .queries import query

S = noise.SHEETS_SQL
SOLID = f"{S}, s AS (SELECT *, {sql.solid()} AS x FROM sheets)"
BIG = "::BIGINT"


def _counts(names: dict[str, str], of: str = "s", key: str = "doc_id, part") -> str:
    return f"SELECT {key}, " + ", ".join(f"({q}){BIG} AS {name}" for name, q in names.items()) + f" FROM {of}"


def _tests(names: dict[str, str], of: str = "s") -> str:
    return "SELECT doc_id, part, " + ", ".join(f"({q})::BOOLEAN AS {name}" for name, q in names.items()) + f" FROM {of}"


# lines

_CAPS = "[A-ZА-ЯЁ]"
_shout = lambda t: f"({sql.full(t, '[IVXLCDM0-9]+')} OR (length({sql.sub(t, '[^A-Za-zА-Яа-яЁё]')}) > 0 AND upper({sql.sub(t, '[^A-Za-zА-Яа-яЁё]')}) = {sql.sub(t, '[^A-Za-zА-Яа-яЁё]')}))"
_bare = lambda t: f"trim({t}, '«»\"''“”„()[]{{}}:;,.!?—–-')"
_caps_title = lambda y: f"({sql.full(y, '[А-ЯЁA-Z0-9IVXLCDM][А-ЯЁA-Z0-9IVXLCDM' + chr(92) + 's«»\"' + chr(39) + '()' + chr(92) + '-]{2,}')} AND {sql.has(y, '[А-ЯЁA-Z]')})"
_doc_heading = lambda y: (
    f"({sql.has(y, post_clean.SECTION)} OR ({sql.has(y, post_clean.NUMBERED_SECTION)} AND length({y}) <= 140) OR CASE WHEN length({y}) <= 90 AND {_caps_title(y)} THEN {sql.n(y, '[А-ЯЁA-Z]')} >= 4"
    f" ELSE length({y}) <= 220 AND NOT {sql.has(y, '[А-ЯЁA-Z][а-яёa-z]')} AND {sql.tally(f'string_split_regex({y}, ' + chr(39) + chr(92) + 's+' + chr(39) + ')', lambda t: _shout(_bare(t)), 't')} >= 3 END)"
)
_doc_reference = lambda y: (
    f"(({sql.has(y, post_clean.REFERENCE_CUE.replace('doi' + chr(92) + 'b', 'doi(?:$|' + sql.EDGE + ')').replace('isbn' + chr(92) + 'b', 'isbn(?:$|' + sql.EDGE + ')'), 'i')} AND ({sql.has(y, post_clean.NOTE_LINE)} OR {sql.n(y, sql.words(chr(92) + 'b(?:19|20)[0-9]{2}' + chr(92) + 'b'))} >= 2 OR length({y}) < 260))"
    f" OR {sql.n(y, ' // ')} >= 2)"
)


@query(f"""{SOLID} {_counts({
    "headings": sql.tally("x", sql.heading), "fragments": sql.tally("x", sql.fragment), "noise": sql.tally("x", sql.noise), "reference_lines": sql.tally("x", sql.reference),
    "sentence_ends": sql.tally("x", sql.ends_sentence), "doc_headings": sql.tally("x", _doc_heading), "doc_references": sql.tally("x", _doc_reference),
    "boundaries": sql.tally("x", lambda y: f"({_doc_heading(y)} OR {sql.has(y, post_clean.BOUNDARY)})"),
    "open_lines": sql.tally("x", lambda y: f"NOT ({_doc_heading(y)} OR {sql.has(y, post_clean.BOUNDARY)} OR {sql.has(y, post_clean.TERMINAL)})"),
    "bracket_notes": sql.tally("x", lambda y: sql.has(y, chr(94) + chr(92) + "[[0-9]{1,3}" + chr(92) + "]")),
})}""")
def line_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines of each page pass each test of a line."""
    x = F.col("x")
    s = noise.sheets(spark, sf_dir).withColumn("x", solid_lines(F.col("text")))
    tests = {
        "headings": L.is_heading, "fragments": L.is_heading_fragment, "noise": L.is_noise, "reference_lines": L.is_reference, "sentence_ends": L.ends_sentence, "doc_headings": post_clean.is_heading,
        "doc_references": post_clean.is_reference_like, "boundaries": post_clean.is_boundary, "open_lines": post_clean.is_open, "bracket_notes": lambda y: has(y, r"^\[\d{1,3}\]"),
    }
    return s.select("doc_id", "part", *[tally(x, test).cast("bigint").alias(name) for name, test in tests.items()])


# pages

_meta = {k: lambda c, k=k, p=p: sql.has(c, sql.words(p), "i" if k in L._NO_CASE else "") for k, p in L._META.items()}
_any_meta = lambda y: "(" + " OR ".join(test(y) for test in _meta.values()) + ")"
_shouted = lambda y: f"({sql.heading(y)} OR {sql.fragment(y)} OR ({sql.has(y, chr(92) + 'p{L}')} AND upper({y}) = {y} AND lower({y}) <> {y}))"
_ODD, _CYR, _LAT = P.ODD_LATIN, P.CYRILLIC, P.LATIN
_garbled_token = lambda t: (
    f"(length(trim({t}, '.,;:!?()[]{{}}«»\"''')) >= 4 AND ({sql.has(t2 := f'trim({t}, ' + chr(39) + '.,;:!?()[]{}«»' + chr(34) + chr(39) * 2 + chr(39) + ')', _ODD)} OR ({sql.has(t2, _LAT)} AND {sql.has(t2, _CYR)}) OR {sql.has(t2, '[{}|' + chr(92) * 2 + '$]')} OR {sql.has(t2, '0ОО|О00|00О')}))"
)
_PAGE = f"{S}, s AS (SELECT *, {sql.solid()} AS x, {sql.strip('text')} AS t, regexp_extract_all(text, '\\S+') AS tokens, {sql.word_list('text')} AS w FROM sheets)"
_mixed_word = lambda t: f"({sql.full(t, sql.LETTER + '{4,}')} AND {sql.has(t, _CYR)} AND {sql.has(t, _LAT)})"
_noisy = {
    "mixed": sql.tally("w", _mixed_word, "t"), "marks": sql.n("text", "[А-Яа-яЁё]{2,}[)!(/][А-Яа-яЁё]{2,}"), "fragments": sql.tally("w", lambda t: sql.full(t, "[А-Яа-яЁё]{2,}[A-Za-z]{1,3}[А-Яа-яЁё]{2,}"), "t"),
    "banners": sql.n("text", P.ARTIFACT_BANNER), "spans": sql.tally("tokens", lambda t: sql.has(t, r"[\p{L}\p{N}_]"), "t"),
}
_COUNTS = f"""{_PAGE}, c AS (SELECT *, len(x) AS n, {sql.n('text', P.DOT_LEADER)} AS leaders, {sql.n('text', P.TOC_ENTRY, 'm')} AS entries, {sql.tally('x', lambda y: sql.has(y, P.PAGE_NUMBER_END))} AS paged,
 {sql.tally('x[1:40]', lambda y: f'length({y}) BETWEEN 8 AND 140')} AS listed, length({sql.joined('x', "' '")}) AS size, {sql.tally('x', lambda y: f'({sql.n_words(y)} >= 6 AND {sql.ends_sentence(y)})')} AS sentences,
 {sql.tally('x', _shouted)} AS shouted, {_meta['front']('text')} AS front, {_meta['isbn']('text')} AS isbn, {_meta['imprint']('text')} AS imprint, {' + '.join(f'{t("text")}::INT' for t in _meta.values())} AS cues,
 {sql.tally('x', _any_meta)} AS meta, {sql.n_compact('text')} AS packed, {sql.n('t', _ODD)} AS odd, {sql.n('t', _CYR)} AS cyr, {sql.n('t', _LAT)} AS lat, {sql.tally('tokens', _garbled_token, 't')} AS bad,
 {sql.tally('x', sql.reference)} AS refs, {sql.tally('x', lambda y: sql.has(y, P.NUMBERED_LINE))} AS numbered, {sql.tally('x', lambda y: sql.has(y, P.BACKMATTER_REFERENCE.replace(chr(92) + 'b', '(?:$|' + sql.EDGE + ')'), 'i'))} AS back,
 {sql.tally('x', lambda y: sql.has(y, 'https?://|www' + chr(92) + '.'))} AS urls, {sql.tally('x', lambda y: f'(length({y}) >= 140 AND NOT {sql.has(y, P.NUMBERED_LINE)})')} AS longs, {sql.n('text', P.GLOSSARY_ENTRY, 'm')} AS terms,
 {sql.tally('x[1:18]', lambda y: f'({sql.n_words(y)} >= 8 AND ({sql.ends_sentence(y)} OR {sql.has(y, "[" + chr(92) + "p{L}" + chr(92) + "p{N}]$")}))')} AS prose,
 {', '.join(f'{q} AS {k}' for k, q in _noisy.items())}, {sql.n('text', '[Ѐ-ӿ]')} AS ocr_cyr FROM s)"""


@query(_COUNTS + " " + _tests({
    "toc": f"n >= 4 AND {sql.has('text', P.TOC_HEADING, 'im')} AND (2 * leaders >= 2 OR 2 * entries >= 4 OR paged >= 4 OR (listed >= 8 AND paged >= 3))",
    "title_page": "n BETWEEN 1 AND 20 AND size < 320 AND sentences < 2 AND doc_id % 10 <= 6 AND ((doc_id % 10 <= 2 AND front) OR (shouted >= 2 AND doc_id % 10 <= 4) OR (front AND sentences = 0 AND n <= 12))",
    "publisher": "t <> '' AND ((cues >= 2 AND meta >= greatest(3, floor(n * 0.6))) OR (isbn AND n <= 3 AND packed <= 220) OR (imprint AND meta >= 2 AND packed <= 800) OR (front AND meta >= 2 AND n <= 20 AND packed <= 900) OR ((contains(lower(text), 'можно купить') OR contains(lower(text), 'книжный салон')) AND packed <= 900))",
    "garbled": f"length(t) >= 40 AND (({sql.has('t', sql.words(P.ARCHIVE), 'i')} AND bad >= 2) OR (odd >= 2 AND cyr <= 12 AND bad >= 3) OR (odd >= 4 AND cyr <= 20 AND lat >= 20 AND bad >= 4))",
    "reference_page": f"{sql.has('text', P.ABBREVIATIONS_HEADING, 'im')} OR (n >= 4 AND (refs >= greatest(4, floor(n * 0.6)) OR (refs >= 3 AND urls >= 2) OR (numbered >= 6 AND back >= 4 AND longs <= 2) OR (numbered >= 10 AND longs <= 1)))",
    "glossary": f"t <> '' AND ({sql.has('text', P.GLOSSARY_HEADING, 'im')} OR (terms >= 6 AND n <= 40))",
    "substantive": "n >= 3 AND prose >= 3",
    "low_quality": "packed >= 120 AND ocr_cyr >= 60 AND (mixed >= 4 OR (fragments >= 3 AND marks >= 1) OR (banners >= 2 AND mixed + marks + fragments >= 2) OR (mixed + marks + fragments >= 8 AND (mixed + marks + fragments) / greatest(1, spans) >= 0.035))",
    "mojibake": f"packed >= 80 AND ((odd >= 12 AND odd > ocr_cyr * 0.35) OR {sql.any_of('x', lambda y: f'({sql.n_compact(y)} >= 8 AND {sql.n(y, _ODD)} >= 6 AND (({sql.n(y, _ODD)} >= 8 AND {sql.n(y, _LAT)} <= 2) OR ({sql.n(y, "[Ѐ-ӿ]")} >= 4 AND {sql.n(y, _ODD)} >= greatest(6, floor({sql.n(y, "[Ѐ-ӿ]")} * 0.45)))))')})",
    "note_page": f"{sql.tally('x', lambda y: sql.has(y, chr(94) + chr(92) + '[[0-9]{1,3}' + chr(92) + ']'))} >= 5 OR {sql.n('text', chr(92) + '[[0-9]{1,3}' + chr(92) + ']')} >= 8",
}, "c"))
def page_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each page is, test by test, as a page read by OCR with a number of its own."""
    t = F.col("text")
    tests = {
        "toc": L.is_toc(t, t), "title_page": L.is_title_page((F.col("doc_id") % 10).cast("int"), t, t), "publisher": L.is_publisher_page(t, t), "garbled": L.is_garbled(t, t, F.lit("ocr")),
        "reference_page": L.is_reference_page(t, t), "glossary": L.is_glossary_page(t, t), "substantive": L.is_substantive(t), "low_quality": L.is_low_quality(t), "mojibake": L.is_mojibake(t), "note_page": model_edits.is_note_page(t),
    }
    return noise.sheets(spark, sf_dir).select("doc_id", "part", *[F.coalesce(c, F.lit(False)).alias(name) for name, c in tests.items()])


# what is counted on a page

_ADDRESS = r"[\p{L}\p{N}_]\S*@\S*[\p{L}\p{N}_]"
_BARE = sql.sub("text", r"https?://\S+", " ")
_LEFT, _REST = sql.n(_BARE, _ADDRESS), sql.sub(_BARE, _ADDRESS, " ")

_protected = {
    "lexical_hyphen_words": sql.n("text", f"{sql.CYRILLIC}+-{sql.CYRILLIC}+"), "abbreviations_with_periods": sql.n("text", rf"(?:^|{sql.EDGE})(?:т\.д\.|т\.п\.|г\.|стр\.|им\.)"),
    "initials_and_names": sql.n("text", rf"(?:^|{sql.EDGE})[А-ЯЁ]\.\s?[А-ЯЁ](?:\.\s?)?[А-ЯЁа-яё-]+"), "legal_structural_numbering": sql.n("text", rf"(?:^|{sql.EDGE})ст\.\s*\d+\b|§\s*\d+|\b\d+(?:\.\d+)+\b"),
    "latin_spans_and_identifiers": f"{sql.n('text', 'https?://' + chr(92) + 'S+')} + {_LEFT} + {sql.n(sql.sub(_REST, '[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}_-]', '  '), '(?:^|' + sql.EDGE + ')[A-Z]{2,}[A-Z0-9-]*(?:$|' + sql.EDGE + ')')}",
}
_flags = {
    "footnote_markers": f"{sql.n('text', chr(92) + '[[0-9]{1,3}' + chr(92) + ']|' + chr(92) + '([0-9]{1,3}' + chr(92) + ')')} + {sql.n('text', sql.CYRILLIC + '[¹²³⁴⁵⁶⁷⁸⁹]')}", "citations_and_bibliographic_refs": sql.n("text", P.CITATION),
    "reference_suffix_material": f"({sql.tally('x', sql.reference)} >= 2)::INT", "toc_index_material": f"{sql.has('text', P.DOT_LEADER)}::INT", "figure_table_formula_labels": sql.tally("x0", lambda y: sql.has(y, P.FIGURE, "i")),
    "number_and_date_formatting": sql.n("text", P.VALUE),
}


@query(f"{S}, s AS (SELECT *, {sql.solid()} AS x, {sql.lines()} AS x0 FROM sheets) {_counts({**{f'protected_{k}': q for k, q in _protected.items()}, **{f'flag_{k}': q for k, q in _flags.items()}})}")
def page_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Protected spans and conditional flags of each page, by rule."""
    s = noise.sheets(spark, sf_dir)
    s = s.withColumn("h", let(F.col("text"), page_cleaning.protected_hits)).withColumn("f", let(F.col("text"), page_cleaning.conditional_flags))
    of = lambda c, rule: F.size(F.filter(c, lambda e: e["rule_id"] == rule)).cast("bigint")
    return s.select("doc_id", "part", *[of("h", k).alias(f"protected_{k}") for k in _protected], *[of("f", k).alias(f"flag_{k}") for k in _flags])
