"""Document quality rules: a threshold table compiled into one projection of ratios."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WS, let, table, words

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it was on are as with be by this at from or an not have he she they "
    "der die das und ist von zu mit den dem des ein eine nicht im auf für als sich auch es "
    "le la les et de du un une que qui dans en pour est par sur au avec pas plus ce il "
    "el los las y del que se por con para no al lo su como más o una"
).split()


#: Languages whose words the list and the bounds on word lengths were made for; other languages pass these rules.
LISTED = ("en", "de", "fr", "es")


@dataclass(frozen=True)
class Rule:
    """A document fails the rule if `metric` is below `least` or above `most`; `langs`, if any, are the only languages that it is for."""

    name: str
    metric: str
    least: float | None = None
    most: float | None = None
    langs: tuple[str, ...] = ()


#: Production thresholds; metrics are the columns that `ratios` makes.
RULES = (
    Rule("word_length", "mean_word_chars", least=2.5, most=12.0, langs=LISTED),
    Rule("symbols", "symbols_per_word", most=0.1),
    Rule("stop_words", "stop_word_share", least=0.02, langs=LISTED),
    Rule("duplicate_lines", "duplicate_line_share", most=0.6),
    Rule("repeated_words", "repeated_word_share", most=0.5),
    Rule("capitals", "capital_share", most=0.4),
    Rule("letters", "letter_word_share", least=0.7),
)


def repeated_words(w: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text; windows are compared by a 64-bit hash."""

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda s, x: s + x)

    def spans(pairs: Column) -> Column:
        n = F.size(pairs)
        same = lambda i, j: F.get(pairs, i)["h"] == F.get(pairs, j)["h"]
        twice = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)))
        at = F.sort_array(F.transform(twice, lambda i: F.get(pairs, i)["at"]))
        return let(at, covered)

    def few(h: Column, twice: Column) -> Column:
        at = F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(twice, x), i)), lambda i: i.isNotNull())
        return let(at, covered)

    def count(h: Column) -> Column:
        def known(s: Column) -> Column:
            twice = F.array_distinct(F.filter(s, lambda x, i: (i > 0) & (x == F.get(s, i - 1))))
            pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
            return let(twice, lambda t: F.when(F.size(t) == 0, F.lit(0)).when(F.size(t) <= 24, few(h, t)).otherwise(let(pairs, spans)))

        return let(F.sort_array(h), known)

    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(windows, count))


def counts(text: Column) -> Column:
    """A struct of the counts that the rules rest on."""

    def of(w: Column, t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != "")
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.regexp_replace(t, WS, "")).cast("bigint").alias("word_chars"),
            F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
            let(lines, lambda x: F.struct(F.size(x).cast("bigint").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("dup"))).alias("lines"),
            repeated_words(w).cast("bigint").alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).cast("bigint").alias("n_stop_words"),
            F.regexp_count(t, F.lit(r"(?-i)\p{Lu}")).cast("bigint").alias("n_capitals"),
            F.size(F.filter(w, lambda x: x.rlike(r"\p{L}"))).cast("bigint").alias("n_letter_words"),
        )

    return let(F.coalesce(text, F.lit("")), lambda t: let(words(t), lambda w: of(w, t)))


def share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def ratios(c: Column) -> dict[str, Column]:
    return {
        "mean_word_chars": share(c["word_chars"], c["n_words"]),
        "symbols_per_word": share(c["n_symbols"], c["n_words"]),
        "stop_word_share": share(c["n_stop_words"], c["n_words"]),
        "duplicate_line_share": share(c["lines"]["dup"], c["lines"]["n"]),
        "repeated_word_share": share(c["n_repeat_words"], c["n_words"]),
        "capital_share": share(c["n_capitals"], c["word_chars"]),
        "letter_word_share": share(c["n_letter_words"], c["n_words"]),
    }


def passes(c: Column, lang: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The table as one Boolean expression. A document without a language is taken as one of a listed language."""
    metrics = ratios(c)

    def test(r: Rule) -> Column:
        low = metrics[r.metric] >= r.least if r.least is not None else F.lit(True)
        high = metrics[r.metric] <= r.most if r.most is not None else F.lit(True)
        return (low & high) | ~F.coalesce(lang.isin(*r.langs), F.lit(True)) if r.langs else low & high

    return reduce(lambda a, b: a & b, map(test, rules), F.lit(True))


def language(docs: DataFrame) -> Column:
    return F.lower("lang") if "lang" in docs.columns else F.lit(None).cast("string")


def base_failed(c: Column) -> Column:
    return (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def measured(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts and verdict of every document, from its whole text; a null text has no words and fails. One row for each row."""
    d = docs.select("doc_id", language(docs).alias("lang"), counts(F.col("text")).alias("c"))
    c = F.col("c")
    failed = base_failed(c)
    return d.select(
        "doc_id", c["n_words"].alias("n_words"), c["word_chars"].alias("word_chars"), c["n_symbols"].alias("n_symbols"), c["lines"]["dup"].alias("n_dup_lines"),
        c["n_repeat_words"].alias("n_repeat_words"), failed.alias("base_failed"), (~failed & passes(c, F.col("lang"), rules)).alias("kept"), c["n_stop_words"].alias("n_stop_words"), c["n_letter_words"].alias("n_letter_words"),
    )


def kept(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that no rule rejects, with their columns as they were."""
    d = docs.withColumn("_c", counts(F.col("text")))
    return d.where(~base_failed(F.col("_c")) & passes(F.col("_c"), language(docs), rules)).drop("_c")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    metrics = {
        "mean_word_chars": "word_chars / n_words", "symbols_per_word": "n_symbols / n_words", "stop_word_share": "n_stop_words / n_words", "duplicate_line_share": "n_dup_lines / n_lines",
        "repeated_word_share": "n_repeat_words / n_words", "capital_share": "n_capitals / word_chars", "letter_word_share": "n_letter_words / n_words",
    }
    bounds = []
    for r in RULES:
        sides = [f"{metrics[r.metric]} >= {r.least}"] * (r.least is not None) + [f"{metrics[r.metric]} <= {r.most}"] * (r.most is not None)
        langs = ", ".join(f"'{x}'" for x in r.langs)
        other = f" OR coalesce(lower(lang), '{r.langs[0]}') NOT IN ({langs})" if langs else ""
        bounds.append(f"({' AND '.join(sides)}{other})")
    return rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, lang, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
p AS (SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS tri FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM l WHERE len(w) >= 3)),
q AS (SELECT doc_id, i FROM p QUALIFY count(*) OVER (PARTITION BY doc_id, tri) >= 2),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM q) GROUP BY doc_id),
c AS (SELECT l.doc_id, l.lang, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
  coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(list_filter(w, lambda x: lower(x) IN ({stop})))::BIGINT AS n_stop_words,
  length(regexp_replace(text, '\P{{Lu}}', '', 'g'))::BIGINT AS n_capitals, len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}')))::BIGINT AS n_letter_words
  FROM l LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  CASE WHEN base_failed THEN false ELSE {" AND ".join(bounds)} END AS kept, n_stop_words, n_letter_words FROM b"""


QUERIES = {"op7_quality_rules": op7_quality_rules}
ORACLES = {"op7_quality_rules": _oracle()}
