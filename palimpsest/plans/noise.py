"""Pages with defects, made from clean documents by one expression that Spark and other engines read alike.

Each defect falls on documents by a remainder of doc_id; documents of a source are a book, doc_id gives the order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table

NL = "chr(10)"
BODY = f"""CASE WHEN doc_id % 8 = 1 THEN replace(text, 'tion', concat('ti', '­', 'on'))
 WHEN doc_id % 5 = 0 THEN replace(text, concat('.', {NL}), concat('[7].', {NL}))
 WHEN doc_id % 4 = 2 THEN replace(text, ', ', '  ,  ') ELSE text END"""
NOISY = f"""concat(CASE WHEN doc_id % 3 <> 0 THEN concat('RUNNING HEAD ', source, {NL}) ELSE '' END, {BODY},
 CASE WHEN doc_id % 7 = 2 THEN concat({NL}, 'представ-', {NL}, 'итель заявил') ELSE '' END,
 CASE WHEN doc_id % 6 = 3 THEN concat({NL}, '~~~~') ELSE '' END,
 CASE WHEN doc_id % 10 = 5 THEN concat({NL}, 'Poccия и Mосква') ELSE '' END,
 CASE WHEN doc_id % 9 = 4 THEN concat({NL}, '1. Ibid. 1999', {NL}, '2. http://x.org 2001', {NL}, '3. См.: 2010') ELSE '' END)"""


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, book and noisy text of every document."""
    none = F.lit("")  # the other engine's concat() passes over nulls
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("book"), F.coalesce("source", none).alias("source"), F.coalesce("text", none).alias("text"))
    return d.select("doc_id", "book", F.expr(NOISY).alias("text"))


def rule_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the columns of the rule engine."""
    p = pages(spark, sf_dir)
    return p.select(
        "doc_id", "book", F.col("doc_id").cast("int").alias("page_number"), F.lit("extract").alias("source"), F.col("text").alias("selected_text"), F.lit("").alias("body_text"),
        F.lit("").alias("notes_text"), F.lit("").alias("reference_text"), F.lit("body_only").alias("page_type"),
    )


#: Lines of made pages, eight to a topic: contents, title page, imprint, garbled text, glossary, references, prose, noise, headings, notes.
LINES = (
    "Содержание", "Глава первая ..... 12", "Введение ........ 3", "Заключение  45", "Приложение 101", "Часть вторая.... 77", "Список таблиц 5", "Послесловие ....... 210",
    "НАУЧНЫЙ СОВЕТ", "ТРУДЫ МУЗЕЯ", "Переводчик Иванова", "ИСТОРИЯ ГОРОДА И ОКРЕСТНОСТЕЙ", "Все права защищены", "МОСКВА", "Главный редактор Петров", "ТОМ II",
    "ISBN 5-89-000", "mail@site.ru", "(812) 123-45-67", "Издательство Наука", "Подписано в печать 12.01", "Тираж 500 экз.", "Формат 60х90", "можно купить в магазине",
    "ƀƂƄ ɐɑɒ foo bar baz", "приBет сcлово и такbе xолод", "О00О text archive.org ɓɔɕ", "{текст}| wоrd сl0vo$ next", "Kahle foundation ƁƂƃ лиcт", "~~~~ грязь) да(нет", "см. ложь!ложь рукzка водыxx", "ƀƂƄƅ ɐɑɒɓ ɔɕ",
    "Список терминов", "РГАЛИ — архив литературы", "API — интерфейс программы", "USA (US) — страна", "ABC - порядок букв", "слово (термин) — значение", "Условные сокращения", "НИИ — институт",
    "1. Иванов И. Книга. М., 1999.", "2) Там же. С. 5", "12 http://x.org/a // 1998", "Ibid. 1990", "См.: Петров П. Труды", "3. Указ. соч. 2001", "РГАЛИ. Ф. 12. Оп. 3. Л. 7", "[4] Цит. по: Сидоров",
    "Это было давно, когда все мы еще жили", "в старом городе на берегу реки.", "Он сказал: да", "по-прежнему стоял дом из-за холма", "Потом пришел представ-", "итель и всетаки сказал слово", "лист упал на землю и поднялся ветер", "Вот и конец истории, которую мы знали.",
    "~~~~", "12", "xiv", "©", "|||", "x пункт списка", "- первый пункт; - второй пункт", "Опубликовано: вчера",
    "Глава 5 НАЧАЛО ПУТИ", "Рис. 1. Вид города. Далее шел снег по всей улице.", "IV. ИТОГИ ВОЙНЫ", "1.2. Раздел о погоде", "БЕЛОЕ ДВИЖЕНИЕ", "ПЕРВЫЙ БОЙ НА РЕКЕ Утро началось рано", "Список литературы", "117 Глава 6",
    "слово[12] и слово¹ и слово12 .", "Текст , с пробелами ( внутри )", "номер № 5 и 10 % и 3,5 кг", "https://site.org/page и дальше", "и т.д. и им. Ленина", "А.С. Пушкин и Л.Н. Толстой", "ст. 12 и § 5 и 1.2.3", "NATO и info@x.ru (1) Рис. 3",
)
TOPICS = len(LINES) // 8
PER_SHEET = 10


def sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, part, book, text): two pages for each document, its lines of LINES alone (part 0), and before its whole text (part 1)."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("book"), "text")
    lines = F.array(*[F.lit(x) for x in LINES])
    pick = F.transform(F.sequence(F.lit(0), F.lit(PER_SHEET - 1)), lambda k: F.get(lines, _place(F.col("doc_id"), k)))
    d = d.withColumn("head", F.array_join(pick, "\n"))
    parts = F.array(F.struct(F.lit(0).alias("part"), F.col("head").alias("text")), F.struct(F.lit(1).alias("part"), F.concat_ws("\n", "head", F.coalesce("text", F.lit(""))).alias("text")))
    return d.select("doc_id", "book", F.explode(parts).alias("p")).select("doc_id", "p.part", "book", "p.text")


def _place(doc_id: Column, k: Column) -> Column:
    """Of the lines of a sheet three quarters come from the topic of its document, the others from all."""
    own = (doc_id % TOPICS) * 8 + (F.floor(doc_id / TOPICS) + k) % 8
    return F.when((doc_id * 31 + k * 17) % 4 == 0, (doc_id * 13 + k * 29) % len(LINES)).otherwise(own).cast("int")


#: The same pages in SQL.
SHEETS_SQL = (
    f"WITH pool AS (SELECT [{', '.join(repr(x) for x in LINES)}] AS pool), "
    "heads AS (SELECT doc_id, source AS book, text, list_aggregate(list_transform(range(" + str(PER_SHEET) + f"), lambda k: pool[CASE WHEN (doc_id * 31 + k * 17) % 4 = 0 THEN (doc_id * 13 + k * 29) % {len(LINES)} ELSE (doc_id % {TOPICS}) * 8 + (doc_id // {TOPICS} + k) % 8 END + 1]), 'string_agg', chr(10)) AS head FROM documents, pool), "
    "sheets AS (SELECT doc_id, 0 AS part, book, head AS text FROM heads UNION ALL SELECT doc_id, 1, book, head || chr(10) || coalesce(text, '') FROM heads)"
)
