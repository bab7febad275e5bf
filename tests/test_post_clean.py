"""Document cleaning against worked examples."""

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import post_clean


def values(spark, texts, make):
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in d.select("i", make(F.col("t")).alias("v")).orderBy("i").collect()]


def test_hyphens(spark):
    given = "толь- ко построе- ния ин-фекционной из- за большинст-ва начальни-ка ребен-ка какой-то зи-мой тру-пы моз-гу кто-то социально- экономический пред-\nставитель по-\nчти"
    want = "только построения инфекционной из-за большинства начальника ребенка какой-то зимой трупы мозгу кто-то социально-экономический представитель почти"
    (got,) = values(spark, [given], post_clean.unhyphenated)
    assert got.split() == want.split()


def test_words(spark):
    (a,) = values(spark, ["Поразному всетаки ЧТОТО покрываемойпланом Семеновскогополка москвойрекой"], lambda t: post_clean.replaced_words(post_clean.replaced_words(t, post_clean.COMPOUNDS), post_clean.JOINED))
    assert a == "По-разному все-таки ЧТО-ТО покрываемой планом Семеновского полка Москвой-рекой"
    assert values(spark, ["сожа ление исто рии"], post_clean.joined_splits) == ["сожаление истории"]


@pytest.fixture(scope="module")
def cleaned(spark):
    def run(text):
        d = spark.createDataFrame([(text,)], "text string")
        return post_clean.cleaned_documents(d).first()

    return run


def test_document(cleaned):
    r = cleaned("117 Глава 5. ПОВЕРЖЕННЫЙ ДРАКОН\nПервая строка, которая\nпродолжается дальше лицее»3!).\nБЕЛОЕ ДВИЖЕНИЕ\n~~~~====\nОпубликовано: вчера\n1. Там же. https://x.org/1\nРис. 4. Вид сверху на город.\nпо- ДОБЫЧА ложили революцию.\n\n\nКонец истории (рис. 3 и 4).")
    lines = r.clean_text.split("\n")
    assert lines[0] == "Глава 5. ПОВЕРЖЕННЫЙ ДРАКОН" and lines[1].startswith("Первая строка, которая продолжается дальше лицее».") and "положили революцию." in r.clean_text
    assert not any(x in r.clean_text for x in ("БЕЛОЕ", "~~~~", "Опубликовано", "x.org", "Рис. 4", "117")) and lines[-1] == "Конец истории (рис. 3 и 4)."
    assert (r.removed_promos, r.removed_note_like, r.removed_reference_like, r.removed_sentences) == (1, 1, 1, 2)


def test_intrusive_heading_and_back_matter(cleaned):
    text = "Фраза перед разрывом\nЧасть IV. ВОЙНА\nпродолжается дальше.\n" + "Обычная строка текста.\n" * 6 + "Именной указатель\nАбрамов 5\n"
    r = cleaned(text)
    assert r.clean_text.startswith("Фраза перед разрывом продолжается дальше.") and "указатель" not in r.clean_text and "Абрамов" not in r.clean_text


def test_empty_documents(cleaned):
    assert cleaned(None).clean_text == "" and cleaned(" \n ").clean_text == ""


def test_repeated_headings(spark):
    d = spark.range(1).select(post_clean.first_headings_only(F.array(*[F.lit(x) for x in ("Глава 1 НАЧАЛО Первый текст.", "Глава 1 НАЧАЛО продолжается.", "Глава 2 ДАЛЬШЕ", "Глава 2 ДАЛЬШЕ")])).alias("x"))
    assert d.first().x == ["Глава 1 НАЧАЛО", "Первый текст.", "продолжается.", "Глава 2 ДАЛЬШЕ"]
    lines = ("ПЛАНЫ ПАРАДОВ ГВАРДИИ", "текст идёт", "ПЛАНЫ ПАРАДОВ ГВАРДИИ продолжается текст", "Часть IV. Карты города Рис. 5. План")
    d = spark.range(1).select(post_clean.without_repeated_headings(F.array(*[F.lit(x) for x in lines])).alias("x"))
    assert d.first().x == ["ПЛАНЫ ПАРАДОВ ГВАРДИИ", "текст идёт", "продолжается текст", "Рис. 5. План"]


def test_captions(spark):
    lines = (
        "Таким образом, Рис. 4. План крепости. ОР БАН. планы парадов показывают порядок войск на плацу.", "Рис. 1. Вид города. Исследования показывают, что здесь были стены.", "Обычный текст строки. Табл. 2. Состав полка",
        "Как видно (рис. 3 и 4), всё просто.", "Илл. 7. Просто подпись", "Рис. 1. Один. Рис. 2. Два", "Список литературы",
    )
    got = spark.range(1).select(post_clean.without_captions(F.array(*[F.lit(x) for x in lines])).alias("x")).first().x
    assert got == ["Таким образом, планы парадов показывают порядок войск на плацу.", "Исследования показывают, что здесь были стены.", "Обычный текст строки.", "Как видно (рис. 3 и 4), всё просто."]
