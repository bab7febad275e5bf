"""Cleaning of whole documents after stitching: hyphens, compounds, headers, back matter, headings, paragraphs.

All steps are column functions on a text or on its array of lines."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.rx import STRINGS, blank, compact, count, folded, full, has, joined, let, lines, n_words, rstrip, solid_lines, strip, sub, tally

# Word pairs that keep their hyphen
PAIRS = ("из-за", "из-под", "по-видимому", "по-прежнему", "во-первых", "во-вторых", "в-третьих")
INNER_PAIRS = ("кто-то", "что-то", "где-то", "как-то", "когда-то", "какой-то", "чей-то", "кое-как")
INNER_LEFTS = ("кое", "экс", "вице", "лейб", "обер", "унтер")
INNER_RIGHTS = ("то", "ли", "де")

# Words put together wrongly, and what they are
COMPOUNDS = {
    "поразному": "по-разному", "всетаки": "все-таки", "когдалибо": "когда-либо", "когданибудь": "когда-нибудь", "ктолибо": "кто-либо", "ктонибудь": "кто-нибудь", "чтолибо": "что-либо",
    "чтонибудь": "что-нибудь", "гделибо": "где-либо", "гденибудь": "где-нибудь", "какойлибо": "какой-либо", "какойнибудь": "какой-нибудь", "ктото": "кто-то", "чтото": "что-то", "какойто": "какой-то",
}
SPLITS = {"опре деления": "определения", "сожа ление": "сожаление", "сожа лением": "сожалением", "британско го": "британского", "про буждение": "пробуждение", "исто рии": "истории"}
JOINED = {
    "траурногозала": "траурного зала", "конюшенногомоста": "конюшенного моста", "гвардейскихполка": "гвардейских полка", "крестнымходом": "крестным ходом", "монастырскогодвора": "монастырского двора",
    "головленковатюрьма": "Головленкова тюрьма", "трапезныхпалатах": "трапезных палатах", "подъемныхдлиною": "подъемных длиною", "центральногомонастырскогодвора": "центрального монастырского двора",
    "крепостистоит": "крепости стоит", "всекомнаты": "все комнаты", "внутреннююситуацию": "внутреннюю ситуацию", "межеваниятакже": "межевания также", "выровненнымкантом": "выровненным кантом", "ивсе": "и все",
    "устроенныеосями": "устроенные осями", "километрахниже": "километрах ниже", "покрываемойпланом": "покрываемой планом", "частойпричиной": "частой причиной", "незавершенностиработ": "незавершенности работ",
    "населенногопункта": "населенного пункта", "поворотногопункта": "поворотного пункта", "межевогоплана": "межевого плана", "уездныхпланах": "уездных планах", "землемернойкниги": "землемерной книги",
    "деталипроцесса": "детали процесса", "экспозициимузея": "экспозиции музея", "объединенногомузея": "объединенного музея", "обобщающихработ": "обобщающих работ", "землянымвалам": "земляным валам",
    "временипочти": "времени почти", "планамповезло": "планам повезло", "земликоторой": "земли которой", "острожныхстен": "острожных стен", "оштукатуренныхстенах": "оштукатуренных стенах",
    "монастырясто": "монастыря сто", "Семеновскогополка": "Семеновского полка", "Преображенскогополка": "Преображенского полка", "Измайловскогополка": "Измайловского полка", "Ямбургскогополка": "Ямбургского полка",
    "гарнизонногополка": "гарнизонного полка", "Конногвардейскогополка": "Конногвардейского полка", "бывшегополка": "бывшего полка", "Троицкогособора": "Троицкого собора", "Софийскогособора": "Софийского собора",
    "Успенскогособора": "Успенского собора", "Георгиевскогособора": "Георгиевского собора", "Богоявленскогособора": "Богоявленского собора", "Благовещенскогособора": "Благовещенского собора",
    "Петропавловскогособора": "Петропавловского собора", "предшествующегособора": "предшествующего собора", "апсидысобора": "апсиды собора", "Всешутейшегособора": "Всешутейшего собора",
    "Музеязаповедника": "Музея-заповедника", "Москвойрекой": "Москвой-рекой",
}

# Patterns of documents
URL = r"https?://\S+|www\.\S+"
INDEX_MARKER = r"ВЕРНУТЬСЯ\s+К\s+ИНДЕКСУ"
PLACEHOLDER = r"<\s*(?:\.{2,}|…+)\s*>"
ANGLE_TEXT = r"<\s*([A-Za-zА-Яа-яЁё0-9][^<>]{0,38}?)\s*>"
CAPS_IN_WORD = r"(\b[А-Яа-яЁё]{2,}-)\s+(?:[A-ZА-ЯЁ]{4,}(?:\s+[A-ZА-ЯЁ]{2,}){0,4})\s+([а-яё]{2,}\b)"
PAGE_HEADING = r"(?:(?:Глава|Часть|ЧАСТЬ)\s+[IVXLCDM0-9]+(?:[.:]\s*|$)|РОСПУСК\b|ПРОЛОГ\b|ЭПИЛОГ\b)"
MOJIBAKE = r"[ƀ-ʯ]"
GARBLE = r"(?=[^\n]*[ƀ-ʯ])[ƀ-ӿA-Za-z0-9\s.\-–—()«»\"'/]{4,}"
PROMO = r"^(?:Опубликовано:|AnonDir:|«Исследование теорий заговора|Conspiracy Theories Explored)"
HEADER_NOISE = r"(?:r&\?-\.\.\.|tQ-\.\.\.|fQ=;|ENG о А ¥: #2|[~_=\-<>/\\|#@&¥]{4,}[A-Za-zА-Яа-яЁё0-9~_=\-<>/\\|#@&¥]*)"
NOISE_ONLY = r"[~`^_=+*#@&¥<>/\\|:;.,'\"!?()\[\]{}-]{4,}"
RUNNING_HEADERS = ("БЕЛОЕ ДВИЖЕНИЕ", "К. С. Веселовский")
RUNNING_HEADER = r"БЕЛОЕ ДВИЖЕНИЕ|(?:ПОСЛЕДНИЕ|ЛЕДНИЕ|НИЕ)\s+БОИ\s+ВООРУЖЕННЫХ\s+СИЛ\s+ЮГА\s+РОССИИ"
HEADER_WORDS = (("CUA", "СИЛ"), ("POCCUH", "РОССИИ"), ("РОССИ", "РОССИИ"))
PROMPT_LEAK = r"^(?:Here's a step-bystep breakdown of the structural cleanup|1\.\s+\*\*Identify and remove artificial blank lines|This results in the REPAIRED PAGE output)\b"
BACK_MATTER = r"^(?:Именной указатель|СОДЕРЖАНИЕ|Научное издание|Научно-просветительное издание|Список иллюстраций\b|КОММЕНТАРИИ\b|Список\s+сокращен(?:ий|ИЯ)\b|КОРОТКО\s+ОБ\s+АВТОРАХ\b|СВЕДЕНИЯ\s+ОБ\s+АВТОРАХ\b|ABOUT\s+THE\s+AUTHORS\b|Вклейка\s+[A-ZА-ЯЁ])"
REFERENCES_START = r"^(?:список литературы|библиограф(?:ия|ический список)|references?)\b"
REFERENCE_CUE = r"(?:цит\.\s*соч\.|там же|references?|bibliography|список литературы|doi\b|isbn\b|источник:|//\s*http|http://|https://)"
NOTE_LINE = r"^\s*(?:\(?\d{1,3}\)|\[\d{1,3}\]|\d{1,3}[.)])\s+"
SECTION = r"^(?:ГЛАВА|Глава|CHAPTER|Chapter|ЧАСТЬ|Часть|PART|Part)\s+[IVXLCDM0-9]+(?:[.:]\s*|\s+|$)"
NUMBERED_SECTION = r"^\d+(?:\.\d+){1,4}\.?(?:\s+|$)"
BOUNDARY = r"^[—–-]\s*\S|^(?:[-•*]\s+|\d{1,3}[.)]\s+)"
CAPS_TITLE = r"(?=.*[А-ЯЁA-Z])[А-ЯЁA-Z0-9IVXLCDM][А-ЯЁA-Z0-9IVXLCDM\s«»\"'()\-]{2,}"
CONTINUES = r'^[«"“„(]*[а-яё]'
TERMINAL = r"[.!?…][\"'»”)]*$"
BIBLIOGRAPHY = r"\bСписок литературы\b[:.]?\s*"
FOOTNOTE_SUFFIX = r"(?<=[\w»”\"\)])(?:\?{0,2}\d+(?:[!?])?|\?{2})\)"
INLINE_HEADING = r'^(?:Глава|Часть|ЧАСТЬ)\s+[IVXLCDM0-9]+(?:[.:]\s*|\s+)(?:[«»"A-ZА-ЯЁ0-9 .,:;—–\-()]{3,160}\s+)?([а-яё].+)$'
LEADING_SECTION = r"^((?:Глава|Часть|ЧАСТЬ)\s+[IVXLCDM0-9]+(?:[.:]?\s+))(.+)$"
SECTION_NUMBER = r"^(Глава|Часть|ЧАСТЬ)\s+([IVXLCDM0-9]+)\.?\s*"
FIGURE = r"(?:Рис|Илл|Табл)\."
FIGURE_START = r"^(?:Рис|Илл|Табл)\.\s*\d+"
SENTENCES = r"\.\s+(?=[А-ЯЁа-яё])"
BODY_START = r'^[«"“„(]*[А-ЯЁа-яё][А-Яа-яёЁ\-]{2,}'
BODY_CUE = r"\b(?:это|этот|эта|эти|однако|поэтому|при этом|в результате|в данном|исследовател|археолог|можно|следует|позвол|показыва|служил|служила|служили|являл|являет|были|было|стал|стала|стали|оказал|оказыва|имеет|имели|обнаруж|применен|применя|доказыва|характериз|подтвержда|свидетельств|например|прежде|кроме|здесь|далее|первый|второй|вопрос|пример)\b"
SOURCE_CUE = r"\b(?:РГИА|РГАВМФ|ОР\s+БАН|АСП-\d+|Публикуется впервые|музей|архив)\b"
SECTION_BEFORE_FIGURE = r"^(?:Глава|Часть|ЧАСТЬ)\s+[IVXLCDM0-9]+(?:\.\s*|\s+).{3,120}?\s+(?=(?:Рис|Илл|Табл)\.)"
AUTHOR_BEFORE_FIGURE = r"^[А-ЯЁ]\.[А-ЯЁ]\.\s+[А-ЯЁ][а-яё]+(?:\.\s+|\s+).{10,180}?\s+(?=(?:Рис|Илл|Табл)\.)"
AUTHOR_TITLE = r"[А-ЯЁ]\.[А-ЯЁ]\.\s+[А-ЯЁ][а-яё]+(?:\.\s+|\s+).{10,160}"
TITLE = r"[А-ЯЁA-Z][^.!?…]{15,140}"
CAPTION_AT_END = r"^(.+?[.!?…»”)])\s+(?:Рис|Илл|Табл)\.\s*\d+[а-яё]?(?:\s*[–—-]\s*\d+[а-яё]?)?(?:\s*,\s*\d+[а-яё]?)?\.\s+.{3,260}$"
FIGURE_CAPTION = r"^(?:Рис|Илл|Табл)\.\s*\d+[а-яё]?(?:\s*[–—-]\s*\d+[а-яё]?)?(?:\s*,\s*\d+[а-яё]?)?\.\s+.{3,260}"


_DASH = "[-‐‑]"


def _any(words) -> str:
    return "|".join(words)


def unhyphenated(text: Column) -> Column:
    """Words that OCR or line ends broke at hyphens, put together; up to four rounds of five passes, each one alternation whose
    first branch keeps what is right (with a plain hyphen) and whose last joins the rest."""
    kept = [p.split("-") for p in PAIRS]
    spaced_keep = "|".join(rf"\b({a}){_DASH}\s+({b})(?![A-Za-zА-Яа-яЁё])" for a, b in kept)
    n = len(kept)

    def passes(t: Column) -> Column:
        # the mark \x02 stands for a kept hyphen; where a branch doesn't match, it is alone and goes
        tidy = lambda c: F.replace(sub(c, r"(?<![A-Za-zА-Яа-яЁё])\x02|\x02(?![A-Za-zА-Яа-яЁё])", ""), F.lit("\x02"), F.lit("-"))
        t = sub(t, rf"([A-Za-zА-Яа-яЁё]{{3,}}){_DASH}\s*\n\s*([a-zа-яё][A-Za-zА-Яа-яЁё]{{2,}})", "$1$2")
        t = sub(t, rf"([A-Za-zА-Яа-яЁё]+){_DASH}\s*\n\s*([a-zа-яё][A-Za-zА-Яа-яЁё]*)", "$1-$2")
        long_ = rf"\b([A-Za-zА-Яа-яЁё]{{7,}}[оеОЕ]){_DASH}\s+([a-zа-яё][A-Za-zА-Яа-яЁё]{{5,}})"
        t = sub(t, rf"{long_}", "$1\x02$2")
        t = sub(t, spaced_keep, "".join(f"${2 * i + 1}\x03${2 * i + 2}" for i in range(n)), "i")
        t = sub(t, r"(?<![A-Za-zА-Яа-яЁё])\x03+|\x03+(?![A-Za-zА-Яа-яЁё])", "")
        t = sub(t, r"\x03+", "\x02")
        t = sub(t, rf"\b([A-Za-zА-Яа-яЁё]+){_DASH}\s+([a-zа-яё][A-Za-zА-Яа-яЁё]*)", "$1$2")
        t = tidy(t)
        whole = _any(PAIRS).replace("-", _DASH)
        t = sub(t, rf"\b(?!(?i:{whole})\b)([A-Za-zА-Яа-яЁё]{{1,3}}){_DASH}([a-zа-яё]{{4,}})\b", "$1$2")
        t = sub(t, rf"\b([A-Za-zА-Яа-яЁё]{{4,}}){_DASH}(?!то\b)([a-zа-яё]{{1,3}})\b", "$1$2")
        inner = _any((*PAIRS, *INNER_PAIRS)).replace("-", _DASH)
        keep = rf"(?!(?i:{inner})\b)(?!(?i:{_any(INNER_LEFTS)}){_DASH})(?![А-Яа-яЁё]{{2}}{_DASH}[а-яё]{{2}}\b)"
        return sub(t, rf"\b{keep}([А-Яа-яЁё]{{2,5}}){_DASH}(?!(?:{_any(INNER_RIGHTS)})\b)([а-яё]{{2,4}})\b", "$1$2")

    # a round changes nothing where no hyphen stands between letters, nor after one that changed nothing
    may = lambda t: has(t, rf"\p{{L}}{_DASH}\s*\p{{L}}|[\x02\x03]")
    again = lambda f: lambda t: let(passes(t), lambda made: F.when(made == t, t).otherwise(f(made)))
    rounds = passes
    for _ in range(3):
        rounds = again(rounds)
    return let(text, lambda t: F.when(may(t), rounds(t)).otherwise(t))


def _cased(word: Column, to: Column) -> Column:
    shout = (F.upper(word) == word) & (F.lower(word) != word)
    return F.when(shout, F.upper(to)).when(has(word, r"^\p{Lu}"), F.concat(F.upper(F.substring(to, 1, 1)), F.substr(to, F.lit(2)))).otherwise(to)


def replaced_words(text: Column, table: dict[str, str]) -> Column:
    """Whole words of a table (in any case) by what they should be, in the case of the word. The words of the tables are Cyrillic."""
    known = {k.lower(): v for k, v in table.items()}
    lookup = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    least = min(map(len, known))

    def replaced(t: Column) -> Column:
        parts = F.regexp_extract_all(t, F.lit(r"(?dU)\w+|\W+"), F.lit(0))
        one = lambda w: let(F.lower(w), lambda low: F.when(low.isin(*known), _cased(w, lookup[low])).otherwise(w))
        return joined(F.transform(parts, lambda w: F.when((F.length(w) >= least) & has(w, "^[А-Яа-яЁё]"), one(w)).otherwise(w)), "")

    return let(F.coalesce(text, F.lit("")), lambda t: F.when(has(t, rf"[А-Яа-яЁё]{{{least}}}"), replaced(t)).otherwise(t))


def joined_splits(text: Column, table: dict[str, str] = SPLITS) -> Column:
    def replaced(t: Column) -> Column:
        for wrong, right in table.items():
            for f in (str, str.capitalize, str.upper):
                t = sub(t, rf"\b{f(wrong)}\b", f(right))
        return t

    some = lambda t: reduce(or_, [t.contains(f(wrong)) for wrong in table for f in (str, str.capitalize, str.upper)])
    return let(text, lambda t: F.when(some(t), replaced(t)).otherwise(t))


def bullets(text: Column) -> Column:
    inline = sub(sub(text, r"^\s*[xхXХ]\s+(?=[A-Za-zА-Яа-яЁё])", "- "), r"(?<=[;:])\s*[xхXХ]\s+(?=[A-Za-zА-Яа-яЁё])", "\n- ")
    return joined(F.transform(lines(inline), lambda x: F.regexp_replace(x, "(?dU)" + P.OCR_BULLET, "- ")))


def without_mojibake(text: Column) -> Column:
    """Garbled runs at the start of a line, or after its number, go."""

    def clean(x: Column) -> Column:
        y = sub(strip(x), rf"^(?!\d+\.\d+\.\s+){GARBLE}?\s+(?=[А-ЯЁ][а-яё])", "")
        y = sub(y, rf"(\b\d+\.\d+\.\s+){GARBLE}?\s+(?=[А-ЯЁ][а-яё])", "$1")
        return strip(sub(sub(y, rf"(\b\d+\.\d+\.\s+){GARBLE}$", "$1"), P.SPACE_RUN, " "))

    return joined(F.transform(lines(text), lambda x: F.when(has(x, MOJIBAKE), clean(x)).otherwise(x)))


def without_markers(text: Column) -> Column:
    """Texts without markers of an index and of gaps, names in angle brackets bare, and arrows as dashes."""
    return F.replace(sub(sub(sub(text, INDEX_MARKER, "", "i"), PLACEHOLDER, ""), ANGLE_TEXT, "$1"), F.lit("—>"), F.lit("—"))


def without_inner_headers(text: Column) -> Column:
    """A running header in capitals inside a broken word goes."""
    return sub(text, CAPS_IN_WORD, "$1 $2")


def without_bibliography_headings(text: Column) -> Column:
    return sub(text, BIBLIOGRAPHY, "", "i")


def normalized_document(text: Column) -> Column:
    """The first pass: invisible characters, markers, hyphens, compounds, bibliography headings, mojibake, bullets, blank lines."""
    t = sub(F.coalesce(text, F.lit("")), r"\r\n?", "\n")
    t = without_markers(sub(F.replace(t, F.lit(P.SOFT_HYPHEN), F.lit("")), P.ZERO_WIDTH, ""))
    t = unhyphenated(without_inner_headers(t))
    t = replaced_words(joined_splits(replaced_words(t, COMPOUNDS)), JOINED)
    t = bullets(without_mojibake(without_bibliography_headings(t)))
    return strip(sub(sub(F.replace(t, F.lit("\t"), F.lit(" ")), r"[ \t]+\n", "\n"), r"\n{3,}", "\n\n"))


def without_page_numbers(text: Column) -> Column:
    return sub(sub(text, rf"^\s*\d{{1,4}}\s+(?={PAGE_HEADING})", "", "m"), rf"(?<!\n)[ \t]+\d{{1,4}}\s+(?={PAGE_HEADING})", "\n")


def is_running_header(line: Column) -> Column:
    def told(x: Column) -> Column:
        for wrong, right in HEADER_WORDS:
            x = sub(x, rf"\b{wrong}\b", right)
        return full(x, RUNNING_HEADER)

    x = strip(sub(sub(F.upper(line), "[`'\"“”„<>|=+_~*.,:;!?-]+", " "), P.SPACE_RUN, " "))
    # every running header has this letter
    return line.isin(*RUNNING_HEADERS) | (has(line, "[оО\u1c82]") & told(x))


def without_headers(text: Column) -> Column:
    tidy = lambda x: strip(sub(sub(x, HEADER_NOISE, " "), P.SPACE_RUN, " "))
    made = F.transform(lines(text), lambda x: F.struct(blank(x).alias("blank"), tidy(strip(x)).alias("x")))
    keep = F.filter(made, lambda s: s["blank"] | ((s["x"] != "") & ~is_running_header(s["x"]) & ~full(s["x"], NOISE_ONLY)))
    return joined(F.transform(keep, lambda s: F.when(s["blank"], "").otherwise(s["x"])))


def is_reference_like(x: Column) -> Column:
    cue = has(x, REFERENCE_CUE, "i")
    return (cue & ((F.length(x) < 260) | has(x, NOTE_LINE) | (count(x, r"\b(?:19|20)\d{2}\b") >= 2))) | (x.contains(" // ") & (count(x, " // ") >= 2))


def _cut(text: Column, first: Column, leak: bool, starts: str) -> Column:
    """The text before the first line that begins back matter."""

    def run(x: Column) -> Column:
        n = F.size(x)

        def probable(i: Column) -> Column:
            sample = F.slice(F.filter(F.transform(F.slice(x, i + 1, n), strip), lambda y: y != ""), 1, 40)
            support = tally(sample, lambda y: has(y, BACK_MATTER, "i") | has(y, REFERENCES_START, "i") | is_reference_like(y) | ((F.length(y) <= 100) & ~has(y, TERMINAL)))
            late = (i >= F.floor(n * 0.75)) & (support >= 0.7 * F.size(sample))
            return (n <= 1) | F.when(n <= 40, i >= F.greatest(F.lit(1), F.floor(n / 3))).otherwise((i >= F.floor(n * 0.9)) | late)

        hit = lambda i: F.lit(leak) & has(strip(F.get(x, i)), PROMPT_LEAK, "i") | (has(strip(F.get(x, i)), starts, "i") & probable(i))
        start = first(n)
        cut = F.when(start < n, F.get(F.filter(F.sequence(start, n - 1), hit), 0))
        return let(cut, lambda c: F.when(c.isNull(), text).otherwise(rstrip(joined(F.slice(x, 1, c)))))

    return let(lines(text), lambda x: F.when(F.size(x) == 0, text).otherwise(run(x)))


def without_back_matter(text: Column) -> Column:
    first = lambda n: F.greatest(F.lit(1), F.when(n <= 40, F.floor(n / 3)).otherwise(F.floor(n * 0.6))).cast("int")
    return _cut(text, first, True, BACK_MATTER)


def without_reference_tail(text: Column) -> Column:
    return _cut(text, lambda n: F.greatest(F.lit(1), F.floor(n * 0.75)).cast("int"), False, REFERENCES_START)


def clean_sentence(line: Column) -> Column:
    def told(x: Column) -> Column:
        y = F.replace(sub(sub(sub(x, URL, "", "i"), PLACEHOLDER, ""), ANGLE_TEXT, "$1"), F.lit("—>"), F.lit("—"))
        y = sub(sub(sub(y, FOOTNOTE_SUFFIX, ""), r"\s+//\s+https?://\S+", "", "i"), r"\s+\(\s*\)", "")
        y = F.btrim(strip(sub(sub(y, r"\s+([.,;:!?…])", "$1"), P.SPACE_RUN, " ")), F.lit(";:,"))
        listed = lambda y: F.when(x.startswith("- "), strip(F.concat(F.lit("- "), strip(sub(y, r"^[- ]+", ""))))).otherwise(strip(y))
        return let(y, listed)

    return let(strip(line), told)


def line_fate(line: Column) -> Column:
    """struct(text, why): the cleaned line, or why it goes."""

    def told(cut: Column, made: Column, reference: Column) -> Column:
        why = (
            F.when(cut == "", "reference_like").when(has(cut, PROMO, "i"), "promo").when(reference & has(cut, NOTE_LINE), "note_like").when(reference, "reference_like").when(F.length(made) <= 2, "short")
        )
        return F.struct(made.alias("text"), F.when(blank(line), F.lit(None).cast("string")).otherwise(why).alias("why"))

    cut = lambda x: F.when(x.contains("Источник:"), strip(sub(x, r"\bИсточник:\b.*$", "", "i"))).otherwise(x)
    return let(let(strip(line), cut), lambda c: let(F.struct(clean_sentence(c).alias("made"), is_reference_like(c).alias("reference")), lambda k: told(c, k["made"], k["reference"])))


def is_heading_token(token: Column) -> Column:
    """Numbers, and words of which all letters of the two alphabets are capitals."""
    return let(F.btrim(token, F.lit("«»\"'“”„()[]{}:;,.!?—–-")), lambda x: full(x, "[IVXLCDM0-9]+") | (~has(x, "[a-zа-яё]") & has(x, "[A-ZА-ЯЁ]")))


def tokens(line: Column) -> Column:
    return let(compact(line), lambda x: F.when(x == "", F.array().cast(STRINGS)).otherwise(F.split(x, " ")))


def is_heading(line: Column) -> Column:
    def told(x: Column) -> Column:
        caps = (F.length(x) <= 90) & ~has(x, "[a-zа-яё]") & full(x, CAPS_TITLE)
        shout = (F.length(x) <= 220) & ~has(x, "[А-ЯЁA-Z][а-яёa-z]") & has(x, "[A-ZА-ЯЁ0-9]") & (tally(tokens(x), is_heading_token) >= 3)
        listed = has(x, SECTION) | ((F.length(x) <= 140) & has(x, NUMBERED_SECTION))
        return (x != "") & (listed | F.when(caps, count(x, "[А-ЯЁA-Z]") >= 4).otherwise(shout))

    return let(strip(line), told)


def is_boundary(line: Column) -> Column:
    return let(strip(line), lambda x: (F.coalesce(x, F.lit("")) != "") & (is_heading(x) | has(x, BOUNDARY)))


def is_open(line: Column) -> Column:
    """Whether a sentence goes on after a line (null: no line)."""
    return F.coalesce(let(strip(line), lambda x: (x != "") & ~has(x, TERMINAL) & ~is_boundary(x)), F.lit(False))


def without_intrusions(x: Column) -> Column:
    """Headings that stand between two halves of a sentence go: lines of their own first, then those before the second half."""
    inner = lambda line, i: (i > 0) & (i < F.size(x) - 1) & has(strip(F.get(x, i + 1)), CONTINUES) & is_heading(line) & is_open(F.get(x, i - 1))
    kept = F.filter(x, lambda line, i: ~F.coalesce(inner(line, i), F.lit(False)))
    rest = lambda line: F.regexp_extract(strip(line), "(?dU)" + INLINE_HEADING, 1)
    cut = lambda k, line, i: let(rest(line), lambda r: F.when((r != "") & (i > 0) & is_open(F.get(k, i - 1)), r).otherwise(line))
    return let(kept, lambda k: F.transform(k, lambda line, i: cut(k, line, i)))


def split_caps_headings(x: Column) -> Column:
    """A run of three or more capital words before a sentence is a line of its own."""

    def one(line: Column) -> Column:
        def cut(t: Column) -> Column:
            n = F.coalesce(F.array_min(F.transform(t, lambda w, i: F.when(~is_heading_token(w), i))), F.size(t))
            ok = lambda n, head: (n >= 3) & (n < F.size(t)) & has(F.get(t, n), "^[А-ЯЁA-Z][а-яёa-z]") & (F.length(head) >= 18) & ~has(strip(line), r"^(?:Глава|ГЛАВА|Часть|ЧАСТЬ|Chapter|CHAPTER|Part|PART) ")
            made = lambda n, head: F.when(ok(n, head), F.array(head, joined(F.slice(t, n + 1, F.size(t)), " "))).otherwise(F.array(line))
            return let(n, lambda n: made(n, joined(F.slice(t, 1, n), " ")))

        # the first three words have no small letters
        may = has(line, r"^\s*(?:[^\sa-zа-яё]+\s+){3}")
        return F.when(may, let(tokens(line), cut)).otherwise(F.array(line))

    return F.flatten(F.transform(x, one))


def _longest(known: Column, line: Column, same: bool) -> Column:
    """The longest of the known headings that the line begins with (or is); null if there is none."""
    hits = F.filter(known, lambda h: line.startswith(F.concat(h, F.lit(" "))) | (F.lit(same) & (line == h)))
    return F.array_max(F.transform(hits, lambda h: F.struct(F.length(h).alias("n"), h.alias("h"))))["h"]


def _after(line: Column, head: Column) -> Column:
    return strip(F.substr(line, F.length(head) + 1))


def _heading_state(*lists: str) -> tuple[Column, str]:
    kind = f"struct<{','.join(f'{n}:{STRINGS}' for n in lists)}>"
    return F.struct(*[F.array().cast(STRINGS).alias(n) for n in lists]).cast(kind), kind


def without_repeated_headings(x: Column) -> Column:
    """Titles that are repeated at the start of later lines go from there; those before a figure's caption in any case."""
    start, kind = _heading_state("out", "seen")

    def merge(s: Column, raw: Column) -> Column:
        def placed(line: Column) -> Column:
            figure = has(line, FIGURE, "i")
            bare = F.when(figure, sub(sub(line, SECTION_BEFORE_FIGURE, "", "i"), AUTHOR_BEFORE_FIGURE, "", "i")).otherwise(line)

            def told(y: Column) -> Column:
                head = _longest(s["seen"], y, False)
                rest = _after(y, head)
                z = F.when(head.isNotNull() & (rest != "") & (figure | ~is_heading(rest)), rest).otherwise(y)

                def ended(w: Column) -> Column:
                    title = ~figure & (F.length(w) <= 180) & (full(w, TITLE) | is_heading(w) | full(w, AUTHOR_TITLE))
                    return let(title, lambda title: kept(w, title))

                def kept(w: Column, title: Column) -> Column:
                    return F.struct(F.concat(s["out"], F.array(F.when(title, raw).otherwise(w))).alias("out"), F.when(title & ~F.array_contains(s["seen"], w), F.concat(s["seen"], F.array(w))).otherwise(s["seen"]).alias("seen")).cast(kind)

                return let(z, ended)

            return let(strip(bare), told)

        return F.when(blank(raw), F.struct(F.concat(s["out"], F.array(raw)).alias("out"), s["seen"].alias("seen")).cast(kind)).otherwise(let(compact(raw), placed))

    return folded(x, start, kind, merge)


def first_headings_only(x: Column) -> Column:
    """A section heading that begins a line is a line of its own where it is first met, and goes wherever it comes again."""
    start, kind = _heading_state("out", "seen", "keys")

    def add(s: Column, more: Column, heading: Column | None = None, key: Column | None = None) -> Column:
        grown = lambda name, v: F.concat(s[name], F.array(v)) if v is not None else s[name]
        return F.struct(F.concat(s["out"], more).alias("out"), grown("seen", heading).alias("seen"), grown("keys", key).alias("keys")).cast(kind)

    def merge(s: Column, raw: Column) -> Column:
        line = strip(raw)
        some = lambda t: F.filter(F.array(t), lambda y: y != "")

        def fresh(label: Column, t: Column) -> Column:
            n = F.coalesce(F.array_min(F.transform(t, lambda w, i: F.when(~is_heading_token(w), i))), F.size(t))
            heading = strip(F.concat(strip(label), F.lit(" "), joined(F.slice(t, 1, n), " ")))
            key = compact(sub(heading, SECTION_NUMBER, "$1 $2 "))
            rest = joined(F.slice(t, n + 1, F.size(t)), " ")
            new = add(s, F.concat(F.array(heading), some(rest)), heading, key)
            return F.when((label == "") | (n == 0), add(s, F.array(raw))).when(F.array_contains(s["keys"], key), add(s, some(rest))).otherwise(new)

        head = _longest(s["seen"], line, True)
        label, body = (F.regexp_extract(line, "(?dU)" + LEADING_SECTION, g) for g in (1, 2))
        return F.when(line == "", add(s, F.array(raw))).when(head.isNotNull(), add(s, some(_after(line, head)))).otherwise(let(tokens(body), lambda t: fresh(label, t)))

    return F.when(F.exists(x, lambda y: has(strip(y), LEADING_SECTION)), folded(x, start, kind, merge)).otherwise(x)


def is_body_like(text: Column, before: Column) -> Column:
    """Whether what stands after a caption reads like the text that it broke."""
    x, n = compact(text), n_words(text)
    told = has(x, CONTINUES) | has(x, BODY_CUE, "i") | (has(before, SOURCE_CUE, "i") & (n >= 6)) | ((F.length(x) >= 90) & (n >= 12)) | has(x, TERMINAL) | x.contains(". ")
    return (F.length(x) >= 25) & (n >= 4) & has(x, BODY_START) & told


def _cut_caption(line: Column) -> Column:
    """What follows a caption that begins a line, from the first sentence that reads like body text; null if none does."""

    def run(p: Column) -> Column:
        head = lambda k: F.concat(joined(F.slice(p, 1, k), ". "), F.lit("."))
        rest = lambda k: strip(joined(F.slice(p, k + 1, F.size(p)), ". "))
        fits = lambda k: has(head(k), FIGURE_START, "i") & (n_words(head(k)) >= 4) & is_body_like(rest(k), head(k))
        return F.when(F.size(p) > 1, let(F.get(F.filter(F.sequence(F.lit(1), F.size(p) - 1), fits), 0), lambda k: F.when(k.isNotNull(), rest(k))))

    return F.when(has(line, "^" + FIGURE, "i"), let(F.split(line, "(?dU)" + SENTENCES), run))


def without_captions(x: Column) -> Column:
    """Captions at the start, inside and at the end of lines go, as do lines that are captions and bibliography headings."""

    def inline(line: Column) -> Column:
        at = F.regexp_instr(line, F.lit("(?dUi)(?<![(\\[])" + FIGURE))

        def run(i: Column) -> Column:
            head, tail = strip(F.substr(line, F.lit(1), i - 1)), strip(F.substr(line, i))
            later = F.regexp_extract(tail, r"(?dU)^.*\.\s+([а-яё][а-яё-]{2,}.*)$", 1)
            kept = F.coalesce(_cut_caption(tail), F.when(F.length(later) >= 12, later))
            return F.when((i > 1) & ~has(line, r"^(?:Рис|Илл|Табл)\."), strip(compact(F.concat_ws(" ", head, kept)))).otherwise(line)

        return let(at, run)

    def one(line: Column) -> Column:
        y = line
        for _ in range(2):
            y = let(y, lambda t: F.coalesce(_cut_caption(t), t))
        y = let(let(y, inline), lambda t: F.coalesce(F.when(has(t, CAPTION_AT_END, "i"), F.regexp_extract(t, "(?dUi)" + CAPTION_AT_END, 1)), t))
        return y

    bare = F.transform(x, lambda y: F.when(blank(y), y).otherwise(strip(sub(compact(y), BIBLIOGRAPHY, "", "i"))))
    told = lambda y: has(y, r"(?<![(\[])" + FIGURE, "i")
    several = lambda y: has(y, r"^(?:Рис|Илл|Табл)\.") & (count(y, FIGURE) >= 2)
    made = F.transform(bare, lambda y: F.when(told(y), one(y)).otherwise(y))
    return F.filter(made, lambda y, i: ~(full(y, FIGURE_CAPTION, "i") | several(y) | ((y == "") & ~blank(F.get(x, i)))))


def starts_paragraph(previous: Column, line: Column) -> Column:
    """Whether a line begins a paragraph after the line before it (null: none). Both are struct(x, boundary), x stripped."""
    goes_on = has(line["x"], r"^\p{Ll}") | has(previous["x"], r"[,;:—(\-]\z")
    return previous.isNull() | (previous["x"] == "") | previous["boundary"] | line["boundary"] | (has(previous["x"], TERMINAL) & ~goes_on)


def restored_paragraphs(x: Column) -> Column:
    """Lines of a paragraph as one; blank lines end paragraphs, headings and list items stand alone."""

    def build(s: Column) -> Column:
        starts = F.filter(F.transform(s, lambda y, i: F.when((y["x"] != "") & starts_paragraph(F.when(i > 0, F.get(s, i - 1)), y), i)), lambda i: i.isNotNull())
        part = lambda a, b: strip(sub(joined(F.filter(F.transform(F.slice(s, a + 1, b - a), lambda y: y["x"]), lambda y: y != ""), " "), P.SPACE_RUN, " "))
        return let(starts, lambda st: F.transform(st, lambda a, k: part(a, F.coalesce(F.get(st, k + 1), F.size(s)))))

    told = lambda y: let(strip(F.coalesce(y, F.lit(""))), lambda z: F.struct(z.alias("x"), is_boundary(z).alias("boundary")))
    return F.when(F.size(x) == 0, F.array().cast(STRINGS)).otherwise(let(F.transform(x, told), build))


def cleaned_documents(docs: DataFrame, text: str = "text", out: str = "clean_text") -> DataFrame:
    """docs with the cleaned text and removed_{sentences,promos,note_like,reference_like}: how many lines went and why."""
    d = docs.withColumn("_t", let(F.col(text), normalized_document))
    for f in (without_page_numbers, without_headers, without_back_matter, without_reference_tail):
        d = d.withColumn("_t", let(F.col("_t"), f))
    d = d.withColumn("_l", F.transform(lines(F.col("_t")), line_fate))
    n = lambda *why: tally(F.col("_l"), lambda s: s["why"].isin(*why)).cast("bigint")
    d = d.withColumn("removed_sentences", tally(F.col("_l"), lambda s: s["why"].isNotNull()).cast("bigint")).withColumn("removed_promos", n("promo"))
    d = d.withColumn("removed_note_like", n("note_like")).withColumn("removed_reference_like", n("note_like", "reference_like"))
    d = d.withColumn("_l", F.transform(F.filter("_l", lambda s: s["why"].isNull()), lambda s: s["text"]))
    d = d.withColumn("_l", F.filter("_l", lambda y, i: (y != "") | ((i > 0) & (F.get(F.col("_l"), i - 1) != ""))))
    for f in (without_intrusions, without_repeated_headings, first_headings_only, split_caps_headings, without_captions, restored_paragraphs):
        d = d.withColumn("_l", let(F.col("_l"), f))
    end = lambda t: sub(replaced_words(joined_splits(replaced_words(unhyphenated(t), COMPOUNDS)), JOINED), r"\n{2,}", "\n")
    return d.withColumn(out, let(strip(joined(F.col("_l"))), end)).drop("_t", "_l")


__all__ = ["cleaned_documents", "clean_sentence", "n_words", "normalized_document", "restored_paragraphs", "solid_lines", "unhyphenated"]
