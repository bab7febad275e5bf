"""Main text of HTML pages: page differencing against the nearest URL of the same host."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, deque
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ranged, released, table

#: Elements that start a block of their own.
BLOCKS = set("address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
#: Elements that never end, and those whose content isn't text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("script style noscript template iframe object svg math canvas audio video head title".split())
#: Elements, roles and words of class or id that mark what isn't the article.
OUTSIDE = set("nav header footer aside form menu dialog button select textarea fieldset".split())
ROLES = set("navigation banner contentinfo complementary search alert dialog menu menubar form".split())
#: Words of class and id attributes of menus, headers, footers, sidebars, notices, adverts, forms and comments.
NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs pagination pager "
    "header masthead topbar footer colophon copyright sidebar aside widget related recommended share sharing social cookie cookies consent notice notices alert popup modal "
    "newsletter subscribe subscription signup login search comment comments reply replies respond disqus".split()
)
#: Words that only place or shape what another word names (site-header, ad-slot), and those that name whose it is (post-comments).
PLAIN = set("site page main top bottom left right global primary secondary list area section box container wrapper wrap block bar links link slot unit inner outer row item items group button buttons label text inline the".split())
OWNERS = set("post article entry story user reader".split())
OWN_PARTS = {"header", "footer", "banner", "masthead"}
ARTICLE = {"article", "main"}
_P_ENDS = BLOCKS - {"br", "button", "body", "html", "option"}
_ITEMS = set("li dd dt tr td th option".split())
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
LINES = "array<struct<text:string,place:int>>"
#: Pages before and after in the order of URLs that a page may be compared with, and how many of them it is.
AROUND, COMPARED = 3, 2
#: Two pages are the same article at two addresses if less than this share of the characters of one isn't in the other.
SAME = 0.1


def outside_name(names: str, article: bool) -> bool:
    """Whether one of the names of a class or id attribute is, as a whole, that of a part which isn't main text.

    Each word of the name must say so or add nothing to it: comment-list is such a name, comment-on-budget and
    article-header aren't. Inside an article a header or footer is the article's own."""
    for name in names.split():
        words = {w.lower() for w in _WORD.findall(name)}
        parts = words & NAMES
        if article or words & OWNERS:
            parts -= OWN_PARTS
        if parts and words <= NAMES | PLAIN | OWNERS:
            return True
    return False


class _Lines(HTMLParser):
    """Text lines of a page, each with its place: 2 in the article, 1 elsewhere in the body, 0 in what isn't main text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, bool, bool]] = []  # (tag, unseen, outside, article)
        self.lines: list[tuple[str, int]] = []
        self.part: list[str] = []
        self.place = 1
        self.count: Counter[str] = Counter()

    def _state(self) -> tuple[bool, bool, bool]:
        return self.open[-1][1:] if self.open else (False, False, False)

    def _end_line(self) -> None:
        text = _SPACE.sub(" ", "".join(self.part)).strip()
        if text:
            self.lines.append((text, self.place))
        self.part = []

    def _pop(self, k: int) -> None:
        self.count.subtract(tag for tag, *_ in self.open[k:])
        del self.open[k:]

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._end_line()
        if tag in _P_ENDS and self.count["p"]:
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == "p":
                    self._pop(k)
                    break
                if self.open[k][0] in BLOCKS:
                    break
        if tag in _ITEMS and self.count[tag]:
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == tag:
                    self._pop(k)
                    break
                if self.open[k][0] in ("ul", "ol", "dl", "table", "menu", "select"):
                    break
        if tag in VOID:
            return
        unseen, outside, article = self._state()
        found = dict(attrs)
        # a header inside an article is the article's own
        outer = tag in OUTSIDE and not (tag in ("header", "footer") and article) or (found.get("role") or "").lower() in ROLES or "hidden" in found
        outer |= tag not in ("html", "body", "article", "main") and outside_name(f"{found.get('class') or ''} {found.get('id') or ''}", article)
        self.count[tag] += 1
        self.open.append((tag, unseen or tag in UNSEEN, outside or outer, article or (tag in ARTICLE and not outside)))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self._end_line()
        if not self.count[tag]:
            return
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self._pop(k)
                break
            if self.open[k][0] in ARTICLE and tag not in ("body", "html", "main", "article"):
                break

    def handle_data(self, data):
        unseen, outside, article = self._state()
        if unseen:
            return
        place = 0 if outside else 2 if article else 1
        if place != self.place:
            self._end_line()
            self.place = place
        self.part.append(data)


def page_lines(text: str) -> list[tuple[str, int]]:
    parser = _Lines()
    parser.feed(text)
    parser.close()
    parser._end_line()
    return parser.lines


def shared(a: list, b: list) -> set[int]:
    """The indexes in a of a longest common subsequence of a and b (Hunt and Szymanski: by matching pairs, not by the product of lengths)."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    where: dict[object, list[int]] = {}
    for j in range(start, len(b) - end):
        where.setdefault(b[j], []).append(j)
    tails: list[int] = []
    ends: list[tuple] = []
    for i in range(start, len(a) - end):
        for j in reversed(where.get(a[i], ())):
            k = bisect_left(tails, j)
            link = (i, ends[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                ends.append(link)
            else:
                tails[k], ends[k] = j, link
    out, link = {*range(start), *range(len(a) - end, len(a))}, ends[-1] if ends else None
    while link:
        out.add(link[0])
        link = link[1]
    return out


def common_lines(own: list[str], others: Iterable[list[str]]) -> set[int]:
    """The indexes of a page's lines that the first COMPARED of the others have, too; others that are the same page don't count."""
    out: set[int] = set()
    left = COMPARED
    size = sum(map(len, own))
    for other in others:
        if not left:
            break
        found = shared(own, other)
        common = sum(len(own[i]) for i in found)
        if size - common < SAME * size or sum(map(len, other)) - common < SAME * sum(map(len, other)):
            continue
        out |= found
        left -= 1
    return out


def main_text(lines: list[tuple[str, int]], common: set[int]) -> str:
    """The text of a page without the lines that it has in common with its neighbours. Lines of marked menus and the like go in any case;
    where the page marks its article, that is the text, and its lines stay though a neighbour may quote them."""
    marked = any(p == 2 for _, p in lines)
    return "\n".join(t for i, (t, p) in enumerate(lines) if p == 2 or p == 1 and not marked and i not in common)


def location(url: Column) -> Column:
    """What pages are ordered by: host, then path, without scheme, query, fragment and what only varies the name of a page."""
    bare = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://|[?#].*$", "")
    return F.regexp_replace(bare, r"(/|/index)?(\.html?|\.php)?/*$", "")


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of the main text of each row; n_common, its lines that neighbours have, too, and marked, whether it marks its article.

    Pages stand in the order of host and path (then page_id, then a hash of the html). A page is compared with COMPARED of
    the AROUND pages before and after it on its host, those first that share more of the path (the later one, on ties);
    pages that are the same article are passed over. Null html has no text; rows that repeat are pages.
    """
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    host = F.split(location(F.col("url")), "/")[0]
    key = F.struct(host.alias("host"), location(F.col("url")).alias("path"), F.col("page_id").alias("id"), F.xxhash64("html").alias("h"))
    rows, ends = ranged(p.withColumn("_key", key).withColumn("_size", F.octet_length("html")), "_key", "_size", AROUND)
    # the AROUND keys next to each range: ends of the ranges that are as near
    steps = F.explode(F.sequence(F.lit(1), F.lit(AROUND))).alias("step")
    after = ends.where("place > 0").select("*", steps).select((F.col("_range") - F.col("step")).alias("to"), F.col("key"), F.row_number().over(W.partitionBy(F.col("_range") - F.col("step")).orderBy("key")).alias("near"))
    before = ends.where("place < 0").select("*", steps).select((F.col("_range") + F.col("step")).alias("to"), F.col("key"), F.row_number().over(W.partitionBy(F.col("_range") + F.col("step")).orderBy(F.desc("key"))).alias("near"))
    moves = after.unionByName(before).where(F.col("near") <= AROUND).select("to", F.col("key").alias("edge"))
    copies = rows.join(F.broadcast(moves), F.col("_key") == F.col("edge")).withColumn("_range", F.col("to")).drop("to", "edge").dropDuplicates(["_range", "_key"])
    rows = rows.withColumn("_copy", F.lit(False)).unionByName(copies.withColumn("_copy", F.lit(True))).select("page_id", "url", "html", "_range", "_copy", "_key")
    id_type = dict(p.dtypes)["page_id"]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_lines = pa.list_(pa.struct([("text", pa.string()), ("place", pa.int32())]))
        for batch in batches:
            lines = [[{"text": t, "place": q} for t, q in page_lines(h)] for h in batch.column(2).to_pylist()]
            kept = [batch.column(i) for i in (0, 1, 3, 4, 5)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(lines, of_lines)], ["page_id", "url", "_range", "_copy", "_key", "_lines"])

    kind: list[pa.DataType] = []

    def in_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[dict]]]:
        """Each row that isn't a copy with its neighbours on its host, nearest path first; a few rows are held at a time."""
        behind: deque[dict] = deque(maxlen=AROUND)
        ahead: deque[dict] = deque()

        def take(least: int) -> Iterator[tuple[dict, list[dict]]]:
            while len(ahead) > least:
                row = ahead.popleft()
                near = [x for pair in zip([*ahead, *[None] * AROUND], [*reversed(behind), *[None] * AROUND]) for x in pair if x and x["host"] == row["host"]]
                behind.append(row)
                if not row["_copy"]:
                    yield row, sorted(near, key=lambda x: -len(commonprefix([x["path"], row["path"]])))

        for batch in batches:
            kind[:] = [batch.schema.field(0).type]
            for row in batch.to_pylist():
                if ahead and ahead[-1]["_range"] != row["_range"]:
                    yield from take(0)
                    behind.clear()
                row |= {"host": row["_key"]["host"], "path": row["_key"]["path"], "texts": [x["text"] for x in row["_lines"]]}
                ahead.append(row)
                yield from take(AROUND)
        yield from take(0)

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch() -> pa.RecordBatch:
            ids, urls, texts, common, marked = zip(*held)
            return pa.RecordBatch.from_arrays([pa.array(ids, kind[0]), pa.array(urls, pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array(common, pa.int64()), pa.array(marked, pa.bool_())], ["page_id", "url", "text", "n_chars", "n_common", "marked"])

        held, size = [], 0
        for row, near in in_ranges(batches):
            lines = [(x["text"], x["place"]) for x in row["_lines"]]
            common = common_lines(row["texts"], (x["texts"] for x in near))
            held.append((row["page_id"], row["url"], main_text(lines, common), len(common), any(q == 2 for _, q in lines)))
            size += len(held[-1][2])
            if size > 1 << 22:
                yield batch()
                held, size = [], 0
        if held:
            yield batch()

    rows = rows.mapInArrow(released(parse), f"page_id {id_type}, url string, _range int, _copy boolean, _key {dict(rows.dtypes)['_key']}, _lines {LINES}")
    rows = rows.repartition("_range").sortWithinPartitions("_range", "_key")
    return rows.mapInArrow(released(pair), f"page_id {id_type}, url string, text string, n_chars bigint, n_common bigint, marked boolean")


def op5_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


QUERIES = {"op5_page_text": op5_page_text}
ORACLES: dict[str, str] = {}
