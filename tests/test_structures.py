"""Segments, rectangles, split words, projections, model stages, folds, sources and sinks against brute force and awkward rows."""

import io
import json
import random
import subprocess
import sys
import time
import zipfile
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from palimpsest.functions import normalize as N
from palimpsest.operators import geometry, model_stages, page_cleaning, post_clean, projections, segments, splits
from palimpsest.sources import books, sinks

REPO = Path(__file__).resolve().parents[1]


def cells(boxes):
    return {(x, y) for a, b, c, d in boxes for x in range(int(a), int(c)) for y in range(int(b), int(d))}


def test_painted_boxes_equal_brute_force(spark):
    r = random.Random(5)
    rows = []
    for k in range(60):
        rows.append((k, [([r.uniform(-5, 35), r.uniform(-5, 25), r.uniform(0, 45), r.uniform(0, 30)], r.choice(["keep", "mask", "mask", "other"])) for _ in range(r.randrange(7))]))
    d = spark.createDataFrame(rows, "k int, regions array<struct<bbox:array<double>,action:string>>")
    got = {x.k: x.p for x in d.select("k", geometry.painted(F.col("regions"), F.lit(40.0), F.lit(20.0)).alias("p")).collect()}

    def clip(b):
        x1, y1, x2, y2 = (int(v) for v in b)
        x1, y1 = max(0, min(x1, 39)), max(0, min(y1, 19))
        return x1, y1, max(x1 + 1, min(x2, 40)), max(y1 + 1, min(y2, 20))

    for k, regions in rows:
        keep = cells(clip(b) for b, a in regions if a == "keep")
        assert cells(got[k]) == cells(clip(b) for b, a in regions if a == "mask") - keep
        for b, a in regions:  # the boxes of one region don't overlap
            if a == "mask":
                own = [x for x in got[k] if cells([x]) <= cells([clip(b)])]
                assert all(x[0] < x[2] and x[1] < x[3] for x in own)


def test_boxes_of_polygons_and_wide_pages(spark):
    r = spark.range(1).select(geometry.around(F.array(F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0), F.lit(4.0)))).alias("a"), geometry.around(F.array(F.array(F.lit(5.0), F.lit(1.0)), F.array(F.lit(2.0), F.lit(9.0)))).alias("b")).first()
    assert (r.a, r.b) == ([1, 2, 3, 4], [2, 1, 5, 9])
    p = spark.createDataFrame([("b", 1, 300.0, 200.0), ("b", 2, 200.0, 300.0), ("b", 3, 10.0, 0.0), ("b", 4, None, None)], "book string, page int, width double, height double")
    s = geometry.split_summary(p, ["book"]).first()
    assert (s.input_pages, s.output_pages, s.split_pages, s.copied_pages) == (4, 5, 1, 3)
    assert [x.clip for x in geometry.split_pages(p.where("page = 1")).collect()] == [[0, 0, 150, 200], [150, 0, 300, 200]]


def test_split_words(spark):
    lexicon = spark.createDataFrame([("Исследователь", 0.9), ("деревянный", 0.75), ("красивая", 0.99), ("крас", 0.9), ("ивая", 0.9), ("оказаться", 0.9), ("оказать", 0.9)], "word string, score double")
    texts = ["ис следователь", "дере вянный", "Британск ого", "историческ был", "крас ивая", "оказать ся", "оказал ся", None, "", "опре деления ис ключение"]
    d = spark.createDataFrame([(k, t, 7) for k, t in enumerate(texts)], "k int, text string, score int")
    of = lambda lex: [r.text for r in splits.without_splits(d, lex).orderBy("k").collect()]
    assert of(lexicon) == ["исследователь", "деревянный", "Британского", "историческ был", "крас ивая", "оказаться", "оказался", None, "", "определения ис ключение"]
    assert of(None)[:3] == ["ис следователь", "дере вянный", "Британского"]
    assert splits.without_splits(d.limit(0), lexicon).count() == 0
    with pytest.raises(ValueError):
        splits.MOST_ENTRIES, most = 2, splits.MOST_ENTRIES
        try:
            splits.without_splits(d, lexicon)
        finally:
            splits.MOST_ENTRIES = most


def test_segments_of_awkward_pages(spark):
    pages = spark.createDataFrame([(1, "body"), (2, None), (3, ""), (4, "x"), (5, "text")], "page int, selected_text string")
    blocks = spark.createDataFrame(
        [(1, 1, "second", "body"), (1, 0, "First", "heading"), (1, 2, "note", "footnote_body"), (4, 0, " ", "body"), (4, 1, "ref", "reference_block"), (5, 0, "7", "page_number")], "page int, place int, text string, role string"
    )
    got = {r.page: r for r in segments.segmented(pages, blocks, ["page"]).collect()}
    assert (got[1].body_text, got[1].notes_text, got[1].page_type, got[1].layout_status) == ("First\n\nsecond", "note", "body_with_notes", "pdf_blocks")
    assert (got[2].page_type, got[2].body_text, got[3].page_type) == ("empty", "", "empty")
    assert (got[4].page_type, got[4].body_text, got[4].reference_text) == ("notes_only", "x", "ref") and got[5].page_type == "empty"
    assert segments.segmented(pages.limit(0), blocks, ["page"]).count() == 0


def test_audit_is_made_once(spark):
    rows = [(1, "Poccия", None), (2, "чистый текст", None), (3, "Poccия", (5, 5, 5)), (4, None, None)]
    d = spark.createDataFrame(rows, "k int, rule_cleaned_text string, homoglyph_audit struct<detected:int,auto_fixed:int,warned:int>")
    once = projections.audited(d)
    got = {r.k: r for r in once.collect()}
    assert got[1].rule_cleaned_text == "Россия" and got[1].homoglyph_audit.auto_fixed == 1 and got[1].audit_note == "detected=1;auto_fixed=1;warned=0"
    assert got[2].homoglyph_audit.detected == 0 and got[2].audit_note is None and got[3].rule_cleaned_text == "Poccия" and got[4].rule_cleaned_text is None
    assert [r.rule_cleaned_text for r in projections.audited(once).orderBy("k").collect()] == [r.rule_cleaned_text for r in once.orderBy("k").collect()]


def test_book_summaries(spark):
    rows = [("a", "ocr", "approve", 2), ("a", "extract", None, 0), ("b", "ocr", "reject", 1)]
    d = spark.createDataFrame([(b, s, v, ["e"] * n, ["f"], []) for b, s, v, n in rows], "book string, source string, page_verdict string, edits array<string>, flags array<string>, protected_hits array<string>")
    got = {r.book: r for r in projections.book_summaries(d, ["book"]).collect()}
    assert (got["a"].pages, got["a"].edits, got["a"].flags, got["a"].protected_hits, got["a"].sources, got["a"].verdicts) == (2, 2, 2, 0, "extract=1,ocr=1", "approve=1,unknown=1")
    assert (got["b"].sources, got["b"].verdicts) == ("ocr=1", "reject=1")


def test_repair_stage(spark):
    class Cut:
        def complete(self, prompts):
            return ['{"operations": [{"op": "delete_line_range", "start_line": 1}]}' if "tag" in p else None for p in prompts]

    long = "\n".join(f"строка номер {k} с текстом" for k in range(20))
    rows = [(1, long, ["tag"], False), (2, long, [], False), (3, "", ["tag"], True), (4, "IV. Глава\n" + long, ["tag"], False), (5, None, None, None)]
    d = spark.createDataFrame(rows, "k int, cleaned_text string, issue_tags array<string>, allow_empty_output boolean").withColumn("raw_text", F.col("cleaned_text"))
    d = d.withColumn("page_verdict", F.lit("approve")).withColumn("llm_verdict", F.lit(None).cast("string")).withColumn("risk_level", F.lit("low"))
    got = {r.k: r for r in model_stages.model_repaired(d, Cut).collect()}
    assert got[1].repair_status == "structured" and got[1].repaired_text == long.split("\n", 1)[1]
    assert got[2].repair_status == "skipped" and got[3].repair_status == "cleaned_empty"
    assert got[4].repair_status == "fallback" and got[4].repaired_text.startswith("IV. ")
    assert got[5].repaired_text == ""
    nothing = {r.k: r.repair_status for r in model_stages.model_repaired(d).collect()}
    assert nothing[1] == "fallback" and nothing[2] == "skipped"
    assert model_stages.settings("max_quality", repair="own").repair == "own" and not model_stages.settings("max_quality").structure_risky_only


def test_folds_grow_with_lines(spark):
    text = "\n".join("слово за словом и далее" for _ in range(2000))
    d = spark.createDataFrame([(text,)], "t string")
    d.select(page_cleaning.paragraph_step(F.lit("а\nб"))).collect()
    began = time.time()
    r = d.select(page_cleaning.paragraph_step(F.col("t")).alias("p")).select(F.length("p.text").alias("n"), F.size("p.edits").alias("e"), F.length(F.to_json("p.edits")).alias("size")).first()
    assert (r.n, r.e) == (len(text), 1999) and r.size < 40 * len(text) and time.time() - began < 10
    headings = d.select(post_clean.without_repeated_headings(F.split("t", "\n")).alias("x")).select(F.size("x").alias("n")).first()
    assert headings.n == 2000


def test_protected_hits_name_their_rules(spark):
    hits = spark.createDataFrame([("кто-то и NATO",)], "t string").select(page_cleaning.protected_hits(F.col("t")).alias("h")).first().h
    assert [(h.rule_id, h.evidence) for h in hits] == [("lexical_hyphen_words", "кто-то"), ("latin_spans_and_identifiers", "NATO")]


def test_character_references(spark):
    rows = ["&amp;lt; &#65;&#x42f;&#X1F600; &eacute;&nope; &#0; &#xD800; &amp &;", "", None, "no reference"]
    d = spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "k int, t string")
    got = [r.t for r in d.select("k", N.unescaped(F.coalesce("t", F.lit(""))).alias("t")).orderBy("k").collect()]
    assert got == ["&lt; AЯ😀 é&nope; � � &amp &;", "", "", "no reference"]


def test_other_kinds_of_books_raise(spark, tmp_path):
    (tmp_path / "x.djvu").write_bytes(b"")
    d = spark.createDataFrame([("x.djvu", ".djvu")], "path string, extension string")
    with pytest.raises(Exception, match="unsupported document type: x.djvu"):
        books.supported(d).collect()


def test_epub_records_rules_and_texts(spark, tmp_path):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("META-INF/container.xml", '<container xmlns="urn:c"><rootfiles><rootfile full-path="p.opf"/></rootfiles></container>')
        z.writestr("p.opf", '<package xmlns="urn:p"><manifest><item id="a" href="a.x"/><item id="b" href="b.x"/></manifest><spine><itemref idref="a"/><itemref idref="b"/></spine></package>')
        z.writestr("a.x", "<p>" + "слово " * 20 + "</p>")
        z.writestr("b.x", "<h1>Содержание</h1><p>Содержание\nГлава ... 1\nГлава ... 2</p>")
    (tmp_path / "a.epub").write_bytes(out.getvalue())
    (tmp_path / "bad.epub").write_bytes(b"x")
    b = books.books(spark, str(tmp_path))
    got = {Path(r.path).name: r for r in books.epub_records(b).collect()}
    assert (got["a.epub"].spine_docs, got["a.epub"].sample_nonempty_pages, got["a.epub"].review_priority) == (2, 1, "low") and got["bad.epub"].review_priority == "medium"
    (tmp_path / "t.txt").write_bytes("да".encode() + b"\xff")
    assert books.texts(spark, f"{tmp_path}/t.txt").first().text == "да�"
    (tmp_path / "rules.json").write_text(json.dumps({"must": {"a": {"x": 1}}, "may": {"b": {"y": [2]}}}))
    assert {(r.group, r.name): json.loads(r.rule) for r in books.rules(spark, f"{tmp_path}/rules.json").collect()} == {("must", "a"): {"x": 1}, ("may", "b"): {"y": [2]}}


def test_sinks(spark, tmp_path):
    m = spark.createDataFrame([("a.pdf", ".pdf", 30, True, 2.0, "r1", "high", "mixed"), ("b.epub", ".epub", None, False, 1.0, "r2", "low", "x")], "relative_path string, extension string, page_count int, needs_ocr boolean, file_size_mb double, route string, review_priority string, text_layer_status string")
    sinks.write_manifest(m, f"{tmp_path}/m")
    text = "\n".join(r.value for r in spark.read.text(f"{tmp_path}/m/markdown").collect())
    assert "- Books: `2`" in text and text.index("## Routes") < text.index("- `r1`: `1`") < text.index("## Review priority") and "- `a.pdf` | pages=`30`" in text
    assert spark.read.option("header", True).csv(f"{tmp_path}/m/csv").count() == 2 and spark.read.json(f"{tmp_path}/m/jsonl").count() == 2
    f = spark.createDataFrame([("x/a b.txt", "old http://x", "new"), ("y.txt", None, "")], "relative_path string, before string, after string")
    folder = sinks.write_versions(f, f"{tmp_path}/v", "before", "after", at=datetime(2024, 1, 2))
    assert folder.endswith("20240102-000000") and spark.read.text(f"{folder}/backup").where("book = 'a_b'").first().value == "old http://x"
    assert {r.relative_path: r.before_urls for r in spark.read.json(f"{folder}/report").collect()} == {"x/a b.txt": 1, "y.txt": 0}
    p = spark.createDataFrame([("b1", 2, "two", "ocr"), ("b1", 1, "one", None), ("b2", 1, None, "x")], "book string, page_number int, raw_text string, source string").withColumn("cleaned_text", F.col("raw_text"))
    sinks.write_trial(p, f"{tmp_path}/t", "book")
    assert [r.value for r in spark.read.text(f"{tmp_path}/t/raw", wholetext=True).where("book = 'b1'").collect()] == ["===== page 1 [] =====\none\n\n===== page 2 [ocr] =====\ntwo\n"]
    sinks.write_documents(p, f"{tmp_path}/d", "book")
    assert {r.book: [x.page_number for x in r.pages] for r in spark.read.json(f"{tmp_path}/d").collect()} == {"b1": [1, 2], "b2": [1]}
    lay = p.withColumn("text", F.col("raw_text")).withColumn("width", F.lit(1.0)).withColumn("height", F.lit(1.0)).withColumn("regions", F.array(F.lit("r")))
    sinks.write_layouts(lay, f"{tmp_path}/l", "book")
    assert {r.book for r in spark.read.text(f"{tmp_path}/l/text").collect()} == {"b1"} and spark.read.text(f"{tmp_path}/l/layout").count() == 2


def test_queries_run_from_another_folder(tmp_path):
    """Workers find the package though the driver runs elsewhere."""
    code = (
        f"import sys; sys.path.insert(0, {str(REPO)!r}); import __spark_entry__ as e; from pyspark.sql import SparkSession;"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2').getOrCreate();"
        f"s.createDataFrame([(1, 'a', 'one\\ntwo')], 'doc_id bigint, source string, text string').write.parquet({str(tmp_path)!r} + '/documents.parquet');"
        f"print('rows', e.queries()['single_edits'](s, {str(tmp_path)!r}).count())"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows 1" in done.stdout, done.stderr[-2000:]
