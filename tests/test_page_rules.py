"""Rules on pages against worked examples."""

import pytest
from pyspark.sql import functions as F

from palimpsest.functions import line_rules, normalize, rx
from palimpsest.operators import edit_plans, evaluation, layout, page_cleaning, review, routing, states, stitching

PAGE = "book string, page_number int, source string, selected_text string, body_text string, notes_text string, reference_text string, page_type string"


def values(spark, texts, make):
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in d.select("i", make(F.col("t")).alias("v")).orderBy("i").collect()]


def test_lines_and_strip(spark):
    assert values(spark, ["", "a", "a\n", "a\r\nb\x0bc", "\n", "a\n\n", None], rx.lines) == [[], ["a"], ["a"], ["a", "b", "c"], [""], ["a", ""], []]
    assert values(spark, ["  a b \n", "", None], rx.strip) == ["a b", "", None]


def test_homoglyphs(spark):
    a, b, c, d = values(spark, ["Poccия и Mосква", "праbо и закоh", "", "ordinary слово http://сайт"], normalize.homoglyphs)
    assert (a.text, a.detected, a.auto_fixed, a.warned) == ("Россия и Москва", 2, 2, 0)
    assert (b.text, b.detected, b.auto_fixed, b.warned) == ("праbо и закоh", 2, 0, 2) and b.samples[0].kind == "warn_suspicious"
    assert (c.text, c.detected) == ("", 0) and d.detected == 0


def test_normalisation(spark):
    assert values(spark, ["a  ,b ( c )  d"], normalize.spacing) == ["a,b (c) d"]
    assert values(spark, ["слово[12] слово¹ слово12. x9y"], normalize.note_markers) == ["слово слово слово. x9y"]
    assert values(spark, ["x пункт\nобычный x"], normalize.bullets) == ["- пункт\nобычный x"]
    assert values(spark, ["работ; - осужденный"], normalize.list_breaks) == ["работ;\n- осужденный"]
    assert values(spark, ["a\x00b\r\nc  \n\n\n\nd "], normalize.normalized) == ["a b\nc\n\nd"]
    assert values(spark, ["a\n\n\nb\n", "a\n\n\n\nb"], normalize.single_blank_lines) == ["a\n\nb", "a\n\nb"]
    assert values(spark, ["a\n \nb", ""], normalize.without_blank_lines) == ["a\nb\n", ""]
    assert values(spark, ["a\nb"], normalize.numbered) == ["001| a\n002| b"]
    assert values(spark, ["x/My book (2).pdf", "/.pdf"], normalize.stem) == ["My_book__2", "pdf"]
    assert values(spark, ["<p>a&amp;b&nbsp;<script>x</script> c</p>"], normalize.html_text) == ["a&b c"]


def test_hyphen_step(spark):
    (s, t) = values(spark, ["аааа-\nббб-\nвввв", "пред-\nставитель"], page_cleaning.hyphen_step)
    assert s.text == "аааа-\nббб-\nвввв" and s.edits == []
    assert t.text == "представитель" and t.edits[0].before == "пред-\\nставитель"


def test_rule_engine(spark):
    text = "RUN HEAD\nТекст строки один про\nпродолжение [12] здесь и далее. Слово12 и пред-\nставитель сказал слово\n\n~~~~\n\nэто 50 % и т.д."
    rows = [("b", i, "extract", text + f"\nконец {i}", "", "", "", "body_only") for i in range(9, 13)]
    toc = "Содержание\n" + "\n".join(f"Глава о чём-то {i} ..... {i}" for i in range(1, 8))
    refs = "\n".join(f"{i}. Иванов И. О праве. М.: 20{i:02d} https://x.org/{i}" for i in range(1, 9))
    rows += [("b", 20, "extract", toc, "", "", "", "body_only"), ("b", 21, "extract", refs, "", "", "", "reference_only"), ("b", 22, "extract", None, None, None, None, None)]
    d = spark.createDataFrame(rows, PAGE)
    got = {r.page_number: r for r in review.reviewed(page_cleaning.cleaned(d)).collect()}
    p = got[9]
    assert p.cleaned_text.startswith("Текст строки один про продолжение [12] здесь и далее. Слово и представитель сказал слово") and "~~~~" not in p.cleaned_text
    assert {"repeated_headers_footers", "line_end_hyphenation", "fake_paragraph_breaks", "isolated_ocr_noise", "inline_note_marker_strip"} <= {e.rule_id for e in p.edits}
    assert "footnote_marker_left" in p.issue_tags and p.page_verdict == "escalate"
    assert (got[20].drop_reason, got[20].cleaned_text, got[20].page_verdict) == ("toc_index_page", "", "approve")
    assert got[21].drop_reason == "reference_only_page" and got[22].cleaned_text == ""


def test_body_pages_keep_their_references(spark):
    prose = "Это достаточно длинное предложение обычного текста, в котором есть много разных слов и мыслей.\n" * 10
    rows = [("b", 512, "extract", prose + "1. Там же. С. 5\n2. См.: Иванов 2001", prose + "1. Там же. С. 5\n2. См.: Иванов 2001", "", "", "body_with_notes"), ("c", 9, "extract", "Одна строка.\nДве строки.\n1. Там же. 1999\n2. Ibid. 2000", "", "", "", "notes_only")]
    got = {r.book: r.cleaned_text for r in page_cleaning.cleaned(spark.createDataFrame(rows, PAGE)).collect()}
    assert "Там же" in got["b"] and "Там же" not in got["c"]


def test_issue_tags_for_notes(spark):
    d = spark.createDataFrame([("Текст [12]\n123 https://example.com",)], "t string")
    tags = d.select(review.issue_tags(F.col("t"), F.col("t"), F.array().cast("array<string>")).alias("x")).first().x
    assert tags == ["footnote_marker_left", "citation_url_left"]


def test_risks(spark):
    r = spark.range(1).select(review.higher_risk(F.lit("medium"), F.lit("high")).alias("a"), review.higher_risk(F.lit("low"), F.lit(None).cast("string")).alias("b"), review.risk_of(F.lit("reject")).alias("c"), review.risk_of(F.lit(None).cast("string")).alias("d")).first()
    assert tuple(r) == ("high", "low", "high", "medium")


@pytest.mark.parametrize(
    ("plan", "want", "notes"),
    [
        ({"operations": [{"op": "merge_with_next", "line": 1}]}, "представитель заявителя\nтекст", []),
        ({"operations": [{"op": "delete_line_range", "start_line": 1, "end_line": 2}]}, "текст", []),
        ({"operations": [{"op": "delete_line_range", "start_line": 9}]}, "пред-\nставитель заявителя\nтекст", ["delete_line_range_missing_target:9-9"]),
        ({"operations": [{"op": "split_before_text", "line": 2, "text": "заявителя"}, {"op": "delete_line_range", "start_line": 2}]}, "пред-\nзаявителя\nтекст", []),
        ({"operations": [{"op": "split_after_text", "line": 3, "text": "текст"}, {"op": "no"}, 5]}, "пред-\nставитель заявителя\nтекст", ["split_after_text_marker_at_end:3", "unsupported_operation_ignored:no", "non_object_operation_ignored"]),
        ({"drop_page": True}, "пред-\nставитель заявителя\nтекст", ["model_drop_page_ignored"]),
        ({"operations": [{"op": "normalize_spacing"}] * 30}, "пред-\nставитель заявителя\nтекст", ["operation_count_capped:30->24"] + ["normalize_spacing_noop"] * 24),
    ],
)
def test_edit_plans(plan, want, notes):
    r = edit_plans.executed("пред-\r\nставитель заявителя\nтекст", plan)
    assert (r["text"], r["notes"]) == (want, notes)


def test_edit_plans_in_frames(spark):
    d = spark.createDataFrame([("a\nb", '```json\n{"drop_page": true}\n```'), (None, None), ("foo [12]\nbar", 'x {"operations":[{"op":"remove_inline_pattern","pattern":"bracket_note_markers"}]}')], "t string, p string")
    got = [r.edited for r in edit_plans.applied(d, "t", "p", F.lit(True)).collect()]
    assert got[0].drop_page and got[0].text == "" and got[1].text == "" and got[2].notes == ["inline_pattern_noop:bracket_note_markers"]


def test_routes(spark):
    def route(*x):
        return spark.range(1).select(routing.route(*[F.lit(v) for v in x]).alias("r")).first().r

    assert tuple(route("extract", "body_only", "blocks", 300))[:2] == ("easy_page", "low")
    assert tuple(route("extract", "body_only", "text_fallback", 300))[:2] == ("risky_extract_page", "medium")
    assert tuple(route("ocr", "body_only", "blocks", 300)) == ("hard_ocr_page", "high", "ocr_source=ocr")
    assert route("ocr", "toc_or_index", "x", 1).decision == "skip_nonbody_page"


def test_ocr_plans(spark):
    none = F.array().cast("array<struct<text:string,bbox:array<double>>>")

    def plan(route="auto", text="t", n=300, skip=None, bad=False, backend="auto"):
        return spark.range(1).select(routing.ocr_plan(F.lit(route), F.lit(text), F.lit(n), F.lit(skip).cast("string"), F.lit(bad), F.lit(False), none, F.lit(backend)).alias("p")).first().p

    assert plan(skip="toc_index_page").source == "ocr_skipped_nonbody"
    assert plan(backend="gemini").reason == "backend_gemini" and plan(backend="gemini").high_scale
    assert plan(bad=True).difficulty == "dirty_extract" and plan(n=50).difficulty == "sparse_text"
    assert plan().reason == "extract_quality_good" and plan(n=100).source == "ocr" and plan(n=200).source == "extract"
    assert plan("pdf_mixed_extract_plus_ocr", n=200).reason == "mixed_route_needs_ocr" and plan("pdf_ocr_then_clean").difficulty == "hard_scan"


def test_early_exit(spark):
    schema = "cleaned_text string, drop_page boolean, route_decision string, source string, page_type string, layout_status string, page_verdict string, risk_level string, issue_tags array<string>, status string, flags array<struct<rule_id:string,evidence:string>>, homoglyphs_warned int"
    good = ("т" * 220, False, "easy_page", "extract", "body_only", "pdf_blocks", "approve", "low", [], "ok", [], 0)
    rows = [good, (*good[:7], "medium", *good[8:]), ("short", *good[1:]), (*good[:10], [("garbled_page", "")], 0)]
    d = spark.createDataFrame(rows, schema)
    got = [tuple(r.x) for r in d.select(routing.early_exit(d).alias("x")).collect()]
    assert got == [(True, "easy_extract_body_only_review_approve"), (False, "risk_level=medium"), (False, "cleaned_text_too_short"), (False, "risky_flags_present")]


def test_states(spark):
    e = spark.createDataFrame([(1, i, s) for i, s in enumerate("EXTRACTED RULE_CLEANED PRIMARY_CLEANED".split())] + [(2, 0, "OCR_DONE"), (2, 1, "FAILED"), (3, 0, "OCR_DONE"), (3, 1, "FAILED"), (3, 2, "RULE_CLEANED"), (3, 3, "EXPORTED")], "p int, i int, to_state string")
    got = {r.p: tuple(r)[1:] for r in states.replayed(e, ["p"], ["i"]).collect()}
    assert got == {1: ("PRIMARY_CLEANED", "PRIMARY_CLEANED", 3, 0), 2: ("FAILED", "OCR_DONE", 2, 0), 3: ("RULE_CLEANED", "RULE_CLEANED", 3, 1)}


def test_monitoring(spark):
    schema = "current_state string, risk_level string, repair_status string, structure_status string, final_text_source string, processing_history array<struct<agent:string,to_state:string>>"
    d = spark.createDataFrame([("EXPORTED", "medium", "ok", "ok", "repaired_passthrough", [("RepairStage", "FAILED"), ("RepairStage", "REPAIRED")]), ("FAILED", "high", None, None, None, [("StructureStage", "FAILED")])], schema)
    got = {(r.metric, r.key): r.n for r in states.monitoring(d).collect()}
    assert got[("state", "FAILED")] == 1 and got[("failed_by_agent", "RepairStage")] == 1 and got[("risk", "high")] == 1 and ("repair_status", None) not in got and len(got) == 9


def test_layout(spark):
    labels = ["text", "title", "table", "picture", "figure", "footnote", "reference", "caption", "mysterious_block", "Doc-Title", None]
    assert values(spark, labels, layout.label) == ["body", "title", "table", "picture", "picture", "note", "note", "note", "body", "title", "body"]
    schema = "width double, height double, page_width double, page_height double, blocks array<struct<text:string,bbox:array<double>>>, regions array<struct<bbox:array<double>,action:string>>"
    blocks = [("header", [0.0, 0.0, 100.0, 10.0]), ("952", [0.0, 190.0, 20.0, 200.0]), ("body", [0.0, 50.0, 100.0, 150.0])]
    regions = [([0.0, 0.0, 200.0, 22.0], "mask"), ([0.0, 378.0, 200.0, 400.0], "mask"), ([0.0, 90.0, 200.0, 310.0], "keep")]
    r = layout.filtered_blocks(spark.createDataFrame([(200.0, 400.0, 100.0, 200.0, blocks, regions)], schema)).first()
    assert r.kept_text == "body" and r.note == "layout_extract_filter_applied:kept=1,removed=2"
    h = layout.halves(spark.createDataFrame([(80.0, 40.0), (30.0, 60.0)], "width double, height double")).collect()
    assert [x.box for x in h] == [[0, 0, 40, 40], [40, 0, 80, 40], [0, 0, 30, 60]]


def test_evaluation(spark):
    schema = "sample_id string, expected_page_type string, predicted_page_type string, keywords array<string>, protected_spans array<string>, raw string, expected string, actual string"
    rows = [("a", "body", "body", ["право", "участник"], [], "x", "текст", "текст"), ("b", "body", None, [], ["x"], None, "", "Poccия построе- ния кто-то Права участника")]
    e = evaluation.evaluated(spark.createDataFrame(rows, schema)).orderBy("sample_id")
    a, b = e.collect()
    assert a.normalized_edit_distance == 0.0 and a.page_type_misclassification == 0.0 and b.normalized_edit_distance is None and b.structure_overreach_rate == 1.0
    assert tuple(b.anomalies)[:2] == (1, 1)
    assert evaluation.summary(e).first().sample_count == 2


def test_stitching(spark):
    pages = [("b", 2, "продолжение текста.\n\n- пункт"), ("b", 1, "ГЛАВА ПЕРВАЯ\nПервая строка пред-\nставителя,\nещё строка"), ("b", 3, " \n"), ("c", 1, None)]
    got = {r.book: r for r in stitching.stitched(spark.createDataFrame(pages, "book string, n int, t string"), "book", "n", "t").collect()}
    assert got["b"].text == "ГЛАВА ПЕРВАЯ\nПервая строка представителя, ещё строка\nпродолжение текста.\n- пункт\n" and set(got) == {"b"}
    assert values(spark, ["слово-\nдалее\n\nкак-\nто"], stitching.epub_block) == ["словодалее\nкак-то"]


def test_continuations(spark):
    assert values(spark, ["и далее по тексту", "Короткий", "ЗАГОЛОВОК БОЛЬШИМИ", ""], line_rules.is_continuation) == [True, False, False, False]
