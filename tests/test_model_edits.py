"""Guards of model stages and requests through a client."""

from pyspark.sql import functions as F

from palimpsest.operators import model_edits


def test_answers_and_retries(spark):
    class Shouting:
        failed = False

        def complete(self, prompts):
            if not self.failed:
                self.failed = True
                raise OSError("try again")
            return [p.upper() for p in prompts]

    d = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "i int, prompt string")
    got = model_edits.asked(d, "prompt", Shouting, at_once=2, wait=0.0)
    assert {r.i: r.answer for r in got.collect()} == {1: "A", 2: None, 3: "C"}
    assert {r.answer for r in model_edits.asked(d, "prompt").collect()} == {None}


def test_guards(spark):
    long_ = "Слово и ещё слово. " * 20
    rows = [(long_, "b", long_, False, False), (long_, "b", "", False, False), (long_, "b", "", True, False), (long_, "b", "", False, True), (long_, "b", "Слово", False, False), ("II. Глава\nтекст", "b", "текст", False, False)]
    d = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, raw string, before string, after string, drop boolean, note boolean")
    got = [r.g for r in d.select("k", model_edits.guarded(*[F.col(c) for c in ("raw", "before", "after", "drop", "note")]).alias("g")).orderBy("k").collect()]
    assert [(g.text == "b", g.status) for g in got] == [(False, "structured"), (True, "fallback"), (False, "structured"), (False, "structured"), (True, "fallback"), (True, "fallback")]
    assert [g.notes for g in got][1:4] == [["empty_model_output_used_fallback", "model_output_too_short_used_fallback"], ["model_marked_non_body_page"], ["note_page_removed"]]


def test_repairs(spark):
    text = "Текст слово12 дальше.\n1. Там же. https://x.org\n2. См. там же // y"
    rows = [("endnote_block_left",), ("footnote_marker_left",), ("garbled_page",), ("other",)]
    d = spark.createDataFrame(rows, "tag string").withColumn("tags", F.array("tag"))
    got = {r.tag: (r.t, r.s) for r in d.select("tag", model_edits.notes_cut(F.lit(text), F.col("tags")).alias("t"), model_edits.least_share(F.col("tags"), F.lit(False)).alias("s")).collect()}
    assert got["endnote_block_left"] == ("Текст слово12 дальше.", 0.12) and got["garbled_page"] == ("", 0.01) and got["other"] == (text, 0.72)
    assert got["footnote_marker_left"][0].startswith("Текст слово дальше.") and got["footnote_marker_left"][1] == 0.30
    r = spark.range(1).select(model_edits.risk(F.lit(""), F.lit("approve"), F.lit("escalate")).alias("a"), model_edits.provenance(source=F.lit("x"), model=None).alias("b")).first()
    assert tuple(r) == ("medium", "source=x")
