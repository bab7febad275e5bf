"""Sources, sinks and the stream of states."""

import io
import json
import zipfile

from pyspark.sql import functions as F

from palimpsest.operators import states
from palimpsest.sources import books
from palimpsest.streaming import state_log


def epub(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("META-INF/container.xml", '<container xmlns="urn:c"><rootfiles><rootfile full-path="OPS/p.opf"/></rootfiles></container>')
        items = "".join(f'<item id="i{k}" href="t{k}.xhtml"/>' for k in range(len(parts))) + '<item id="gone" href="none.xhtml"/>'
        spine = '<itemref idref="gone"/>' + "".join(f'<itemref idref="i{k}"/>' for k in reversed(range(len(parts))))
        z.writestr("OPS/p.opf", f'<package xmlns="urn:p"><manifest>{items}</manifest><spine>{spine}</spine></package>')
        for k, p in enumerate(parts):
            z.writestr(f"OPS/t{k}.xhtml", p)
    return out.getvalue()


def test_epub_books(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.epub").write_bytes(epub(["<p>One &amp; two</p>", "<p> </p>", "<p>Three</p>"]))
    (tmp_path / "bad.epub").write_bytes(b"no archive")
    (tmp_path / "y.pdf").write_bytes(b"%PDF")
    (tmp_path / "z.txt").write_text("no book")
    b = books.books(spark, str(tmp_path))
    assert sorted(r.extension for r in b.collect()) == [".epub", ".epub", ".pdf"]
    assert [(r.page_number, r.selected_text) for r in books.epub_pages(b).orderBy("page_number").collect()] == [(1, "Three"), (3, "One & two")]


def test_page_choices(spark):
    r = spark.range(1).select(
        books.page_subset(F.lit(5), F.array(F.lit(3), F.lit(9), F.lit(1), F.lit(3))).alias("a"), books.page_subset(F.lit(3), F.lit(None).cast("array<int>")).alias("b"), books.representative_pages(F.lit(40), 6).alias("c"),
    ).first()
    assert (r.a, r.b, r.c) == ([1, 3], [1, 2, 3], [1, 2, 3, 5, 10, 20])


def test_files(spark, tmp_path):
    (tmp_path / "m.csv").write_text("relative_path,route\na.pdf,x\nb.pdf,y\na.pdf,z\n")
    assert {r.relative_path: r.route for r in books.manifest(spark, f"{tmp_path}/m.csv").collect()} == {"a.pdf": "z", "b.pdf": "y"}
    (tmp_path / "layout.json").write_text(json.dumps({"pages": [{"page_number": "7", "width": 10.0, "regions": []}, {"page_number": "x", "regions": []}]}))
    assert [r.page_number for r in books.layout_regions(spark, f"{tmp_path}/layout.json").collect()] == [7]
    g = tmp_path / "golden" / "s1"
    g.mkdir(parents=True)
    (g / "metadata.json").write_text(json.dumps({"keywords": ["a"], "expected_page_type": "body"}))
    (g / "expected.txt").write_text("text\nmore")
    r = books.golden_samples(spark, f"{tmp_path}/golden").first()
    assert (r.sample_id, r.keywords, r.expected, r.actual) == ("s1", ["a"], "text\nmore", "")
    s = spark.createDataFrame([("d1", 1, "NEW"), ("d2", 1, "FAILED")], "doc_id string, page_number int, current_state string")
    books.write_states(s, f"{tmp_path}/run_1/states")
    assert books.page_states(spark, f"{tmp_path}/run_1/states").count() == 2
    assert books.latest_run(spark, str(tmp_path)) == "run_1"
    books.write_texts(spark.createDataFrame([("x/My book.pdf", " text ")], "relative_path string, text string"), f"{tmp_path}/out")
    assert spark.read.text(f"{tmp_path}/out").first() == ("text", "My_book")


def test_stream_equals_batch(spark, tmp_path):
    rows = [(k % 5, k, s) for k, s in enumerate(["EXTRACTED", "OCR_DONE", "FAILED", "RULE_CLEANED", "PRIMARY_CLEANED", "EXPORTED", "RULE_CLEANED", "FAILED"] * 6)]
    for part in range(3):
        spark.createDataFrame(rows[part * 16 : (part + 1) * 16], "p int, i int, to_state string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    batch = {str(r.p): (r.current_state, r.last_success_state, r.n_moves, r.n_illegal) for r in states.replayed(spark.read.parquet(f"{tmp_path}/in"), ["p"], ["i"]).collect()}
    stream = spark.readStream.schema("p int, i int, to_state string").parquet(f"{tmp_path}/in")
    q = state_log.tracked(stream, "p", "i").writeStream.outputMode("update").format("memory").queryName("pages_now").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r.page: (r.current_state, r.last_success_state, r.n_moves, r.n_illegal) for r in spark.table("pages_now").collect()}
    assert got == batch
