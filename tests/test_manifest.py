"""The manifest from sampled pages."""

from pyspark.sql import functions as F

from palimpsest.operators import manifest, reports


def test_sampled_pages(spark):
    def pages(n, most):
        return spark.range(1).select(manifest.sample_pages(F.lit(n), most).alias("p")).first().p

    assert pages(0, 7) == [] and pages(2, 7) == [1, 2] and pages(100, 9) == [1, 2, 3, 26, 51, 76, 98, 99, 100]
    assert pages(100, 7) == [1, 2, 3, 26, 51, 76, 100] and pages(100, 3) == [1, 26, 100]


def test_analysis(spark):
    prose = ("Длинная строка обычного текста, в которой больше сорока восьми знаков подряд.\n") * 12
    samples = [("rich.pdf", prose), ("rich.pdf", prose), ("scan.pdf", ""), ("scan.pdf", None), ("mixed.pdf", prose), ("mixed.pdf", ""), ("кн_book.pdf", prose), ("toc.pdf", "Глава ..... 5\n" * 60 + "[1] [2] [3]")]
    books = [(b, n) for b, n in (("rich.pdf", 100), ("scan.pdf", 400), ("mixed.pdf", 600), ("кн_book.pdf", 10), ("toc.pdf", 10), ("none.pdf", None))]
    b = manifest.analysed(spark.createDataFrame(samples, "relative_path string, text string"), spark.createDataFrame(books, "relative_path string, page_count int"))
    got = {r.relative_path: r for r in b.collect()}
    told = {k: (r.text_layer_status, r.route, r.layout_risk, r.review_priority) for k, r in got.items()}
    assert told["rich.pdf"] == ("text_rich", "pdf_extract_then_clean", "low", "low")
    assert told["scan.pdf"] == ("image_only", "pdf_ocr_then_clean", "low", "high")
    assert told["mixed.pdf"] == ("mixed", "pdf_mixed_extract_plus_ocr", "medium", "medium") and got["mixed.pdf"].notes == "long_book;partial_text_layer"
    assert told["кн_book.pdf"] == ("text_rich", "pdf_extract_then_clean", "medium", "medium") and got["кн_book.pdf"].needs_layout_review
    assert told["toc.pdf"] == ("text_rich", "pdf_extract_then_clean", "high", "high")
    assert told["none.pdf"][:2] == ("unknown", "pdf_ocr_then_clean")
    full = b.withColumn("extension", F.lit(".pdf")).withColumn("file_size_mb", F.lit(1.0))
    assert [r.relative_path for r in reports.top_ocr(full, 2).collect()] == ["mixed.pdf", "scan.pdf"]
    assert reports.manifest_summary(full).first().estimated_ocr_pages == 1000
    assert {(r.metric, r.key): r.n for r in reports.manifest_counts(full).collect()}[("route", "pdf_ocr_then_clean")] == 2
