"""What a run leaves behind: documents and manifests as JSON, CSV and Markdown, final texts with what they replace, layouts and trials.

Everything is written by Spark's writers to a folder of its own; nothing is changed in place, so that a job that is run
again finds what it read."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import stem
from ..functions.rx import strip
from ..operators.reports import file_report, manifest_counts, manifest_summary, top_ocr


def write_documents(pages: DataFrame, path: str, book: str, order: str = "page_number") -> None:
    """One JSON document for each book: its pages as an array in order. The old documents go when the new ones are there."""
    page = F.struct(*[c for c in pages.columns if c != book])
    pages.groupBy(book).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_at"), page.alias("page")))).alias("p")).select(book, F.transform("p", lambda x: x["page"]).alias("pages")).write.mode("overwrite").json(path)


def summary_lines(manifest: DataFrame) -> DataFrame:
    """(line): a Markdown summary of a manifest: books and pages, counts by route, priority and text layer, and the books that most need OCR."""
    s = manifest_summary(manifest)
    item = lambda label, value: F.concat(F.lit(f"- {label}: `"), value.cast("string"), F.lit("`"))
    head = F.array(
        F.lit("# Manifest summary"), F.lit(""), item("Books", F.col("book_count")), item("PDFs", F.col("pdf_count")), item("EPUBs", F.col("epub_count")), item("PDF pages", F.col("pdf_pages_total")), item("Pages for OCR", F.col("estimated_ocr_pages")),
    )
    first = s.select(F.posexplode(head).alias("b", "line")).select(F.lit(0).alias("a"), "b", "line")
    titles = {"route": "Routes", "review_priority": "Review priority", "text_layer_status": "Text layer"}
    counts = manifest_counts(manifest).select(F.col("metric"), F.concat(F.lit("- `"), "key", F.lit("`: `"), F.col("n").cast("string"), F.lit("`")).alias("line"))
    place = F.create_map(*[F.lit(x) for i, k in enumerate(titles, 1) for x in (k, i)])
    titled = manifest.sparkSession.createDataFrame([(k, f"\n## {t}") for k, t in titles.items()], "metric string, line string")
    middle = titled.select(place[F.col("metric")].alias("a"), F.lit(-1).alias("b"), "line").unionByName(counts.select(place[F.col("metric")].alias("a"), F.lit(0).alias("b"), "line"))
    rows = top_ocr(manifest).select(F.concat_ws(" | ", F.concat(F.lit("- `"), "relative_path", F.lit("`")), F.concat(F.lit("pages=`"), F.col("page_count").cast("string"), F.lit("`"))).alias("line"), F.coalesce("page_count", F.lit(0)).alias("n"))
    last = manifest.sparkSession.createDataFrame([("\n## Largest for OCR",)], "line string").select(F.lit(9).alias("a"), F.lit(-1).alias("b"), "line").unionByName(rows.select(F.lit(9).alias("a"), (-F.col("n")).cast("int").alias("b"), "line"))
    return first.unionByName(middle).unionByName(last).orderBy("a", "b", "line").select("line")


def write_manifest(manifest: DataFrame, path: str) -> None:
    """The manifest as CSV and JSON lines, its counts as JSON and its summary as Markdown, in folders of `path`."""
    manifest.write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    manifest.write.mode("overwrite").json(f"{path}/jsonl")
    manifest_counts(manifest).unionByName(manifest_summary(manifest).select(F.lit("books").alias("metric"), F.lit("all").alias("key"), F.col("book_count").alias("n"))).coalesce(1).write.mode("overwrite").json(f"{path}/summary")
    summary_lines(manifest).coalesce(1).write.mode("overwrite").text(f"{path}/markdown")


def write_versions(files: DataFrame, path: str, before: str, after: str, name: str = "relative_path", at: datetime | None = None) -> str:
    """Texts after a cleaning, those before it and a report of both, in a folder of the time. Returns the folder; earlier ones stay as they are."""
    folder = f"{path}/{(at or datetime.now(UTC)).strftime('%Y%m%d-%H%M%S')}"
    book = stem(F.col(name))
    for part, text in (("texts", after), ("backup", before)):
        files.select(book.alias("book"), F.coalesce(text, F.lit("")).alias("value")).write.partitionBy("book").text(f"{folder}/{part}")
    file_report(files, before, after).drop(before, after).write.json(f"{folder}/report")
    return folder


def layout_documents(pages: DataFrame, book: str) -> DataFrame:
    """(book, document, text): the layout of each book as JSON and its text, null where no region has any.

    pages: book, page_number, width, height, regions, text."""
    made = F.array_sort(F.collect_list(F.struct("page_number", "width", "height", "regions", strip(F.coalesce("text", F.lit(""))).alias("text"))))
    b = pages.groupBy(book).agg(made.alias("pages"))
    text = F.array_join(F.filter(F.transform("pages", lambda p: p["text"]), lambda t: t != ""), "\n\n")
    return b.select(book, F.to_json(F.struct(F.col(book).alias("source_path"), F.size("pages").alias("page_count"), "pages")).alias("document"), F.when(text != "", text).alias("text"))


def write_layouts(pages: DataFrame, path: str, book: str) -> None:
    """Layouts as JSON, a folder for each book, and texts for books that have one; what a book had before goes, so that no old text stays."""
    d = layout_documents(pages, book).withColumn("book", stem(F.col(book)))
    d.select("book", F.col("document").alias("value")).write.mode("overwrite").partitionBy("book").text(f"{path}/layout")
    d.where("text IS NOT NULL").select("book", F.col("text").alias("value")).write.mode("overwrite").partitionBy("book").text(f"{path}/text")


def trial_texts(pages: DataFrame, book: str, text: Column) -> DataFrame:
    """(book, text): each book's pages under a line with their number and source, in order. Pages of a book meet in one row, as the text does."""
    header = F.concat(F.lit("===== page "), F.col("page_number").cast("string"), F.lit(" ["), F.coalesce("source", F.lit("")), F.lit("] ====="))
    parts = pages.groupBy(book).agg(F.array_sort(F.collect_list(F.struct("page_number", F.concat_ws("\n", header, strip(F.coalesce(text, F.lit("")))).alias("t")))).alias("p"))
    return parts.select(book, F.array_join(F.transform("p", lambda x: x["t"]), "\n\n").alias("text"))


def write_trial(pages: DataFrame, path: str, book: str) -> None:
    """A trial run: texts as read and as cleaned, and an index of what each book has."""
    for name, column in (("raw", "raw_text"), ("cleaned", "cleaned_text")):
        trial_texts(pages, book, F.col(column)).select(stem(F.col(book)).alias("book"), F.col("text").alias("value")).write.mode("overwrite").partitionBy("book").text(f"{path}/{name}")
    pages.groupBy(book).agg(F.count("*").alias("pages"), F.min("page_number").alias("first_page"), F.max("page_number").alias("last_page")).coalesce(1).write.mode("overwrite").json(f"{path}/index")
