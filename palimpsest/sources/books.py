"""Sources and sinks of the library: books, manifests, checkpoints, layout results, golden samples, and final texts.

All of them are read and written by Spark's own readers and writers, so that any store Spark knows will do; archives and
PDF pages are opened from the bytes that `binaryFile` gives."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.line_rules import skip_reason
from ..functions.normalize import html_text, sample_text, stem
from ..functions.rx import strip, sub

PAGE_STATE = (
    "doc_id string, page_number int, current_state string, last_success_state string, route_decision string, page_type string, risk_level string, raw_text string, rule_cleaned_text string, primary_clean_text string, "
    "repaired_text string, final_text string, review_tags array<string>, structure_plan struct<status:string,final_text_source:string>, stage_payloads struct<repaired:struct<repair_status:string>>, "
    "processing_history array<struct<agent:string,from_state:string,to_state:string,timestamp:string,note:string>>"
)
LAYOUT = "source_path string, page_count int, pages array<struct<page_number:string,width:double,height:double,sanitized_image_path:string,regions:array<struct<bbox:array<double>,action:string,mapped_label:string,text:string>>>>"


def books(spark: SparkSession, root: str) -> DataFrame:
    """(path, extension, length, content) of every PDF and EPUB file under a folder. Contents aren't sorted: order the paths where an order is needed."""
    b = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{pdf,epub,PDF,EPUB}").load(root)
    return b.select("path", F.lower(F.regexp_extract("path", r"(\.[^.]*)$", 1)).alias("extension"), "length", "content")


def supported(files: DataFrame) -> DataFrame:
    """The files, if all of them are of a kind that can be read; the first other one raises an error that names it."""
    known = F.lower("extension").isin(".pdf", ".epub")
    return files.withColumn("extension", F.when(known, F.col("extension")).otherwise(F.raise_error(F.concat(F.lit("unsupported document type: "), "path"))))


def page_subset(n: Column, wanted: Column) -> Column:
    """The wanted page numbers that a book of n pages has, once each, ascending; all if none are named."""
    return F.when(wanted.isNull(), F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))).otherwise(F.array_sort(F.array_distinct(F.filter(wanted, lambda p: p.between(1, n)))))


def representative_pages(n: Column, most: int) -> Column:
    """First, early, middle and last pages, at most `most`."""
    picks = F.array(*[F.lit(p) for p in (1, 2, 3, 5, 10)], F.floor(n / 2).cast("int"), n.cast("int"))
    return F.slice(F.array_distinct(F.filter(picks, lambda p: p.between(1, n))), 1, most)


def epub_parts(files: DataFrame) -> DataFrame:
    """(path, page_number, html): the parts of EPUB books in the order of their spines; files that don't open have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from posixpath import dirname, join, normpath
        from urllib.parse import unquote
        from xml.etree import ElementTree

        def parts(content: bytes) -> Iterator[str]:
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                names = set(z.namelist())
                root = next(e.get("full-path") for e in ElementTree.fromstring(z.read("META-INF/container.xml")).iter() if e.tag.endswith("rootfile"))
                package = list(ElementTree.fromstring(z.read(root)).iter())
                where = {e.get("id"): e.get("href") for e in package if e.tag.endswith("}item")}
                for e in package:
                    if e.tag.endswith("}itemref") and (href := where.get(e.get("idref"))):
                        name = normpath(join(dirname(root), unquote(href.split("#")[0])))
                        if name in names:
                            yield z.read(name).decode("utf-8", "replace")

        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    rows += [(path, i, h) for i, h in enumerate(parts(content), 1)]
                except (zipfile.BadZipFile, KeyError, StopIteration, ElementTree.ParseError):
                    continue
            yield pd.DataFrame(rows, columns=["path", "page_number", "html"])

    return files.where("extension = '.epub'").select("path", "content").mapInPandas(run, "path string, page_number int, html string")


def epub_pages(files: DataFrame) -> DataFrame:
    """EPUB parts as pages with text, empty ones gone; parts that a test of the text sets apart are named as such, with the reason."""
    p = epub_parts(files).withColumn("selected_text", html_text(F.col("html"))).where("selected_text <> ''").withColumn("skip_reason", skip_reason(F.col("selected_text")))
    source = F.when(F.col("skip_reason").isNotNull(), "epub_skip_nonbody").otherwise("epub_extract")
    return p.select("path", "page_number", source.alias("source"), "selected_text", "skip_reason")


def epub_records(files: DataFrame, samples: int = 3, least: int = 40) -> DataFrame:
    """(path, spine_docs, sample_text_chars, sample_nonempty_pages, avg_chars_per_sampled_page, route, review_priority) of EPUB books, from their first parts."""
    texts = epub_parts(files).select("path", "page_number", sample_text(sub(F.col("html"), "<[^>]+>", " ")).alias("text"))
    size = F.when(F.col("page_number") <= samples, F.length(F.replace("text", F.lit(" "), F.lit(""))))
    known = texts.groupBy("path").agg(F.count("*").alias("spine_docs"), F.sum(size).alias("sample_text_chars"), F.count_if(size >= least).alias("sample_nonempty_pages"), F.bround(F.avg(size), 1).alias("avg_chars_per_sampled_page"))
    books = files.where("extension = '.epub'").select("path")
    return books.join(known, "path", "left").select("*", F.lit("epub_extract_then_clean").alias("route"), F.when(F.col("spine_docs").isNull(), "medium").otherwise("low").alias("review_priority"))


def texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of whole files; bytes that aren't UTF-8 become replacement characters."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"path": b["path"], "text": [c.decode("utf-8", "replace") for c in b["content"]]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, text string")


def rules(spark: SparkSession, path: str) -> DataFrame:
    """(group, name, rule) of a rule file: JSON of groups of named rules, each rule as JSON text."""
    groups = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,map<string,string>>").alias("g"))
    return groups.select(F.explode("g").alias("group", "r")).select("group", F.explode("r").alias("name", "rule"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest CSV by relative_path; of rows for one path the last in the file counts (of files, the last by name)."""
    m = spark.read.csv(path, header=True).select("*", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row")).alias("_at"))
    last = F.row_number().over(W.partitionBy("relative_path").orderBy(F.col("_at").desc()))
    return m.withColumn("_r", last).where("_r = 1").drop("_r", "_at")


def page_states(spark: SparkSession, path: str) -> DataFrame:
    """Page checkpoints (one JSON object a file) with the file they come from."""
    return spark.read.schema(PAGE_STATE).option("multiLine", True).json(path).withColumn("file", F.col("_metadata.file_path"))


def layout_regions(spark: SparkSession, path: str) -> DataFrame:
    """(page_number, width, height, sanitized_image_path, regions) of layout results; pages without a whole number go."""
    pages = spark.read.schema(LAYOUT).option("multiLine", True).json(path).select(F.explode("pages").alias("p"))
    return pages.withColumn("page_number", F.expr("try_cast(p.page_number AS int)")).where("page_number IS NOT NULL").select("page_number", "p.width", "p.height", "p.sanitized_image_path", "p.regions")


def golden_samples(spark: SparkSession, root: str) -> DataFrame:
    """(sample_id, metadata fields, raw, expected, actual): a folder each; missing texts are empty."""
    at = lambda c: F.regexp_extract(c, r"([^/]+)/[^/]+$", 1)
    texts = spark.read.text(f"{root}/*/*.txt", wholetext=True).select(at(F.col("_metadata.file_path")).alias("sample_id"), F.regexp_extract("_metadata.file_name", r"^(.*)\.txt$", 1).alias("name"), "value")
    wide = texts.groupBy("sample_id").pivot("name", ["raw", "expected", "actual"]).agg(F.first("value"))
    schema = "expected_page_type string, predicted_page_type string, keywords array<string>, protected_spans array<string>"
    meta = spark.read.schema(schema).option("multiLine", True).json(f"{root}/*/metadata.json").withColumn("sample_id", at(F.col("_metadata.file_path")))
    none = F.array().cast("array<string>")
    full = wide.join(meta, "sample_id", "full")
    return full.select("sample_id", "expected_page_type", "predicted_page_type", F.coalesce("keywords", none).alias("keywords"), F.coalesce("protected_spans", none).alias("protected_spans"), *[F.coalesce(c, F.lit("")).alias(c) for c in ("raw", "expected", "actual")])


def latest_run(spark: SparkSession, root: str) -> str | None:
    """The last of the run_ folders under a folder by name."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(F.max(F.regexp_extract("path", r"/(run_[^/]*)/", 1)).alias("m")).first()
    return found.m or None


def write_states(states: DataFrame, path: str, book: str = "doc_id") -> None:
    """Checkpoints of a stage, a folder for each book; a stage that is run again replaces its books' folders."""
    states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(book).json(path)


def write_texts(documents: DataFrame, path: str, name: str = "relative_path", text: str = "text") -> None:
    """Final texts, a folder for each book's safe name."""
    documents.select(stem(F.col(name)).alias("book"), strip(F.col(text)).alias("value")).write.mode("overwrite").partitionBy("book").text(path)
