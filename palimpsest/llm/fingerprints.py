"""Bottom-k sketches of word shingles, built, merged and compared with Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SHINGLE_WORDS, let, parts, table, with_next, words

#: Hashes in a sketch: the standard error of a resemblance r is sqrt(r * (1 - r) / K).
K = 128


def shingle_hashes(text: Column, size: int = SHINGLE_WORDS) -> Column:
    """Distinct 64-bit hashes of the text's windows of `size` words; a shorter text with words is one shingle, a blank one none."""

    def windows(h: Column) -> Column:
        n = F.size(h)
        whole = F.array(F.xxhash64(F.concat_ws(" ", F.transform(h, lambda x: x.cast("string")))))
        each = F.transform(F.sequence(F.lit(1), n - (size - 1)), lambda i: F.xxhash64(*[F.get(h, i + (j - 1)) for j in range(size)]))
        return F.when(n >= size, F.array_distinct(each)).when(n > 0, whole).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words(text), lambda w: F.xxhash64(w)), windows)


def sketch(text: Column, k: int = K, size: int = SHINGLE_WORDS) -> Column:
    """The k least shingle hashes in ascending order (all, if fewer)."""
    return F.slice(F.sort_array(shingle_hashes(text, size)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles (Jaccard); 1 if both are empty, 0 if one is."""
    both = let(merge(a, b, k), lambda u: F.when(F.size(u) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(u, F.array_intersect(a, b))) / F.size(u)))
    return both.cast("double")


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    rank = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / rank)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has, from the resemblance and both sizes; 1 if a is empty."""
    r = resemblance(a, b, k)
    shared = r / (1 + r) * (distinct_shingles(a, k) + distinct_shingles(b, k))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def encoded(a: Column) -> Column:
    """The sketch as a string: 16 hexadecimal digits for each hash."""
    return F.concat_ws("", F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")))


def merged_by(df: DataFrame, key: str, text: str, k: int = K) -> DataFrame:
    """One sketch for each key over all its rows; a hot key's hashes are cut to k in each of many salted parts before they meet."""
    salts = max(2, parts(df.sparkSession))
    hashes = df.select(F.col(key).alias("key"), (F.abs(F.xxhash64(text)) % salts).alias("salt"), F.explode_outer(sketch(F.col(text), k)).alias("h")).distinct()

    def least(d: DataFrame, *by: str) -> DataFrame:
        rank = F.row_number().over(W.partitionBy(*by).orderBy(F.col("h").asc_nulls_last()))
        return d.withColumn("rank", rank).where(F.col("rank") <= k).select("key", "h").distinct()

    few = least(least(hashes, "key", "salt"), "key")
    return few.groupBy(F.col("key").alias(key)).agg(F.sort_array(F.collect_list("h")).alias("sketch"))


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of every text and of its edited text.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many (or all) of the next
    document's in descending doc_id; the last document is followed by the first, and a lone one by itself. Null texts
    count as empty; an empty text has the fingerprint "", likeness 1 to another empty one and 0 to any other. Rows that
    repeat a doc_id follow each other by a hash of their texts; rows without doc_id count as the lowest. Other columns
    are not read.
    """
    low = F.lit(-(2**63))
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumn("_key", F.struct(F.coalesce(F.col("doc_id").cast("bigint"), low).alias("id"), F.xxhash64("text").alias("h")))
    own = F.struct("text", sketch(F.col("text"), k).alias("_sketch")).alias("_own")
    sketched = lambda rows: rows.select("doc_id", "_key", "_range", "_copy", own)
    d = with_next(d.withColumn("_size", F.octet_length("text")), "_key", "_size", sketched, F.col("_own"), "_next")
    d = d.select("doc_id", F.col("_own.text").alias("text"), F.col("_own._sketch").alias("_sketch"), F.col("_next._sketch").alias("_after"), F.col("_next.text").alias("_text"))
    n = F.length("text").cast("bigint")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), (n - half).cast("int")), F.substr("_text", F.lit(1), half))
    d = d.select("doc_id", n.alias("n_chars"), edited.alias("_edited"), "_sketch", "_after")
    d = d.select("doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"), "_sketch", "_after", sketch(F.col("_edited"), k).alias("_new"))
    return d.select(
        "doc_id", "n_chars", "edited_sha256", encoded(F.col("_sketch")).alias("fingerprint"), encoded(F.col("_new")).alias("edited_fingerprint"),
        resemblance(F.col("_sketch"), F.col("_new"), k).alias("near_edited"), resemblance(F.col("_sketch"), F.col("_after"), k).alias("near_next"),
        distinct_shingles(F.col("_sketch"), k).alias("shingles_estimate"), containment(F.col("_new"), F.col("_sketch"), k).alias("edited_in_text"),
    )


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


QUERIES = {"op1_fingerprints": op1_fingerprints}
ORACLES: dict[str, str] = {}
