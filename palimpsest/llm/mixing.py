"""Mixing sources to target weights along a curriculum: each source's weight is a function of training time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, digest, running, table, written

#: Times a document may be taken.
MOST_EPOCHS = 3
#: Weights of the sources in code point order, over and over.
WEIGHTS = (1, 2, 3)
#: A source's weight at time t in [0, 1] is its target * (1 + slope * (2 * t - 1)), by its place in the order; the mean over time is its target.
SLOPES = (-0.5, 0.0, 0.5)

def sizes(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def targets(by_source: DataFrame) -> DataFrame:
    """(source, n, source_size) with slope and target, and the sizes of the sources before each: weights share all sizes, no target is above MOST_EPOCHS times its source.

    The excess of capped sources is reshared by weight until none is above, which is water filling: with the sources
    by cap / weight ascending, a source is capped if its level cap / weight is at most what is left per weight.
    """
    s = running(by_source, [F.col("source").isNull(), F.col("source")], {"first": "source_size"})
    place = F.col("_rank") % len(WEIGHTS)
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), place.cast("int") + 1).cast("bigint"))
    s = s.withColumn("slope", F.element_at(F.array(*[F.lit(x) for x in SLOPES]), place.cast("int") + 1))
    s = s.withColumn("cap", F.col("source_size") * MOST_EPOCHS).drop("_rank")
    s = running(s, [F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source")], {"caps": "cap", "less": "weight"})
    s = written(s, "sources")
    whole = s.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    s = s.withColumn("left", F.lit(whole.size or 0) - F.col("caps")).withColumn("weights", F.lit(whole.weight or 0) - F.col("less"))
    # cap / weight <= left / weights, in whole numbers; the first that isn't capped sets the level
    s = s.withColumn("capped", F.col("cap").cast("decimal(38,0)") * F.col("weights") <= F.col("left").cast("decimal(38,0)") * F.col("weight"))
    level = s.where(~F.col("capped")).agg(F.min(F.struct("_rank", "left", "weights")).alias("l")).first().l
    shared = F.lit(level.left if level else 0) * F.col("weight") / F.lit(level.weights if level else 1)
    return s.withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(shared)).select("source", "n", "source_size", "first", "slope", "target")


def arrival(share: Column, slope: Column) -> Column:
    """The time t at which a source has met `share` of its demand: solves t + slope * (t * t - t) = share."""
    b = 1 - slope
    root = (F.sqrt(b * b + 4 * slope * share) - b) / (2 * slope)
    return F.when(slope == 0, share).otherwise(root)


def plan(docs: DataFrame, once: bool = False) -> DataFrame:
    """How often the mix takes each document, and the times at which it is due.

    Documents of a source stand in the order of md5('mix:' + doc_id), then size. Of its target, each source first takes
    as many whole rounds of all its documents as fit, then documents in order as long as at least half of one fits into
    the rest. A document's first time is when the integral of its source's weight schedule reaches the sizes before it.
    Null texts have size 0 and are taken as often as others of their source; null sources are one source, null ids one id;
    rows that repeat an id and a size stand in any order. Texts are read once; what follows is done on their sizes.
    once: rows that repeat a doc_id and its text count once, a digest of the text (`copy`) tells others apart, and stands
    for a null id.
    """
    copy = ["copy"] if once else []
    d = docs.select("doc_id", "source", sizes(F.col("text")).alias("size"), *[digest(F.col("text")).alias(c) for c in copy])
    if once:
        d = d.dropDuplicates(["doc_id", "copy"])
    d = d.withColumn("key", F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), *copy, F.lit("")))))
    d = written(d.withColumn("row", F.monotonically_increasing_id()), "sizes")
    s = targets(d.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size")))
    # one order of all documents, source by source: a source of any size is cut into ranges, and so are rows without id
    d = running(d, [F.col("source").isNull(), F.col("source"), F.col("key"), F.col("size"), *map(F.col, copy), F.col("row")], {"before": "size"})
    d = d.join(s.drop("n").withColumnRenamed("source", "_source"), F.equal_null("source", "_source")).drop("_source")
    d = d.withColumn("before", F.col("before") - F.col("first"))
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    d = d.withColumn("rounds", rounds).withColumn("rest", F.col("target") - F.col("rounds") * F.col("source_size"))
    more = (F.col("rounds") < MOST_EPOCHS) & (2 * F.col("before") + F.col("size") <= 2 * F.col("rest")) & (F.col("rest") > 0)
    d = d.withColumn("times", F.col("rounds") + F.when(more, 1).otherwise(0))
    due = F.when((F.col("times") > 0) & (F.col("target") > 0), arrival(F.least(F.lit(1.0), F.col("before") / F.col("target")), F.col("slope")))
    return d.select("doc_id", "source", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"), due.alias("due"), "before", "slope", *copy)


def mixed(docs: DataFrame) -> DataFrame:
    """The plan of every document, range-sorted by the time it is first due (documents that are left out come first)."""
    d = plan(docs).select("doc_id", "size", "source_size", "target", "taken", F.col("times").cast("bigint").alias("times"), F.floor(F.col("due") * 1_000_000_000).cast("bigint").alias("position"))
    return d.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


def dealt(docs: DataFrame) -> DataFrame:
    """The mix itself: the columns of docs, a row for each time that a document is taken, range-sorted by when it is due.

    Rows are matched to their plan by doc_id and text; rows that repeat both must be alike, and count once.
    """
    p = plan(docs, once=True).where("times > 0")
    again = F.explode(F.sequence(F.lit(0), F.col("times").cast("int") - 1))
    p = p.select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy"), "before", "source_size", "target", "slope", again.alias("_round"))
    due = arrival(F.least(F.lit(1.0), (F.col("before") + F.col("_round") * F.col("source_size")) / F.greatest(F.col("target"), F.lit(1.0))), F.col("slope"))
    p = p.select("_id", "_copy", due.alias("_due"))
    d = docs.withColumn("_own", digest(F.col("text"))).dropDuplicates(["doc_id", "_own"])
    d = d.join(p, F.equal_null(d["doc_id"], p["_id"]) & (d["_own"] == p["_copy"]))
    return d.repartitionByRange("_due", "_id").sortWithinPartitions("_due", "_id", "_own").drop("_due", "_id", "_copy", "_own")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))


_ORACLE = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
p AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS place FROM s),
w AS (SELECT *, (place + 1)::BIGINT AS weight, [-0.5, 0.0, 0.5][place + 1]::DOUBLE AS slope, {MOST_EPOCHS} * source_size AS cap FROM p),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER r, 0))::BIGINT AS rest, (sum(weight) OVER () - coalesce(sum(weight) OVER r, 0))::BIGINT AS weights
  FROM w WINDOW r AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, cap::HUGEINT * weights <= rest::HUGEINT * weight AS capped FROM l),
v AS (SELECT rest, weights FROM c WHERE NOT capped ORDER BY cap / weight, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, slope, CASE WHEN capped THEN cap::DOUBLE ELSE (v.rest * weight)::DOUBLE / v.weights END AS target FROM c LEFT JOIN v ON true),
o AS (SELECT d.*, source_size, slope, target, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS rounds FROM o),
m AS (SELECT *, rounds + CASE WHEN rounds < {MOST_EPOCHS} AND 2 * before + size <= 2 * (target - rounds * source_size) AND target - rounds * source_size > 0 THEN 1 ELSE 0 END AS times, least(1.0, before / target) AS share FROM r)
SELECT doc_id, size, source_size, target, times * size AS taken, times, CASE WHEN times > 0 AND target > 0 THEN floor(
  CASE WHEN slope = 0 THEN share ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * share) - (1 - slope)) / (2 * slope) END * 1000000000) END::BIGINT AS position FROM m"""


QUERIES = {"op9_mixing": op9_mixing}
ORACLES = {"op9_mixing": _ORACLE}
