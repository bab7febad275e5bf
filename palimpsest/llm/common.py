"""What the operators of this subpackage share: words, tables, shared scratch folders, neighbours in an order."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.tables import table

#: Space, tab, line feed, vertical tab, form feed, carriage return: what separates words.
WS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
WS_CHARS = " \t\n\x0b\x0c\r"
SHINGLE_WORDS = 5
SIMILARITY = 0.8


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once for each row, whatever the optimizer inlines."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text in order; null and blank texts have none."""
    even = F.coalesce(text, F.lit(""))
    for c in WS_CHARS[1:]:
        even = F.replace(even, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(even, " "), "")


def digest(text: Column) -> Column:
    """192 bits that stand for a text; a null text is an empty one."""
    text = F.coalesce(text, F.lit(""))
    return F.concat(F.md5(text), F.hex(F.xxhash64(text)))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from the session; one is made only where the session has none and runs on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = f"{tempfile.gettempdir()}/palimpsest-checkpoints"
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, what: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


#: Paths of the tables that were written, in order.
_tables: list[str] = []


def written(df: DataFrame, what: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again: lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, what)
    df.write.parquet(path)
    _tables.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def working(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that were written inside, but for the last one: what is made from them has been written by then."""
    mark = len(_tables)
    yield
    gone, _tables[mark:] = _tables[mark:-1], _tables[-1:] if len(_tables) > mark else []
    for path in gone:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function on Arrow batches that gives free memory back when its task ends: a worker waits for the next task, beside the executor."""

    @wraps(run)
    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return task


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes of text in a range of an order, about, and ranges at most: what is broadcast about ranges is bounded by their number.
RANGE_BYTES, MOST_RANGES = 32 << 20, 20_000


def _place(key: Column, cuts: Column) -> Column:
    """How many of the ascending cuts are at most the key, by halving."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(cuts) + 1)).cast("int"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.shiftright(s["a"] + s["b"], 1)
        above = F.struct((middle + 1).alias("a"), s["b"].alias("b"))
        below = F.struct(s["a"].alias("a"), middle.alias("b"))
        return F.when(s["a"] >= s["b"], s).when(F.get(cuts, middle) <= key, above).otherwise(below)

    return F.aggregate(steps, F.struct(F.lit(0).alias("a"), F.size(cuts).alias("b")), halve, lambda s: s["a"])


def ranged(df: DataFrame, key: str, size: str, around: int = 1) -> tuple[DataFrame, DataFrame]:
    """(df with its `_range` in the ascending order of `key`, a table of the `around` first and last keys of each range).

    Ranges are those of a range partitioning of the keys alone, as many as `size` bytes of all rows ask for. Rows with
    equal keys are in one range. The table (_range, place, key: place 1 is the first key, -1 the last) is in the shared
    folder, so that all tasks, run again or not, see the same ranges.
    """
    spark = df.sparkSession
    total = df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    n = min(MOST_RANGES, max(2 * parts(spark), -(-int(total) // RANGE_BYTES)))
    keys = df.select(F.col(key).alias("key")).repartitionByRange(n, "key").withColumn("part", F.spark_partition_id())
    own = W.partitionBy("part")
    keys = keys.withColumn("place", F.dense_rank().over(own.orderBy("key"))).withColumn("back", F.dense_rank().over(own.orderBy(F.desc("key"))))
    ends = keys.where((F.col("place") <= around) | (F.col("back") <= around)).dropDuplicates(["part", "key"])
    ends = written(ends.select("part", "place", "back", "key"), "ranges")
    lows = ends.where("place = 1").select(F.sort_array(F.collect_list("key")).alias("cuts"))
    first = ends.where("place = 1").select("part", (F.dense_rank().over(W.orderBy("key")) - 1).alias("_range"))
    ends = ends.join(F.broadcast(first), "part")
    ends = ends.where(F.col("place") <= around).select("_range", "place", "key").unionByName(ends.where(F.col("back") <= around).select("_range", (-F.col("back")).alias("place"), "key"))
    cut = df.withColumn("_cuts", lows.scalar())
    return cut.withColumn("_range", (_place(F.col(key), F.col("_cuts")) - 1).cast("int")).drop("_cuts"), ends


def with_next(df: DataFrame, key: str, size: str, prepare: Callable[[DataFrame], DataFrame], carry: Column, out: str) -> DataFrame:
    """Adds as `out` the value of `carry` in the next row in the descending order of `key`; the last row gets the first row's.

    Rows with equal keys must be alike. The order is cut into ranges; each gets a copy of the first row of the next one, so
    that rows are dealt out once, by range. `prepare`, which adds columns, is run on the rows just before that.
    """
    rows, ends = ranged(df, key, size)
    highs = ends.where("place = -1").select("_range", "key")
    last = F.max("_range").over(W.partitionBy())
    moves = highs.select(F.when(F.col("_range") == last, 0).otherwise(F.col("_range") + 1).alias("_to"), F.col("key").alias("_edge"))
    copies = rows.join(F.broadcast(moves), F.col(key) == F.col("_edge")).withColumn("_range", F.col("_to")).drop("_to", "_edge").dropDuplicates(["_range"])
    rows = prepare(rows.withColumn("_copy", F.lit(0)).unionByName(copies.withColumn("_copy", F.lit(1))))
    order = W.partitionBy("_range").orderBy("_copy", F.col(key).desc())
    return rows.withColumn(out, F.lead(carry).over(order)).where("_copy = 0").drop("_copy", "_range")


def running(df: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """Adds sums of columns over all rows before a row in an order (sums: the column of each new one), and `_rank`, the number of those rows.

    Rows are range-sorted; sums are taken within ranges and, in a table of one row for each range, over ranges, so that no
    task gets more than a range or the row of each. df, which has no long columns, is written once.
    """
    n = min(MOST_RANGES, 2 * parts(df.sparkSession))
    named = df.select("*", *[c.alias(f"_o{i}") for i, c in enumerate(order)])
    by = [F.col(f"_o{i}") for i in range(len(order))]
    ranges = written(named.repartitionByRange(n, *[c.asc_nulls_first() for c in by]).withColumn("_part", F.spark_partition_id()), "ordered")
    sums = sums | {"_rank": "_one"}
    ranges = ranges.withColumn("_one", F.lit(1).cast("bigint"))
    totals = ranges.groupBy("_part").agg(*[F.sum(c).alias(out) for out, c in sums.items()])
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select("_part", *[F.coalesce(F.sum(out).over(earlier), F.lit(0)).alias(f"_{out}") for out in sums])
    before = W.partitionBy("_part").orderBy(*[c.asc_nulls_first() for c in by]).rowsBetween(W.unboundedPreceding, -1)
    rows = ranges.select("*", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(out) for out, c in sums.items()]).join(F.broadcast(totals), "_part")
    return rows.select(*df.columns, *[(F.col(out) + F.col(f"_{out}")).alias(out) for out in sums])


__all__ = ["digest", "let", "parts", "ranged", "released", "running", "scratch", "shared_folder", "table", "with_next", "words", "working", "written"]
