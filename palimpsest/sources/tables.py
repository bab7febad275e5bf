"""Tables of a folder, dealt out to all cores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of files that one task gets, about.
PART_BYTES = 64 << 20


def spread(df: DataFrame) -> DataFrame:
    """df as it is, or, where it comes from fewer files than there are cores or parts of PART_BYTES, dealt out evenly: a file of one row group
    is one task, however many cores wait and however large it is. Columns that aren't asked for stay in the files. Rows go by their place in
    the files, so that a task that runs again deals them out alike without sorting them first."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-size // PART_BYTES))
    return df.repartition(parts, F.monotonically_increasing_id()) if 0 < len(df.inputFiles()) < parts else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))
