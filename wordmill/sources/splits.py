"""Input-split report - how many read tasks a file source gets per split
size (the reference's "Launched map tasks" per HDFS block size).

The splits are counted from the scan itself: every row carries
``_metadata.file_path`` and ``_metadata.file_block_start``; the distinct
pairs are the splits that held rows. One scan and one small aggregation per
size; nothing is collected but the final counts. Every task tells the driver of
its metrics, so the scan reads many small splits in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MB = 1024 * 1024
#: Bytes of splits that a counting task reads.
TASK_BYTES = 128 * MB
#: Tasks that list the files of a size's scan, at most.
LISTING_TASKS = 32


def session_with_splits(spark: SparkSession, size_mb: int, unit_bytes: int = MB) -> SparkSession:
    """A child session (same context, own settings) with this split size."""
    child = spark.newSession()
    child.conf.set("spark.sql.files.maxPartitionBytes", str(size_mb * unit_bytes))
    return child


def splits_of(df: DataFrame) -> DataFrame:
    """Distinct (file, split start) pairs of a scan, with their rows."""
    return (df.select(F.col("_metadata.file_path").alias("file_path"),
                      F.col("_metadata.file_block_start").alias("split_start"))
              .groupBy("file_path", "split_start")
              .agg(F.count(F.lit(1)).alias("rows")))


def read_tasks(spark: SparkSession, path: str | list[str], fmt: str = "text") -> int:
    """Read tasks Spark plans for the scan at the current split size (the
    "Launched map tasks" figure). Planning only: no job runs."""
    return spark.read.format(fmt).load(path).rdd.getNumPartitions()


def split_report(spark: SparkSession, path: str | list[str], sizes_mb: Sequence[int],
                 fmt: str = "text", size_col: str = "split_mb", unit_bytes: int = MB) -> DataFrame:
    """One row per split size: (split_mb, tasks, splits, rows) - the
    planned read tasks, the splits that held rows, and the rows read. Sizes are
    in units of ``unit_bytes`` (MB unless given).

    The split size is a read-time setting, so each size is its own scan, in a
    child session of its own: other queries of ``spark`` never see it. Files
    are cut at that size; the count then reads about :data:`TASK_BYTES` of such
    splits in each task.
    """
    rows = []
    for size in sizes_mb:
        child = session_with_splits(spark, size, unit_bytes)
        child.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(LISTING_TASKS))
        df = child.read.format(fmt).load(path)
        tasks = df.rdd.getNumPartitions()
        at_once = max(child.sparkContext.defaultParallelism, -(-tasks * size * unit_bytes // TASK_BYTES))
        child.conf.set("spark.sql.files.maxPartitionNum", str(at_once))
        got = splits_of(df).agg(
            F.count(F.lit(1)).alias("splits"), F.sum("rows").alias("rows")).first()
        rows.append((int(size), tasks, int(got["splits"]), int(got["rows"] or 0)))
    return spark.createDataFrame(rows, f"{size_col} int, tasks int, splits long, rows long")
