"""Table sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# A session setting that the registered queries read: into how many partitions
# the rows of a scan are dealt out before per-row work (unset: as scanned).
SCAN_PARTITIONS = "spark.wordmill.scanPartitions"


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None,
               partitions: int | None = None) -> DataFrame:
    """Read a parquet table; ``columns`` are pruned at the scan.

    A parquet row group is never split between tasks, so a table of a few
    large row groups keeps few tasks busy. ``partitions`` deals its rows out
    round-robin before the work on them; that shuffles the texts once, so it
    is the caller's decision and off unless asked for. A large table has row
    groups enough and needs none.
    """
    df = spark.read.parquet(path)
    if columns:
        df = df.select(*columns)
    return df.repartition(partitions) if partitions else df


def scan_partitions(spark: SparkSession) -> int | None:
    """The session's :data:`SCAN_PARTITIONS`, if set."""
    value = spark.conf.get(SCAN_PARTITIONS, None)
    return int(value) if value else None
