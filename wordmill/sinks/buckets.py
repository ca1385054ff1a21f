"""A3 into an existing result: count sets in buckets by word.

A set is a Parquet folder written in ``n`` buckets by the hash of the word, each
sorted by word (Spark's own bucketed layout). New counts are merged into it by
a join on the word: only the new ones are shuffled, to the buckets of the old
set, which is read in place, bucket by bucket, and never shuffled.
The merged set has the same layout and replaces the old one as a whole.

The layout is read through a table entry of the session's catalog that exists
while the plan is made; the folder alone holds the set.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.text import merge_counts
from ..sources.text import InputNotFound
from ..store import Store

BUCKETS = 64
_MARK = "_buckets-"


@contextmanager
def _table(spark: SparkSession):
    """A table name that is gone afterwards (its files stay)."""
    name = f"wordmill_{uuid.uuid4().hex}"
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _write(counts: DataFrame, folder: str, buckets: int) -> None:
    spark = counts.sparkSession
    with _table(spark) as name:
        (counts.write.format("parquet").bucketBy(buckets, "word").sortBy("word")
         .option("path", folder).saveAsTable(name))
    Store(spark, folder).write_new(f"{folder}/{_MARK}{buckets}", "")


def write_bucketed(counts: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Write (word, count), words distinct, as a bucketed set; fails if ``path``
    exists."""
    store = Store(counts.sparkSession, path)
    if store.exists(path):
        raise FileExistsError(path)
    rows = counts.select("word", F.col("count").cast("bigint").alias("count")).repartition(buckets, "word")
    store.replace(path, lambda new: _write(rows, new, buckets))


def _buckets(store: Store, folder: str) -> int:
    marks = [n for n in store.names(folder) if n.startswith(_MARK)]
    if not marks:
        raise InputNotFound(f"no bucketed count set: {folder}")
    return int(marks[0].removeprefix(_MARK))


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The set as (word, count), with its buckets known to Spark."""
    store = Store(spark, path)
    folder = store.current(path)
    buckets = _buckets(store, folder)
    with _table(spark) as name:
        location = folder.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} (word STRING, count BIGINT) USING parquet "
                  f"CLUSTERED BY (word) SORTED BY (word) INTO {buckets} BUCKETS LOCATION '{location}'")
        table = spark.table(name)
        table.schema  # resolved while the entry exists
    return table


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """Two count sets, each with distinct words (none null), summed by a join
    that keeps the buckets of ``old``."""
    a, b = old.alias("a"), new.alias("b")
    total = F.coalesce(F.col("a.count"), F.lit(0)) + F.coalesce(F.col("b.count"), F.lit(0))
    return (a.hint("merge").join(b, F.col("a.word") == F.col("b.word"), "full_outer")
            .select(F.coalesce("a.word", "b.word").alias("word"), total.cast("bigint").alias("count")))


def merge_into(path: str, *counts: DataFrame) -> None:
    """Add one or more (word, count) sets (words may repeat) to the bucketed
    set at ``path``. Counts of a null word are left out, as no operator of this
    library gives one. A failed job leaves the set as it was."""
    spark = counts[0].sparkSession
    store = Store(spark, path)
    old = read_bucketed(spark, path)
    buckets = _buckets(store, store.current(path))
    new = merge_counts(*counts).where(F.col("word").isNotNull())
    store.replace(path, lambda target: _write(merged(old, new), target, buckets))
