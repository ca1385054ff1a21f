"""K4: a log of run records that keeps the order of arrival.

Every append writes its records in a folder of its own and then commits it
under the next free number: a file ``commits/<number>`` that names the folder,
put in place by one rename that fails if the number is taken. Readers follow
the commits only, so they see an append whole or not at all, and the number
says when it came, whatever the files are called and however long they are.

A retried append names the ``key`` of the first try: if that one was committed
after all, nothing is added. The first append of a sweep (``first``) hides the
records before it in the same step as it is committed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.ordering import range_sorted
from ..sources.text import InputNotFound
from ..store import Store

COMMITS = "commits"
_ROWS = "pos long, value string"


def _commits(spark: SparkSession, path: str) -> DataFrame:
    """``number, folder, first, key`` of every commit."""
    lines = spark.read.text(f"{path}/{COMMITS}", wholetext=True)
    part = F.split("value", "\t", 3)
    return lines.select(F.col("_metadata.file_name").cast("long").alias("number"), part[0].alias("folder"),
                        (part[1] == "1").alias("first"), part[2].alias("key"))


def is_record_log(spark: SparkSession, path: str) -> bool:
    return bool(Store(spark, path).names(f"{path.rstrip('/')}/{COMMITS}"))


def append_records(records: DataFrame, path: str, key: str | None = None, first: bool = False,
                   order: list[str | Column] | None = None, value_col: str = "value") -> int:
    """Append ``records`` (any number of rows) and return their number.

    Rows of one append are in ``order`` (else in the order of their text): they
    are range-sorted, and their ``pos`` rises along the ranges. ``key`` makes the append repeatable: the number of an earlier append with
    the same key is returned and nothing is written. Several writers may append
    at the same time; each gets a number of its own.
    """
    spark, path = records.sparkSession, path.rstrip("/")
    store = Store(spark, path)

    def committed() -> int | None:
        if key is None or not store.names(f"{path}/{COMMITS}"):
            return None
        return _commits(spark, path).where(F.col("key") == key).agg(F.min("number")).first()[0]

    done = committed()
    if done is not None:
        return done
    folder = f"data-{uuid.uuid4().hex}"
    keys = [F.col(c) if isinstance(c, str) else c for c in (order or [value_col])]
    (range_sorted(records, keys)
     .select(F.monotonically_increasing_id().alias("pos"), F.col(value_col).alias("value"))
     .write.parquet(f"{path}/{folder}"))
    while True:
        taken = store.names(f"{path}/{COMMITS}")
        number = max((int(n) for n in taken if n.isdigit()), default=0) + 1
        if store.write_new(f"{path}/{COMMITS}/{number:012d}", f"{folder}\t{int(first)}\t{key or ''}"):
            return number
        done = committed()  # someone else took the number, perhaps the first try of this append
        if done is not None:
            store.delete(f"{path}/{folder}")
            return done


def read_records(spark: SparkSession, path: str, value_col: str = "record") -> DataFrame:
    """``number, pos, <value_col>``: the records of the latest ``first`` append
    and of those after it. ``number, pos`` is the order of arrival (``pos`` has
    gaps; :func:`~wordmill.operators.runlog.run_report` numbers without)."""
    path = path.rstrip("/")
    if not is_record_log(spark, path):
        raise InputNotFound(path)
    commits = _commits(spark, path)
    start = commits.where("first").agg(F.max("number")).first()[0] or 0
    rows = spark.read.schema(_ROWS).parquet(f"{path}/data-*")
    rows = rows.withColumn("folder", F.regexp_extract(F.col("_metadata.file_path"), r"/(data-[0-9a-f]+)/[^/]*$", 1))
    live = commits.where(F.col("number") >= start).select("number", "folder")
    return rows.join(live, "folder").select("number", "pos", F.col("value").alias(value_col))
