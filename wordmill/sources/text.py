"""Text sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from ..store import Store


class InputNotFound(FileNotFoundError):
    """The input path does not exist (the job must not start)."""


def read_lines(spark: SparkSession, path: str | list[str], line_col: str = "value") -> DataFrame:
    """One row per line of a text file, folder or glob.

    Lines end at LF, CR or CRLF; bytes that are not UTF-8 decode to U+FFFD,
    which the word strip later removes. Splittable: one task per file split
    (``spark.sql.files.maxPartitionBytes``), like one map task per block.
    """
    try:
        df = spark.read.text(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise InputNotFound(str(path)) from exc
        raise
    return df if line_col == "value" else df.withColumnRenamed("value", line_col)


def read_lines_in_order(spark: SparkSession, path: str | list[str], line_col: str = "line",
                        at_col: str = "at") -> DataFrame:
    """S1 with the place of each line: ``file, <at_col>, <line_col>``.

    ``at_col`` is a struct that sorts as the lines stand: files by the time of
    their last change (lines appended as new files come in that order), then by
    name; in a file by the start of the split and the place in it. A row's
    position alone does not say so: Spark deals splits to tasks by size.
    """
    lines = read_lines(spark, path, line_col)
    at = F.struct(F.col("_metadata.file_modification_time").alias("changed"), F.col("_metadata.file_path").alias("file"),
                  F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))
    return lines.select(F.col("_metadata.file_path").alias("file"), at.alias(at_col), line_col)


def read_counts(spark: SparkSession, path: str, word_col: str = "word",
                count_col: str = "count") -> DataFrame:
    """Read ``word<TAB>count`` lines back as (word STRING, count BIGINT).

    Not CSV: raw tokens may hold quotes or commas. The count is after the
    last tab; a word never holds a tab (it is a token delimiter). A line that
    is no such pair fails the read, so a damaged result set is never merged
    into a smaller total; ``bad_count_lines`` lists such lines. If a replacement
    of the set was cut off between its renames, the whole copy is read.
    """
    lines = read_lines(spark, Store(spark, path).current(path))
    damaged = F.raise_error(F.concat(F.lit("not a word<TAB>count line: "), "value")).cast("bigint")
    return lines.select(
        F.substring_index("value", "\t", 1).alias(word_col),
        F.coalesce(_count(), damaged).alias(count_col),
    )


def _count() -> Column:
    return F.when(F.col("value").contains("\t"), F.substring_index("value", "\t", -1).try_cast("bigint"))


def bad_count_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a result set that are no ``word<TAB>count`` pair."""
    return read_lines(spark, path).where(_count().isNull())
