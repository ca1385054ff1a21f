"""Line dedup by site-relative frequency (operator 10), DataFrame functions only.

For each host, the number of pages that contain a line is divided by the
host's number of pages; lines above a ratio are boilerplate and are dropped
from the host's pages.

A boilerplate line is on more than ``ratio`` of a host's pages, so a host has
fewer than (mean lines per page) / ``ratio`` of them, however many pages it
has. They are kept as one short array of hashes per host, and the texts are
cleaned by a join on the host alone: the texts are not shuffled while that
table is small (measured), and lines are never exploded with their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, frozen, text_or_empty

RATIO = 0.1
MIN_PAGES = 5


def _line_key(line: Column) -> Column:
    """Hash of a line without its outer blanks; null for a blank line, which
    never counts as boilerplate."""
    bare = F.btrim(line)
    return F.when(bare != "", F.xxhash64(bare, F.crc32(bare)))


def boilerplate(docs: DataFrame, host_col: str, text_col: str, ratio: float = RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """``host, keys, n_bytes``: the hashes of each host's boilerplate lines.

    Exact copies of a page count as one page of the host, in the line's count
    and in the total: a page that was copied a thousand times does not turn
    its own lines into boilerplate.
    """
    pages = docs.select(F.col(host_col).alias("host"), text_or_empty(text_col).alias("text"))
    pages = pages.select("host", F.xxhash64("text", F.crc32("text")).alias("page"),
                         F.split("text", "\n").alias("lines"))
    total = (pages.select("host", "page").distinct()
             .groupBy("host").agg(F.count(F.lit(1)).alias("n_pages")))
    keys = F.array_distinct(F.filter(F.transform("lines", _line_key), lambda k: k.isNotNull()))
    counts = (pages.select("host", "page", F.explode(keys).alias("key")).distinct()
              .groupBy("host", "key").agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") >= min_pages))
    # Null hosts form one group of their own.
    common = (counts.join(frozen(total), counts["host"].eqNullSafe(total["host"]))
              .where(F.col("n") > ratio * F.col("n_pages"))
              .select(counts["host"].alias("host"), "key"))
    return frozen(common.groupBy("host").agg(F.sort_array(F.collect_set("key")).alias("keys")))


def line_dedup(docs: DataFrame, host_col: str = "source", text_col: str = "text",
               ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """All rows and columns of ``docs``, with the text cleaned, plus
    ``n_lines`` and ``n_dropped`` (long).

    A line is dropped when it stands on at least ``min_pages`` distinct pages
    of the row's host and on more than ``ratio`` of them. Blank lines stay.
    A null text stays null (no line), an empty one empty; a page of nothing
    but boilerplate becomes empty. Rows with a null host form one host.
    """
    marks = boilerplate(docs, host_col, text_col, ratio, min_pages)
    n_keys = marks.agg(F.max(F.size("keys"))).first()[0] or 0
    marks = broadcast_if_small(marks, 64 + 8 * n_keys).select(
        F.col("host").alias("__ld_host"), F.col("keys").alias("__ld_keys"))
    lines = F.split(text_or_empty(text_col), "\n")
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    joined = (docs.select(*[F.col(f"`{c}`") for c in names])
              .join(marks, F.col(host_col).eqNullSafe(F.col("__ld_host")), "left")
              .withColumn("__ld_lines", lines)
              .withColumn("__ld_kept", F.when(F.col("__ld_keys").isNull(), F.col("__ld_lines")).otherwise(
                  F.filter("__ld_lines", lambda x: F.coalesce(
                      ~F.array_contains(F.col("__ld_keys"), _line_key(x)), F.lit(True))))))
    no_text = F.col(text_col).isNull()
    n_lines = F.when(no_text, 0).otherwise(F.size("__ld_lines")).cast("long")
    n_kept = F.when(no_text, 0).otherwise(F.size("__ld_kept")).cast("long")
    cleaned = F.when(no_text, F.col(text_col)).otherwise(F.array_join("__ld_kept", "\n"))
    return joined.select(*[cleaned.alias(text_col) if c == text_col else F.col(f"`{c}`") for c in names],
                         n_lines.alias("n_lines"), (n_lines - n_kept).alias("n_dropped"))
