"""Ordering operators (O1, O2, O3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.ordering import Descending, Order, global_index, range_sorted


def sorted_counts(df: DataFrame, word_col: str = "word", rank_col: str | None = "rank",
                  num_partitions: int | None = None) -> DataFrame:
    """O1: counts ordered by word in UTF-8 byte order (Spark's string order).

    The result is range-partitioned on the word, so a sink writes many
    sorted part files in global order instead of one file from one task.
    With ``rank_col`` a 1-based position is added (distributed numbering,
    see :mod:`wordmill.plans.ordering`).
    """
    if rank_col is None:
        return range_sorted(df, [F.col(word_col)], num_partitions)
    return global_index(df, [F.col(word_col)], rank_col, num_partitions, distinct_rows=True)


def _top_keys(count_col: str = "count", word_col: str = "word") -> list[Column]:
    return [F.col(count_col), F.concat(F.col(word_col), F.lit("\t"))]


def top_order(count_col: str = "count", word_col: str = "word") -> list[Column]:
    """Order of ``sort -t$'\\t' -k2 -nr`` on ``word<TAB>count`` lines (C
    locale): count descending, then the whole line compared bytewise and
    reversed. With equal counts that is ``word || TAB`` descending, which
    differs from ``word`` descending when a raw token holds a byte < 0x09."""
    return [c.desc() for c in _top_keys(count_col, word_col)]


def top_words(df: DataFrame, k: int = 10, count_col: str = "count", word_col: str = "word",
              rank_col: str | None = "rank") -> DataFrame:
    """O2: the k most frequent words (planned as TakeOrderedAndProject: each
    task keeps its own top k). The k rows of every task meet in one task, so
    this is for reports; :func:`rank_words` ranks whole result sets."""
    order = top_order(count_col, word_col)
    top = df.orderBy(*order).limit(k)
    if rank_col is None:
        return top
    return top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)).cast("long"))


def rank_words(df: DataFrame, count_col: str = "count", word_col: str = "word", rank_col: str = "rank",
               num_partitions: int | None = None) -> DataFrame:
    """O2 for a whole result set or a very large k: every word with its rank,
    numbered by the distributed numbering (filter on the rank for a top k)."""
    order = [Descending(c) for c in _top_keys(count_col, word_col)]
    return global_index(df, order, rank_col, num_partitions, distinct_rows=True)


# A count is rounded down to this many leading bits in the histogram.
_BITS = 7


def count_cutoff(df: DataFrame, k: int, count_col: str = "count") -> int | None:
    """A count that at least the ``k`` most frequent words reach, as near to
    theirs as a histogram of the counts tells; None if there are fewer words.

    The histogram has a row per count of up to 128 and per 1/64 of a power of
    two above, less than 4,000 rows whatever the data holds, and is combined
    in the tasks. Runs one job, which returns one number.
    """
    c = F.col(count_col).cast("long")
    low = F.greatest(F.length(F.bin(c)) - _BITS, F.lit(0))
    edge = F.when(c > 0, F.call_function("shiftleft", F.call_function("shiftright", c, low), low)).otherwise(c)
    steps = df.select(edge.alias("edge")).groupBy("edge").agg(F.count(F.lit(1)).alias("n"))
    reached = F.sum("n").over(Window.orderBy(F.col("edge").desc()))
    return steps.withColumn("reached", reached).where(F.col("reached") >= k).agg(F.max("edge")).first()[0]


def top_ranked(df: DataFrame, k: int, count_col: str = "count", word_col: str = "word", rank_col: str = "rank",
               num_partitions: int | None = None) -> DataFrame:
    """O2 for a large k: the same rows and ranks as :func:`top_words`. Words
    below a cut-off from the histogram of counts go in the scan; what passes
    (k words and those that share the cut-off's step) is ranked by the
    distributed numbering, so no task gathers the k best of every other task.
    """
    cutoff = count_cutoff(df, k, count_col)
    passed = df if cutoff is None else df.where(F.col(count_col) >= cutoff)
    return rank_words(passed, count_col, word_col, rank_col, num_partitions).where(F.col(rank_col) <= k)


def numbered(df: DataFrame, order: list[Order], name: str = "i",
             num_partitions: int | None = None) -> DataFrame:
    """O3: number report rows 1..n in ``order`` (the ``i=1; i++`` loop)."""
    return global_index(df, order, name, num_partitions)
