"""Text sinks (K1-K4).

Output modes follow the reference's rules for existing output:

* K1 ``write_counts``: fails when the path exists (``errorifexists``),
* K2 ``write_counts(mode="overwrite")``: replace earlier output; it is written
  beside the old one and swapped in, so a failed job leaves the old one,
* K3 ``stage``: write only when no complete input is there; staged beside and
  renamed, with a marker that tells a complete folder from a crashed run's,
* K4 ``append_run``: first record overwrites, later ones append (plain text
  files; :mod:`wordmill.sinks.records` keeps the order of arrival).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..store import STAGED, Store


def count_lines(df: DataFrame, word_col: str = "word", count_col: str = "count") -> DataFrame:
    """The ``word<TAB>count`` text line of each result row."""
    return df.select(F.concat_ws("\t", F.col(word_col), F.col(count_col).cast("string"))
                     .alias("value"))


def write_counts(df: DataFrame, path: str, mode: str = "errorifexists",
                 word_col: str = "word", count_col: str = "count",
                 max_lines_per_file: int | None = None) -> None:
    """K1/K2: write (word, count) as tab-separated text.

    Keeps the partitioning of ``df``: a range-sorted frame (O1) gives part
    files in global word order; ``max_lines_per_file`` cuts them further.
    """
    lines = count_lines(df, word_col, count_col)

    def write(target: str, how: str) -> None:
        writer = lines.write.mode(how)
        if max_lines_per_file:
            writer = writer.option("maxRecordsPerFile", max_lines_per_file)
        writer.text(target)
    if mode == "overwrite":
        Store(df.sparkSession, path).replace(path, lambda new: write(new, "errorifexists"))
    else:
        write(path, mode)


def stage(df: DataFrame, path: str, fmt: str = "text") -> bool:
    """K3: write the input only if a complete one is not there yet; returns
    whether it was written.

    Complete is a file, or a folder with a marker: ``_STAGED`` (written here) or
    ``_SUCCESS`` (any Spark job). The input is written to a hidden folder beside
    ``path``, marked, and put in place by one rename, so no reader sees a part
    of it. A folder without a marker is what a crashed run left: it is moved
    aside as ``.<name>.incomplete-<id>`` (nothing is deleted) and staged again;
    :func:`mark_staged` declares a folder complete that was filled by hand.
    """
    store = Store(df.sparkSession, path)
    if store.complete(path):
        return False
    aside = store.beside(path, "staging")
    try:
        df.write.format(fmt).save(aside)
        store.write_new(f"{aside}/{STAGED}", "")
    except BaseException:
        store.delete(aside)
        raise
    while not store.move(aside, path):
        if store.complete(path):  # another run was faster
            store.delete(aside)
            return False
        store.move(path, store.beside(path, "incomplete"))
    return True


def mark_staged(spark: SparkSession, path: str) -> None:
    """Declare the folder ``path`` a complete staged input."""
    Store(spark, path).write_new(f"{path}/{STAGED}", "")


def append_run(df: DataFrame, path: str, first: bool = False, fmt: str = "text") -> None:
    """K4: append run records (one ``value`` string column for text); the
    first record of a sweep replaces the earlier results set."""
    df.write.mode("overwrite" if first else "append").format(fmt).save(path)
