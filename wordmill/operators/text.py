"""Word-count operators.

All operators are plain ``DataFrame -> DataFrame`` functions usable with
``df.transform``. The counting plans are:

* A2 ``token_count``: scan -> explode -> filter -> partial count ->
  Exchange(hash word) -> final count. One shuffle, and the map side sends one
  row per distinct token per task, so a hot word costs one row per task.
* A1 ``word_count``: A2, then lower/strip on the *distinct* tokens only, then
  a second (small) aggregation by word. The non-empty filter is pinned with a
  predicate that needs the aggregate result, so Catalyst cannot push the
  regex below the first aggregate and run it once per token.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def lines(df: DataFrame, col: str = "text", keep: list[str] | None = None,
          line_col: str = "line", pos_col: str | None = "line_no") -> DataFrame:
    """One row per line of a text column (positions start at 1)."""
    keep = list(keep if keep is not None else [c for c in df.columns if c != col])
    arr = T.line_array(col)
    if pos_col is None:
        return df.select(*keep, F.explode(arr).alias(line_col))
    return (df.select(*keep, F.posexplode(arr).alias("_p", line_col))
              .select(*keep, (F.col("_p") + 1).cast("long").alias(pos_col), line_col))


def explode_tokens(df: DataFrame, col: str = "text", keep: list[str] | None = None,
                   token_col: str = "token", pos_col: str | None = None) -> DataFrame:
    """One row per non-empty token (1 -> 0..n rows per input row).

    With ``pos_col`` the 1-based position among the non-empty tokens of the
    row is added (this needs the array form; the plain form keeps the
    empty-token filter inside codegen).
    """
    keep = list(keep if keep is not None else [c for c in df.columns if c != col])
    if pos_col is None:
        return (df.select(*keep, F.explode(T.split_blanks(col)).alias(token_col))
                  .where(F.col(token_col) != ""))
    return (df.select(*keep, F.posexplode(T.tokenize(col)).alias("_p", token_col))
              .select(*keep, (F.col("_p") + 1).cast("long").alias(pos_col), token_col))


def token_count(df: DataFrame, col: str = "text", word_col: str = "word",
                count_col: str = "count") -> DataFrame:
    """A2: raw-token count (case and punctuation kept) -> (word, count)."""
    return (explode_tokens(df, col, keep=[], token_col=word_col)
            .groupBy(word_col)
            .agg(F.count(F.lit(1)).alias(count_col)))


def normalize_counts(counts: DataFrame, word_col: str = "word",
                     count_col: str = "count") -> DataFrame:
    """Normalise the words of a (word, count) set and re-aggregate (P2, P3,
    F1, A3). Used by A1 on the raw-token counts."""
    normed = counts.select(T.normalize(word_col).alias(word_col), F.col(count_col))
    summed = normed.groupBy(word_col).agg(F.sum(count_col).cast("bigint").alias(count_col))
    # Pinned filter: it needs the sum, so Catalyst cannot push it under the
    # aggregates (a plain `word != ''` would travel down to the raw tokens and
    # run the regex per token). The regex runs once per distinct token; the
    # empty word is one extra group, dropped here.
    return summed.where(F.length(word_col) * F.col(count_col) > 0)


def word_count(df: DataFrame, col: str = "text", word_col: str = "word",
               count_col: str = "count") -> DataFrame:
    """A1 (flagship): normalised word count -> (word STRING, count BIGINT)."""
    return normalize_counts(token_count(df, col, word_col, count_col), word_col, count_col)


def word_count_line_first(df: DataFrame, col: str = "text", word_col: str = "word",
                          count_col: str = "count") -> DataFrame:
    """A1, single-shuffle form: lower-case and strip the whole text (the
    delimiters are kept), then split and count. Same result as
    :func:`word_count`; it is the form a streaming query can use, since it
    has one aggregation."""
    # After lower() no ASCII capital is left, so \p{Alnum} keeps [a-z0-9].
    cleaned = F.regexp_replace(F.lower(F.col(col)), T.STRIP_KEEP_DELIMITERS_REGEX, "")
    return (df.select(F.explode(T.split_blanks(cleaned)).alias(word_col))
              .where(F.col(word_col) != "")
              .groupBy(word_col)
              .agg(F.count(F.lit(1)).alias(count_col)))


def merge_counts(*counts: DataFrame, word_col: str = "word",
                 count_col: str = "count") -> DataFrame:
    """A3: merge earlier (word, count) sets by summing per word."""
    if not counts:
        raise ValueError("merge_counts needs at least one input")
    union = counts[0].select(word_col, count_col)
    for other in counts[1:]:
        union = union.unionByName(other.select(word_col, count_col))
    return union.groupBy(word_col).agg(F.sum(count_col).cast("bigint").alias(count_col))


def tokens_per_row(col: str | Column = "text") -> Column:
    """P1 as a scalar: number of non-empty tokens of a text."""
    return F.size(T.tokenize(col))
