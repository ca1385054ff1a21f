"""Exact dedup by progressive refinement (operator 7), DataFrame functions only.

Texts are equal when they are identical after white space
(``[\\x20\\x09-\\x0D]``) is deleted. Candidates shrink level by level: rows
that share a length, of those the rows that share a hash of the first
characters, of those the rows that share the SHA-256 of the whole text. The
levels shuffle key columns only. (Where the digest is left to the survivors,
their texts are found by a semi join on the surviving keys: a broadcast while
these are few, measured, else a shuffle.)

Every level is a partial aggregate followed by a join with the (small) set of
surviving keys. The key set is written first, so both join sides are plain
shuffles and adaptive execution splits a hot key; no group ever meets in one
task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, frozen, text_or_empty

PREFIX_CHARS = 256
_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text_col: str):
    """The text without white space; a null text is empty."""
    return F.regexp_replace(text_or_empty(text_col), _SPACE, "")


def _shared(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that at least two rows have; while they are few, the rows of
    the next level stay where they are, whatever share one key holds."""
    shared = frozen(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys))
    return broadcast_if_small(shared, 16 + 8 * len(keys))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest_all: bool = False, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the most code points in the original text
    stays, then the smallest id (a null id comes last), then, among rows that
    repeat an id, exactly one. ``text_sha256`` is the lower-case hex digest of
    the normalised text. Without ``digest_all`` the whole content is read and
    digested only for rows that still share length and prefix (others get
    null); with it the caller asks for the digest of every row, so it is taken
    in the scan, and the levels still decide which rows are grouped by it.
    A null text counts as empty; an empty table gives an empty result; other
    columns are ignored.
    """
    text = docs.select(F.col(id_col).alias("id"),
                       F.length(text_or_empty(text_col)).cast("long").alias("n_cp"),
                       normalised(text_col).alias("norm"))
    full = F.sha2(F.col("norm"), 256)
    light = [F.col("id"), F.col("n_cp"), F.octet_length("norm").alias("n_bytes"),
             F.xxhash64(F.substring("norm", 1, prefix_chars)).alias("prefix")]
    sig = frozen(text.select(*light, (full if digest_all else F.lit(None).cast("string")).alias("sha")))

    same_length = _shared(sig, ["n_bytes"])
    same_prefix = _shared(sig.join(same_length, ["n_bytes"], "left_semi"), ["n_bytes", "prefix"])
    if not digest_all:
        # The second read of the texts: the digest is computed for survivors only.
        survivors = (text.select(*light, "norm").join(same_prefix, ["n_bytes", "prefix"], "left_semi")
                     .select("id", "n_cp", "n_bytes", "prefix", full.alias("sha")))
        singles = sig.join(same_prefix, ["n_bytes", "prefix"], "left_anti")
        sig = frozen(survivors.unionByName(singles))
    # The rows are in checkpoint files now, so this number is stable.
    sig = sig.withColumn("rid", F.monotonically_increasing_id())
    survivors = sig.join(same_prefix, ["n_bytes", "prefix"], "left_semi")

    order = F.struct((-F.col("n_cp")).alias("n_cp"), F.col("id").isNull().alias("no_id"),
                     F.col("id").alias("id"), F.col("rid").alias("rid"))
    key = ["n_bytes", "prefix", "sha"]
    groups = frozen(survivors.groupBy(*key)
                    .agg(F.count(F.lit(1)).alias("size"), F.min(order).alias("keep"))
                    .where("size > 1"))
    grouped = sig.join(groups, key, "left")
    alone = F.col("size").isNull()
    return grouped.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("keep.rid") == F.col("rid"))).alias("kept"),
        F.col("sha").alias("text_sha256"))
