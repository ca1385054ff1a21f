"""S3: the repeatable synthetic corpus.

The reference writes ``n_lines`` lines in blocks of equal lines; each block's
line is one leading space and 15 words drawn from a 16-word list. Its
``$RANDOM`` draw is replaced by an md5-derived index, so the corpus is the
same on every run and any SQL engine can rebuild it:

    index(block, j) = int(first 8 hex digits of md5('<seed>:<block>:<j>')) mod |vocab|

Generation is shuffle-free: one row per block (the only place md5 runs),
then ``explode(array_repeat(line, block_lines))``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values that must equal the reference's generator: the 16-word
# vocabulary (in its order), words per line, lines per block, total lines.
VOCABULARY = (
    "hadoop mapreduce yarn hdfs datanode namenode distributed computing "
    "big data processing cluster parallel framework apache java"
).split()
WORDS_PER_LINE = 15
BLOCK_LINES = 5_000
TOTAL_LINES = 4_000_000


def word_index(block: Column, j: int, seed: int, vocab_size: int) -> Column:
    key = F.concat_ws(":", F.lit(str(seed)), block.cast("string"), F.lit(str(j)))
    hex8 = F.substring(F.md5(key), 1, 8)
    return F.pmod(F.conv(hex8, 16, 10).cast("long"), F.lit(vocab_size))


def block_line(block: str | Column, seed: int = 0, words_per_line: int = WORDS_PER_LINE,
               vocabulary: Sequence[str] = VOCABULARY) -> Column:
    """The line of one block: a leading space, then the words joined by
    single spaces."""
    b = F.col(block) if isinstance(block, str) else block
    vocab = F.array(*[F.lit(w) for w in vocabulary])
    words = [F.element_at(vocab, (word_index(b, j, seed, len(vocabulary)) + 1).cast("int"))
             for j in range(words_per_line)]
    return F.concat(F.lit(" "), F.concat_ws(" ", *words))


# Target bytes of text per generated partition.
PARTITION_BYTES = 128 * 1024 * 1024


def _partitions_for(spark: SparkSession, lines: int, words_per_line: int,
                    vocabulary: Sequence[str], n_blocks: int) -> int:
    """Enough partitions for every core, and for about 128 MB of text each;
    never more than there are blocks."""
    avg_word = sum(len(w) for w in vocabulary) / len(vocabulary)
    est_bytes = lines * (1 + words_per_line * (avg_word + 1))
    by_size = math.ceil(est_bytes / PARTITION_BYTES)
    return max(1, min(n_blocks, max(by_size, spark.sparkContext.defaultParallelism)))


def corpus(spark: SparkSession, n_lines: int = TOTAL_LINES, words_per_line: int = WORDS_PER_LINE,
           block_lines: int = BLOCK_LINES, seed: int = 0,
           vocabulary: Sequence[str] = VOCABULARY, num_partitions: int | None = None,
           with_ids: bool = False) -> DataFrame:
    """S3: the corpus as a text-source frame (``value``), ``n_lines`` rounded
    up to whole blocks as the reference's loop does.

    ``with_ids`` adds ``line_id`` (0-based line number) and ``block``.
    """
    n_blocks = math.ceil(n_lines / block_lines)
    parts = num_partitions or _partitions_for(spark, n_blocks * block_lines, words_per_line,
                                              vocabulary, n_blocks)
    blocks = spark.range(0, n_blocks, 1, parts).withColumnRenamed("id", "block")
    lined = blocks.select("block", block_line("block", seed, words_per_line, vocabulary)
                          .alias("value"))
    if not with_ids:
        return lined.select(F.explode(F.array_repeat("value", block_lines)).alias("value"))
    rep = lined.select("block", F.posexplode(F.array_repeat("value", block_lines))
                       .alias("_k", "value"))
    return rep.select((F.col("block") * block_lines + F.col("_k")).alias("line_id"),
                      "block", "value")


def corpus_for(df: DataFrame, id_col: str, block_lines: int = BLOCK_LINES, seed: int = 0,
               words_per_line: int = WORDS_PER_LINE,
               vocabulary: Sequence[str] = VOCABULARY) -> DataFrame:
    """S3 keyed by an existing id column: line ``id`` of the corpus for each
    row (block ``id div block_lines``), so the corpus grows with a table."""
    block = F.floor(F.col(id_col) / block_lines).cast("long")
    return df.select(F.col(id_col).alias("line_id"), block.alias("block")).select(
        "line_id", "block", block_line("block", seed, words_per_line, vocabulary).alias("value"))
