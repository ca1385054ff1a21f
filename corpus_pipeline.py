"""The corpus pipeline: documents in, packed training sequences out.

Each stage calls one operator on all that its predecessor kept. Its result is
written as Parquet in the shared scratch folder and read again as the next
stage's documents, so a lost executor costs at most a part of one stage.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.llm import decontaminate as decontamination
from wordmill.llm import langid, line_dedup, packing, simhash
from wordmill.llm.common import written

TOKENIZER = "byte_bpe_50k.json"
SHINGLE_WORDS = 3
MAX_BITS = 2

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in none of the learned languages go: those
    without a letter, and those that no profile fits at all. Profiles are
    learned from the rows that are not held out."""
    profiles = langid.learn(docs.where(~langid.held_out("doc_id")))
    judged = docs.withColumn("__lang", langid.verdict(profiles, F.col("text")))
    return judged.where(langid.accepted(F.col("__lang"))).drop("__lang")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each source go; every document stays."""
    out = line_dedup.line_dedup(docs, host_col="source", text_col="text")
    n_chars = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return out.withColumn("n_chars", n_chars).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays
    (of rows that repeat that id, one)."""
    return simhash.representatives(docs, "doc_id", "text", SHINGLE_WORDS, MAX_BITS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontamination.decontaminate(docs, benchmark)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in as few sequences as possible."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", drop_lines),
    ("simhash", near_duplicates),
    ("decontamination", decontaminate),
    ("packing", pack),
]

# Language identification, fingerprints and tokens are not expressible in SQL;
# the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the whole ``documents`` table on."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
