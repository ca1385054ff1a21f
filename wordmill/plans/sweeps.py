"""Split-size sweep: the reference's block-size experiment in Spark terms.

For each split size the word count is run over the input, its wall time is
measured on the driver (P8), the read tasks are counted (R9) and the block
and metadata figures are derived from the file sizes (R5). One ``K=V`` record
per setting is appended to a results set (K4); the numbered report (R7) is
read back from that set. The loop is over a handful of settings; each step
is a distributed job.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.runlog import METADATA_BYTES_PER_BLOCK, Field, run_report, to_record
from ..operators.text import token_count, word_count
from ..session import scratch_path
from ..sinks.text import append_run, stage
from ..sources.splits import MB, read_tasks, session_with_splits
from ..sources.text import read_lines

SWEEP_FIELDS = [
    Field("SEQ", "int"),
    Field("BLOCKSIZE", "int"),
    Field("BLOCOS", "int"),
    Field("MAP_TASKS", "int"),
    Field("TEMPO_WC", "double"),
    Field("UPLOAD", "double"),
    Field("METADATA", "bigint"),
]


def blocks_of(spark: SparkSession, path: str, block_mb: int) -> int:
    """Blocks the input files take at ``block_mb`` (file sizes come from a
    listing; no file content is read, and only the sum reaches the driver)."""
    files = spark.read.format("binaryFile").load(path).select("length")
    got = files.agg(F.sum(F.ceil(F.col("length") / F.lit(block_mb * MB)))).first()[0]
    return int(got or 0)


def split_size_sweep(spark: SparkSession, path: str, sizes_mb: Sequence[int],
                     records_path: str | None = None, normalized: bool = False,
                     stage_input: bool = False) -> DataFrame:
    """Run the count once per split size; return the numbered report.

    With ``stage_input`` each setting first stages its own copy of the input,
    as the reference does (``UPLOAD`` is that time in seconds, else 0). The split
    size is set in a child session, so other queries never see it. A missing
    ``path`` raises :class:`~wordmill.sources.text.InputNotFound` (S5).
    """
    source = read_lines(spark, path)
    if records_path is None:
        records_path = f"{scratch_path(spark, 'sweep')}/records"
    for seq, size in enumerate(sizes_mb, start=1):
        child = session_with_splits(spark, size)
        staged, upload = path, 0.0
        if stage_input:
            staged = f"{scratch_path(spark, 'sweep-input')}/input"
            t0 = time.perf_counter()
            stage(source, staged)
            upload = time.perf_counter() - t0
        lines = read_lines(child, staged)
        counts = word_count(lines, "value") if normalized else token_count(lines, "value")
        t0 = time.perf_counter()
        counts.write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - t0
        tasks = read_tasks(child, staged)
        blocks = blocks_of(child, staged, size)
        record = spark.range(1).select(to_record([
            ("SEQ", F.lit(seq)), ("BLOCKSIZE", F.lit(size)), ("BLOCOS", F.lit(blocks)),
            ("MAP_TASKS", F.lit(tasks)), ("TEMPO_WC", F.lit(round(seconds, 3))),
            ("UPLOAD", F.lit(round(upload, 3))), ("METADATA", F.lit(blocks * METADATA_BYTES_PER_BLOCK)),
        ]).alias("value"))
        append_run(record, records_path, first=(seq == 1))
    recs = read_lines(spark, records_path).withColumnRenamed("value", "record")
    seq = F.regexp_extract("record", r"(?:^|\|)SEQ=(\d+)", 1).try_cast("int")
    recs = recs.withColumn("seq", seq)
    return run_report(recs, SWEEP_FIELDS[1:], order=["seq"])
