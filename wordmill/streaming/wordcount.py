"""Incremental word count over a growing folder of text files.

The batch job counts one staged input; here new files dropped into the
input folder are counted as they arrive, with the running totals kept in
Spark's state store (partitioned by word, so state grows with the
vocabulary, not with the text). Each micro-batch writes the full counts to a
folder of its own, and :func:`latest_counts` reads the newest folder that is
complete, so a reader never sees half a result.

The normalised count uses the single-aggregation form of A1 (a streaming
query cannot chain two aggregations in complete mode); its result equals
the batch A1.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.text import token_count, word_count_line_first
from ..session import checkpoint_dir


def streaming_counts(lines: DataFrame, normalized: bool = True, col: str = "value") -> DataFrame:
    """The running (word, count) aggregation of a streaming text frame."""
    return word_count_line_first(lines, col) if normalized else token_count(lines, col)


def latest_counts(spark: SparkSession, output_path: str) -> DataFrame:
    """The newest complete (word, count) set that the stream has published."""
    sc = spark.sparkContext
    root = sc._jvm.org.apache.hadoop.fs.Path(output_path)
    store = root.getFileSystem(sc._jsc.hadoopConfiguration())
    done = store.globStatus(sc._jvm.org.apache.hadoop.fs.Path(root, "epoch-*/_SUCCESS"))
    if not done:
        raise FileNotFoundError(output_path)
    return spark.read.parquet(max(str(s.getPath().getParent()) for s in done))


def start_word_count(spark: SparkSession, input_dir: str, output_path: str,
                     checkpoint_location: str | None = None, normalized: bool = True,
                     available_now: bool = True, max_files_per_trigger: int | None = None,
                     processing_time: str | None = None) -> StreamingQuery:
    """Start the stream. ``available_now`` processes what is there and stops
    (a repeatable incremental run); otherwise it runs on ``processing_time``.

    The state (one row per distinct word) is kept by the session's state
    store; for a large vocabulary name RocksDB there
    (``spark.sql.streaming.stateStore.providerClass``).

    Pass the same ``checkpoint_location`` on every run to continue the
    totals (and to recover after a failure); without one a new folder under
    the shared checkpoint folder is used and counting starts afresh.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    counts = streaming_counts(reader.load(input_dir), normalized)
    location = (checkpoint_location
                or f"{checkpoint_dir(spark).rstrip('/')}/stream-wc-{uuid.uuid4().hex}")

    def publish(batch: DataFrame, epoch: int) -> None:
        # A repeated epoch replaces its own folder only.
        batch.write.mode("overwrite").parquet(f"{output_path}/epoch-{epoch:012d}")

    writer = (counts.writeStream.outputMode("complete")
              .option("checkpointLocation", location)
              .foreachBatch(publish))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
