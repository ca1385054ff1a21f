"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir, scratch_path

# A table is broadcast by hint only when it was written and measured first and
# holds at most this many bytes; beyond that the same join runs as a shuffle
# join (split by adaptive execution where a key is hot).
BROADCAST_BYTES = 32 << 20

# Texts are handed to numpy code in slices of about this many bytes, so the
# memory of a task does not depend on the Arrow batch size.
SLICE_BYTES = 1 << 20


def frozen(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and reread: later
    stages survive lost executors and do not compute it again."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in a scratch folder, reread."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, row_bytes: int) -> DataFrame:
    """Broadcast hint for an already materialised table whose measured size
    (rows x ``row_bytes``) is at most :data:`BROADCAST_BYTES`."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def text_slices(ids: pa.Array, texts: pa.Array) -> Iterator[tuple[list, list[str]]]:
    """Slices of a batch of about :data:`SLICE_BYTES` each (one text at least);
    a null text is an empty one."""
    rows: list = []
    part: list[str] = []
    size = 0
    for key, text in zip(ids, texts):
        value = text.as_py() or ""
        rows.append(key.as_py())
        part.append(value)
        size += len(value) + 64
        if size >= SLICE_BYTES:
            yield rows, part
            rows, part, size = [], [], 0
    if rows:
        yield rows, part


#: What this Python worker keeps from task to task.
_kept: dict = {}


def kept(make: Callable, *key):
    """``make(*key)``, made once per Python worker, which runs many tasks. A
    worker keeps what was asked for last only."""
    if (make, key) not in _kept:
        _kept.clear()
        _kept[make, key] = make(*key)
    return _kept[make, key]


@cache
def _trim() -> Callable | None:
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def _release() -> None:
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim:
        trim(0)


def worker_batches(batches: Iterable, keeps: bool = False) -> Iterator:
    """The batches of a task in a Python worker. Workers go on to the tasks of
    other operators, in an executor with little memory beside the heap: what
    another operator kept goes first (unless the task ``keeps`` its own, see
    :func:`kept`), and after each batch what the allocators hold unused goes
    back to the system."""
    if not keeps and _kept:
        _kept.clear()
        _release()
    for batch in batches:
        yield batch
        del batch
        _release()


def map_texts(df: DataFrame, id_col: str, text_col: str, schema: str,
              per_slice: Callable[[], Callable[[list, list[str]], dict]], keeps: bool = False) -> DataFrame:
    """Run ``per_slice()(ids, texts) -> columns`` over slices of the table.

    ``per_slice`` is called once per task, so it can load a model there
    (``keeps``: by :func:`kept`).
    """
    names = [part.split()[0] for part in schema.split(",")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = per_slice()
        for batch in worker_batches(batches, keeps):
            for ids, texts in text_slices(batch.column(0), batch.column(1)):
                columns = work(ids, texts)
                yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, schema)
