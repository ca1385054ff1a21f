"""Global 1..n numbering of a DataFrame without a single-partition window.

``row_number().over(Window.orderBy(...))`` moves every row into one task. Here
a sample of the order keys is taken once, when the frame is built, and gives
the bounds of key ranges. They go into the plan as literals: a row's range is
an expression of its own keys, the same in every pass, task and retry. The rows
are sent to their ranges and sorted there; a row's position in its range plus
the sizes of the ranges before (one row per range, whatever the data holds,
broadcast back) is its number. Nothing is written and no job but the sample's
runs before the result is asked for.

Both the sizes and the rows read the one exchange (Spark reuses it); where a
caller drops columns and it cannot be reused, the literal bounds still send
each row to the same range, provided that the input gives the same rows again.

Keys without literals (structs, arrays, timestamps) and sort-order columns take
the older way: the range-partitioned frame is checkpointed first.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir

# monotonically_increasing_id() = (partition index << 33) + row position.
_PARTITION_SHIFT = 33
# Rows per range aimed at where no number of ranges is given.
ROWS_PER_RANGE = 10_000
# A partition's n-th row is in the sample with probability m / n: all of the
# first m rows, and a number that grows with the logarithm of the rest. m is
# SAMPLE over the number of ranges, within these limits.
SAMPLE, SAMPLE_LIMITS = 12_800, (8, 128)
_LITERAL_TYPES = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                  T.BooleanType, T.DecimalType, T.DateType, T.BinaryType)


@dataclass(frozen=True)
class Descending:
    """An order key, largest first, nulls last."""
    column: str | Column


Order = str | Column | Descending


def _col(key: Order) -> Column:
    key = key.column if isinstance(key, Descending) else key
    return F.col(key) if isinstance(key, str) else key


def _sort(column: Column, key: Order) -> Column:
    return column.desc() if isinstance(key, Descending) else column.asc()


def _before(column: Column, bound: Column, down: bool) -> Column:
    """Whether a key sorts before a bound (nulls are least)."""
    if down:
        return F.coalesce(column > bound, column.isNotNull() & bound.isNull())
    return F.coalesce(column < bound, column.isNull() & bound.isNotNull())


def _row_before(columns: list[Column], bounds: list[Column], down: list[bool]) -> Column:
    (column, *columns), (bound, *bounds), (first, *down) = columns, bounds, down
    before = _before(column, bound, first)
    return before | (column.eqNullSafe(bound) & _row_before(columns, bounds, down)) if columns else before


def range_bounds(df: DataFrame, keys: list[Order], names: list[str], num_ranges: int | None) -> list[tuple]:
    """Bounds of at most ``num_ranges`` ranges of about equal size, from one
    job over ``df``, whose columns ``names`` hold the keys. They are values of
    rows of ``df``, in order; a row is in range ``i`` if ``i`` of them are not
    after it. Without ``num_ranges`` a range has about
    :data:`ROWS_PER_RANGE` rows, and there are no more than shuffle partitions.
    """
    most = num_ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = min(max(SAMPLE // most, SAMPLE_LIMITS[0]), SAMPLE_LIMITS[1])
    place = F.monotonically_increasing_id() % F.lit(1 << _PARTITION_SHIFT)
    sample = (df.select(*names, place.alias("_wm_place"), F.rand(1).alias("_wm_rand"))
              .where(F.col("_wm_rand") * (F.col("_wm_place") + 1) < first)
              .select(*names, F.greatest(F.lit(1.0), (F.col("_wm_place") + 1) / first).alias("_wm_weight")))
    order = Window.orderBy(*[_sort(F.col(n), k) for n, k in zip(names, keys)])
    total = F.sum("_wm_weight").over(Window.partitionBy())
    ranges = F.lit(float(most)) if num_ranges else F.least(F.lit(float(most)), F.ceil(total / ROWS_PER_RANGE))
    upto = F.sum("_wm_weight").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    at = sample.select(*names, F.floor(upto * ranges / total).alias("_wm_at"))
    bounds = (at.withColumn("_wm_last", F.lag("_wm_at", 1, 0).over(order))
              .where((F.col("_wm_at") > F.col("_wm_last")) & (F.col("_wm_at") < most))
              .select(*names).distinct().orderBy(*[_sort(F.col(n), k) for n, k in zip(names, keys)]))
    return [tuple(r) for r in bounds.collect()]  # fewer rows than ranges


def range_of(df: DataFrame, keys: list[Order], names: list[str], bounds: list[tuple]) -> Column:
    """The range of each row: a binary search in literal arrays of bounds."""
    if not bounds:
        return F.lit(0)
    types = [df.schema[n].dataType for n in names]
    columns = [F.array(*[F.lit(b[i]).cast(t) for b in bounds]) for i, t in enumerate(types)]
    down = [isinstance(k, Descending) for k in keys]
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def advance(low: Column, step: Column) -> Column:
        to = low + step
        after = ~_row_before([F.col(n) for n in names], [F.get(c, to - 1) for c in columns], down)
        return F.when((to <= len(bounds)) & after, to).otherwise(low)
    return F.aggregate(F.array(*[F.lit(i) for i in steps]), F.lit(0), advance)


def _literal(df: DataFrame, keys: Sequence[Order]) -> bool:
    """Whether every key has a type whose values can stand in a plan."""
    if any(isinstance(k, Column) and re.search(r" (ASC|DESC) NULLS (FIRST|LAST)'>$", str(k)) for k in keys):
        return False
    return all(isinstance(f.dataType, _LITERAL_TYPES) for f in df.select(*[_col(k) for k in keys]).schema)


def range_sorted(df: DataFrame, order: list[str | Column],
                 num_partitions: int | None = None) -> DataFrame:
    """Range-partition on ``order`` and sort inside each partition.

    Without ``num_partitions`` adaptive execution may merge neighbouring
    ranges of a small result (global order is kept), so a 4-row report is
    not spread over hundreds of partitions while a large one keeps many.
    """
    if num_partitions:
        return df.repartitionByRange(int(num_partitions), *order).sortWithinPartitions(*order)
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def _tie(df: DataFrame) -> Column:
    """A hash of the row; map columns cannot be hashed."""
    hashable = [F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t]
    return F.xxhash64(*hashable) if hashable else F.lit(0).cast("long")


def global_index(df: DataFrame, order: Sequence[Order], name: str = "rank",
                 num_partitions: int | None = None, distinct_rows: bool = False) -> DataFrame:
    """Add ``name`` = 1-based position of each row in ``order``.

    Rows with equal ``order`` keys are ordered by a hash of the whole row,
    which also lets a key that holds a large share of the rows be split
    instead of going to one task. Identical rows are counted first and numbered
    among themselves (copy 1..n), so they are split as well, and a retried task
    numbers them as before; ``distinct_rows`` tells that there are none (the
    counts of words) and saves that aggregation. The result keeps the ranges
    and the order. Building it runs the sampling job only.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    row_hash = _tie(df)
    tie: list[Order] = [row_hash]
    if not distinct_rows:
        df = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_wm_copies"))
              .select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), "_wm_copies")).alias("_wm_copy")))
        tie.append(F.col("_wm_copy"))
    keys = [*order, *tie]
    if not _literal(df, keys):
        return _checkpointed_index(df, cols, [_sort(_col(k), k) if isinstance(k, Descending) else _col(k)
                                              for k in keys], name, num_partitions)
    names = [f"_wm_k{i}" for i in range(len(keys))]
    keyed = df.select(*cols, *[_col(k).alias(n) for k, n in zip(keys, names)])
    bounds = range_bounds(keyed, keys, names, num_partitions)
    dealt = (keyed.withColumn("_wm_range", range_of(keyed, keys, names, bounds))
             .repartitionById(len(bounds) + 1, F.col("_wm_range")))
    # least(1, ...) is 1; it keeps all columns in both branches, so that they
    # share one exchange.
    one = F.least(F.lit(1), F.bit_count(row_hash) + 1)
    sizes = dealt.groupBy("_wm_range").agg(F.sum(one).alias("_wm_n"))
    offsets = sizes.select("_wm_range", (F.sum("_wm_n").over(Window.orderBy("_wm_range")) - F.col("_wm_n"))
                           .alias("_wm_off"))
    sorted_rows = dealt.sortWithinPartitions(*[_sort(F.col(n), k) for n, k in zip(names, keys)])
    place = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), _PARTITION_SHIFT)
    moved = F.raise_error(F.lit("a range was not read as one partition")).cast("long")
    placed = sorted_rows.select(*cols, "_wm_range", F.when(F.spark_partition_id() == F.col("_wm_range"), place)
                                .otherwise(moved).alias("_wm_place"))
    # One (int, long) row per range, whatever the data holds: a broadcast join
    # streams the ranges in place, so their order is kept.
    return (placed.join(F.broadcast(offsets), "_wm_range")
            .select(*cols, (F.col("_wm_off") + F.col("_wm_place") + 1).alias(name)))


def grouped_index(df: DataFrame, by: Sequence[str], order: Sequence[Order], name: str = "pos",
                  weight: str | Column | None = None, num_ranges: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based position of each row in its group, in ``order``;
    with ``weight`` (long) 1 + the sum of the weights before it.

    Two levels: rows are ranked per (group, key range), ranges as in
    :func:`global_index`, and shifted by what the group has in the ranges
    before. A group of any size is spread over as many tasks as its ranges.
    Rows equal in group and order keys stay together (count them first and give
    the count as weight); their order among themselves is any. Order keys need
    literal types.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    keys: list[Order] = [F.xxhash64(*by), *order]
    if not _literal(df, keys):
        raise TypeError("order keys of grouped_index need literal types")
    names = [f"_wm_k{i}" for i in range(len(keys))]
    amount = F.lit(1).cast("long") if weight is None else F.col(weight) if isinstance(weight, str) else weight
    keyed = df.select(*cols, *[_col(k).alias(n) for k, n in zip(keys, names)], amount.alias("_wm_w"))
    bounds = range_bounds(keyed, keys, names, num_ranges)
    ranged = keyed.withColumn("_wm_range", range_of(keyed, keys, names, bounds))
    sizes = ranged.groupBy("_wm_range", *by).agg(F.sum("_wm_w").alias("_wm_n"))
    before = Window.partitionBy(*by).orderBy("_wm_range")
    offsets = sizes.select(F.col("_wm_range").alias("_wm_r"), *[F.col(f"`{c}`").alias(f"_wm_by{i}") for i, c in enumerate(by)],
                           (F.sum("_wm_n").over(before) - F.col("_wm_n")).alias("_wm_off"))
    inside = (Window.partitionBy("_wm_range", *by)
              .orderBy(*[_sort(F.col(n), k) for n, k in zip(names[1:], order)])
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = ranged.withColumn("_wm_place", F.sum("_wm_w").over(inside) - F.col("_wm_w"))
    same = (F.col("_wm_range") == F.col("_wm_r"))
    for i, c in enumerate(by):  # a null group is a group
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"_wm_by{i}"))
    return placed.join(offsets, same).select(*cols, (F.col("_wm_off") + F.col("_wm_place") + 1).alias(name))


def _checkpointed_index(df: DataFrame, cols: list[Column], keys: list[Column], name: str,
                        num_partitions: int | None) -> DataFrame:
    """:func:`global_index` by a range-partitioned frame that is checkpointed to
    the shared folder, so that both passes see the same ranges."""
    checkpoint_dir(df.sparkSession)
    frozen = range_sorted(df, keys, num_partitions).checkpoint(eager=True)
    tagged = frozen.select(*cols, F.spark_partition_id().alias("_wm_pid"),
                           F.monotonically_increasing_id().alias("_wm_mid"))
    sizes = tagged.groupBy("_wm_pid").agg(F.count(F.lit(1)).alias("_wm_n"))
    offsets = sizes.select("_wm_pid", (F.sum("_wm_n").over(Window.orderBy("_wm_pid")) - F.col("_wm_n"))
                           .alias("_wm_off"))
    place = F.col("_wm_mid") - F.shiftleft(F.col("_wm_pid").cast("long"), _PARTITION_SHIFT)
    return (tagged.join(F.broadcast(offsets), "_wm_pid")
            .select(*cols, (F.col("_wm_off") + place + 1).alias(name)))
