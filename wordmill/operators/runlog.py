"""Run-log and run-record operators (P5, P6, A5, A6, R5, R6, R7, R8, K4 line).

The reference's sweep scripts pull numbers out of job logs with grep, write
``KEY=VALUE|KEY=VALUE`` records, and print numbered reports. Here every step
is a DataFrame operator; per-run summaries are one grouped aggregation with
conditional aggregates, so a log is read once however many metrics it feeds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import runlog as R
from ..plans.ordering import Order, grouped_index
from .rank import numbered

# Fixed values from the reference: metadata bytes per block, and its sweep
# parameters (block sizes in MB, replication factors).
METADATA_BYTES_PER_BLOCK = 150
BLOCK_SIZES_MB = (32, 64, 128)
MB = 1024 * 1024
REPLICATION_FACTORS = (1, 2, 3)
# `grep -oP "=\K\d+"`: every run of digits right after an equals sign.
COUNTER_PATTERN = "=(\\d+)"
SUCCESS, FAILURE = "SUCCESS", "FAILURE"

Predicate = Callable[[Column], Column]


def contains(text: str) -> Predicate:
    """Case-sensitive substring test (``grep text``)."""
    return lambda c: c.contains(text)


def starts_with(text: str) -> Predicate:
    """Anchored test (``grep ^text``)."""
    return lambda c: c.startswith(text)


def matches(regex: str) -> Predicate:
    """Regex test (Java syntax)."""
    return lambda c: c.rlike(regex)


def _pred(marker: str | Predicate) -> Predicate:
    return contains(marker) if isinstance(marker, str) else marker


def extract_counters(df: DataFrame, marker: str | Predicate, col: str = "line",
                     keep: Sequence[str] | None = None, value_col: str = "value",
                     pos_col: str | None = "pos", pattern: str = COUNTER_PATTERN) -> DataFrame:
    """P5: every number after ``=`` on the lines that hold ``marker``.

    ``grep -o`` prints all matches, so a line with two ``=n`` parts gives two
    rows. Values too large for BIGINT become null rather than failing.
    """
    keep = list(keep if keep is not None else [c for c in df.columns if c != col])
    found = F.regexp_extract_all(F.col(col), F.lit(pattern), 1)
    hit = df.where(_pred(marker)(F.col(col)))
    if pos_col is None:
        out = hit.select(*keep, F.explode(found).alias("_v"))
        return out.select(*keep, F.col("_v").try_cast("bigint").alias(value_col))
    out = hit.select(*keep, F.posexplode(found).alias("_p", "_v"))
    return out.select(*keep, (F.col("_p") + 1).cast("long").alias(pos_col),
                      F.col("_v").try_cast("bigint").alias(value_col))


@dataclass(frozen=True)
class Field:
    """One typed field of a ``K=V`` record. ``default`` (literal or column)
    replaces a missing or empty value (P7)."""
    key: str
    type: str = "string"
    default: object = None
    name: str | None = None

    @property
    def column_name(self) -> str:
        return self.name or self.key


def field_column(col: str | Column, field: Field, pair_sep: str = "|", kv_sep: str = "=") -> Column:
    raw = R.kv_value(col, field.key, pair_sep, kv_sep)
    if field.default is not None:
        raw = R.or_default(raw, field.default)
    return raw.try_cast(field.type).alias(field.column_name)


def parse_kv(df: DataFrame, fields: Sequence[Field | str], col: str = "record",
             pair_sep: str = "|", kv_sep: str = "=",
             keep: Sequence[str] | None = None) -> DataFrame:
    """P6 (+P7): parse ``K=V<sep>K=V`` records into typed columns.

    A missing key gives null (or the field default); a value that does not
    parse as the field type gives null (``try_cast``), never a failed job.
    """
    keep = list(keep if keep is not None else [c for c in df.columns if c != col])
    specs = [f if isinstance(f, Field) else Field(f) for f in fields]
    return df.select(*keep, *[field_column(col, f, pair_sep, kv_sep) for f in specs])


def kv_rows(df: DataFrame, col: str = "record", pair_sep: str = "|", kv_sep: str = "=",
            keep: Sequence[str] | None = None, pos_col: str | None = None) -> DataFrame:
    """P6 without a field list: one row per record and key, ``keep, key,
    value``, whatever the keys are; with ``pos_col`` the place of the key among
    the record's keys, from 1.

    The first occurrence of a key wins, an empty value is null, a null record
    has no key. No shuffle: a record's keys are compared in its own row.
    """
    keep = list(keep if keep is not None else [c for c in df.columns if c != col])
    entries = R.kv_entries(col, pair_sep, kv_sep)
    rows = df.select(*keep, F.posexplode(entries).alias("_p", "_e"))
    place = [(F.col("_p") + 1).cast("long").alias(pos_col)] if pos_col else []
    return rows.select(*keep, *place, F.col("_e.key").alias("key"), F.col("_e.value").alias("value"))


def discover_keys(df: DataFrame, col: str = "record", pair_sep: str = "|", kv_sep: str = "=") -> DataFrame:
    """The keys that occur in the records of a set: ``key, n_records, n_values,
    n_numbers`` (records that have the key, with a value, with a number)."""
    rows = kv_rows(df.select(col), col, pair_sep, kv_sep, keep=[])
    return rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_records"), F.count("value").alias("n_values"),
        F.count(F.col("value").try_cast("decimal(38,10)")).alias("n_numbers"))


# The fields of the reference's five record layouts, in order.
RECORD_LAYOUTS: dict[str, tuple[Field, ...]] = {
    "block_size": (Field("BLOCKSIZE", "int"), Field("BLOCOS", "int"), Field("MAP_TASKS", "int"),
                   Field("TEMPO_WC", "double"), Field("UPLOAD", "double"), Field("METADATA", "bigint")),
    "node_memory": (Field("MEMORIA", "int"), Field("MAP_TASKS", "int"), Field("REDUCE_TASKS", "int"),
                    Field("TEMPO_WC", "double"), Field("CONTAINERS_MAX", "bigint")),
    "task_memory": (Field("MAP_MB", "int"), Field("REDUCE_MB", "int"), Field("MAP_TASKS", "int"),
                    Field("REDUCE_TASKS", "int"), Field("REEXEC", "bigint"), Field("FAILED", "bigint"),
                    Field("TEMPO_WC", "double")),
    "replication": (Field("REPLICACAO", "int"), Field("UPLOAD", "double"), Field("LEITURA", "double"),
                    Field("ESPACO_USADO"), Field("ESPACO_TOTAL"), Field("DATANODES", "int")),
    "vcores": (Field("VCORES", "int"), Field("MAP_TASKS", "int"), Field("REDUCE_TASKS", "int"),
               Field("TEMPO_WC", "double"), Field("VCORES_TOTAL", "bigint")),
}


def to_record(fields: Sequence[tuple[str, str | Column]], pair_sep: str = "|",
              kv_sep: str = "=") -> Column:
    """K4 line: ``KEY=VALUE`` pairs joined by ``|`` (the appended record)."""
    parts = [F.concat(F.lit(k + kv_sep), F.coalesce((F.col(v) if isinstance(v, str) else v)
                                                   .cast("string"), F.lit("")))
             for k, v in fields]
    return F.concat_ws(pair_sep, *parts)


def count_matching(df: DataFrame, markers: dict[str, str | Predicate], col: str = "line",
                   by: Sequence[str] = (), total_col: str | None = "n_lines") -> DataFrame:
    """A5: lines holding each marker (``grep -c``), per group, in one pass."""
    c = F.col(col)
    aggs = [F.count_if(_pred(m)(c)).alias(name) for name, m in markers.items()]
    if total_col:
        aggs.insert(0, F.count(F.lit(1)).alias(total_col))
    grouped = df.groupBy(*by) if by else df.groupBy()
    return grouped.agg(*aggs)


def status_of(flag: Column) -> Column:
    return F.when(flag, F.lit(SUCCESS)).otherwise(F.lit(FAILURE))


def status(df: DataFrame, marker: str | Predicate, col: str = "line",
           by: Sequence[str] = (), status_col: str = "status") -> DataFrame:
    """SUCCESS when any line of the group holds the marker."""
    any_hit = F.coalesce(F.bool_or(_pred(marker)(F.col(col))), F.lit(False))
    grouped = df.groupBy(*by) if by else df.groupBy()
    return grouped.agg(status_of(any_hit).alias(status_col))


def _sweep(agg_df: DataFrame, by: Sequence[str], param_col: str,
           columns: dict[int, dict[str, str]], params: Sequence[int]) -> DataFrame:
    """Turn one wide row per group (one column per parameter and metric)
    into one row per (group, parameter), with no join."""
    metric_names = list(next(iter(columns.values())).keys())
    structs = [F.struct(F.lit(p).cast("int").alias(param_col),
                        *[F.col(columns[p][m]).alias(m) for m in metric_names])
               for p in params]
    return (agg_df.select(*by, F.explode(F.array(*structs)).alias("_s"))
                  .select(*by, "_s.*"))


def block_footprint(df: DataFrame, col: str = "text", sizes: Sequence[int] = BLOCK_SIZES_MB,
                    by: Sequence[str] = (), size_col: str = "block_size_mb",
                    unit_bytes: int = MB) -> DataFrame:
    """Per block size, the files, bytes, blocks and metadata bytes.

    Each row is one file of ``octet_length(col)`` bytes; it takes
    ``ceil(bytes / block)`` blocks (an empty file takes none) and every block
    costs 150 bytes of metadata. ``sizes`` are in units of ``unit_bytes``
    (MB unless given). All sizes are summed in one scan.
    """
    nbytes = F.octet_length(F.col(col)).cast("long")
    # coalesce: an empty input takes 0 bytes and 0 blocks, not null.
    aggs = [F.count(F.lit(1)).alias("files"), F.coalesce(F.sum(nbytes), F.lit(0)).alias("bytes")]
    cols: dict[int, dict[str, str]] = {}
    for s in sizes:
        name = f"_blocks_{s}"
        blocks = F.sum(F.ceil(nbytes / F.lit(s * unit_bytes))).cast("long")
        aggs.append(F.coalesce(blocks, F.lit(0).cast("long")).alias(name))
        cols[s] = {"files": "files", "bytes": "bytes", "blocks": name}
    grouped = df.groupBy(*by) if by else df.groupBy()
    wide = grouped.agg(*aggs)
    out = _sweep(wide, by, size_col, cols, sizes)
    return out.withColumn("metadata_bytes", F.col("blocks") * METADATA_BYTES_PER_BLOCK)


def replica_footprint(df: DataFrame, col: str = "text",
                      factors: Sequence[int] = REPLICATION_FACTORS, by: Sequence[str] = (),
                      factor_col: str = "replication") -> DataFrame:
    """Logical and replicated bytes per replication factor."""
    nbytes = F.octet_length(F.col(col)).cast("long")
    grouped = df.groupBy(*by) if by else df.groupBy()
    wide = grouped.agg(F.coalesce(F.sum(nbytes), F.lit(0)).alias("logical_bytes"))
    cols = {r: {"logical_bytes": "logical_bytes"} for r in factors}
    out = _sweep(wide, by, factor_col, cols, factors)
    return out.withColumn("total_bytes", F.col("logical_bytes") * F.col(factor_col))


def run_report(records: DataFrame, fields: Sequence[Field | str], order: Sequence[str],
               col: str = "record", number_col: str = "i", pair_sep: str = "|",
               kv_sep: str = "=") -> DataFrame:
    """Parse appended run records (P6, P7) and number them (O3) in
    ``order`` (arrival order in the reference)."""
    parsed = parse_kv(records, fields, col, pair_sep, kv_sep, keep=list(order))
    return numbered(parsed, list(order), number_col)


@dataclass(frozen=True)
class Counter:
    """The numbers on the log lines that hold ``marker`` (P5), all of them in
    log order, else the text ``default`` (P7)."""
    name: str
    marker: str | Predicate
    default: object = 0
    pattern: str = COUNTER_PATTERN


def _found(ctr: Counter, line: Column) -> tuple[Column, Column]:
    """The numbers of a counter on a line, and whether the line has any."""
    numbers = F.regexp_extract_all(line, F.lit(ctr.pattern), 1)
    return numbers, F.coalesce(_pred(ctr.marker)(line) & (F.size(numbers) > 0), F.lit(False))


# Sorts arrays of numbers as Spark sorts the arrays: no number holds a NUL.
_NUL = "\0"


def run_numbers(logs: DataFrame, counters: Sequence[Counter], by: Sequence[str] = ("run",), col: str = "line",
                order: Sequence[Order] = ("line_no",), num_ranges: int | None = None) -> DataFrame:
    """R8, the numbers of a run of any size as rows: ``by, counter, pos,
    number, value``.

    ``pos`` numbers what a counter found in a run, from 1, in line order (lines
    of equal order by their numbers) and along the line; ``number`` is the
    text, ``value`` the BIGINT (null if it is none). The lines of a run are
    merged in two levels (:func:`~wordmill.plans.ordering.grouped_index`):
    ranked per range of the order, then shifted by the ranges before, so no
    task holds all lines of a hot run. Null keys form a run of their own.
    """
    line, by = F.col(col), list(by)
    keys = [k.column if hasattr(k, "column") else k for k in order]
    names = [f"_o{i}" for i in range(len(keys))]
    hits = []
    for ctr in counters:
        numbers, hit = _found(ctr, line)
        hits.append(F.when(hit, F.struct(F.lit(ctr.name).alias("counter"), numbers.alias("numbers"))))
    rows = (logs.select(*by, *[(F.col(k) if isinstance(k, str) else k).alias(n) for k, n in zip(keys, names)],
                        F.explode(F.array_compact(F.array(*hits))).alias("_h"))
            .groupBy(*by, *names, F.col("_h.counter").alias("counter"), F.col("_h.numbers").alias("_numbers"))
            .agg(F.count(F.lit(1)).alias("_copies"))
            .withColumn("_text", F.array_join("_numbers", _NUL)))
    marks = [type(k)(n) if hasattr(k, "column") else n for k, n in zip(order, names)]
    placed = grouped_index(rows, [*by, "counter"], [*marks, "_text"], "_start",
                           weight=F.col("_copies") * F.size("_numbers"), num_ranges=num_ranges)
    return (placed.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
            .select(*by, "counter", "_start", "_copy", F.size("_numbers").alias("_n"), F.posexplode("_numbers").alias("_i", "number"))
            .select(*by, "counter", (F.col("_start") + F.col("_copy") * F.col("_n") + F.col("_i")).alias("pos"),
                    "number", F.col("number").try_cast("bigint").alias("value")))


def run_summary(logs: DataFrame, by: Sequence[str] = ("run",), col: str = "line",
                order: Sequence[str | Column] = ("line_no",), counters: Sequence[Counter] = (),
                line_counts: dict[str, str | Predicate] | None = None,
                success_marker: str | Predicate | None = "completed successfully",
                status_col: str = "status") -> DataFrame:
    """R8 for runs of any size: one row per run, in one grouped pass of partial
    aggregates of fixed size, so a run with a third of all lines costs one row
    per task.

    As :func:`log_summary`, but a counter ``c`` gives its first number in line
    order (``c``, text, else the default; ``c_value``, BIGINT) and how many
    there are (``c_count``); :func:`run_numbers` has them all, as rows.
    """
    line = F.col(col)
    places = [F.col(k) if isinstance(k, str) else k for k in order]
    aggs: list[Column] = [F.count(F.lit(1)).alias("n_lines")]
    for ctr in counters:
        numbers, hit = _found(ctr, line)
        at = F.struct(*[p.alias(f"o{i}") for i, p in enumerate(places)], F.array_join(numbers, _NUL).alias("text"),
                      F.get(numbers, F.lit(0)).alias("number"))
        first = F.coalesce(F.min(F.when(hit, at))["number"], F.lit(str(ctr.default)))
        text = R.or_default(F.min(F.when(hit, at))["number"], ctr.default)
        aggs += [text.alias(ctr.name), first.try_cast("bigint").alias(f"{ctr.name}_value"),
                 F.coalesce(F.sum(F.when(hit, F.size(numbers))), F.lit(0)).cast("long").alias(f"{ctr.name}_count")]
    for name, marker in (line_counts or {}).items():
        aggs.append(F.count_if(_pred(marker)(line)).alias(name))
    if success_marker is not None:
        any_hit = F.coalesce(F.bool_or(_pred(success_marker)(line)), F.lit(False))
        aggs.append(status_of(any_hit).alias(status_col))
    return logs.groupBy(*by).agg(*aggs)


def log_summary(logs: DataFrame, by: Sequence[str] = ("run",), col: str = "line",
                order_col: str = "line_no", counters: Sequence[Counter] = (),
                line_counts: dict[str, str | Predicate] | None = None,
                success_marker: str | Predicate | None = "completed successfully",
                status_col: str = "status") -> DataFrame:
    """One row per run from its log lines, in a single grouped pass.

    Counters (P5+P7), marker line counts (A5, e.g. ``Resubmitting`` and
    ``failed``, case-sensitive) and the run status (A6).

    A counter ``c`` gives two columns. ``c`` is text: every number found, in
    line order, one per line as ``grep -o`` prints them, or the default as it
    is (``N/A`` stays ``N/A``). ``c_value`` is the first of them as BIGINT
    (null if it is no number). A run's numbers are kept in its row, as the
    reference keeps them in a variable, so a row grows with its run: for logs
    with very many marker lines per run use :func:`run_summary` and
    :func:`run_numbers`.
    """
    line = F.col(col)
    aggs: list[Column] = [F.count(F.lit(1)).alias("n_lines")]
    for ctr in counters:
        found = F.regexp_extract_all(line, F.lit(ctr.pattern), 1)
        hit = _pred(ctr.marker)(line) & (F.size(found) > 0)
        # Lines of equal order sort by their numbers, so the result is the same on every run.
        ordered = F.sort_array(F.collect_list(F.when(
            hit, F.struct(F.col(order_col).alias("at"), found.alias("numbers")))))
        numbers = F.flatten(F.transform(ordered, lambda o: o["numbers"]))
        text = R.or_default(F.array_join(numbers, "\n"), ctr.default)
        first = F.coalesce(F.try_element_at(numbers, F.lit(1)), F.lit(str(ctr.default)))
        aggs += [text.alias(ctr.name), first.try_cast("bigint").alias(f"{ctr.name}_value")]
    for name, marker in (line_counts or {}).items():
        aggs.append(F.count_if(_pred(marker)(line)).alias(name))
    if success_marker is not None:
        any_hit = F.coalesce(F.bool_or(_pred(success_marker)(line)), F.lit(False))
        aggs.append(status_of(any_hit).alias(status_col))
    return logs.groupBy(*by).agg(*aggs)
