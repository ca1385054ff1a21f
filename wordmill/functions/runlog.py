"""Column expressions for run records and run logs (P6 value access, P7-P11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values from the reference's capacity arithmetic: two worker nodes,
# 512 MB kept for the application master, 1024 MB per container, at least
# one container.
NODES = 2
AM_MEMORY_MB = 512
CONTAINER_MB = 1024
MIN_CONTAINERS = 1

_REGEX_META = set("\\^$.|?*+()[]{}")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def regex_quote(text: str) -> str:
    """Escape ``text`` for a regex that both Java and RE2 read the same way."""
    return "".join("\\" + ch if ch in _REGEX_META else ch for ch in text)


def kv_value(col: str | Column, key: str, pair_sep: str = "|", kv_sep: str = "=") -> Column:
    """The value of ``key`` in a ``K=V<sep>K=V`` record, or null.

    The key must start the record or follow a separator and be followed by
    ``kv_sep``, so ``VCORES`` never matches ``VCORES_TOTAL``; the value stops
    at the next separator (the reference's ``ESPACO_TOTAL=\\K.*`` did not).
    The first occurrence wins. An empty value is null.
    """
    ps = regex_quote(pair_sep)
    # Up to the separator itself, which may be longer than one character.
    pattern = f"(?s)(?:^|{ps}){regex_quote(key)}{regex_quote(kv_sep)}(.*?)(?:{ps}|\\z)"
    return F.nullif(F.regexp_extract(_col(col), pattern, 1), F.lit(""))


def kv_entries(col: str | Column, pair_sep: str = "|", kv_sep: str = "=") -> Column:
    """P6 without a field list: the ``key, value`` entries of a ``K=V<sep>K=V``
    record, in order, as an array of structs.

    The key ends at the first ``kv_sep``; parts without one are no entries.
    The first occurrence of a key wins, an empty value is null, both as in
    :func:`kv_value`. Repeated keys are found by sorting the entries of the
    record, so a record of many pairs costs no more than that.
    """
    parts = F.transform(
        F.filter(F.split(_col(col), regex_quote(pair_sep)), lambda p: p.contains(kv_sep)),
        lambda p, i: F.struct(F.substring_index(p, kv_sep, 1).alias("key"), i.alias("at"),
                              F.nullif(p.substr(F.length(F.substring_index(p, kv_sep, 1)) + len(kv_sep) + 1,
                                                F.length(p)), F.lit("")).alias("value")))
    ranked = F.sort_array(parts)  # by key, then place
    before = F.concat(F.array(F.lit(None)).cast("array<struct<key:string,at:int,value:string>>"), ranked)
    first = F.array_compact(F.zip_with(ranked, before, lambda e, b: F.when(
        e.isNotNull() & (b.isNull() | (b["key"] != e["key"])),
        F.struct(e["at"].alias("at"), e["key"].alias("key"), e["value"].alias("value")))))
    return F.transform(F.sort_array(first), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))


def or_default(col: str | Column, default) -> Column:
    """``value || echo default`` - a missing or empty value becomes
    ``default``. Works on the extracted text, before any typing."""
    fallback = default.cast("string") if isinstance(default, Column) else F.lit(str(default))
    return F.coalesce(F.nullif(_col(col).cast("string"), F.lit("")), fallback)


_MICROS = 1_000_000


def _div(a: Column, b: int) -> Column:
    """Integer division that truncates toward zero (exact for any BIGINT)."""
    return F.call_function("div", a, F.lit(b))


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970, independent of the session time zone.

    A TIMESTAMP is an instant: its own microseconds, as ``date +%s`` counts
    them. A TIMESTAMP_NTZ (how parquet times read) is a wall-clock time with
    no zone: its day number and time of day. The type is known when the plan
    is made, so only one branch remains in it.
    """
    c = _col(ts)
    instant = F.unix_micros(c.cast("timestamp"))
    wall = c.cast("timestamp_ntz")
    # date_part('SECOND') is DECIMAL(8,6): seconds with the fraction, exact.
    second = (F.date_part(F.lit("SECOND"), wall) * F.lit(_MICROS)).cast("long")
    minutes = ((F.unix_date(wall.cast("date")).cast("long") * 24 + F.hour(wall)) * 60 + F.minute(wall))
    return F.when(F.typeof(c) == "timestamp", instant).otherwise(minutes * (60 * _MICROS) + second)


def micros_between(start: str | Column, end: str | Column) -> Column:
    """Microseconds from ``start`` to ``end`` (see :func:`epoch_micros`)."""
    return epoch_micros(end) - epoch_micros(start)


def elapsed_seconds(start: str | Column, end: str | Column) -> Column:
    """``end - start`` in fractional seconds (``date +%s.%N`` + ``bc``)."""
    return micros_between(start, end).cast("double") / F.lit(1e6)


def _epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds, floored (``date +%s``)."""
    micros = epoch_micros(ts)
    return _div(micros - F.pmod(micros, F.lit(_MICROS)), _MICROS)


def elapsed_whole_seconds(start: str | Column, end: str | Column) -> Column:
    """Difference of two whole-second stamps, as the reference's
    ``$((END - START))`` on ``date +%s`` values (each end floored first)."""
    return _epoch_seconds(end) - _epoch_seconds(start)


def elapsed_text(start: str | Column, end: str | Column) -> Column:
    """``Xm Ys`` with shell arithmetic ``X = d / 60``, ``Y = d % 60``
    (both truncate toward zero)."""
    d = elapsed_whole_seconds(start, end)
    return F.concat(_div(d, 60).cast("string"), F.lit("m "),
                    (d % 60).cast("string"), F.lit("s"))


def max_containers(memory_mb: str | Column) -> Column:
    """P10: ``max(1, (NODES * mem - 512) div 1024)``."""
    m = _col(memory_mb).cast("long")
    avail = m * NODES - AM_MEMORY_MB
    return F.greatest(_div(avail, CONTAINER_MB), F.lit(MIN_CONTAINERS).cast("long"))


def vcores_total(vcores: str | Column) -> Column:
    """Total vcores of the two worker nodes."""
    return _col(vcores).cast("long") * NODES
