"""Read a query's physical plan (for plan tests and tuning)."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def explain_string(df: DataFrame, mode: str = "simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def physical_lines(df: DataFrame) -> list[str]:
    """The physical plan, one operator per line, top operator first."""
    text = explain_string(df, "simple")
    body = text.split("== Physical Plan ==", 1)[-1]
    return [ln for ln in body.splitlines() if ln.strip()]


def count_operator(df: DataFrame, name: str) -> int:
    return sum(1 for ln in physical_lines(df) if name in ln)


def below_first(df: DataFrame, operator: str) -> list[str]:
    """Plan lines under the lowest ``operator`` (the map side of the first
    shuffle when ``operator`` is ``Exchange``)."""
    lines = physical_lines(df)
    idx = [i for i, ln in enumerate(lines) if operator in ln]
    return lines[idx[-1] + 1:] if idx else []
