"""Rows that every operator must take: nulls, empty and very long texts, ties,
repeated rows, extra columns with clashing names."""

from __future__ import annotations

import hashlib
import os

import duckdb

SF = "/root/testdata/sf0.001"

HARD_TEXTS = [(5, None), (3, ""), (9, " \t\n"), (1, "a"), (2, "A"), (None, "a b"), (7, "É a\x1cb c\nx  y "),
              (7, "É a\x1cb c\nx  y "), (4, "word " * 30000), (6, "日本 語 テスト 🙂 <s> <|endoftext|> ▁x"),
              (8, "w" * 9000)]


def hard_docs(spark, clash=("id", "fp", "key", "host", "page", "lines", "rank", "score", "piece", "n_bytes")):
    rows = [(i, t, "en" if n % 2 else None, "s", n, *["x"] * len(clash)) for n, (i, t) in enumerate(HARD_TEXTS)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"{c} string" for c in clash)
    return spark.createDataFrame(rows, schema)


def duck(sql: str, **frames):
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels"):
        if name not in frames:
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    for name, frame in frames.items():
        con.register(name, frame)
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


def same(df, cols, rows):
    assert sorted(df.columns) == sorted(cols)
    got = [tuple(str(r[c]).lower() for c in sorted(cols)) for r in df.collect()]
    order = [cols.index(c) for c in sorted(cols)]
    assert sorted(got) == sorted(tuple(str(r[i]).lower() for i in order) for r in rows)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def files_under(path: str) -> list[str]:
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names)
