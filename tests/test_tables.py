"""Table sources: the caller decides whether a scan is dealt out."""

from __future__ import annotations

from wordmill.plans.inspect import physical_lines
from wordmill.plans.registry import QUERIES
from wordmill.sources.tables import SCAN_PARTITIONS, read_table

DOCUMENTS = "/root/testdata/sf0.01/documents.parquet"


def test_a_scan_is_left_alone_unless_asked(spark):
    df = read_table(spark, DOCUMENTS, ["text"])
    assert not any("Exchange" in ln for ln in physical_lines(df))
    out = read_table(spark, DOCUMENTS, ["text"], partitions=12)
    assert out.rdd.getNumPartitions() == 12
    assert any("RoundRobinPartitioning" in ln for ln in physical_lines(out))


def test_registered_queries_read_the_session_setting(spark):
    def dealt(df):
        return any("RoundRobinPartitioning" in ln for ln in physical_lines(df))
    assert not dealt(QUERIES["tokenize"](spark, "/root/testdata/sf0.01"))
    spark.conf.set(SCAN_PARTITIONS, "4")
    try:
        assert dealt(QUERIES["tokenize"](spark, "/root/testdata/sf0.01"))
    finally:
        spark.conf.unset(SCAN_PARTITIONS)


def test_merge_counts_plan(spark):
    plan = physical_lines(QUERIES["merge_counts"](spark, "/root/testdata/sf0.01"))
    assert sum("Exchange" in ln for ln in plan) <= 6
