"""Plans of the operators that are DataFrame functions throughout, and of the
sides that are broadcast."""

from __future__ import annotations

import pytest

from tests.llm.helpers import SF
from wordmill.llm import common
from wordmill.llm.queries import QUERIES
from wordmill.plans.inspect import explain_string


@pytest.mark.parametrize("name", ["op2_decontamination", "op7_exact_dedup", "op10_line_dedup"])
def test_native_queries_run_no_python(spark, name):
    plan = explain_string(QUERIES[name](spark, SF))
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


@pytest.mark.parametrize("name", ["op2_decontamination", "op5_repeated_passages", "op7_exact_dedup", "op10_line_dedup"])
def test_results_do_not_depend_on_broadcasts(spark, monkeypatch, name):
    want = sorted(map(str, QUERIES[name](spark, SF).collect()))
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(str, QUERIES[name](spark, SF).collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
