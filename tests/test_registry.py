"""Every registered query against its DuckDB oracle SQL (sf0.001), plus the entry point."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import compare, duck  # noqa: E402

from tidewatch.plans import catalog  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "z_score" in df.columns


def test_every_query_has_a_decision_on_oracles():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.queries()) <= set(entry.queries())
    assert set(catalog.queries()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, name):
    line, ok = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF)
    assert ok, line


def test_whole_run_shows_every_decision(spark):
    rows = entry.queries()["suppression_first_run"](spark, "/root/testdata/sf0.01").collect()
    assert {r.decision for r in rows} == {"new", "escalation", "suppressed"}
