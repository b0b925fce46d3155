"""Registered queries: equal to their DuckDB twins, and planned the way large data needs."""

from __future__ import annotations

import os
import re

import pytest

from checks import compare
from checks.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"
CHECKED = sorted(ORACLE)

needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not here")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@needs_data
@pytest.mark.parametrize("name", CHECKED)
def test_equals_duckdb(spark, duck, name):
    assert compare.compare(spark, duck, name, SF_DIR) == ""


@needs_data
@pytest.mark.parametrize("name", ["percentile_global", "running_quantity", "local_minima_daily", "mart_positions", "mart_safe_to_spend"])
def test_no_window_gathers_the_table(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    gathered = re.findall(r"Window (.*)\n(?:.*Sort.*\n)?.*Exchange SinglePartition", plan)
    assert all("__slice_sum" in window for window in gathered)  # one row per slice
    assert "CartesianProduct" not in plan


@needs_data
def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["latest_order_by_customer"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    (schema,) = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert "o_orderstatus" not in schema and "o_orderpriority" not in schema


@needs_data
@pytest.mark.parametrize(
    "name, table, scans",
    [
        ("mart_portfolio_actions", "part", 2),  # the sums, then the positions measured by them
        ("mart_review_digest", "part", 2),
        ("mart_review_snapshot", "part", 1),  # the sums are settled before
        ("mart_review_snapshot", "lineitem", 1),
        ("mart_property_cycle", "orders", 0),  # both panels are settled, each read once
    ],
)
def test_sources_are_not_read_again(spark, name, table, scans):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(rf"FileScan parquet .*/{table}\.parquet\]", plan)) == scans
