"""Registered queries against their SQL twins on the smallest folder, and plan shapes."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect

QUERIES, TWINS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, folder, con, name):
    if name in TWINS:
        problem = compare(spark, con, folder, name, QUERIES[name], TWINS[name])
        assert problem is None, problem
    else:
        assert QUERIES[name](spark, folder).count() > 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def _plan(spark, folder, name) -> str:
    return QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_products(spark, folder):
    for name in ("reconcile_totals", "open_orders_report", "document_chain", "skew_safe_join", "kpi_order_to_cash"):
        assert not re.search("Cartesian|BroadcastNestedLoop", _plan(spark, folder, name)), name


def test_semi_and_anti_joins(spark, folder):
    assert "LeftSemi" in _plan(spark, folder, "semi_join_keyset")
    assert "LeftAnti" in _plan(spark, folder, "anti_join_missing")


def test_filters_and_columns_reach_the_scan(spark, folder):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = _plan(spark, folder, "predicate_range_list")
    assert "GreaterThanOrEqual(o_totalprice,100000.0)" in plan
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<>" in _plan(spark, folder, "row_count")  # a count reads no column


def test_reading_a_table_shuffles_nothing(spark):
    for name in ("row_count", "kpi_order_to_cash", "open_orders_report"):
        assert "RoundRobin" not in _plan(spark, "/root/testdata/sf0.1", name), name
