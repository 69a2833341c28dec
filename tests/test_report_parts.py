"""The order report by parts: the same rows, and each plan moves a part only."""

from __future__ import annotations

from collections import Counter

import pytest

from erpweave.plans.report import open_orders_report
from erpweave.queries import models
from erpweave.queries.registry import Tables
from erpweave.session import materialize


@pytest.mark.parametrize("first", [False, True])
def test_parts_give_the_rows_of_the_whole(spark, folder, first):
    table, labels = Tables(spark, folder).raw, []

    def stored(df, label):
        labels.append(label)
        return materialize(df, label)

    whole = open_orders_report(table, one_row_per_item=first)
    parts = open_orders_report(table, one_row_per_item=first, stored=stored)
    assert len(labels) == len(set(labels)) == 5 and whole.dtypes == parts.dtypes
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, parts.collect()))


@pytest.mark.parametrize("query", [models.report, models.report_first, models.report_items])
def test_the_last_step_joins_stored_items_and_orders_only(spark, folder, query):
    plan = query(Tables(spark, folder))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
