from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from frames import rows
from erpweave.operators import aggregates, dedupe, joins, paging, projection, quality
from erpweave.operators import rows as row_ops


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_reduce_to_keys_empty_null_and_duplicates(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    driver = spark.createDataFrame([("a",), ("a",), (None,)], "d string")
    assert rows(joins.reduce_to_keys(target, driver, {"k": "d"})) == [("a", 1)]
    assert rows(joins.reduce_to_keys(target, driver.limit(0), {"k": "d"})) == []
    assert rows(joins.missing_keys(target, driver, {"k": "d"})) == [("b", 2), (None, 3)]


def test_fiscal_join_needs_the_whole_key(spark):
    left = spark.createDataFrame([("1", "d", "2024")], "bukrs string, belnr string, gjahr string")
    with pytest.raises(ValueError, match="gjahr"):
        joins.fiscal_join(left, left.drop("gjahr"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_safe_join_equals_plain_join_with_a_hot_key(spark, how):
    # Key 7 holds a third of the left rows and repeats on the right; key 500 has no partner.
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") == 1, 500).otherwise(F.col("id") % 100).alias("k"), "id"
    )
    right = spark.range(101).select((F.col("id") % 100).alias("k"), F.col("id").alias("r"))
    right = right.unionByName(spark.sql("SELECT 7L AS k, 999L AS r"))
    got = Counter(tuple(r) for r in joins.skew_safe_join(left, right, ["k"], how, pieces=8).select("k", "id", "r").collect())
    want = Counter(tuple(r) for r in left.join(right, ["k"], how).select("k", "id", "r").collect())
    assert got == want


def test_skew_safe_join_spreads_the_hot_key(spark):
    left = spark.range(20000).select(F.lit(1).alias("k"), "id")
    right = spark.createDataFrame([(1, "x")], "k int, r string")
    joined = joins.skew_safe_join(left, right, ["k"], pieces=16)
    spread = joined.withColumn("p", F.pmod(F.xxhash64("k", "id"), F.lit(16))).groupBy("p").count()
    assert joined.count() == 20000 and spread.count() == 16


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_safe_join_deals_out_null_keys(spark, how):
    # Nine of ten keys are NULL, most others are one key.
    left = spark.range(20000).select(F.when(F.col("id") % 10 != 0, None).when(F.col("id") % 100 != 0, 5).otherwise(6).alias("k"), "id")
    right = spark.createDataFrame([(5, "x"), (5, "y"), (None, "z")], "k int, r string")
    joined = joins.skew_safe_join(left, right, ["k"], how)
    want = Counter(tuple(r) for r in left.join(right, ["k"], how).select("k", "id", "r").collect())
    assert Counter(tuple(r) for r in joined.select("k", "id", "r").collect()) == want
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sizes = [r["count"] for r in joins.skew_safe_join(left, right, ["k"], how).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(sizes) < 2 * sum(sizes) / len(sizes)


def test_expand_items_pages_a_hot_header(spark):
    headers = spark.createDataFrame([("h1",), ("h2",), ("h3",)], "h string")
    items = spark.range(1000).select(F.when(F.col("id") < 990, "h1").otherwise("h2").alias("h"), F.col("id").alias("n"))
    out = joins.expand_items(headers, items, ["h"], ["n"], page_size=100)
    sizes = {(r["h"], r["page"]): len(r["items"]) for r in out.collect()}
    assert sum(n for (h, _), n in sizes.items() if h == "h1") == 990
    assert len([1 for h, _ in sizes if h == "h1"]) == 10 and max(sizes.values()) < 200
    assert sizes[("h3", 0)] == 0 and sizes[("h2", 0)] == 10


def test_association_joins_only_when_used(spark):
    base = spark.createDataFrame([("p1", "v1"), ("p2", None)], "ebeln string, lifnr string")
    vendors = spark.createDataFrame([("v1", "Acme")], "lifnr string, name1 string")
    view = joins.EntityView(base, {"Order": "ebeln", "Supplier": "lifnr"},
                            {"_Supplier": joins.Association(vendors, {"Supplier": "lifnr"})})
    assert "Join" not in plan(view.select("Order"))
    assert rows(view.select("Order", "_Supplier.name1 AS SupplierName")) == [("p1", "Acme"), ("p2", None)]


def test_broadcast_hint_needs_a_small_plan(spark, folder):
    small = spark.read.parquet(f"{folder}/nation.parquet")
    assert joins.broadcast_if_small(small, 10**6) is not small
    assert joins.broadcast_if_small(small, 10) is small


def test_document_chain_and_flow(spark):
    order = spark.createDataFrame([("o1",), ("o2",)], "o string")
    delivery = spark.createDataFrame([("d1", "o1"), ("d2", "o1")], "d string, vgbel string")
    bill = spark.createDataFrame([("b1", "d2")], "b string, ref string")
    out = joins.document_chain(order, [(delivery, {"o": "vgbel"}), (bill, {"d": "ref"})])
    assert rows(out) == [("o1", "d2", "b1")]
    flow = spark.createDataFrame([("o1", "d1", "J"), ("o1", "d1", "J"), ("o1", "b", "M")], "vbelv string, vbeln string, vbtyp_n string")
    assert rows(joins.doc_flow(flow, "J")) == [("o1", "d1")]


def test_working_columns_do_not_clash_with_those_of_the_input(spark):
    df = spark.createDataFrame([(1, 5, 7), (1, 4, 9), (2, 3, 8)], "k int, _rn int, __RN int")
    first = dedupe.first_per_key(df, ["k"], ["_rn"])
    assert first.columns == df.columns and sorted(map(tuple, first.collect())) == [(1, 4, 9), (2, 3, 8)]
    left = spark.createDataFrame([(1, i, i % 2 == 0) for i in range(40)] + [(2, 50, None), (None, 60, True)], "_n int, _piece int, _hot boolean")
    right = spark.createDataFrame([(1, "a"), (2, "b")], "_n int, r string")
    for how in ("inner", "left"):
        got = joins.skew_safe_join(left, right, ["_n"], how, share=0.5, pieces=4)
        want = left.join(right, ["_n"], how)
        assert got.columns == want.columns and Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    first = dedupe.first_per_key(df, ["k"], [F.desc("id")])
    assert plan(first).count("WindowGroupLimit") == 2
    assert rows(first) == [(0, 99), (1, 97), (2, 98)]


def test_first_schedule_line_and_ties(spark):
    df = spark.createDataFrame([("a", "0002", "x"), ("a", "0001", "z"), ("a", "0001", "y")], "k string, e string, d string")
    assert rows(dedupe.first_per_key(df, ["k"], ["e"])) == [("a", "0001", "y")]


def test_event_totals_one_pass(spark):
    df = spark.createDataFrame([("a", "1", 2.0), ("a", "2", 5.0), ("a", "1", 3.0), ("b", "2", 1.0), ("c", "9", 7.0)], "k string, e string, v double")
    out = aggregates.event_totals(df, ["k"], "e", {"one": ("1", "v", "decimal(9,1)"), "two": ("2", "v", "decimal(9,1)")})
    assert [(k, float(a), float(b)) for k, a, b in rows(out)] == [("a", 5.0, 5.0), ("b", 0.0, 1.0)]


def test_paging_covers_every_row_once(spark):
    df = spark.range(25).select((F.col("id") % 4).alias("s"), "id")
    pages = [r["id"] for skip in range(0, 30, 10) for r in paging.page(df, ["s"], skip, 10).collect()]
    assert sorted(pages) == list(range(25))
    seen, last = [], None
    while got := [r["id"] for r in paging.page_after(df, "id", last, 10).collect()]:
        seen, last = seen + got, got[-1]
    assert seen == list(range(25))
    assert paging.top_rows(df, ["id"], 0).count() == 25 and paging.top_rows(df, ["id"], 3).count() == 3


def test_rules_drop_warn_and_count(spark):
    df = spark.createDataFrame([("a", 1), (None, -1), ("c", None)], "k string, v int")
    rules = [quality.Rule("key", "k IS NOT NULL"), quality.Rule("positive", "v >= 0", "warn")]
    seen = Observation("dq")
    assert rows(quality.expect(df, rules, seen), "k") == [("a",), ("c",)]
    assert seen.get == {"rows": 3, "key": 1, "positive": 2}
    assert rows(quality.rule_metrics(df, rules)) == [("key", "drop", 2, 1), ("positive", "warn", 1, 2)]
    status = quality.row_status(df, rules).select("status", "message")
    assert [tuple(r) for r in status.collect()] == [("S", ""), ("E", "key"), ("W", "positive")]


def test_profile_of_nothing_has_no_score(spark):
    empty = spark.createDataFrame([], "mandt string, k string, v double, d date")
    got = quality.quality_profile(empty, "k", "v", "d").first()
    assert got["total_rows"] == 0 and got["quality_score"] is None


def test_reconcile(spark):
    df = spark.createDataFrame([(1.0,), (2.5,)], "v double")
    quality.assert_reconciled(df, df, "v")
    with pytest.raises(ValueError):
        quality.assert_reconciled(df, df.limit(1), "v")
    assert quality.reconcile(df.limit(0), df.limit(0), "v").first()["consistent"] is True
    assert "Cartesian" not in plan(quality.reconcile(df, df, "v"))


def test_grain_and_schema(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert rows(quality.grain_violations(df, ["k"])) == [(1, 2)]
    report = quality.schema_conformance(df, StructType.fromDDL("k bigint, w string"))
    assert {r["column"]: r["verdict"] for r in report.collect()} == {"k": "type", "w": "missing", "v": "unexpected"}


def test_prevalidate_and_retry(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    known = spark.createDataFrame([("a",), ("a",)], "x string")
    assert rows(quality.prevalidate_existing(df, known, {"k": "x"})) == [("a", "SKIP"), ("b", "NEW")]
    log = spark.createDataFrame([("a", 1, "E"), ("a", 2, "S"), ("b", 1, "E")], "k string, run int, status string")
    assert rows(quality.failed_rows(df, log, ["k"])) == [("b",)]


def test_row_changes(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    assert rows(row_ops.update_where(df, F.col("k") == "a", v=9)) == [("a", 9), (None, 2)]
    assert rows(row_ops.delete_where(df, F.col("k") == "a")) == [(None, 2)]
    assert row_ops.append_rows(df, [{"v": 3}]).count() == 3


def test_projection_helpers(spark):
    df = spark.createDataFrame([("1 | Ana |  7",)], "wa string")
    assert rows(projection.split_delimited(df, "wa", ["a", "b", "c", "d"])) == [("1", "Ana", "7", None)]
    partners = spark.createDataFrame([("o", "ZG", "p1", None), ("o", "WE", None, "k1"), ("o", "RE", "x", "x")], "d string, parvw string, pernr string, kunnr string")
    out = projection.by_role(partners, {"gc": ("ZG", "pernr"), "we": ("WE", "kunnr")}, ["d"], "parvw")
    assert rows(out) == [("o", "p1", "k1")]
    two = partners.unionByName(partners.withColumn("pernr", F.lit("p2")))
    out = projection.by_role(two, {"gc": ("ZG", "pernr"), "we": ("WE", "kunnr"), "re": ("XX", "kunnr")}, ["d"], "parvw")
    assert rows(out) == [("o", "p1", "k1", None), ("o", "p2", "k1", None)]


def test_sums_and_two_distinct_counts_without_expand(spark):
    from erpweave.operators.aggregates import sums_and_distincts

    values = [("a", 1, "x", 2), ("a", 1, "y", 3), ("a", 1, "x", 5), ("a", 2, "x", None), ("a", None, "z", 1), (None, 3, None, 4), (None, None, None, 1)]
    df = spark.createDataFrame(values, "s0 string, document int, other string, k0 int")  # named like its working columns
    got = sums_and_distincts(df, ["s0"], {"total": "k0"}, ("documents", "document"), ("others", "other"))
    want = df.groupBy("s0").agg(F.sum("k0").alias("total"), F.count_distinct("document").alias("documents"), F.count_distinct("other").alias("others"))
    assert got.columns == want.columns and rows(got) == rows(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Expand" in want._jdf.queryExecution().executedPlan().toString()
    assert sums_and_distincts(df.limit(0), ["s0"], {"total": "k0"}, ("documents", "document"), ("others", "other")).count() == 0


def test_key_figures_repeat_no_row_per_distinct_count(spark, folder):
    import __spark_entry__ as entry

    for name in ("kpi_revenue_by_customer_month", "kpi_purchase_spend_by_vendor", "kpi_purchase_spend_by_currency"):
        assert "Expand" not in entry.queries()[name](spark, folder)._jdf.queryExecution().executedPlan().toString(), name
