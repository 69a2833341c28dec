"""Plans of the order report and the document traces: what moves, and how rows grow."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from erpweave.plans import documented as D
from erpweave.plans import purchasing_lakehouse as L
from erpweave.plans.report import open_orders_report
from erpweave.queries.registry import Tables


@pytest.fixture()
def no_broadcast(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_items_move_twice_and_never_by_a_missing_key(spark, folder, no_broadcast):
    plan = open_orders_report(Tables(spark, folder).raw)._jdf.queryExecution().executedPlan()
    moves = []

    def visit(node):
        if node.nodeName() == "Exchange":
            columns = {re.sub(r"#\d+$", "", str(a)) for a in node.output().mkString("|").split("|")}
            moves.append((columns, node.outputPartitioning().toString()))
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(plan)
    # Item rows carry the plant that they are ordered from.
    wide = [(c, p) for c, p in moves if "centro_origem" in c]
    keys = [tuple(re.findall(r"(\w+)#", p)) for _, p in wide]
    assert sorted(keys) == [("matnr",), ("vbeln",), ("vbeln", "posnr")]
    # The one by material is of items alone, before anything is joined to them.
    alone = next(c for c, p in wide if "matnr#" in p)
    assert "linha" not in alone and "primeira_data" not in alone and len(alone) <= 9


def test_lines_of_a_note_become_rows_behind_the_last_move(spark, folder, no_broadcast):
    plan = open_orders_report(Tables(spark, folder).raw)._jdf.queryExecution().executedPlan()
    below, above = [], []

    def visit(node, moved):
        if node.nodeName() == "Generate" and "quantidade_nf" in node.output().mkString("|"):
            (below if moved else above).append(node)
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i), moved or node.nodeName() == "Exchange")

    visit(plan, False)
    assert len(above) == 1 and not below


def test_lines_of_a_note_and_their_first(spark):
    """Notes without lines, with an unknown quantity, and invoices without a note."""
    one = {
        "vbak": "SELECT '100' mandt, vbeln, 'k' kunnr, '01' vsbed, 'Z1' auart, '20240101' vdatu FROM VALUES ('1'), ('2'), ('3'), ('4') AS t(vbeln)",
        "vbap": "SELECT '100' mandt, vbeln, '10' posnr, '007' matnr, 'w' werks, 'l' lgort, 'r' route, 'g' matkl, 'UN' vrkme, 'A' fkrel "
                "FROM VALUES ('1'), ('2'), ('3'), ('4') AS t(vbeln)",
        "lips": "SELECT '100' mandt, '8' || v vbeln, '10' posnr, v vgbel, '10' vgpos, 'l' lgort FROM VALUES ('1'), ('2'), ('3') AS t(v)",
        "vbrp": "SELECT '100' mandt, '9' || v vbeln, '8' || v vgbel, '10' vgpos, v aubel, '10' aupos FROM VALUES ('1'), ('2'), ('3') AS t(v)",
        "vbrk": "SELECT '100' mandt, '9' || v vbeln, '' sfakn, '' fksto, '20240102' fkdat FROM VALUES ('1'), ('2'), ('3') AS t(v)",
        "j_1bnfdoc": "SELECT '100' mandt, v docnum, '9' || v refkey, '20240103' docdat FROM VALUES ('1'), ('2') AS t(v)",
        "j_1bnflin": "SELECT '100' mandt, d docnum, q nfqtd FROM VALUES ('1', '3.5'), ('1', '2'), ('2', '1'), ('2', NULL), (NULL, '5') AS t(d, q)",
    }
    empty = {
        "vbkd": "vbeln posnr inco1", "vbpa": "vbeln parvw kunnr pernr", "pa0001": "pernr ename", "kna1": "kunnr name1 ort01 regio",
        "tvsbt": "spras vsbed vtext", "mara": "matnr bismt prdha", "vbep": "vbeln posnr etenr edatu", "likp": "vbeln",
        "vttp": "vbeln tknum", "vttk": "tknum tdlnr", "lfa1": "lifnr name1", "oigsi": "doc_typ doc_number shnumber",
    }

    def table(name):
        if name in one:
            return spark.sql(one[name])
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in ["mandt", *empty[name].split()]))

    def rows(**how):
        got = open_orders_report(table, **how).select("nr_ordem", "item", F.col("quantidade_nf").cast("double")).collect()
        return sorted((tuple(r) for r in got), key=str)

    assert rows() == sorted([("1", "7", 2.0), ("1", "7", 3.5), ("2", "7", None), ("2", "7", 1.0), ("3", "7", None), ("4", "7", None)], key=str)
    assert rows(one_row_per_item=True) == [("1", "7", 2.0), ("2", "7", None), ("3", "7", None), ("4", "7", None)]


def test_items_of_the_purchase_fact_never_move_by_supplier(spark, no_broadcast):
    frame = lambda columns: spark.createDataFrame([], ", ".join(f"{c} string" for c in columns.split()))
    fact = L.gold_po_fact(
        frame("ebeln ebelp matnr werks menge meins netpr netwr waers"), frame("ebeln lifnr ekorg bedat waers").withColumn("bedat", F.to_date("bedat")),
        frame("lifnr name1"), frame("matnr maktx"))
    plan = fact._jdf.queryExecution().executedPlan().toString()
    moves = [line for line in plan.splitlines() if "Exchange hashpartitioning(lifnr" in line]
    optimized = fact._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in optimized.splitlines() if "Join LeftOuter" in line]
    # From the top: by order, then material on the items' side and supplier on the headers'.
    assert [re.search(r"\((\w+)#", line)[1] for line in joins] == ["ebeln", "matnr", "lifnr"] and len(moves) <= 2


def test_traces_by_item_stay_linear(spark):
    n = 100_000
    lines = spark.range(1, n + 1).select(
        F.lit("100").alias("mandt"), F.lit("8").alias("vbeln"), F.col("id").cast("string").alias("posnr"), F.lit("7").alias("vgbel"),
        F.col("id").cast("string").alias("vgpos"), F.lit("m").alias("matnr"), F.lit(1.0).alias("lfimg"), F.lit(1.0).alias("kwmeng"),
        F.lit("7").alias("aubel"), F.col("id").cast("string").alias("aupos"), F.lit("601").alias("bwart"), F.lit(-2.5).alias("dmbtr"))
    head = spark.createDataFrame([("100", "7", "c", "20240101", 5.0, "C")], "mandt string, vbeln string, kunnr string, audat string, netwr double, rfbsk string")
    head = head.withColumn("fkdat", F.col("audat"))
    order, delivery, bill = (lines.withColumn("vbeln", F.lit(v)) for v in ("7", "8", "9"))
    billed = bill.withColumn("vgbel", F.lit("8"))
    got = D.order_to_billing_trace(
        head, order, delivery, head.withColumn("vbeln", F.lit("8")), billed, head.withColumn("vbeln", F.lit("9")), "20200101", by_item=True)
    assert got.count() == n
    costs = bill.unionByName(bill)
    cost = D.order_profitability(head, order, bill, head.withColumn("vbeln", F.lit("9")), costs, "20200101", by_item=True)
    assert cost.agg(F.count("*"), F.min("custo_mercadoria"), F.max("custo_mercadoria")).first()[:] == (n, 5, 5)
