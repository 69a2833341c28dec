"""Aggregates, windows, sorting and row-set operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from erpweave.functions import money, month_start
from erpweave.operators import aggregates as A
from erpweave.operators import dedupe as D
from erpweave.operators import paging as G
from erpweave.operators import rows as R
from erpweave.queries.oracle import twin
from erpweave.queries.registry import Tables, query


@query("group_sum_decimal", twin("""SELECT vkorg, CAST(sum(CAST(netwr AS DECIMAL(17,2))) AS DECIMAL(17,2)) AS total
    FROM vbak GROUP BY vkorg"""))
def sum_decimal(t: Tables):
    return A.exact_sums(t.raw("vbak").withColumn("netwr", money("netwr")), ["vkorg"], {"total": ("netwr", "decimal(17,2)")})


@query("group_by_month", """SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS ship_month, count(*) AS items,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(17,2))) AS DECIMAL(17,2)) AS amount FROM lineitem GROUP BY 1""")
def by_month(t: Tables):
    return t.source("lineitem").groupBy(month_start("l_shipdate").alias("ship_month")).agg(
        F.count(F.lit(1)).alias("items"), F.sum(money("l_extendedprice")).cast("decimal(17,2)").alias("amount")
    )


@query("multi_count_distinct", """SELECT l_suppkey, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts
    FROM lineitem GROUP BY 1""")
def distinct_two(t: Tables):
    return A.distinct_counts(t.source("lineitem"), ["l_suppkey"], {"orders": "l_orderkey", "parts": "l_partkey"})


@query("avg_rate", twin("""SELECT tax_type, CAST(round(CAST(sum(tax_rate) AS DECIMAL(38,10)) / count(tax_rate), 4) AS DECIMAL(7,4)) AS avg_tax_rate
    FROM silver_j_1bnfstx GROUP BY 1"""))
def avg_rate(t: Tables):
    return t.silver("j_1bnfstx").groupBy("tax_type").agg(F.avg("tax_rate").cast("decimal(7,4)").alias("avg_tax_rate"))


@query("first_milestone", twin("""SELECT source_order, min(actual_goods_issue_date) AS first_goods_issue_date FROM fact_delivery GROUP BY 1"""))
def milestone(t: Tables):
    return A.first_milestone(t.fact_delivery(), ["source_order"], "actual_goods_issue_date", "first_goods_issue_date")


@query("first_status", twin("SELECT vbeln, min(overall_status) AS overall_status FROM fact_sales_order GROUP BY 1"))
def first_status(t: Tables):
    return A.first_milestone(t.fact_sales_order(), ["vbeln"], "overall_status", "overall_status")


@query("gr_ir_totals", twin("""SELECT i.ebeln, i.ebelp, CAST(coalesce(r.q, 0) AS DECIMAL(17,3)) AS qty_received,
    CAST(coalesce(v.a, 0) AS DECIMAL(17,2)) AS amount_invoiced FROM silver_ekpo i
    LEFT JOIN (SELECT ebeln, ebelp, sum(qty) AS q FROM silver_ekbe WHERE event_type = '1' GROUP BY ALL) r ON i.ebeln = r.ebeln AND i.ebelp = r.ebelp
    LEFT JOIN (SELECT ebeln, ebelp, sum(amount) AS a FROM silver_ekbe WHERE event_type = '2' GROUP BY ALL) v ON i.ebeln = v.ebeln AND i.ebelp = v.ebelp"""))
def gr_ir(t: Tables):
    totals = A.event_totals(
        t.silver("ekbe"), ["ebeln", "ebelp"], "event_type",
        {"qty_received": ("1", "qty", "decimal(17,3)"), "amount_invoiced": ("2", "amount", "decimal(17,2)")},
    )
    return t.silver("ekpo").select("ebeln", "ebelp").join(totals, ["ebeln", "ebelp"], "left").na.fill(0)


@query("having_positive_stock", twin("""SELECT matnr, werks, lgort, CAST(sum(CAST(labst AS DECIMAL(17,3))) AS DECIMAL(17,3)) AS estoque_total
    FROM mard WHERE mandt = '100' AND werks IN ('P001', 'P002', 'P003') GROUP BY 1, 2, 3 HAVING sum(CAST(labst AS DECIMAL(17,3))) > 0"""))
def having(t: Tables):
    stock = t.raw("mard").filter((F.col("mandt") == "100") & F.col("werks").isin("P001", "P002", "P003"))
    stock = stock.withColumn("labst", F.col("labst").cast("decimal(17,3)"))
    return A.positive_groups(stock, ["matnr", "werks", "lgort"], "labst", "estoque_total", "decimal(17,3)")


@query("global_sum", twin("SELECT CAST(sum(CAST(labst AS DECIMAL(17,3))) AS DECIMAL(27,3)) AS stock FROM mard WHERE werks = 'P001'"))
def global_sum(t: Tables):
    stock = t.raw("mard").filter(F.col("werks") == "P001")
    return stock.agg(F.sum(F.col("labst").cast("decimal(17,3)")).cast("decimal(27,3)").alias("stock"))


@query("account_balance", twin("""SELECT saknr, CAST(sum(CASE WHEN shkzg = 'S' THEN amount ELSE -amount END) AS DECIMAL(17,2)) AS balance FROM
    (SELECT saknr, shkzg, CAST(dmbtr AS DECIMAL(17,2)) AS amount FROM bseg WHERE augdt = ''
     UNION ALL SELECT saknr, shkzg, CAST(dmbtr AS DECIMAL(17,2)) FROM bseg WHERE augdt <> '') GROUP BY saknr"""))
def balance(t: Tables):
    lines = t.raw("bseg").select("saknr", "shkzg", money("dmbtr").alias("dmbtr"), "augdt")
    return A.account_balance(
        lines.filter(F.col("augdt") == "").drop("augdt"), lines.filter(F.col("augdt") != "").drop("augdt"), ["saknr"],
        "decimal(17,2)",
    )


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(t: Tables):
    return t.source("lineitem").agg(F.count(F.lit(1)).alias("n"))


@query("first_schedule_line", twin("""SELECT vbeln, posnr, etenr, edatu FROM (SELECT *, row_number() OVER
    (PARTITION BY vbeln, posnr ORDER BY etenr, edatu) AS rn FROM vbep) WHERE rn = 1"""))
def schedule(t: Tables):
    return D.first_per_key(t.raw("vbep").select("vbeln", "posnr", "etenr", "edatu"), ["vbeln", "posnr"], ["etenr"])


@query("distinct_dimension", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_dim(t: Tables):
    return D.distinct_dimension(t.source("part"), ["p_brand", "p_type"])


@query("dedupe_by_key", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (SELECT *, row_number() OVER
    (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_suppkey, l_quantity) AS rn FROM lineitem) WHERE rn = 1""")
def dedupe(t: Tables):
    items = t.source("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return D.latest_per_key(items, ["l_orderkey", "l_linenumber"], "l_partkey")


@query("delete_adjacent_duplicates", twin("""SELECT kunnr, vbeln, audat FROM (SELECT kunnr, vbeln, audat, row_number() OVER
    (PARTITION BY kunnr ORDER BY audat, vbeln NULLS FIRST) AS rn FROM vbak) WHERE rn = 1"""))
def adjacent(t: Tables):
    return D.adjacent_duplicates_removed(t.raw("vbak").select("kunnr", "vbeln", "audat"), ["kunnr"], ["audat"])


@query("read_first_match", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey = 7
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 1""")
def first_match(t: Tables):
    rows = t.source("orders").filter(F.col("o_custkey") == 7).select("o_orderkey", "o_custkey", "o_totalprice")
    return D.read_index(rows, [F.desc("o_totalprice")])


@query("sort_mixed", """SELECT o_orderdate, o_custkey, o_orderkey FROM orders ORDER BY o_orderdate DESC, o_custkey ASC""")
def sort_mixed(t: Tables):
    return G.sorted_by(t.source("orders").select("o_orderdate", "o_custkey", "o_orderkey"), F.desc("o_orderdate"), "o_custkey")


@query("top_k_orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def top_k(t: Tables):
    return G.top_rows(t.source("orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice")], 100)


@query("page_orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 50 OFFSET 100")
def page(t: Tables):
    return G.page(t.source("orders").select("o_orderkey", "o_totalprice"), ["o_totalprice"], 100, 50)


@query("page_after_key", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 500 ORDER BY o_orderkey LIMIT 50")
def page_after(t: Tables):
    return G.page_after(t.source("orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 500, 50)


@query("select_single", twin("SELECT mandt, matnr, maktx, spras FROM makt WHERE mandt = '100' AND matnr = '000000000000000042' AND spras = 'P'"))
def single(t: Tables):
    return G.single_row(t.raw("makt").drop("maktg"), mandt="100", matnr="000000000000000042", spras="P")


@query("read_entities", twin("""SELECT ebeln, lifnr, bedat, netwr FROM ekko WHERE lifnr = '0000000003' AND bukrs = 'BR01'
    ORDER BY bedat DESC, ebeln LIMIT 20 OFFSET 5"""))
def entities(t: Tables):
    orders = t.raw("ekko").select("ebeln", "lifnr", "bedat", "netwr", "bukrs")
    return G.read_entities(
        orders, filter=(F.col("lifnr") == "0000000003") & (F.col("bukrs") == "BR01"),
        select=["ebeln", "lifnr", "bedat", "netwr"], orderby=[F.desc("bedat"), "ebeln"], top=20, skip=5,
    )


@query("read_entities_expand", twin("""WITH h AS (SELECT ebeln, bedat FROM ekko WHERE bukrs = 'BR01' ORDER BY bedat DESC, ebeln LIMIT 100)
    SELECT h.ebeln, h.bedat, count(i.ebelp) AS item_count, CAST(coalesce(sum(CAST(i.menge AS BIGINT)), 0) AS BIGINT) AS qty
    FROM h LEFT JOIN ekpo i ON h.ebeln = i.ebeln GROUP BY 1, 2"""))
def entities_expand(t: Tables):
    result = G.read_entities(
        t.raw("ekko").select("ebeln", "bedat", "bukrs"), filter=F.col("bukrs") == "BR01", select=["ebeln", "bedat"],
        orderby=[F.desc("bedat"), "ebeln"], top=100,
        expand=(t.raw("ekpo"), ["ebeln"], ["ebelp", "matnr", "menge"]),
    )
    per_page = result.select(
        "ebeln", "bedat", F.size("items").cast("bigint").alias("n"),
        F.aggregate("items", F.lit(0).cast("bigint"), lambda s, i: s + i["menge"].cast("bigint")).alias("q"),
    )
    return per_page.groupBy("ebeln", "bedat").agg(F.sum("n").alias("item_count"), F.sum("q").alias("qty"))


@query("union_all_items", twin("""SELECT belnr, buzei, 'open' AS state FROM bseg WHERE augdt = ''
    UNION ALL SELECT belnr, buzei, 'cleared' FROM bseg WHERE augdt <> ''"""))
def union_items(t: Tables):
    lines = t.raw("bseg")
    return R.union_rows(
        lines.filter(F.col("augdt") == "").select("belnr", "buzei", F.lit("open").alias("state")),
        lines.filter(F.col("augdt") != "").select("belnr", "buzei", F.lit("cleared").alias("state")),
    )


@query("conditional_update", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderstatus = 'P' THEN 50000.0::DOUBLE ELSE o_totalprice END AS o_totalprice FROM orders""")
def update(t: Tables):
    rows = t.source("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return R.update_where(rows, F.col("o_orderstatus") == "P", o_totalprice=50000.0, o_orderstatus="F")


@query("conditional_delete", twin("SELECT ebeln, lifnr FROM ekko WHERE lifnr IS NULL OR lifnr <> '0000000001'"))
def delete(t: Tables):
    return R.delete_where(t.raw("ekko").select("ebeln", "lifnr"), F.col("lifnr") == "0000000001")
