"""Join operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from erpweave.functions import object_key
from erpweave.operators import joins as J
from erpweave.operators.dedupe import distinct_dimension
from erpweave.queries.oracle import twin
from erpweave.queries.registry import Tables, query


def _orders(t: Tables):
    return t.source("orders").withColumnRenamed("o_orderkey", "l_orderkey")


@query("join_header_item", """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, o_custkey, o_orderstatus
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def header_item(t: Tables):
    items = t.source("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    headers = _orders(t).select("l_orderkey", "o_custkey", "o_orderstatus")
    return J.header_items(items, headers, ["l_orderkey"])


@query("join_left_enrich", twin("""SELECT b.kunnr, b.vbeln, b.posnr, c.customer_name FROM fact_billing b
    LEFT JOIN dim_customer c ON b.kunnr = c.kunnr"""))
def left_enrich(t: Tables):
    facts = t.fact_billing().select("kunnr", "vbeln", "posnr")
    return J.enrich(facts, t.dim_customer().select("kunnr", "customer_name"), ["kunnr"])


@query("join_composite_left", twin("""SELECT i.vbeln, i.posnr, d.vbeln AS delivery, d.lgort
    FROM vbap i LEFT JOIN lips d ON i.vbeln = d.vgbel AND i.posnr = d.vgpos"""))
def composite(t: Tables):
    lips = t.raw("lips").select(F.col("vbeln").alias("delivery"), "lgort", "vgbel", "vgpos")
    return J.enrich(t.raw("vbap").select("vbeln", "posnr"), lips, {"vbeln": "vgbel", "posnr": "vgpos"})


def _accounting(t: Tables):
    """Accounting headers and items that carry the full fiscal key."""
    bkpf = t.raw("bkpf").select("mandt", "bukrs", "belnr", "gjahr", "budat")
    keys = bkpf.select("belnr", "bukrs", "gjahr")
    bseg = t.raw("bseg").join(keys, "belnr").select("bukrs", "belnr", "gjahr", "buzei", "saknr", "dmbtr", "shkzg", "koart", "lifnr", "augdt")
    return bkpf, bseg


@query("join_fiscal_key", twin("""WITH items AS (SELECT k.bukrs, k.belnr, k.gjahr, s.buzei, s.dmbtr FROM bseg s JOIN bkpf k ON s.belnr = k.belnr)
    SELECT h.bukrs, h.belnr, h.gjahr, h.budat, s.buzei, s.dmbtr FROM bkpf h JOIN items s
    ON h.bukrs = s.bukrs AND h.belnr = s.belnr AND h.gjahr = s.gjahr WHERE h.mandt = '100'"""))
def fiscal(t: Tables):
    bkpf, bseg = _accounting(t)
    header = bkpf.filter(F.col("mandt") == "100").drop("mandt")
    return J.fiscal_join(header, bseg.select("bukrs", "belnr", "gjahr", "buzei", "dmbtr"))


@query("join_with_tenant", twin("""SELECT h.mandt, h.vbeln, i.posnr, i.netwr FROM vbak h JOIN vbap i
    ON h.mandt = i.mandt AND h.vbeln = i.vbeln"""))
def with_tenant(t: Tables):
    return J.header_items(
        t.raw("vbap").select("mandt", "vbeln", "posnr", "netwr"), t.raw("vbak").select("mandt", "vbeln"), ["vbeln"],
        tenant="mandt",
    )


@query("semi_join_keyset", twin("""SELECT v.vbeln, v.posnr, v.etenr FROM vbep v
    WHERE EXISTS (SELECT 1 FROM vbak h WHERE h.mandt = '100' AND h.vbeln = v.vbeln)"""))
def semi(t: Tables):
    driver = t.raw("vbak").filter(F.col("mandt") == "100")
    return J.reduce_to_keys(t.raw("vbep").select("vbeln", "posnr", "etenr"), driver, {"vbeln": "vbeln"})


@query("semi_join_filtered", twin("""SELECT pernr, ename FROM pa0001 WHERE pernr IN
    (SELECT pernr FROM vbpa WHERE pernr IS NOT NULL AND pernr <> '')"""))
def semi_filtered(t: Tables):
    driver = t.raw("vbpa").filter(F.col("pernr") != "")
    return J.reduce_to_keys(t.raw("pa0001").select("pernr", "ename"), driver, {"pernr": "pernr"})


@query("in_subquery", twin("""SELECT matnr, maktx FROM makt WHERE spras = 'P' AND matnr IN
    (SELECT matnr FROM mseg WHERE bwart = '101' AND budat BETWEEN '19980101' AND '19980131')"""))
def in_subquery(t: Tables):
    moved = t.raw("mseg").filter((F.col("bwart") == "101") & F.col("budat").between("19980101", "19980131"))
    texts = t.raw("makt").filter(F.col("spras") == "P").select("matnr", "maktx")
    return J.reduce_to_keys(texts, moved, {"matnr": "matnr"})


@query("exists_check", """SELECT c_custkey, c_name FROM customer WHERE EXISTS
    (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def exists(t: Tables):
    urgent = t.source("orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return J.reduce_to_keys(t.source("customer").select("c_custkey", "c_name"), urgent, {"c_custkey": "o_custkey"})


@query("anti_join_missing", """SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS
    (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND CAST(o_orderdate AS DATE) >= DATE '2000-01-01')""")
def anti(t: Tables):
    recent = t.source("orders").filter(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
    return J.missing_keys(t.source("customer").select("c_custkey", "c_name"), recent, {"c_custkey": "o_custkey"})


@query("for_all_entries", twin("""SELECT i.ebeln, i.ebelp, i.matnr, i.menge FROM ekpo i WHERE i.mandt = '100'
    AND EXISTS (SELECT 1 FROM ekko h WHERE h.ebeln = i.ebeln AND h.bedat >= '20000101')"""))
def fae(t: Tables):
    driver = t.raw("ekko").filter(F.col("bedat") >= "20000101")
    items = t.raw("ekpo").filter(F.col("mandt") == "100").select("ebeln", "ebelp", "matnr", "menge")
    return J.reduce_to_keys(items, driver, {"ebeln": "ebeln"})


@query("for_all_entries_empty", twin("""SELECT i.ebeln, i.ebelp FROM ekpo i WHERE EXISTS
    (SELECT 1 FROM ekko h WHERE h.ebeln = i.ebeln AND h.bedat >= '29990101')"""))
def fae_empty(t: Tables):
    driver = t.raw("ekko").filter(F.col("bedat") >= "29990101")
    return J.reduce_to_keys(t.raw("ekpo").select("ebeln", "ebelp"), driver, {"ebeln": "ebeln"})


@query("broadcast_lookup", """SELECT c_custkey, c_nationkey AS n_nationkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def hashed(t: Tables):
    rows = t.source("customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return J.lookup(rows, t.source("nation").select("n_nationkey", "n_name"), ["n_nationkey"])


@query("merge_join_hint", """SELECT l_orderkey, l_linenumber, l_suppkey, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def merge_hint(t: Tables):
    return J.merge_join(
        t.source("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"),
        _orders(t).select("l_orderkey", "o_custkey"), ["l_orderkey"],
    )


@query("skew_safe_join", """SELECT l_linestatus AS status, l_orderkey, l_linenumber, d.meaning FROM lineitem
    LEFT JOIN (SELECT DISTINCT o_orderstatus AS status, concat('S', o_orderstatus) AS meaning FROM orders) d ON l_linestatus = d.status""")
def skewed(t: Tables):
    # Two or three statuses hold all rows, so every key is hot.
    items = t.source("lineitem").select(F.col("l_linestatus").alias("status"), "l_orderkey", "l_linenumber")
    meanings = distinct_dimension(
        t.source("orders").select(
            F.col("o_orderstatus").alias("status"), F.concat(F.lit("S"), "o_orderstatus").alias("meaning")
        ),
        ["status", "meaning"],
    )
    return J.skew_safe_join(items, meanings, ["status"], how="left")


@query("role_playing_join", twin("""SELECT h.vbeln, s.name1 AS sold_to_name, w.name1 AS ship_to_name FROM vbak h
    LEFT JOIN (SELECT vbeln, kunnr FROM vbpa WHERE parvw = 'WE') p ON h.vbeln = p.vbeln
    LEFT JOIN kna1 s ON h.kunnr = s.kunnr LEFT JOIN kna1 w ON p.kunnr = w.kunnr"""))
def role_playing(t: Tables):
    customer = t.raw("kna1").select("kunnr", "name1")
    partner = t.raw("vbpa").filter(F.col("parvw") == "WE").select("vbeln", F.col("kunnr").alias("we"))
    orders = J.enrich(t.raw("vbak").select("vbeln", "kunnr"), partner, ["vbeln"])
    sold = J.enrich(orders, customer.withColumnRenamed("name1", "sold_to_name"), ["kunnr"])
    shipped = J.enrich(sold, customer.withColumnRenamed("name1", "ship_to_name"), {"we": "kunnr"})
    return shipped.select("vbeln", "sold_to_name", "ship_to_name")


@query("left_join_on_literal", twin("""SELECT m.matnr, m.matkl, t.maktx FROM mara m
    LEFT JOIN makt t ON m.matnr = t.matnr AND t.spras = 'P'"""))
def on_literal(t: Tables):
    texts = t.raw("makt").filter(F.col("spras") == "P").select("matnr", "maktx")
    return J.enrich(t.raw("mara").select("matnr", "matkl"), texts, ["matnr"])


@query("document_chain", twin("""SELECT o.vbeln AS order_number, i.posnr AS order_item, i.matnr, i.kwmeng AS qty_ordered,
    d.vbeln AS delivery_number, di.lfimg AS qty_delivered, b.vbeln AS invoice_number, b.fkdat AS invoice_date, bi.netwr AS net_value
    FROM vbak o JOIN vbap i ON o.vbeln = i.vbeln JOIN lips di ON di.vgbel = i.vbeln AND di.vgpos = i.posnr
    JOIN likp d ON d.vbeln = di.vbeln JOIN vbrp bi ON bi.vgbel = di.vbeln AND bi.vgpos = di.posnr
    JOIN vbrk b ON b.vbeln = bi.vbeln WHERE o.auart = 'Z1'"""))
def chain(t: Tables):
    return J.document_chain(
        t.raw("vbak").filter(F.col("auart") == "Z1").select(F.col("vbeln").alias("order_number")),
        [
            (t.raw("vbap").select("vbeln", F.col("posnr").alias("order_item"), "matnr", F.col("kwmeng").alias("qty_ordered")),
             {"order_number": "vbeln"}),
            (t.raw("lips").select(F.col("vbeln").alias("delivery_number"), F.col("posnr").alias("_di"), "vgbel", "vgpos",
                                  F.col("lfimg").alias("qty_delivered")),
             {"order_number": "vgbel", "order_item": "vgpos"}),
            (t.raw("likp").select("vbeln"), {"delivery_number": "vbeln"}),
            (t.raw("vbrp").select(F.col("vbeln").alias("invoice_number"), "vgbel", "vgpos", F.col("netwr").alias("net_value")),
             {"delivery_number": "vgbel", "_di": "vgpos"}),
            (t.raw("vbrk").select("vbeln", F.col("fkdat").alias("invoice_date")), {"invoice_number": "vbeln"}),
        ],
    ).drop("_di")


@query("object_key_join", twin("""SELECT f.bukrs, f.belnr, f.gjahr, m.mblnr, m.budat AS posted FROM bkpf f
    JOIN mkpf m ON f.awkey = concat(m.mblnr, m.mjahr) AND f.awtyp = 'MKPF'"""))
def by_object_key(t: Tables):
    movements = t.raw("mkpf").select("mblnr", "mjahr", F.col("budat").alias("posted"))
    accounting = t.raw("bkpf").select("bukrs", "belnr", "gjahr", "awkey", "awtyp")
    return J.object_key_join(accounting, movements, object_key("mblnr", "mjahr"), "MKPF").select(
        "bukrs", "belnr", "gjahr", "mblnr", "posted"
    )


def _po_view(t: Tables) -> J.EntityView:
    return J.EntityView(
        t.raw("ekko"),
        {"PurchaseOrder": "ebeln", "Supplier": "lifnr", "CompanyCode": "bukrs", "PurchaseOrderDate": "bedat",
         "NetAmount": "netwr", "Currency": "waers"},
        {
            "_Supplier": J.Association(t.raw("lfa1"), {"Supplier": "lifnr"}),
            "_Items": J.Association(t.raw("ekpo"), {"PurchaseOrder": "ebeln"}),
        },
    )


@query("association_path", twin("""SELECT h.ebeln AS PurchaseOrder, v.name1 AS SupplierName, h.netwr AS NetAmount
    FROM ekko h LEFT JOIN lfa1 v ON h.lifnr = v.lifnr WHERE h.bukrs = 'BR01'"""))
def association(t: Tables):
    return _po_view(t).select(
        "PurchaseOrder", "_Supplier.name1 AS SupplierName", "NetAmount", where=F.col("CompanyCode") == "BR01"
    )


@query("cds_like_view", twin("""SELECT ebeln AS PurchaseOrder, lifnr AS Supplier, bedat AS PurchaseOrderDate, netwr AS NetAmount,
    waers AS Currency FROM ekko WHERE bukrs = 'BR01' AND bedat >= '19980101'"""))
def cds_view(t: Tables):
    _po_view(t).register("z_po_header")
    return t.spark.sql(
        "SELECT PurchaseOrder, Supplier, PurchaseOrderDate, NetAmount, Currency FROM z_po_header "
        "WHERE CompanyCode = 'BR01' AND PurchaseOrderDate >= '19980101'"
    )


@query("expand_items", """WITH n AS (SELECT l_orderkey AS k, CAST(ceil(count(*) / 3) AS BIGINT) AS pages FROM lineitem GROUP BY 1),
    p AS (SELECT l_orderkey AS k, l_partkey % pages AS page, count(*) AS items, sum(l_partkey) AS parts
          FROM lineitem JOIN n ON k = l_orderkey GROUP BY 1, 2)
    SELECT o_orderkey AS l_orderkey, o_custkey, coalesce(page, 0) AS page, coalesce(items, 0) AS item_count,
    CAST(coalesce(parts, 0) AS BIGINT) AS part_sum FROM orders LEFT JOIN p ON k = o_orderkey""")
def expand(t: Tables):
    items = t.source("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    nested = J.expand_items(
        _orders(t).select("l_orderkey", "o_custkey"), items, ["l_orderkey"],
        ["l_linenumber", "l_partkey", "l_suppkey"], page_size=3, spread=F.col("l_partkey"),
    )
    return nested.select(
        "l_orderkey", "o_custkey", "page", F.size("items").cast("bigint").alias("item_count"),
        F.aggregate("items", F.lit(0).cast("bigint"), lambda s, i: s + i["l_partkey"]).alias("part_sum"),
    )


@query("doc_flow_header", twin("SELECT DISTINCT vbelv AS predecessor, vbeln AS successor FROM vbfa WHERE vbtyp_n = 'J'"))
def flow(t: Tables):
    return J.doc_flow(t.raw("vbfa"), "J")
