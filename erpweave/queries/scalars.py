"""Projection, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from erpweave.functions import (
    SelectOption, code_label, days_between, flag_to_bool, guarded_ratio, hierarchy_level, in_ranges, is_blank,
    mask_tax_id, money, month_of, month_start, not_flag, object_key, quantity, rate, register_mask_udf, sap_date,
    signed_amount, strip_leading_zeros, year_of,
)
from erpweave.operators import projection as P
from erpweave.queries.oracle import twin
from erpweave.queries.registry import Tables, query


@query("business_rename", twin("""SELECT kunnr, name1 AS customer_name, mcod1, stcd1 AS cnpj_cpf,
    ktokd AS account_group, ort01 AS city, regio AS state, land1 AS country FROM kna1"""))
def business_rename(t: Tables):
    return P.business_names(t.raw("kna1"), {
        "kunnr": "kunnr", "name1": "customer_name", "mcod1": "mcod1", "stcd1": "cnpj_cpf",
        "ktokd": "account_group", "ort01": "city", "regio": "state", "land1": "country",
    })


@query("tenant_filter", twin("SELECT mandt, vbeln, kunnr, netwr FROM vbak WHERE mandt = '100'"))
def tenant(t: Tables):
    return P.tenant_filter(t.raw("vbak")).select("mandt", "vbeln", "kunnr", "netwr")


@query("language_filter", twin("SELECT matnr, maktx FROM makt WHERE spras = 'P'"))
def language(t: Tables):
    return P.language_filter(t.raw("makt")).select("matnr", "maktx")


@query("partner_roles", twin("""WITH p AS (SELECT vbeln, parvw, pernr, kunnr FROM vbpa
        UNION SELECT vbeln, 'ZG', 'second', NULL FROM vbpa WHERE vbeln LIKE '%7'),
    keys AS (SELECT DISTINCT vbeln FROM p WHERE parvw IN ('ZG', 'ZA', 'WE')),
    g AS (SELECT DISTINCT vbeln, pernr AS manager FROM p WHERE parvw = 'ZG' AND pernr IS NOT NULL),
    a AS (SELECT DISTINCT vbeln, pernr AS assistant FROM p WHERE parvw = 'ZA' AND pernr IS NOT NULL),
    w AS (SELECT DISTINCT vbeln, kunnr AS ship_to FROM p WHERE parvw = 'WE' AND kunnr IS NOT NULL)
    SELECT vbeln, manager, assistant, ship_to FROM keys LEFT JOIN g USING (vbeln) LEFT JOIN a USING (vbeln) LEFT JOIN w USING (vbeln)"""))
def roles(t: Tables):
    """Every seventh order has a second manager."""
    partners = t.raw("vbpa").select("vbeln", "parvw", "pernr", "kunnr")
    second = partners.filter(F.col("vbeln").endswith("7")).select(
        "vbeln", F.lit("ZG").alias("parvw"), F.lit("second").alias("pernr"), F.lit(None).cast("string").alias("kunnr"))
    return P.by_role(
        partners.unionByName(second), {"manager": ("ZG", "pernr"), "assistant": ("ZA", "pernr"), "ship_to": ("WE", "kunnr")},
        ["vbeln"], "parvw",
    )


@query("code_filters", twin("""SELECT 'commercial' AS kind, vbeln AS doc FROM vbkd WHERE posnr = '000000'
    UNION ALL SELECT 'shipment', doc_number FROM oigsi WHERE doc_typ = 'J'
    UNION ALL SELECT 'outbound', docnum FROM j_1bnfdoc WHERE direct = 'O'
    UNION ALL SELECT 'active', vbeln FROM silver_vbrk WHERE cancelled_flag = FALSE"""))
def code_filters(t: Tables):
    def kind(df, name, condition, doc):
        return df.filter(condition).select(F.lit(name).alias("kind"), F.col(doc).alias("doc"))

    return (
        kind(t.raw("vbkd"), "commercial", F.col("posnr") == "000000", "vbeln")
        .unionByName(kind(t.raw("oigsi"), "shipment", F.col("doc_typ") == "J", "doc_number"))
        .unionByName(kind(t.raw("j_1bnfdoc"), "outbound", F.col("direct") == "O", "docnum"))
        .unionByName(kind(t.silver("vbrk"), "active", ~F.col("cancelled_flag"), "vbeln"))
    )


@query("predicate_range_list", """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    WHERE o_totalprice >= 100000 AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'
    AND o_orderstatus IN ('F', 'O') AND o_orderpriority <> '5-LOW' AND o_orderpriority LIKE '%-%'""")
def predicates(t: Tables):
    # The date range stays on the stored timestamp so that it reaches the scan.
    return t.source("orders").filter(
        (F.col("o_totalprice") >= 100000)
        & (F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
        & F.col("o_orderstatus").isin("F", "O")
        & (F.col("o_orderpriority") != "5-LOW")
        & F.col("o_orderpriority").like("%-%")
    ).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("null_safe_flags", twin("""SELECT vbeln, (sfakn IS NULL OR sfakn = '') AS not_reversed,
    (fksto IS NULL OR fksto <> 'X') AS not_cancelled FROM vbrk"""))
def null_safe(t: Tables):
    return t.raw("vbrk").select(
        "vbeln", is_blank("sfakn").alias("not_reversed"), not_flag("fksto").alias("not_cancelled")
    )


@query("active_invoices_strict", twin("""SELECT vbeln, fkdat FROM vbrk WHERE mandt = '100'
    AND (sfakn IS NULL OR sfakn = '') AND (fksto IS NULL OR fksto <> 'X')"""))
def active_strict(t: Tables):
    return P.tenant_filter(t.raw("vbrk")).filter(is_blank("sfakn") & not_flag("fksto")).select("vbeln", "fkdat")


@query("select_options", twin("""SELECT ebeln, bedat, ekgrp FROM ekko WHERE
    ((bedat BETWEEN '19960101' AND '19961231') OR bedat >= '20010101') AND NOT (ekgrp = '003')
    AND (bsart = 'NB' OR bsart LIKE 'F%')"""))
def select_options(t: Tables):
    return t.raw("ekko").filter(
        in_ranges("bedat", [SelectOption("I", "BT", "19960101", "19961231"), SelectOption("I", "GE", "20010101")])
        & in_ranges("ekgrp", [SelectOption("E", "EQ", "003")])
        & in_ranges("bsart", [SelectOption("I", "EQ", "NB"), SelectOption("I", "CP", "F*")])
        & in_ranges("bukrs", [])
    ).select("ebeln", "bedat", "ekgrp")


@query("sap_date_parse", twin("SELECT vbeln, audat, CAST(try_strptime(audat, '%Y%m%d') AS DATE) AS order_date FROM vbak"))
def date_parse(t: Tables):
    return t.raw("vbak").select("vbeln", "audat", sap_date("audat").alias("order_date"))


@query("sap_date_sentinel", twin("""SELECT vbeln, vdatu, CASE WHEN vdatu IN ('00000000', '99991231') THEN NULL
    ELSE CAST(strptime(CASE WHEN vdatu IN ('00000000', '99991231') THEN NULL ELSE vdatu END, '%Y%m%d') AS DATE) END AS wanted_date,
    CAST(try_strptime(vdatu, '%Y%m%d') AS DATE) AS validity_date FROM vbak"""))
def date_sentinel(t: Tables):
    return t.raw("vbak").select(
        "vbeln", "vdatu", sap_date("vdatu", open_end="null").alias("wanted_date"),
        sap_date("vdatu").alias("validity_date"),
    )


@query("month_bucket", """SELECT l_orderkey, l_linenumber, CAST(date_trunc('month', l_shipdate) AS DATE) AS ship_month
    FROM lineitem""")
def month_bucket(t: Tables):
    return t.source("lineitem").select("l_orderkey", "l_linenumber", month_start("l_shipdate").alias("ship_month"))


@query("year_month_parts", """SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS order_year,
    CAST(month(o_orderdate) AS BIGINT) AS order_month FROM orders""")
def year_month(t: Tables):
    return t.source("orders").select(
        "o_orderkey", year_of("o_orderdate").alias("order_year"), month_of("o_orderdate").alias("order_month")
    )


@query("days_between", twin("""SELECT vbeln, CAST(date_diff('day', planned_delivery_date, actual_goods_issue_date) AS BIGINT)
    AS delay_days FROM silver_likp"""))
def days(t: Tables):
    return t.silver("likp").select(
        "vbeln", days_between("planned_delivery_date", "actual_goods_issue_date").alias("delay_days")
    )


@query("decimal_cast", """SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_extendedprice AS DECIMAL(17,2)) AS amount,
    CAST(l_quantity AS DECIMAL(17,3)) AS qty, CAST(l_tax AS DECIMAL(7,4)) AS tax_rate,
    TRY_CAST(concat(CAST(l_quantity AS STRING), CASE WHEN l_linenumber = 3 THEN 'x' ELSE '' END) AS DECIMAL(17,2)) AS text_amount
    FROM lineitem""")
def decimals(t: Tables):
    text = F.concat(
        F.col("l_quantity").cast("string"), F.when(F.col("l_linenumber") == 3, "x").otherwise("")
    )
    return t.source("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", money("l_extendedprice").alias("amount"),
        quantity("l_quantity").alias("qty"), rate("l_tax").alias("tax_rate"), money(text).alias("text_amount"),
    )


@query("case_flag", twin("SELECT vbeln, CASE WHEN fksto = 'X' THEN TRUE ELSE FALSE END AS cancelled_flag FROM vbrk"))
def case_flag(t: Tables):
    return t.raw("vbrk").select("vbeln", flag_to_bool("fksto").alias("cancelled_flag"))


@query("case_label", twin("""SELECT vbeln, posnr, CASE WHEN abgru IS NULL OR abgru = '' THEN 'Ativo' ELSE 'Rejeitado' END
    AS item_status FROM vbap"""))
def case_label(t: Tables):
    return t.raw("vbap").select(
        "vbeln", "posnr", code_label("abgru", {"": "Ativo"}, "Rejeitado").alias("item_status")
    )


@query("coalesce_fallback", twin("""SELECT h.vbeln, coalesce(p.kunnr, h.kunnr) AS ship_to
    FROM vbak h LEFT JOIN (SELECT vbeln, kunnr FROM vbpa WHERE parvw = 'WE') p ON h.vbeln = p.vbeln"""))
def fallback(t: Tables):
    partner = t.raw("vbpa").filter(F.col("parvw") == "WE").select("vbeln", F.col("kunnr").alias("we"))
    return t.raw("vbak").join(partner, "vbeln", "left").select("vbeln", F.coalesce("we", "kunnr").alias("ship_to"))


@query("typed_nulls", """SELECT o_orderkey, CAST(NULL AS VARCHAR) AS obs_ov, CAST(NULL AS DATE) AS primeira_data_desejada
    FROM orders""")
def typed_nulls(t: Tables):
    return t.source("orders").select(
        "o_orderkey", F.lit(None).cast("string").alias("obs_ov"), F.lit(None).cast("date").alias("primeira_data_desejada")
    )


@query("hierarchy_split", twin("""SELECT matnr, trim(substr(prdha, 1, 5)) AS linha, trim(substr(prdha, 6, 5)) AS familia
    FROM mara"""))
def hierarchy(t: Tables):
    return t.raw("mara").select(
        "matnr", hierarchy_level("prdha", 1).alias("linha"), hierarchy_level("prdha", 2).alias("familia")
    )


@query("strip_leading_zeros", twin("SELECT matnr, ltrim(matnr, '0') AS item FROM mara"))
def strip(t: Tables):
    return t.raw("mara").select("matnr", strip_leading_zeros("matnr").alias("item"))


@query("object_key_concat", twin("SELECT mblnr, mjahr, concat(mblnr, mjahr) AS awkey FROM mkpf"))
def obj_key(t: Tables):
    return t.raw("mkpf").select("mblnr", "mjahr", object_key("mblnr", "mjahr").alias("awkey"))


@query("inline_arithmetic", twin("""SELECT aufnr, posnr,
    CAST(abs(psmng - wemng) AS DECIMAL(17,3)) AS open_qty,
    CAST(CAST(psmng AS DECIMAL(17,3)) * 4 AS DECIMAL(17,3)) AS planned_value FROM afpo"""))
def arithmetic(t: Tables):
    return t.raw("afpo").select(
        "aufnr", "posnr", F.abs(F.col("psmng") - F.col("wemng")).cast("decimal(17,3)").alias("open_qty"),
        (quantity("psmng") * 4).cast("decimal(17,3)").alias("planned_value"),
    )


@query("guarded_ratio", """SELECT l_orderkey, l_linenumber, l_partkey,
    CAST(CASE WHEN l_discount > 0 THEN l_tax / l_discount * 100 END AS DECIMAL(17,1)) AS pct FROM lineitem""")
def ratio(t: Tables):
    return t.source("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", guarded_ratio("l_tax", "l_discount").cast("decimal(17,1)").alias("pct")
    )


@query("signed_amount", twin("""SELECT belnr, buzei, CAST(CASE WHEN shkzg = 'S' THEN dmbtr ELSE -dmbtr END AS DECIMAL(17,2))
    AS amount FROM bseg"""))
def signed(t: Tables):
    return t.raw("bseg").select("belnr", "buzei", signed_amount("dmbtr", "shkzg").cast("decimal(17,2)").alias("amount"))


@query("mask_tax_id", twin("""SELECT lifnr, CASE WHEN land1 = 'AR' THEN stcd1
    ELSE concat(substr(stcd1, 1, 2), '.***.***/***-**') END AS tax_id FROM lfa1"""))
def mask(t: Tables):
    return t.raw("lfa1").select("lifnr", mask_tax_id("stcd1", F.col("land1") == "AR").alias("tax_id"))


@query("sql_udf_mask", twin("SELECT kunnr, concat(substr(stcd1, 1, 2), '.***.***/***-**') AS tax_id FROM kna1"))
def udf_mask(t: Tables):
    name = register_mask_udf(t.spark)
    return t.raw("kna1").selectExpr("kunnr", f"{name}(stcd1, false) AS tax_id")


@query("domain_text_union", twin("""SELECT 'VSBED' AS domname, vsbed AS domvalue_l, spras AS ddlanguage, vtext AS ddtext FROM tvsbt
    UNION ALL SELECT 'WERKS', werks, 'P', name1 FROM t001w"""))
def domains(t: Tables):
    shipping = t.raw("tvsbt").select("vsbed", "spras", "vtext")
    plants = t.raw("t001w").select("werks", "name1", F.lit("P").alias("spras"))
    return P.domain_texts([
        (shipping, {"vsbed": "domvalue_l", "spras": "ddlanguage", "vtext": "ddtext"}, "VSBED"),
        (plants, {"werks": "domvalue_l", "spras": "ddlanguage", "name1": "ddtext"}, "WERKS"),
    ])


@query("corresponding_fields", twin("""SELECT ebeln, lifnr AS z_fornecedor, CAST(try_strptime(bedat, '%Y%m%d') AS DATE) AS z_data_po,
    CAST(netwr AS DECIMAL(15,2)) AS netwr, CAST(NULL AS VARCHAR) AS z_status FROM ekko"""))
def corresponding(t: Tables):
    target = StructType.fromDDL("ebeln string, z_fornecedor string, z_data_po date, netwr decimal(15,2), z_status string")
    typed = t.raw("ekko").withColumn("bedat", sap_date("bedat"))
    return P.corresponding(typed, target, {"z_fornecedor": "lifnr", "z_data_po": "bedat"})


@query("json_fields", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
    json_extract_string(props, '$.missing') AS missing FROM events""")
def json_fields(t: Tables):
    parsed = F.from_json("props", "k bigint, missing string")
    return t.source("events").select("event_id", parsed["k"].alias("k"), parsed["missing"].alias("missing"))


@query("delimited_row_split", """SELECT CAST(n_nationkey AS STRING) AS nationkey, n_name AS name,
    CAST(n_regionkey AS STRING) AS regionkey, CAST(NULL AS VARCHAR) AS comment FROM nation""")
def split_rows(t: Tables):
    work_area = t.source("nation").select(
        F.concat_ws(" | ", F.col("n_nationkey").cast("string"), "n_name", F.col("n_regionkey").cast("string")).alias("wa")
    )
    return P.split_delimited(work_area, "wa", ["nationkey", "name", "regionkey", "comment"])
