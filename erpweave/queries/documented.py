"""Analyst queries over the raw document tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from erpweave.functions import SelectOption, in_ranges
from erpweave.functions.numbers import signed_amount
from erpweave.operators.maintenance import change_history
from erpweave.plans import documented as D
from erpweave.plans import purchasing_lakehouse as L
from erpweave.queries.oracle import CTES, twin
from erpweave.queries.registry import Tables, query
from erpweave.session import materialize, work_folder
from erpweave.sources.layout import curve_layout

# Derived inputs: accounting lines with their full key, incoming invoice items, journal,
# planning data and message tables.
CTES.update({
    "bseg_full": "SELECT s.mandt, k.bukrs, s.belnr, k.gjahr, s.buzei, s.saknr, s.dmbtr, s.shkzg, s.koart, s.lifnr, s.augdt FROM bseg s JOIN bkpf k ON s.belnr = k.belnr",
    "rseg": "SELECT i.mandt, i.ebeln, i.ebelp, concat('51', substr(i.ebeln, 3)) AS belnr, substr(h.bedat, 1, 4) AS gjahr FROM ekpo i JOIN ekko h ON i.ebeln = h.ebeln WHERE h.bsart = 'NB'",
    "acdoca": """SELECT if(right(s.belnr, 1) IN ('3', '7'), '2L', '0L') AS rldnr, s.bukrs, s.belnr, s.gjahr, s.buzei, s.saknr, h.budat, h.blart,
        CAST(if(s.shkzg = 'S', 1, -1) * CAST(s.dmbtr AS DECIMAL(17,2)) AS DECIMAL(17,2)) AS amount,
        CAST(if(s.shkzg = 'S', 4, -4) * CAST(s.dmbtr AS DECIMAL(17,2)) AS DECIMAL(17,2)) AS group_amount,
        concat('CC', right(s.saknr, 2)) AS rcostcenter, CASE WHEN s.koart = 'S' THEN concat('PC', right(s.lifnr, 1)) END AS rprctr,
        CAST(right(s.saknr, 2) AS DECIMAL(13,3)) AS menge FROM bseg_full s JOIN bkpf h ON s.belnr = h.belnr""",
    "ska1": "SELECT lpad(CAST(n_nationkey AS STRING), 10, '0') AS saknr, n_name AS txt50 FROM nation WHERE n_nationkey < 15",
    "marc": "SELECT matnr, werks, CAST(count(*) * 25 - 25 AS DECIMAL(17,3)) AS minbe FROM mard GROUP BY 1, 2",
    "edidc": "SELECT CASE WHEN event_id % 10 = 9 THEN '200' ELSE '100' END AS mandt, event_id AS docnum, event_type AS mestyp, CASE WHEN event_type = 'error' THEN '51' ELSE '53' END AS status, CAST(ts AS DATE) AS credat, CASE user_id % 3 WHEN 0 THEN '1' ELSE '2' END AS direct FROM events",
    "edids": "SELECT CASE WHEN event_id % 10 = 9 THEN '200' ELSE '100' END AS mandt, event_id AS docnum, props AS statxt, CASE WHEN user_id % 5 > 0 THEN 'SAP' END AS stamqu FROM events",
})


def _own(table: str) -> str:
    """Rows of the client: equal to joining on the client and filtering the first table."""
    return f"(SELECT * FROM {table} WHERE mandt = '100')"


def _bseg(t: Tables):
    keys = t.raw("bkpf").select("belnr", "bukrs", "gjahr")
    return t.raw("bseg").join(keys, "belnr")


def _rseg(t: Tables):
    header = t.raw("ekko").filter(F.col("bsart") == "NB").select("ebeln", F.substring("bedat", 1, 4).alias("gjahr"))
    number = F.concat(F.lit("51"), F.expr("substr(ebeln, 3)"))
    return t.raw("ekpo").select("mandt", "ebeln", "ebelp").join(header, "ebeln").withColumn("belnr", number)


def _journal(t: Tables):
    """Some documents belong to a further ledger; one of the company's currency is worth four of the group's."""
    header = t.raw("bkpf").select("belnr", "bukrs", "gjahr", "budat", "blart")
    amount = signed_amount("dmbtr", "shkzg").cast("decimal(17,2)")
    lines = t.raw("bseg").select(
        "belnr", "buzei", "saknr", amount.alias("amount"), (amount * 4).cast("decimal(17,2)").alias("group_amount"),
        F.when(F.right("belnr", F.lit(1)).isin("3", "7"), "2L").otherwise("0L").alias("rldnr"),
        F.concat(F.lit("CC"), F.right("saknr", F.lit(2))).alias("rcostcenter"),
        F.when(F.col("koart") == "S", F.concat(F.lit("PC"), F.right("lifnr", F.lit(1)))).alias("rprctr"),
        F.right("saknr", F.lit(2)).cast("decimal(13,3)").alias("menge"),
    )
    return lines.join(header, "belnr")


def _planning(t: Tables):
    return t.raw("mard").groupBy("mandt", "matnr", "werks").agg(
        (F.count(F.lit(1)) * 25 - 25).cast("decimal(17,3)").alias("minbe")
    )


def _two_clients(t: Tables):
    """Stock of client 100 and, with other quantities, of client 200."""
    own = t.raw("mard").select("mandt", "matnr", "werks", "lgort", "labst")
    return own.unionByName(own.withColumns({"mandt": F.lit("200"), "labst": F.col("labst") - 5}))


@query("q_po_header_item", twin("""WITH changed AS (SELECT ebeln, lifnr FROM ekko WHERE mandt = '100' AND aedat >= '20000101')
    SELECT ebeln, lifnr, matnr, menge, netpr FROM (SELECT ebeln, matnr, menge, netpr FROM ekpo WHERE mandt = '100') INNER JOIN changed USING (ebeln)"""))
def q1(t: Tables):
    return D.po_header_item(t.raw("ekko"), t.raw("ekpo"), "20000101")


@query("q_open_purchase_orders", twin("""WITH ordered AS (SELECT ebeln, lifnr, bedat FROM ekko WHERE bstyp = 'F' AND bedat >= '19990101' AND mandt = '100'),
    pending AS (SELECT ebeln, ebelp, matnr, menge, netpr, netwr FROM ekpo WHERE mandt = '100' AND (elikz IS NULL OR elikz = ''))
    SELECT ebeln, lifnr, bedat, ebelp, matnr, menge, netpr, netwr FROM pending INNER JOIN ordered USING (ebeln)"""))
def q2(t: Tables):
    return D.open_purchase_orders(t.raw("ekko"), t.raw("ekpo"), "19990101")


@query("q_goods_receipts", twin("""WITH head AS (SELECT mblnr, mjahr, budat FROM mkpf WHERE mandt = '100'),
    arrived AS (SELECT mblnr, matnr, werks, lgort, menge, dmbtr, ebeln, ebelp FROM mseg WHERE bwart = '101' AND mandt = '100')
    SELECT mblnr, mjahr, budat, matnr, werks, lgort, menge, dmbtr, ebeln, ebelp FROM arrived INNER JOIN head USING (mblnr)
    WHERE budat >= '19980101' AND budat <= '19981231'"""))
def q3(t: Tables):
    return D.goods_receipts(_mseg(t), t.raw("mkpf"), "19980101", "19981231")


def _mseg(t: Tables):
    """Movement items with the year of their document."""
    return t.raw("mseg").drop("budat").join(t.raw("mkpf").select("mblnr", "mjahr"), "mblnr")


@query("q_procure_to_pay_trace", twin(f"""WITH ordered AS (SELECT ebeln, lifnr AS fornecedor FROM {_own("ekko")} WHERE bedat >= '20000101'),
    arrived AS (SELECT ebeln, ebelp, menge AS qtd_recebida, dmbtr AS valor_recebido FROM {_own("mseg")} WHERE bwart = '101'),
    bill AS (SELECT belnr AS nr_fatura, gjahr AS bill_year, rmwwr AS valor_fatura FROM {_own("rbkp")}),
    billed AS (SELECT ebeln, ebelp, nr_fatura, valor_fatura FROM {_own("rseg")} LEFT JOIN bill ON belnr = nr_fatura AND gjahr = bill_year)
    SELECT ebeln AS nr_po, fornecedor, matnr AS material, menge AS qtd_pedida, qtd_recebida, valor_recebido, nr_fatura, valor_fatura
    FROM (SELECT ebeln, ebelp, matnr, menge FROM {_own("ekpo")}) INNER JOIN ordered USING (ebeln)
    LEFT JOIN arrived USING (ebeln, ebelp) LEFT JOIN billed USING (ebeln, ebelp)"""))
def q4(t: Tables):
    return D.procure_to_pay_trace(
        t.raw("ekko"), t.raw("ekpo"), t.raw("mseg"), _rseg(t), t.raw("rbkp"), "20000101"
    )


@query("q_order_to_billing_trace", twin(f"""WITH invoice AS (SELECT vgbel AS delivery, vbeln AS nr_billing, fkdat AS data_fatura, total AS valor_faturado
        FROM (SELECT vbeln, vgbel FROM {_own("vbrp")}) INNER JOIN (SELECT vbeln, fkdat, netwr AS total FROM {_own("vbrk")}) USING (vbeln)),
    shipped AS (SELECT vgbel AS vbeln, vgpos AS posnr, lfimg AS qtd_entregue, delivery
        FROM (SELECT vbeln AS delivery, vgbel, vgpos, lfimg FROM {_own("lips")})
        INNER JOIN (SELECT vbeln AS delivery FROM {_own("likp")}) USING (delivery))
    SELECT vbeln AS nr_so, cliente, material, qtd_pedida, qtd_entregue, nr_billing, data_fatura, valor_faturado
    FROM invoice INNER JOIN shipped USING (delivery)
    INNER JOIN (SELECT vbeln, posnr, matnr AS material, kwmeng AS qtd_pedida FROM {_own("vbap")}) USING (vbeln, posnr)
    INNER JOIN (SELECT vbeln, kunnr AS cliente FROM {_own("vbak")} WHERE audat >= '20010101') USING (vbeln)"""))
def q5(t: Tables):
    tables = {name: t.raw(name) for name in ("vbak", "vbap", "lips", "likp", "vbrp", "vbrk")}
    return D.order_to_billing_trace(**tables, since="20010101")


@query("q_order_to_billing_items", twin(f"""WITH invoice AS (SELECT vbeln AS nr_billing, fkdat AS data_fatura, netwr AS valor_faturado FROM {_own("vbrk")}),
    line AS (SELECT vbeln AS nr_billing, vgbel AS delivery, vgpos AS delivery_item FROM {_own("vbrp")}),
    shipped AS (SELECT vbeln AS delivery, posnr AS delivery_item, vgbel AS vbeln, vgpos AS posnr, lfimg AS qtd_entregue FROM {_own("lips")}
        WHERE vbeln IN (SELECT vbeln FROM {_own("likp")}))
    SELECT vbeln AS nr_so, cliente, matnr AS material, kwmeng AS qtd_pedida, qtd_entregue, nr_billing, data_fatura, valor_faturado
    FROM line INNER JOIN invoice USING (nr_billing) INNER JOIN shipped USING (delivery, delivery_item)
    INNER JOIN (SELECT vbeln, posnr, matnr, kwmeng FROM {_own("vbap")}) USING (vbeln, posnr)
    INNER JOIN (SELECT vbeln, kunnr AS cliente FROM {_own("vbak")} WHERE audat >= '20010101') USING (vbeln)"""))
def q5_items(t: Tables):
    """The trace along item numbers."""
    tables = {name: t.raw(name) for name in ("vbak", "vbap", "lips", "likp", "vbrp", "vbrk")}
    return D.order_to_billing_trace(**tables, since="20010101", by_item=True)


@query("q_open_payables", twin("""WITH booked AS (SELECT mandt, bukrs, belnr, gjahr, bldat FROM bkpf WHERE budat >= '19980101')
    SELECT bukrs, belnr, gjahr, lifnr, bldat, dmbtr, shkzg
    FROM (SELECT * FROM bseg_full WHERE mandt = '100' AND bukrs = 'BR01' AND koart = 'K' AND augdt = '') INNER JOIN booked USING (mandt, bukrs, belnr, gjahr)"""))
def q6(t: Tables):
    return D.open_payables(_bseg(t), t.raw("bkpf"), "BR01", "19980101")


@query("q_production_balance", twin("""SELECT a.aufnr, a.werks, a.erdat, a.gstrp, a.gltrp, p.matnr,
    CAST(p.psmng AS DECIMAL(17,3)) AS qtd_planejada, CAST(p.wemng AS DECIMAL(17,3)) AS qtd_recebida,
    CAST(CAST(p.psmng AS DECIMAL(17,3)) - CAST(p.wemng AS DECIMAL(17,3)) AS DECIMAL(17,3)) AS saldo_pendente
    FROM aufk a JOIN afpo p ON a.mandt = p.mandt AND a.aufnr = p.aufnr
    WHERE a.mandt = '100' AND a.werks = 'P001' AND a.erdat >= '19980101' AND a.auart IN ('PP01', 'PP02')"""))
def q7(t: Tables):
    return D.production_balance(t.raw("aufk"), t.raw("afpo"), "P001", "19980101")


@query("change_history", twin("""SELECT h.changenr, h.objectid, h.udate, h.utime, h.username, p.tabname, p.fname, p.value_old, p.value_new
    FROM cdhdr h JOIN cdpos p ON h.mandt = p.mandt AND h.changenr = p.changenr WHERE h.objectclas = 'EINKBELEG'
    AND p.fname = 'NETPR' AND h.udate BETWEEN '20240105' AND '20240120'"""))
def q8(t: Tables):
    return change_history(t.raw("cdhdr"), t.raw("cdpos"), "EINKBELEG", "NETPR", "20240105", "20240120")


@query("q_fi_document_lines", twin("""SELECT b.bukrs, b.belnr, b.gjahr, b.budat, s.saknr, s.dmbtr, s.shkzg FROM bkpf b JOIN bseg_full s
    ON s.mandt = b.mandt AND s.bukrs = b.bukrs AND s.belnr = b.belnr AND s.gjahr = b.gjahr
    WHERE b.mandt = '100' AND b.bukrs = 'BR02' AND b.gjahr = '1999'"""))
def q9(t: Tables):
    return D.fi_document_lines(t.raw("bkpf"), _bseg(t), "BR02", "1999")


@query("q_production_cost", twin(f"""WITH used AS (SELECT aufnr, mblnr, matnr AS componente, menge AS qtd_consumida, dmbtr AS valor_consumo FROM {_own("mseg")} WHERE bwart = '261'),
    moved AS (SELECT mblnr, concat(mblnr, mjahr) AS origin FROM {_own("mkpf")} WHERE budat >= '19960101' AND budat <= '19981231'),
    booked AS (SELECT awkey AS origin, belnr AS doc_fi, budat AS data_lancamento FROM {_own("bkpf")} WHERE awtyp = 'MKPF')
    SELECT aufnr AS nr_ordem, matnr AS produto_acabado, werks AS planta, componente, qtd_consumida, valor_consumo, doc_fi, data_lancamento
    FROM booked INNER JOIN moved USING (origin) INNER JOIN used USING (mblnr)
    INNER JOIN (SELECT aufnr, matnr, werks FROM {_own("afpo")} WHERE werks = 'P003') USING (aufnr)"""))
def q10(t: Tables):
    return D.production_cost(t.raw("afpo"), _mseg(t), t.raw("mkpf"), t.raw("bkpf"), "19960101", "19981231", "P003")


@query("q_order_profitability", twin(f"""WITH cost AS (SELECT vbeln AS invoice, abs(dmbtr) AS custo_mercadoria FROM {_own("mseg")} WHERE bwart = '601'),
    revenue AS (SELECT vbeln AS invoice, netwr AS receita_bruta, fkdat AS data_faturamento FROM {_own("vbrk")} WHERE rfbsk = 'C' AND fkdat >= '20000101'),
    link AS (SELECT vbeln AS invoice, aubel AS vbeln, aupos AS posnr FROM {_own("vbrp")})
    SELECT vbeln AS nr_so, cliente, material, qtd_pedida, receita_bruta, data_faturamento, custo_mercadoria
    FROM cost INNER JOIN revenue USING (invoice) INNER JOIN link USING (invoice)
    INNER JOIN (SELECT vbeln, posnr, matnr AS material, kwmeng AS qtd_pedida FROM {_own("vbap")}) USING (vbeln, posnr)
    INNER JOIN (SELECT vbeln, kunnr AS cliente FROM {_own("vbak")}) USING (vbeln)"""))
def q11(t: Tables):
    tables = {name: t.raw(name) for name in ("vbak", "vbap", "vbrp", "vbrk", "mseg")}
    return D.order_profitability(**tables, since="20000101")


@query("q_order_profitability_items", twin(f"""WITH cost AS (SELECT vbeln AS invoice, posnr AS line, sum(CAST(abs(dmbtr) AS DECIMAL(17,2))) AS total
        FROM {_own("mseg")} WHERE bwart = '601' GROUP BY 1, 2),
    revenue AS (SELECT vbeln AS invoice, netwr AS receita_bruta, fkdat AS data_faturamento FROM {_own("vbrk")} WHERE rfbsk = 'C' AND fkdat >= '20000101'),
    link AS (SELECT vbeln AS invoice, posnr AS line, aubel AS vbeln, aupos AS posnr FROM {_own("vbrp")})
    SELECT vbeln AS nr_so, cliente, material, qtd_pedida, receita_bruta, data_faturamento, CAST(total AS DECIMAL(17,2)) AS custo_mercadoria
    FROM cost INNER JOIN link USING (invoice, line) INNER JOIN revenue USING (invoice)
    INNER JOIN (SELECT vbeln, posnr, matnr AS material, kwmeng AS qtd_pedida FROM {_own("vbap")}) USING (vbeln, posnr)
    INNER JOIN (SELECT vbeln, kunnr AS cliente FROM {_own("vbak")}) USING (vbeln)"""))
def q11_items(t: Tables):
    """Revenue of an order item against the cost added up per invoice item."""
    tables = {name: t.raw(name) for name in ("vbak", "vbap", "vbrp", "vbrk", "mseg")}
    return D.order_profitability(**tables, since="20000101", by_item=True)


@query("q_document_by_object_key", twin("""SELECT belnr, gjahr, budat, blart FROM bkpf WHERE mandt = '100' AND awtyp = 'VBRK'
    AND awkey = '900000000022'"""))
def q12(t: Tables):
    return D.document_by_object_key(t.raw("bkpf"), "VBRK", "900000000022")


@query("q_failed_messages", twin("""WITH bad AS (SELECT docnum, mestyp, direct, status, credat FROM edidc
        WHERE status = '51' AND credat >= DATE '2024-01-10' AND mandt = '100'),
    reason AS (SELECT docnum, statxt, stamqu FROM edids WHERE mandt = '100')
    SELECT * FROM bad INNER JOIN reason USING (docnum)"""))
def q13(t: Tables):
    client = F.when(F.col("event_id") % 10 == 9, "200").otherwise("100").alias("mandt")
    events = t.source("events")
    control = events.select(
        client, F.col("event_id").alias("docnum"), F.col("event_type").alias("mestyp"),
        F.when(F.col("event_type") == "error", "51").otherwise("53").alias("status"),
        F.col("ts").cast("date").alias("credat"), F.when(F.col("user_id") % 3 == 0, "1").otherwise("2").alias("direct"),
    )
    texts = events.select(
        client, F.col("event_id").alias("docnum"), F.col("props").alias("statxt"),
        F.when(F.col("user_id") % 5 > 0, "SAP").alias("stamqu"),
    )
    return D.failed_messages(control, texts, "51", "2024-01-10")


@query("open_cleared_split", twin("""WITH every AS (SELECT koart, augdt FROM bseg
        UNION ALL SELECT 'A', augdt FROM bseg WHERE koart = 'S' UNION ALL SELECT NULL, '' FROM bseg WHERE koart = 'K')
    SELECT koart, if(trim(augdt) = '' OR augdt IS NULL, 'open', 'cleared') AS state, count(*) AS items FROM every GROUP BY ALL"""))
def q14(t: Tables):
    """With items of a further account type and some without any."""
    own = t.raw("bseg").select("koart", "augdt")
    every = own.unionByName(own.filter("koart = 'S'").withColumn("koart", F.lit("A"))).unionByName(
        own.filter("koart = 'K'").select(F.lit(None).cast("string").alias("koart"), F.lit("").alias("augdt")))
    return D.split_by_clearing(every).groupBy("koart", "state").agg(F.count(F.lit(1)).alias("items"))


@query("flat_po_extract", twin("""SELECT k.ebeln, k.lifnr, k.bedat, p.ebelp, p.matnr, p.menge, p.netpr, p.netwr, m.maktx, v.name1
    FROM ekko k JOIN ekpo p ON k.mandt = p.mandt AND k.ebeln = p.ebeln
    LEFT JOIN (SELECT matnr, maktx FROM makt WHERE spras = 'P') m ON p.matnr = m.matnr LEFT JOIN lfa1 v ON k.lifnr = v.lifnr
    WHERE k.mandt = '100' AND k.bukrs = 'BR01' AND k.bstyp = 'F' AND k.bedat BETWEEN '19970101' AND '19991231'
    AND p.werks IN ('P001', 'P004', 'P007') AND coalesce(p.loekz, '') = ''"""))
def q15(t: Tables):
    return D.flat_po_extract(
        t.raw("ekko"), t.raw("ekpo"), t.raw("makt"), t.raw("lfa1"), "BR01",
        in_ranges("bedat", [SelectOption("I", "BT", "19970101", "19991231")]),
        in_ranges("werks", [SelectOption("I", "EQ", w) for w in ("P001", "P004", "P007")]),
    )


@query("q_journal_slice", twin("""SELECT rldnr, bukrs, gjahr, belnr, budat, blart, buzei, saknr, rcostcenter, rprctr, amount, group_amount, menge
    FROM acdoca WHERE rldnr = '0L' AND bukrs = 'BR01' AND gjahr = '1998' AND budat BETWEEN '19980301' AND '19980930' AND blart IN ('RE', 'WE')"""))
def q16(t: Tables):
    return D.journal_slice(_journal(t), "BR01", "1998", "19980301", "19980930", ["RE", "WE"])


@query("q_journal_balance", twin("""SELECT CAST(sum(amount) AS DECIMAL(27,2)) AS balance FROM acdoca WHERE rldnr = '0L' AND bukrs = 'BR01'
    AND gjahr = '1998' AND saknr = '0000000007'"""))
def q17(t: Tables):
    return D.journal_balance(_journal(t), "BR01", "1998", "0000000007")


@query("q_material_movements", twin("""SELECT mblnr, mjahr, zeile, budat, bwart, matnr, werks, lgort, menge, meins, dmbtr
    FROM mseg INNER JOIN (SELECT mblnr, mjahr FROM mkpf) USING (mblnr) WHERE mandt = '100' AND werks = 'P010' AND bwart = '101' AND budat BETWEEN '19970101' AND '19971231'"""))
def q18(t: Tables):
    items = t.raw("mseg").join(t.raw("mkpf").select("mblnr", "mjahr"), "mblnr")
    return D.material_movements(items, "P010", "101", "19970101", "19971231")


# Reorder points exist for client 100 only; stock is there for two clients.
_CRITICAL = """SELECT matnr, werks, lgort, labst AS estoque_disponivel, minbe AS estoque_minimo,
    CAST(round(100 * (labst / CAST(minbe AS DOUBLE)), 4) AS DECIMAL(17,4)) AS perc_do_minimo
    FROM marc INNER JOIN mard USING (matnr, werks)
    WHERE minbe > 0 AND werks = '{plant}' AND labst / minbe * 100 <= {percent}"""


@query("critical_stock", twin(_CRITICAL.format(plant="P001", percent=60)))
def q19(t: Tables):
    return D.critical_stock(_two_clients(t), _planning(t), "100", "P001", 60.0)


@query("critical_stock_function", twin(_CRITICAL.format(plant="P002", percent=40)))
def stock_function(t: Tables):
    name = D.register_critical_stock(_two_clients(t), _planning(t))
    return t.spark.sql(f"SELECT * FROM {name}('100', 'P002', 40.0D)")


@query("q_material_stock", twin("""WITH label AS (SELECT matnr, maktx FROM makt WHERE spras = 'P'),
    chosen AS (SELECT matnr, mtart, matkl FROM mara WHERE mtart = 'FERT')
    SELECT matnr, mtart, matkl, maktx, werks, lgort, labst
    FROM (SELECT matnr, werks FROM marc) INNER JOIN chosen USING (matnr) INNER JOIN label USING (matnr)
    LEFT JOIN (SELECT matnr, werks, lgort, labst FROM mard) USING (matnr, werks)"""))
def q20(t: Tables):
    return D.material_stock(
        t.raw("mara"), _planning(t), t.raw("makt"), t.raw("mard"), "FERT"
    )


@query("q_material_valuation", twin("""SELECT m.matnr, v.verpr, v.stprs, v.vprsv FROM mara m JOIN mbew v ON m.matnr = v.matnr
    AND v.bwkey = 'BR01'"""))
def q21(t: Tables):
    return D.material_valuation(t.raw("mara"), t.raw("mbew"), "BR01")


@query("po_received_by_item", twin("""WITH done AS (SELECT ebeln, ebelp, sum(menge::DECIMAL(17,3)) FILTER (vgabe = '1') AS received,
        sum(wrbtr::DECIMAL(17,2)) FILTER (vgabe = '2') AS invoiced FROM ekbe GROUP BY ALL),
    item AS (SELECT DISTINCT ebeln, ebelp, matnr, menge AS qty_ordered FROM ekpo WHERE coalesce(loekz, '') = '')
    SELECT ebeln, lifnr, ebelp, matnr, qty_ordered, coalesce(received, 0)::DECIMAL(17,3) AS qty_received,
        coalesce(invoiced, 0)::DECIMAL(17,2) AS value_invoiced
    FROM item INNER JOIN (SELECT DISTINCT ebeln, lifnr FROM ekko WHERE bsart = 'NB') USING (ebeln) LEFT JOIN done USING (ebeln, ebelp)"""))
def q22(t: Tables):
    return D.po_received_by_item(t.raw("ekko"), t.raw("ekpo"), t.raw("ekbe"), "NB")


@query("q_fi_with_account_text", twin("""SELECT h.belnr, h.budat, h.blart, i.buzei, i.saknr, i.dmbtr, i.shkzg, g.txt50 AS account_desc
    FROM bkpf h JOIN bseg_full i ON h.bukrs = i.bukrs AND h.belnr = i.belnr AND h.gjahr = i.gjahr
    LEFT JOIN ska1 g ON i.saknr = g.saknr WHERE h.bukrs = 'BR01' AND h.gjahr = '2000' AND i.koart = 'S'"""))
def q23(t: Tables):
    accounts = t.source("nation").filter(F.col("n_nationkey") < 15).select(
        F.lpad(F.col("n_nationkey").cast("string"), 10, "0").alias("saknr"), F.col("n_name").alias("txt50")
    )
    return D.fi_with_account_text(t.raw("bkpf"), _bseg(t), accounts, "BR01", "2000", "S")


@query("q_customer_sales_area", twin("""SELECT c.kunnr, c.name1, c.land1, s.vkorg, s.kdgrp, s.bzirk FROM kna1 c JOIN knvv s
    ON c.kunnr = s.kunnr WHERE s.vkorg = 'BR01'"""))
def q24(t: Tables):
    return D.customer_sales_area(t.raw("kna1"), t.raw("knvv"), "BR01")


@query("q_vendor_on_orders", twin("SELECT h.ebeln, h.bedat, v.lifnr, v.name1, v.land1 FROM ekko h JOIN lfa1 v ON h.lifnr = v.lifnr"))
def q25(t: Tables):
    return D.vendor_on_orders(t.raw("ekko"), t.raw("lfa1"))


_PO_HEADER = "SELECT *, CAST(try_strptime(bedat, '%Y%m%d') AS DATE) AS po_date FROM ekko"


_GOLD_PO_FACT = f"""SELECT i.ebeln AS purchase_order, i.ebelp AS purchase_order_item, h.lifnr AS supplier_id,
    s.name1 AS supplier_name, i.matnr AS material_id, m.maktx AS material_description, i.werks AS plant, h.ekorg AS purchasing_org,
    h.po_date AS order_date, CAST(year(h.po_date) AS BIGINT) AS order_year, CAST(month(h.po_date) AS BIGINT) AS order_month,
    CAST(i.menge AS DECIMAL(13,3)) AS quantity_ordered, i.meins AS unit_of_measure, CAST(i.netpr AS DECIMAL(11,2)) AS net_price,
    CAST(i.netwr AS DECIMAL(13,2)) AS net_value, h.waers AS currency FROM ekpo i LEFT JOIN ({_PO_HEADER}) h ON i.ebeln = h.ebeln
    LEFT JOIN lfa1 s ON h.lifnr = s.lifnr LEFT JOIN (SELECT * FROM makt WHERE spras = 'P') m ON i.matnr = m.matnr"""


@query("gold_po_fact", twin(_GOLD_PO_FACT))
def q26(t: Tables):
    return L.gold_po_fact(
        L.typed_item(t.raw("ekpo")), L.typed_header(t.raw("ekko")), t.raw("lfa1"),
        t.raw("makt").filter(F.col("spras") == "P"),
    )


@query("gold_po_fact_partitions", twin(f"SELECT *, TRUE AS has_update_time FROM ({_GOLD_PO_FACT})"))
def q26_table(t: Tables):
    """The fact as a table by order year and month: written with wrong prices in one year, which is then written again."""
    path = work_folder(t.spark, "po-fact")
    # Joined once for both writes.
    fact = materialize(q26(t), "po-fact-joined", "zstd")
    year = F.col("order_year") == 1997
    L.write_po_fact(fact.withColumn("net_price", F.when(year, -1).otherwise(F.col("net_price")).cast("decimal(11,2)")), path)
    L.write_po_fact(fact.filter(year), path)
    stored = L.read_po_fact(t.spark, path, fact.schema)
    return stored.withColumn("has_update_time", F.col("_updated_at").isNotNull()).drop("_updated_at")


@query("layout_space_filling", twin(_GOLD_PO_FACT))
def q26_layout(t: Tables):
    """The fact clustered by order date and plant: a filter on either one skips most files."""
    path = work_folder(t.spark, "po-fact-curve")
    fact = q26(t)
    curve_layout(fact, ["order_date", "plant"], 32).write.parquet(path)
    return t.spark.read.schema(fact.schema).parquet(path)
