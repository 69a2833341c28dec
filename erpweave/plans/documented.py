"""Analyst queries over raw document tables, one function per question.

Every function takes raw frames by keyword and a client; dates are eight-digit text, so
range filters compare text and reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from erpweave.functions import guarded_ratio, is_blank, object_key
from erpweave.operators.joins import fiscal_join, lookup
from erpweave.operators.projection import tenant_filter

# Movement types.
RECEIPT_FOR_ORDER, ISSUE_TO_PRODUCTION, ISSUE_TO_DELIVERY = "101", "261", "601"


def _of_client(df: DataFrame, client: str) -> DataFrame:
    return tenant_filter(df, client)


def po_header_item(ekko: DataFrame, ekpo: DataFrame, since: str, client: str = "100") -> DataFrame:
    header = _of_client(ekko, client).filter(F.col("aedat") >= since).select("mandt", "ebeln", "lifnr")
    item = ekpo.select("mandt", "ebeln", "matnr", "menge", "netpr")
    return item.join(header, ["mandt", "ebeln"]).drop("mandt")


def open_purchase_orders(ekko: DataFrame, ekpo: DataFrame, since: str, client: str = "100") -> DataFrame:
    """Standard orders since a date whose item still awaits deliveries."""
    header = _of_client(ekko, client).filter((F.col("bstyp") == "F") & (F.col("bedat") >= since))
    item = ekpo.filter(is_blank("elikz")).select("mandt", "ebeln", "ebelp", "matnr", "menge", "netpr", "netwr")
    return header.select("mandt", "ebeln", "lifnr", "bedat").join(item, ["mandt", "ebeln"]).drop("mandt")


def goods_receipts(mseg: DataFrame, mkpf: DataFrame, low: str, high: str, client: str = "100") -> DataFrame:
    """Receipts against purchase orders posted in a period."""
    header = mkpf.filter(F.col("budat").between(low, high)).select("mandt", "mblnr", "mjahr", "budat")
    item = _of_client(mseg, client).filter(F.col("bwart") == RECEIPT_FOR_ORDER).select(
        "mandt", "mblnr", "mjahr", "matnr", "werks", "lgort", "menge", "dmbtr", "ebeln", "ebelp"
    )
    return item.join(header, ["mandt", "mblnr", "mjahr"]).drop("mandt")


def procure_to_pay_trace(
    ekko: DataFrame, ekpo: DataFrame, mseg: DataFrame, rseg: DataFrame, rbkp: DataFrame, since: str,
    client: str = "100",
) -> DataFrame:
    """Order item, its receipts and its invoices; missing steps stay NULL."""
    header = _of_client(ekko, client).filter(F.col("bedat") >= since).select("mandt", "ebeln", "lifnr")
    item = ekpo.select("mandt", "ebeln", "ebelp", "matnr", F.col("menge").alias("qtd_pedida"))
    receipt = mseg.filter(F.col("bwart") == RECEIPT_FOR_ORDER).select(
        "mandt", "ebeln", "ebelp", F.col("menge").alias("qtd_recebida"), F.col("dmbtr").alias("valor_recebido")
    )
    invoice = rseg.select("mandt", "ebeln", "ebelp", "belnr", "gjahr").join(
        rbkp.select("mandt", "belnr", "gjahr", F.col("belnr").alias("nr_fatura"), F.col("rmwwr").alias("valor_fatura")),
        ["mandt", "belnr", "gjahr"], "left",
    ).drop("belnr", "gjahr")
    keys = ["mandt", "ebeln", "ebelp"]
    return (
        item.join(header, ["mandt", "ebeln"]).join(receipt, keys, "left").join(invoice, keys, "left")
        .select(
            F.col("ebeln").alias("nr_po"), F.col("lifnr").alias("fornecedor"), F.col("matnr").alias("material"),
            "qtd_pedida", "qtd_recebida", "valor_recebido", "nr_fatura", "valor_fatura",
        )
    )


def order_to_billing_trace(
    vbak: DataFrame, vbap: DataFrame, lips: DataFrame, likp: DataFrame, vbrp: DataFrame, vbrk: DataFrame, since: str,
    client: str = "100", by_item: bool = False,
) -> DataFrame:
    """Order items through delivery to billing. Billing items meet the delivery at header
    level, as documented, so an invoice item shows for every item of its delivery: items times invoice items.
    ``by_item`` follows the item numbers instead, so rows grow with the lines of a document."""
    order = _of_client(vbak, client).filter(F.col("audat") >= since).select("mandt", "vbeln", "kunnr")
    item = vbap.select("mandt", "vbeln", "posnr", "matnr", F.col("kwmeng").alias("qtd_pedida"))
    delivery = lips.select(
        "mandt", F.col("vbeln").alias("d_vbeln"), F.col("posnr").alias("d_posnr"), F.col("vgbel").alias("vbeln"),
        F.col("vgpos").alias("posnr"), F.col("lfimg").alias("qtd_entregue"),
    )
    head = likp.select("mandt", F.col("vbeln").alias("d_vbeln"))
    preceding = {"vgbel": "d_vbeln", "vgpos": "d_posnr"} if by_item else {"vgbel": "d_vbeln"}
    bill_item = vbrp.select("mandt", *[F.col(c).alias(n) for c, n in preceding.items()], F.col("vbeln").alias("nr_billing"))
    bill = vbrk.select(
        "mandt", F.col("vbeln").alias("nr_billing"), F.col("fkdat").alias("data_fatura"),
        F.col("netwr").alias("valor_faturado"),
    )
    return (
        item.join(order, ["mandt", "vbeln"]).join(delivery, ["mandt", "vbeln", "posnr"])
        .join(head, ["mandt", "d_vbeln"]).join(bill_item, ["mandt", *preceding.values()])
        .join(bill, ["mandt", "nr_billing"])
        .select(
            F.col("vbeln").alias("nr_so"), F.col("kunnr").alias("cliente"), F.col("matnr").alias("material"),
            "qtd_pedida", "qtd_entregue", "nr_billing", "data_fatura", "valor_faturado",
        )
    )


def open_payables(items: DataFrame, bkpf: DataFrame, company: str, since: str, client: str = "100") -> DataFrame:
    """Open vendor items of a company with an accounting header."""
    header = _of_client(bkpf, client).filter((F.col("bukrs") == company) & (F.col("budat") >= since))
    header = header.select("mandt", "bukrs", "belnr", "gjahr", "bldat")
    lines = items.filter((F.col("koart") == "K") & is_blank("augdt")).select(
        "mandt", "bukrs", "belnr", "gjahr", "lifnr", "dmbtr", "shkzg"
    )
    return fiscal_join(lines, header, tenant="mandt").drop("mandt")


def production_balance(aufk: DataFrame, afpo: DataFrame, plant: str, since: str, client: str = "100") -> DataFrame:
    """Production orders of a plant with planned, received and pending quantity."""
    order = _of_client(aufk, client).filter(
        (F.col("werks") == plant) & (F.col("erdat") >= since) & F.col("auart").isin("PP01", "PP02")
    )
    item = afpo.select(
        "mandt", "aufnr", "matnr", F.col("psmng").cast("decimal(17,3)").alias("qtd_planejada"),
        F.col("wemng").cast("decimal(17,3)").alias("qtd_recebida"),
    )
    joined = item.join(order.select("mandt", "aufnr", "werks", "erdat", "gstrp", "gltrp"), ["mandt", "aufnr"])
    pending = (F.col("qtd_planejada") - F.col("qtd_recebida")).cast("decimal(17,3)")
    return joined.withColumn("saldo_pendente", pending).drop("mandt")


def fi_document_lines(bkpf: DataFrame, bseg: DataFrame, company: str, year: str, client: str = "100") -> DataFrame:
    header = _of_client(bkpf, client).filter((F.col("bukrs") == company) & (F.col("gjahr") == year))
    lines = bseg.select("mandt", "bukrs", "belnr", "gjahr", "saknr", "dmbtr", "shkzg")
    return fiscal_join(header.select("mandt", "bukrs", "belnr", "gjahr", "budat"), lines, tenant="mandt").drop("mandt")


def production_cost(
    afpo: DataFrame, mseg: DataFrame, mkpf: DataFrame, bkpf: DataFrame, low: str, high: str, plant: str | None = None,
    client: str = "100",
) -> DataFrame:
    """Components issued to production orders with the accounting document they posted."""
    order = _of_client(afpo, client)
    if plant is not None:
        order = order.filter(F.col("werks") == plant)
    order = order.select("mandt", "aufnr", F.col("matnr").alias("produto_acabado"), F.col("werks").alias("planta"))
    issue = mseg.filter(F.col("bwart") == ISSUE_TO_PRODUCTION).select(
        "mandt", "aufnr", "mblnr", "mjahr", F.col("matnr").alias("componente"), F.col("menge").alias("qtd_consumida"),
        F.col("dmbtr").alias("valor_consumo"),
    )
    posting = (
        mkpf.filter(F.col("budat").between(low, high))
        .select("mandt", "mblnr", "mjahr", object_key("mblnr", "mjahr").alias("awkey"))
        .join(
            bkpf.filter(F.col("awtyp") == "MKPF").select(
                "mandt", "awkey", F.col("belnr").alias("doc_fi"), F.col("budat").alias("data_lancamento")
            ),
            ["mandt", "awkey"],
        )
        .drop("awkey")
    )
    return (
        issue.join(posting, ["mandt", "mblnr", "mjahr"]).join(order, ["mandt", "aufnr"])
        .select(
            F.col("aufnr").alias("nr_ordem"), "produto_acabado", "planta", "componente", "qtd_consumida",
            "valor_consumo", "doc_fi", "data_lancamento",
        )
    )


def order_profitability(
    vbak: DataFrame, vbap: DataFrame, vbrp: DataFrame, vbrk: DataFrame, mseg: DataFrame, since: str,
    client: str = "100", posted: str = "C", by_item: bool = False,
) -> DataFrame:
    """Revenue of an order item against the cost of the goods issued for its invoice.

    As documented, every cost line of an invoice shows for every item of it: items times lines. With ``by_item`` the
    lines are added up per invoice item first, so an item has one cost. Only invoices in posting status ``posted`` count: those accounting has taken over.
    """
    order = _of_client(vbak, client).select("mandt", "vbeln", "kunnr")
    item = vbap.select("mandt", "vbeln", "posnr", "matnr", F.col("kwmeng").alias("qtd_pedida"))
    bill_item = vbrp.select(
        "mandt", F.col("vbeln").alias("b_vbeln"), F.col("posnr").alias("b_posnr"), F.col("aubel").alias("vbeln"),
        F.col("aupos").alias("posnr"),
    )
    bill = vbrk.filter((F.col("fkdat") >= since) & (F.col("rfbsk") == posted)).select(
        "mandt", F.col("vbeln").alias("b_vbeln"), F.col("netwr").alias("receita_bruta"),
        F.col("fkdat").alias("data_faturamento"),
    )
    issued = mseg.filter(F.col("bwart") == ISSUE_TO_DELIVERY)
    invoice = ["mandt", "b_vbeln"]
    if by_item:
        invoice.append("b_posnr")
        issued = issued.groupBy("mandt", "vbeln", "posnr").agg(
            F.sum(F.abs("dmbtr").cast("decimal(17,2)")).cast("decimal(17,2)").alias("dmbtr")
        )
    numbers = {"b_vbeln": "vbeln", "b_posnr": "posnr"}
    cost = issued.select(
        "mandt", *[F.col(numbers[n]).alias(n) for n in invoice[1:]], F.abs("dmbtr").alias("custo_mercadoria")
    )
    return (
        item.join(order, ["mandt", "vbeln"]).join(bill_item, ["mandt", "vbeln", "posnr"])
        .join(bill, ["mandt", "b_vbeln"]).join(cost, invoice)
        .select(
            F.col("vbeln").alias("nr_so"), F.col("kunnr").alias("cliente"), F.col("matnr").alias("material"),
            "qtd_pedida", "receita_bruta", "data_faturamento", "custo_mercadoria",
        )
    )


def document_by_object_key(bkpf: DataFrame, origin: str, key: str, client: str = "100") -> DataFrame:
    found = _of_client(bkpf, client).filter((F.col("awtyp") == origin) & (F.col("awkey") == key))
    return found.select("belnr", "gjahr", "budat", "blart")


def failed_messages(control: DataFrame, status: DataFrame, code: str, since: str, client: str = "100") -> DataFrame:
    """Documents in an error status, with their direction, the text of that status and its message qualifier, newest first."""
    failed = _of_client(control, client).filter((F.col("status") == code) & (F.col("credat") >= since))
    return (
        failed.select("mandt", "docnum", "mestyp", "direct", "status", "credat")
        .join(status.select("mandt", "docnum", "statxt", "stamqu"), ["mandt", "docnum"])
        .drop("mandt")
        .orderBy(F.desc("credat"), "docnum", "statxt", "stamqu")
    )


def split_by_clearing(items: DataFrame) -> DataFrame:
    """All items with ``state``, open or cleared, whatever their account type.

    Written partitioned by (koart, state) this is the split into one set per type and state.
    """
    return items.withColumn("state", F.when(is_blank("augdt"), "open").otherwise("cleared"))


def flat_po_extract(
    ekko: DataFrame, ekpo: DataFrame, makt: DataFrame, lfa1: DataFrame, company: str, dates: Column, plants: Column,
    language: str = "P", client: str = "100",
) -> DataFrame:
    """Flat purchase order extract with material text and vendor name looked up."""
    header = _of_client(ekko, client).filter((F.col("bukrs") == company) & (F.col("bstyp") == "F") & dates)
    item = ekpo.filter(is_blank("loekz") & plants).select(
        "mandt", "ebeln", "ebelp", "matnr", "menge", "netpr", "netwr"
    )
    orders = item.join(header.select("mandt", "ebeln", "lifnr", "bedat"), ["mandt", "ebeln"]).drop("mandt")
    texts = _of_client(makt, client).filter(F.col("spras") == language).select("matnr", "maktx")
    vendors = _of_client(lfa1, client).select("lifnr", "name1")
    flat = lookup(lookup(orders, texts, ["matnr"]), vendors, ["lifnr"])
    return flat.select("ebeln", "lifnr", "bedat", "ebelp", "matnr", "menge", "netpr", "netwr", "maktx", "name1")


def journal_slice(
    journal: DataFrame, company: str, year: str, low: str, high: str, kinds: list[str], ledger: str = "0L"
) -> DataFrame:
    """Postings of one ledger, company and year by date and kind, with cost and profit centre, group amount and quantity."""
    return journal.filter(
        (F.col("rldnr") == ledger) & (F.col("bukrs") == company) & (F.col("gjahr") == year) & F.col("budat").between(low, high)
        & F.col("blart").isin(kinds)
    ).select(
        "rldnr", "bukrs", "gjahr", "belnr", "budat", "blart", "buzei", "saknr", "rcostcenter", "rprctr", "amount", "group_amount", "menge"
    )


def journal_balance(journal: DataFrame, company: str, year: str, account: str, ledger: str = "0L") -> DataFrame:
    rows = journal.filter((F.col("rldnr") == ledger) & (F.col("bukrs") == company) & (F.col("gjahr") == year) & (F.col("saknr") == account))
    return rows.agg(F.sum("amount").cast("decimal(27,2)").alias("balance"))


def material_movements(
    mseg: DataFrame, plant: str, movement: str, low: str, high: str, client: str = "100"
) -> DataFrame:
    return _of_client(mseg, client).filter(
        (F.col("werks") == plant) & (F.col("bwart") == movement) & F.col("budat").between(low, high)
    ).select("mblnr", "mjahr", "zeile", "budat", "bwart", "matnr", "werks", "lgort", "menge", "meins", "dmbtr")


def critical_stock(stock: DataFrame, planning: DataFrame, client: str, plant: str, percent: float) -> DataFrame:
    """Stock lines of a client's plant at or below a percentage of the reorder point, worst first."""
    here = (F.col("mandt") == client) & (F.col("werks") == plant)
    minimum = planning.filter(here & (F.col("minbe") > 0)).select("mandt", "matnr", "werks", "minbe")
    lines = stock.filter(here).join(minimum, ["mandt", "matnr", "werks"])
    share = guarded_ratio(F.col("labst").cast("decimal(17,3)"), "minbe").cast("decimal(17,4)")
    return (
        lines.select(
            "matnr", "werks", "lgort", F.col("labst").alias("estoque_disponivel"),
            F.col("minbe").alias("estoque_minimo"), share.alias("perc_do_minimo"),
        )
        .filter(F.col("perc_do_minimo") <= percent)
        .orderBy("perc_do_minimo", "matnr", "lgort")
    )


def register_critical_stock(stock: DataFrame, planning: DataFrame, name: str = "critical_stock") -> str:
    """Publish ``name(client, plant, percent)`` as a SQL table function over two frames."""
    spark = stock.sparkSession
    stock.createOrReplaceTempView(f"{name}_stock")
    planning.createOrReplaceTempView(f"{name}_planning")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(client STRING, plant STRING, percent DOUBLE)
        RETURNS TABLE (matnr STRING, werks STRING, lgort STRING, estoque_disponivel DOUBLE, estoque_minimo DECIMAL(17,3),
                       perc_do_minimo DECIMAL(17,4))
        RETURN SELECT matnr, werks, lgort, labst, minbe, share
               FROM (SELECT *, CAST(round(labst / CAST(minbe AS DOUBLE) * 100, 4) AS DECIMAL(17,4)) AS share
                     FROM {name}_stock JOIN {name}_planning USING (mandt, matnr, werks)
                     WHERE mandt = {name}.client AND werks = {name}.plant AND minbe > 0)
               WHERE share <= {name}.percent ORDER BY share, matnr, lgort
    """)
    return name


def material_stock(
    mara: DataFrame, marc: DataFrame, makt: DataFrame, mard: DataFrame, material_type: str, language: str = "P"
) -> DataFrame:
    """Materials of a type with their plants and text, and the stock where there is any."""
    texts = makt.filter(F.col("spras") == language).select("matnr", "maktx")
    return (
        marc.select("matnr", "werks")
        .join(mara.filter(F.col("mtart") == material_type).select("matnr", "mtart", "matkl"), "matnr")
        .join(texts, "matnr")
        .join(mard.select("matnr", "werks", "lgort", "labst"), ["matnr", "werks"], "left")
    )


def material_valuation(mara: DataFrame, mbew: DataFrame, area: str) -> DataFrame:
    prices = mbew.filter(F.col("bwkey") == area).select("matnr", "verpr", "stprs", "vprsv")
    return mara.select("matnr").join(prices, "matnr")


def po_received_by_item(ekko: DataFrame, ekpo: DataFrame, ekbe: DataFrame, order_type: str) -> DataFrame:
    """Received quantity and invoiced value per item, zero where nothing happened.

    The history is totalled per item first; joined raw it would repeat the item per entry.
    """
    history = ekbe.filter(F.col("vgabe").isin("1", "2")).groupBy("ebeln", "ebelp").agg(
        F.sum(F.when(F.col("vgabe") == "1", F.col("menge").cast("decimal(17,3)"))).alias("received"),
        F.sum(F.when(F.col("vgabe") == "2", F.col("wrbtr").cast("decimal(17,2)"))).alias("invoiced"),
    )
    header = ekko.filter(F.col("bsart") == order_type).select("ebeln", "lifnr")
    item = ekpo.filter(is_blank("loekz")).select("ebeln", "ebelp", "matnr", F.col("menge").alias("qty_ordered"))
    return item.join(header, "ebeln").join(history, ["ebeln", "ebelp"], "left").select(
        "ebeln", "lifnr", "ebelp", "matnr", "qty_ordered",
        F.coalesce("received", F.lit(0)).cast("decimal(17,3)").alias("qty_received"),
        F.coalesce("invoiced", F.lit(0)).cast("decimal(17,2)").alias("value_invoiced"),
    )


def fi_with_account_text(
    bkpf: DataFrame, bseg: DataFrame, ska1: DataFrame, company: str, year: str, account_type: str
) -> DataFrame:
    header = bkpf.filter((F.col("bukrs") == company) & (F.col("gjahr") == year)).select(
        "bukrs", "belnr", "gjahr", "budat", "blart"
    )
    lines = bseg.filter(F.col("koart") == account_type).select(
        "bukrs", "belnr", "gjahr", "buzei", "saknr", "dmbtr", "shkzg"
    )
    return (
        fiscal_join(lines, header).join(ska1.select("saknr", F.col("txt50").alias("account_desc")), "saknr", "left")
        .drop("bukrs", "gjahr")
    )


def customer_sales_area(kna1: DataFrame, knvv: DataFrame, sales_org: str) -> DataFrame:
    areas = knvv.filter(F.col("vkorg") == sales_org).select("kunnr", "vkorg", "kdgrp", "bzirk")
    return areas.join(kna1.select("kunnr", "name1", "land1"), "kunnr")


def vendor_on_orders(ekko: DataFrame, lfa1: DataFrame) -> DataFrame:
    return ekko.select("ebeln", "bedat", "lifnr").join(lfa1.select("lifnr", "name1", "land1"), "lifnr")
