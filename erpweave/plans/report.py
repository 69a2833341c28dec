"""Open and billed orders: one row per order item and whatever followed it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from erpweave.functions import hierarchy_level, is_blank, not_flag, quantity, sap_date, strip_leading_zeros
from erpweave.operators.dedupe import first_per_key
from erpweave.operators.joins import reduce_to_keys
from erpweave.operators.projection import tenant_filter

# Fixed values of the report's selection.
MANAGER, ASSISTANT, SHIP_TO = "ZG", "ZA", "WE"
HEADER_ITEM = "000000"
TRANSPORT_DOC = "J"

# Columns of the report in order.
REPORT_COLUMNS = (
    "nr_ordem nr_linha_ordem emissor_ordem receb_mercadoria receb_nome_fantasia ot nome_destinatario "
    "municipio_destinatario uf_destinatario centro_origem deposito_remessa deposito_venda itiner_ov transportadora "
    "data_emissao_nf data_faturamento dt_desej_entrega gc assistente_vendas linha familia grade item "
    "classificacao_produto quantidade_nf unidade_medida tp_carga_email obs_ov tipo_ordem condicao_entrega "
    "condicao_expedicao primeira_data primeira_data_desejada dt_referencia_template"
).split()
# Columns whose sources exist in no table here.
EMPTY_COLUMNS = {
    "tp_carga_email": "string", "obs_ov": "string", "primeira_data_desejada": "date", "dt_referencia_template": "date",
}


def _report_date(column: str):
    return sap_date(column, open_end="null")


def open_orders_report(
    table: Callable[[str], DataFrame], client: str = "100", language: str = "P", one_row_per_item: bool = False,
    stored: Callable[[DataFrame, str], DataFrame] = lambda df, _: df,
) -> DataFrame:
    """The 34-column report over raw tables, ``table(name)`` giving each of them.

    Optional documents are left-joined with their full fan-out: an item with two
    deliveries is two rows. ``one_row_per_item`` keeps the first combination only.
    What hangs on the order header is joined while there is one row per order, and what follows a delivery is joined among
    the narrow follow-on documents, where every row has its key. So the item rows, of which many have no
    delivery or invoice, never shuffle on a key that may be missing: they move once by order and item
    number and once by order number (and by material where that table is too large to broadcast).
    The lines of a fiscal note, which repeat every item of its invoice, travel as one array per note and become rows
    behind the last join; for ``one_row_per_item`` only the first of them is kept, null before the least quantity.

    ``stored(frame, label)`` gets the parts that are joined last and returns them to go on with. As tables, written one after
    the other with their shuffles freed in between (``erpweave.session.materialize``), they hold the disk to what the
    largest part moves; as they are, the whole report is one plan, which keeps what all its joins move until its end.
    """
    def raw(name: str) -> DataFrame:
        return tenant_filter(table(name), client)

    # Values are converted on their own table, before joins repeat its rows.
    header = raw("vbak").select(
        "vbeln", "kunnr", "vsbed", F.col("auart").alias("tipo_ordem"), _report_date("vdatu").alias("dt_desej_entrega")
    )
    item = raw("vbap").filter(F.col("fkrel").isNull() | (F.col("fkrel") != " ")).select(
        "vbeln", "posnr", "matnr", F.col("werks").alias("centro_origem"), F.col("lgort").alias("deposito_venda"),
        F.col("route").alias("itiner_ov"),
        F.col("matkl").alias("classificacao_produto"), F.col("vrkme").alias("unidade_medida"),
    )
    # ---- order header and masters ---------------------------------------------
    terms = raw("vbkd").filter(F.col("posnr") == HEADER_ITEM).select("vbeln", F.col("inco1").alias("condicao_entrega"))
    partners = raw("vbpa").select("vbeln", "parvw", "kunnr", "pernr")
    staff = raw("pa0001").filter(F.col("pernr") != "").select("pernr", "ename").distinct()

    def employee(role: str, name: str) -> DataFrame:
        named = partners.filter(F.col("parvw") == role).select("vbeln", "pernr")
        return named.join(staff, "pernr", "left").select("vbeln", F.col("ename").alias(name))

    customers = raw("kna1").select("kunnr", "name1", "ort01", "regio")
    sold_to = customers.withColumnsRenamed({"name1": "ag_name1", "ort01": "ag_ort01", "regio": "ag_regio"})
    ship_to = (
        partners.filter(F.col("parvw") == SHIP_TO).select("vbeln", F.col("kunnr").alias("we_kunnr"))
        .join(
            customers.withColumnsRenamed(
                {"kunnr": "we_kunnr", "name1": "we_name1", "ort01": "we_ort01", "regio": "we_regio"}
            ),
            "we_kunnr", "left",
        )
    )
    conditions = raw("tvsbt").filter((F.col("spras") == language) & (F.col("vsbed") != "")).select(
        "vsbed", F.col("vtext").alias("condicao_expedicao")
    )
    material = raw("mara").select(
        "matnr", F.col("bismt").alias("grade"), hierarchy_level("prdha", 1).alias("linha"),
        hierarchy_level("prdha", 2).alias("familia"),
    )
    schedule = first_per_key(
        raw("vbep").select("vbeln", "posnr", "etenr", "edatu"), ["vbeln", "posnr"], ["etenr"]
    ).select("vbeln", "posnr", _report_date("edatu").alias("primeira_data"))

    # ---- delivery, transport -------------------------------------------------
    delivery = raw("lips").select(
        F.col("vbeln").alias("d_vbeln"), F.col("posnr").alias("d_posnr"), F.col("vgbel").alias("vbeln"),
        F.col("vgpos").alias("posnr"), F.col("lgort").alias("deposito_remessa"),
    )
    # A transport or shipment counts only for deliveries that have a header.
    shipped = raw("likp").select("vbeln")
    transport = (
        reduce_to_keys(raw("vttp").select("vbeln", "tknum"), shipped, {"vbeln": "vbeln"})
        .join(raw("vttk").select("tknum", F.col("tdlnr").alias("lifnr")), "tknum", "left")
        .join(raw("lfa1").select("lifnr", F.col("name1").alias("transportadora")), "lifnr", "left")
        .select(F.col("vbeln").alias("d_vbeln"), "transportadora")
    )
    shipment = (
        raw("oigsi").filter(F.col("doc_typ") == TRANSPORT_DOC)
        .select(F.col("doc_number").alias("d_vbeln"), F.col("shnumber").alias("ot"))
    )
    # Header copies multiply the shipments, as the chain through the delivery header does.
    shipment = shipped.select(F.col("vbeln").alias("d_vbeln")).join(shipment, "d_vbeln", "left")

    # ---- billing, fiscal note ------------------------------------------------
    billed = reduce_to_keys(
        raw("vbrp").select("vbeln", "vgbel", "vgpos", "aubel", "aupos"),
        reduce_to_keys(item.select("vbeln", "posnr"), header.select("vbeln"), {"vbeln": "vbeln"}),
        {"aubel": "vbeln", "aupos": "posnr"},
    ).select(F.col("vgbel").alias("d_vbeln"), F.col("vgpos").alias("d_posnr"), F.col("vbeln").alias("i_vbeln"))
    invoice = raw("vbrk").filter(is_blank("sfakn") & not_flag("fksto")).select(
        "vbeln", _report_date("fkdat").alias("data_faturamento")
    )
    note = raw("j_1bnfdoc").select(
        "docnum", F.col("refkey").alias("vbeln"), _report_date("docdat").alias("data_emissao_nf")
    )
    line = raw("j_1bnflin").filter(F.col("docnum").isNotNull()).select("docnum", quantity("nfqtd").alias("quantidade_nf"))
    if one_row_per_item:
        known = F.count("quantidade_nf") == F.count(F.lit(1))
        quantities, lines = "quantidade_nf", F.when(known, F.min("quantidade_nf"))
    else:
        quantities, lines = "lines", F.collect_list(F.struct("quantidade_nf"))
    noted = (
        invoice.join(note, "vbeln", "left").join(line.groupBy("docnum").agg(lines.alias(quantities)), "docnum", "left")
        .select(F.col("vbeln").alias("i_vbeln"), "data_faturamento", "data_emissao_nf", quantities)
    )
    # What follows an order item, from its deliveries on; every key on the left side is there.
    billed = stored(billed.join(noted, "i_vbeln", "left").drop("i_vbeln"), "billed")
    chain = (
        delivery.join(billed, ["d_vbeln", "d_posnr"], "left")
        .join(transport, "d_vbeln", "left")
        .join(shipment, "d_vbeln", "left")
        .drop("d_vbeln", "d_posnr")
    )
    chain = stored(chain, "chain")

    name = F.coalesce("we_name1", "ag_name1")
    headed = (
        header.join(sold_to, "kunnr", "left")
        .join(conditions, "vsbed", "left")
        .join(terms, "vbeln", "left")
        .join(ship_to, "vbeln", "left")
        .join(employee(MANAGER, "gc"), "vbeln", "left")
        .join(employee(ASSISTANT, "assistente_vendas"), "vbeln", "left")
        .withColumns(
            {
                "receb_mercadoria": F.coalesce("we_kunnr", "kunnr"),
                "receb_nome_fantasia": name,
                "nome_destinatario": name,
                "municipio_destinatario": F.coalesce("we_ort01", "ag_ort01"),
                "uf_destinatario": F.coalesce("we_regio", "ag_regio"),
            }
        )
    )
    described = item.join(material, "matnr", "left").withColumn("item", strip_leading_zeros("matnr")).drop("matnr")
    planned = stored(described.join(schedule, ["vbeln", "posnr"], "left"), "planned")
    followed = stored(planned.join(chain, ["vbeln", "posnr"], "left"), "followed").join(stored(headed, "headed"), "vbeln")
    if not one_row_per_item:
        followed = followed.select(*[c for c in followed.columns if c != "lines"], F.inline_outer("lines"))
    renamed = {"vbeln": "nr_ordem", "posnr": "nr_linha_ordem", "kunnr": "emissor_ordem"}
    report = followed.withColumnsRenamed(renamed).withColumns(
        {column: F.lit(None).cast(kind) for column, kind in EMPTY_COLUMNS.items()}
    ).select(*REPORT_COLUMNS)
    if one_row_per_item:
        return first_per_key(report, ["nr_ordem", "nr_linha_ordem"], [])
    return report
