"""Dimensions and facts over typed tables.

Joins follow the documents' own references. Grains are not enforced: a repeated header
repeats its items, as the raw data says; ``grain_violations`` reports such keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from erpweave.operators.aggregates import event_totals
from erpweave.operators.dedupe import distinct_dimension
from erpweave.operators.joins import enrich, header_items

# History event types of a purchase order item.
GOODS_RECEIPT, INVOICE_RECEIPT = "1", "2"


def dim_customer(kna1: DataFrame) -> DataFrame:
    return distinct_dimension(
        kna1, ["kunnr", "customer_name", "mcod1", "cnpj_cpf", "account_group", "city", "state", "country"]
    )


def dim_vendor(lfa1: DataFrame) -> DataFrame:
    return distinct_dimension(lfa1, ["lifnr", "vendor_name", "mcod1", "cnpj_cpf", "city", "state", "country"])


def dim_material(mara: DataFrame, makt: DataFrame) -> DataFrame:
    return enrich(
        mara.select(
            "matnr", "material_group", "base_uom", "product_hierarchy", "net_weight", "gross_weight"
        ),
        makt,
        ["matnr"],
    )


def fact_sales_order(vbap: DataFrame, vbak: DataFrame) -> DataFrame:
    header = vbak.select(
        "vbeln", "kunnr", "order_date", "order_type", "sales_org", "distribution_channel", "division",
        "overall_status",
    )
    item = vbap.select(
        "vbeln", "posnr", "matnr", "werks", "base_uom", "order_qty", F.col("net_value").alias("item_net_value"),
        "currency", "billing_status", "delivery_status",
    )
    return header_items(item, header, ["vbeln"])


def order_values(vbap: DataFrame, vbak: DataFrame) -> DataFrame:
    """Order value per order and currency, with the header attributes of the sales fact.

    The items are summed before they meet the header: one row per order and currency is
    shuffled, however many items an order has.
    """
    value = vbap.groupBy("vbeln", "currency").agg(F.sum("net_value").alias("item_net_value"))
    header = vbak.select("vbeln", "kunnr", "order_date", "order_type", "sales_org", "overall_status")
    return header_items(value, header, ["vbeln"])


def fact_billing(vbrp: DataFrame, vbrk: DataFrame) -> DataFrame:
    """Items of invoices that are not cancelled."""
    header = vbrk.filter(~F.col("cancelled_flag")).select(
        "vbeln", F.col("payer_customer").alias("kunnr"), "billing_date", "billing_type",
        F.col("tax_amount").alias("doc_tax"),
    )
    item = vbrp.select(
        "vbeln", "posnr", "currency", "matnr", "base_uom", "billed_qty",
        F.col("net_value").alias("item_net_value"), "item_tax",
        F.col("ref_doc_number").alias("source_delivery"), F.col("source_order_no").alias("source_order"),
    )
    return header_items(item, header, ["vbeln"])


def fact_delivery(lips: DataFrame, likp: DataFrame) -> DataFrame:
    header = likp.select("vbeln", "kunnr", "planned_delivery_date", "actual_goods_issue_date")
    item = lips.select(
        "vbeln", "posnr", "matnr", "base_uom", "delivered_qty",
        F.col("ref_doc_number").alias("source_order"), F.col("ref_item_number").alias("source_order_item"),
    )
    return header_items(item, header, ["vbeln"])


def fact_purchase_order(ekpo: DataFrame, ekko: DataFrame, ekbe: DataFrame) -> DataFrame:
    """Order items with received quantity and invoiced amount, zero where nothing happened."""
    history = event_totals(
        ekbe,
        ["ebeln", "ebelp"],
        "event_type",
        {
            "qty_received": (GOODS_RECEIPT, "qty", "decimal(17,3)"),
            "amount_invoiced": (INVOICE_RECEIPT, "amount", "decimal(17,2)"),
        },
    )
    header = ekko.select("ebeln", "lifnr", "company_code", "po_date", F.col("doc_type").alias("po_type"))
    item = ekpo.select("ebeln", "ebelp", "matnr", "base_uom", "qty_ordered", "net_price")
    return (
        header_items(item, header, ["ebeln"])
        .join(history, ["ebeln", "ebelp"], "left")
        .withColumns(
            {
                "qty_received": F.coalesce("qty_received", F.lit(0)).cast("decimal(17,3)"),
                "amount_invoiced": F.coalesce("amount_invoiced", F.lit(0)).cast("decimal(17,2)"),
            }
        )
    )


def fact_fiscal_note(doc: DataFrame, line: DataFrame, tax: DataFrame) -> DataFrame:
    """Note lines with their taxes; a line without tax stays, a line with n taxes is n rows."""
    header = doc.select("docnum", "company_code", "nf_number", "bupla", "serie", "direct", "doc_date")
    item = line.select("docnum", "nf_item_no", "matnr", "cfop", "nf_qty", "nf_value")
    return header_items(item, header, ["docnum"]).join(tax, ["docnum", "nf_item_no"], "left")
