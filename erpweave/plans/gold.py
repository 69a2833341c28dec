"""Key figures over facts and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from erpweave.functions import days_between, month_start
from erpweave.operators.aggregates import first_milestone, sums_and_distincts


def revenue_by_customer_month(billing: DataFrame, customer: DataFrame) -> DataFrame:
    """Billed revenue and tax per customer, month and currency.

    The fact is aggregated before it meets the dimension, so the join carries one row per
    customer and month instead of one per invoice item. A customer that the dimension
    lists several times under one name multiplies the sums, as joining first would.
    """
    monthly = sums_and_distincts(
        billing.withColumn("billing_month", month_start("billing_date")), ["kunnr", "billing_month", "currency"],
        {"_revenue": "item_net_value", "_tax": "item_tax"}, ("invoice_count", "vbeln"), ("distinct_materials", "matnr"))
    names = customer.groupBy("kunnr", "customer_name", "state").agg(F.count(F.lit(1)).alias("_copies"))
    copies = F.coalesce("_copies", F.lit(1))
    return monthly.join(names, "kunnr", "left").select(
        "kunnr", "customer_name", "state", "billing_month", "currency",
        (F.col("_revenue") * copies).cast("decimal(17,2)").alias("total_net_revenue"),
        (F.col("_tax") * copies).cast("decimal(17,2)").alias("total_tax"),
        "invoice_count", "distinct_materials",
    )


def order_to_cash(sales: DataFrame, delivery: DataFrame, billing: DataFrame) -> DataFrame:
    """Per order: value, first goods issue, first billing and the days to each.

    ``sales`` is the stored sales fact or, straight from typed tables, ``order_values``.
    """
    orders = sales.groupBy("vbeln", "kunnr", "order_date", "order_type", "sales_org", "currency").agg(
        F.sum("item_net_value").cast("decimal(17,2)").alias("order_net_value"),
        # A header attribute: every row of an order has the same one, min makes it repeatable.
        F.min("overall_status").alias("overall_status"),
    )
    issue = first_milestone(delivery, ["source_order"], "actual_goods_issue_date", "first_goods_issue_date")
    bill = first_milestone(billing, ["source_order"], "billing_date", "first_billing_date")
    return (
        orders.join(issue.withColumnRenamed("source_order", "vbeln"), "vbeln", "left")
        .join(bill.withColumnRenamed("source_order", "vbeln"), "vbeln", "left")
        .withColumns(
            {
                "days_to_delivery": days_between("order_date", "first_goods_issue_date"),
                "days_to_billing": days_between("order_date", "first_billing_date"),
            }
        )
    )


def purchase_spend_by_vendor(orders: DataFrame, vendor: DataFrame, by_currency: bool = False) -> DataFrame:
    """Invoiced amount and quantities per vendor, month and company.

    Aggregated before the vendor join, as in ``revenue_by_customer_month``. ``by_currency``
    keeps currencies apart when the fact carries a currency column.
    """
    sums = {
        "total_invoiced": ("amount_invoiced", "decimal(17,2)"),
        "total_qty_ordered": ("qty_ordered", "decimal(17,3)"),
        "total_qty_received": ("qty_received", "decimal(17,3)"),
    }
    monthly = sums_and_distincts(
        orders.withColumn("po_month", month_start("po_date")),
        ["lifnr", "po_month", "company_code", *(["currency"] if by_currency else [])],
        {name: column for name, (column, _) in sums.items()}, ("po_count", "ebeln"), ("distinct_materials", "matnr"))
    names = vendor.groupBy("lifnr", "vendor_name", "country").agg(F.count(F.lit(1)).alias("_copies"))
    copies = F.coalesce("_copies", F.lit(1))
    return (
        monthly.join(names, "lifnr", "left")
        .withColumns({name: (F.col(name) * copies).cast(kind) for name, (_, kind) in sums.items()})
        .drop("_copies")
    )


def tax_summary(notes: DataFrame) -> DataFrame:
    """Outbound tax per company, month and type. The rate is the plain average of lines and
    the note value repeats per tax line, as the tax report defines them."""
    return (
        notes.filter(F.col("direct") == "O")
        .groupBy("company_code", month_start("doc_date").alias("tax_month"), "tax_type")
        .agg(
            F.sum("tax_value").cast("decimal(17,2)").alias("total_tax_value"),
            F.avg("tax_rate").cast("decimal(7,4)").alias("avg_tax_rate"),
            F.count_distinct("docnum").alias("nf_document_count"),
            F.sum("nf_value").cast("decimal(17,2)").alias("total_nf_value"),
        )
    )


def weighted_tax_rate(notes: DataFrame) -> DataFrame:
    """Tax per company and type with the value-weighted rate."""
    return (
        notes.filter(F.col("direct") == "O")
        .groupBy("company_code", "tax_type")
        .agg(
            F.sum("tax_value").cast("decimal(17,2)").alias("total_tax_value"),
            F.sum("nf_value").cast("decimal(17,2)").alias("taxed_value"),
        )
        .withColumn(
            "weighted_rate",
            F.try_divide(F.col("total_tax_value") * 100, F.col("taxed_value")).cast("decimal(17,4)"),
        )
    )
