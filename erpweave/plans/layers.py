"""The layered refresh: landed files, raw streams, typed streams, facts, key figures."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from erpweave.operators.projection import with_processing_time
from erpweave.plans import domain, gold
from erpweave.plans.report import open_orders_report
from erpweave.plans.silver import SILVER, silver_table
from erpweave.sources.discovery import SYSTEM
from erpweave.sources.tables import write_run
from erpweave.streaming.ingest import append_tables, ingest_evolving


def silver_layer(
    spark: SparkSession, bronze: Mapping[str, DataFrame], store: str, client: str = "100",
    hints: Mapping[str, StructType] | None = None, opened: Callable[[str], DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Typed tables, fed incrementally from the raw tables below ``<store>/bronze``, or from the streams that ``opened`` gives by name.

    With ``hints``, the raw tables are evolving ones, which hold all fields without a hint as text. What each rule let pass and dropped is appended to ``<store>/metrics/silver``, batch by batch.
    """
    def stored(name: str) -> StructType:
        schema = bronze[name].schema
        if hints is None:
            return schema
        kept = {*hints[name].names, *SYSTEM}
        return StructType([f if f.name in kept else StructField(f.name, StringType()) for f in schema.fields])

    def raw(name: str) -> DataFrame:
        return opened(name) if opened else spark.readStream.schema(stored(name)).parquet(f"{store}/bronze/{name}")

    streams = {name: silver_table(raw(name), name, client, name) for name in SILVER}
    return append_tables(streams, f"{store}/silver", f"{store}/checkpoints/silver", metrics=f"{store}/metrics/silver")


def domain_layer(silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Dimensions and facts, computed from the whole typed tables."""
    return {
        "dim_customer": domain.dim_customer(silver["kna1"]),
        "dim_vendor": domain.dim_vendor(silver["lfa1"]),
        "dim_material": domain.dim_material(silver["mara"], silver["makt"]),
        "fact_sales_order": domain.fact_sales_order(silver["vbap"], silver["vbak"]),
        "fact_billing": domain.fact_billing(silver["vbrp"], silver["vbrk"]),
        "fact_delivery": domain.fact_delivery(silver["lips"], silver["likp"]),
        "fact_purchase_order": domain.fact_purchase_order(silver["ekpo"], silver["ekko"], silver["ekbe"]),
        "fact_nota_fiscal": domain.fact_fiscal_note(
            silver["j_1bnfdoc"], silver["j_1bnflin"], silver["j_1bnfstx"]
        ),
    }


def gold_layer(
    facts: Mapping[str, DataFrame], raw: Callable[[str], DataFrame], client: str = "100"
) -> dict[str, DataFrame]:
    """Key figures over facts, and the order report over raw tables."""
    return {
        "kpi_revenue_by_customer_month": gold.revenue_by_customer_month(
            facts["fact_billing"], facts["dim_customer"]
        ),
        "kpi_order_to_cash": gold.order_to_cash(
            facts["fact_sales_order"], facts["fact_delivery"], facts["fact_billing"]
        ),
        "kpi_purchase_spend_by_vendor": gold.purchase_spend_by_vendor(
            facts["fact_purchase_order"], facts["dim_vendor"]
        ),
        "kpi_nota_fiscal_tax_summary": gold.tax_summary(facts["fact_nota_fiscal"]),
        "open_orders_report": open_orders_report(raw, client),
    }


def refresh(
    spark: SparkSession, landing: str, store: str, schemas: Mapping[str, StructType], client: str = "100"
) -> dict[str, DataFrame]:
    """Bring every layer up to date with the landed files.

    Raw and typed tables read only new files; a field that ``schemas`` does not have becomes a column of its raw table
    when it is first landed. Facts and key figures are rebuilt, each layer from the stored one below it, as a
    run beside the one readers may have open. Returns the key figures.
    """
    bronze = ingest_evolving(
        spark, landing, f"{store}/bronze", f"{store}/checkpoints/bronze", f"{store}/schemas", schemas
    )
    silver = silver_layer(spark, bronze, store, client, schemas)

    run = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")

    def stored(layer: str, frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        written = {}
        for name, df in frames.items():
            written[name] = spark.read.schema(df.schema).parquet(write_run(df, f"{store}/{layer}/{name}", run))
        return written

    facts = stored("domain", domain_layer(silver))
    figures = gold_layer(facts, bronze.__getitem__, client)
    return stored("gold", {name: with_processing_time(df) for name, df in figures.items()})
