"""Purchase-to-pay in layers: landed files, typed streams, a dated fact.

``silver_*`` work on batch and streaming frames; ``erpweave.streaming.state.append_first`` keeps one row per key of what
a stream brings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from erpweave.functions import month_of, sap_date, year_of
from erpweave.operators.dedupe import first_per_key, latest_per_key
from erpweave.operators.quality import Rule, expect
from erpweave.sources.tables import overwrite_partitions

# Quality rules of the layer.
HEADER_RULES = [
    Rule("ebeln_not_null", "ebeln IS NOT NULL"),
    Rule("valid_date", "bedat >= DATE '2000-01-01'"),
    Rule("valid_amount", "netwr >= 0", "warn"),
]
ITEM_RULES = [
    Rule("ebeln_not_null", "ebeln IS NOT NULL"),
    Rule("ebelp_not_null", "ebelp IS NOT NULL"),
    Rule("valid_quantity", "menge >= 0", "warn"),
]


def typed_header(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {"bedat": sap_date("bedat"), "netwr": F.col("netwr").try_cast("decimal(15,2)")}
    )


def typed_item(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "menge": F.col("menge").try_cast("decimal(13,3)"),
            "netpr": F.col("netpr").try_cast("decimal(11,2)"),
            "netwr": F.col("netwr").try_cast("decimal(13,2)"),
        }
    )


def silver_header(raw: DataFrame, observation: Observation | str | None = None) -> DataFrame:
    return expect(typed_header(raw), HEADER_RULES, observation)


def silver_item(raw: DataFrame, observation: Observation | str | None = None) -> DataFrame:
    return expect(typed_item(raw), ITEM_RULES, observation)


def silver_slice(raw: DataFrame, partition_date: str) -> DataFrame:
    """One load date of the header table: typed, keyed, one row per order."""
    day = raw.filter(F.col("_partition_date") == partition_date)
    return first_per_key(typed_header(day).filter(F.col("ebeln").isNotNull()), ["ebeln"], [])


def latest_header(raw: DataFrame, version: str) -> DataFrame:
    return latest_per_key(silver_header(raw), ["ebeln"], version)


def gold_po_fact(items: DataFrame, headers: DataFrame, suppliers: DataFrame, materials: DataFrame) -> DataFrame:
    """Item fact with header, supplier and material; items without partners stay.

    Suppliers join while there is one row per order and materials while items are narrow, so items move by material and
    by order, never by supplier.
    """
    header = headers.select("ebeln", "lifnr", "ekorg", "bedat", "waers").join(suppliers.select("lifnr", "name1"), "lifnr", "left")
    return (
        items.drop("waers").join(materials.select("matnr", "maktx"), "matnr", "left")
        .join(header, "ebeln", "left")
        .select(
            F.col("ebeln").alias("purchase_order"), F.col("ebelp").alias("purchase_order_item"),
            F.col("lifnr").alias("supplier_id"), F.col("name1").alias("supplier_name"),
            F.col("matnr").alias("material_id"), F.col("maktx").alias("material_description"),
            F.col("werks").alias("plant"), F.col("ekorg").alias("purchasing_org"),
            F.col("bedat").alias("order_date"), year_of("bedat").alias("order_year"),
            month_of("bedat").alias("order_month"), F.col("menge").alias("quantity_ordered"),
            F.col("meins").alias("unit_of_measure"), F.col("netpr").alias("net_price"),
            F.col("netwr").alias("net_value"), F.col("waers").alias("currency"),
        )
    )


_FACT_PARTITIONS = ["order_year", "order_month"]


def write_po_fact(fact: DataFrame, path: str) -> None:
    """Write the fact by order year and month; only the months that ``fact`` holds are replaced.

    ``_updated_at`` says when a month was last written. Items without an order date have a partition of their own.
    """
    overwrite_partitions(fact.withColumn("_updated_at", F.current_timestamp()), path, _FACT_PARTITIONS, only_touched=True)


def read_po_fact(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The stored fact with ``_updated_at``; a filter on year or month prunes partitions."""
    return spark.read.schema(StructType([*schema.fields, StructField("_updated_at", TimestampType())])).parquet(path)


def gold_p2p_fact(items: DataFrame, headers: DataFrame) -> DataFrame:
    """Item fact of the declarative flow: header attributes and calendar parts."""
    header = headers.select("ebeln", "lifnr", "ekorg", "bukrs", "bedat", F.col("waers").alias("h_waers"))
    return items.join(header, "ebeln", "left").select(
        F.col("ebeln").alias("purchase_order"), F.col("ebelp").alias("line_item"),
        F.col("lifnr").alias("supplier_id"), F.col("ekorg").alias("purchasing_org"),
        F.col("bukrs").alias("company_code"), F.col("matnr").alias("material_id"), F.col("werks").alias("plant"),
        F.col("bedat").alias("order_date"), year_of("bedat").alias("order_year"),
        month_of("bedat").alias("order_month"), F.col("menge").alias("quantity"), F.col("meins").alias("uom"),
        F.col("netpr").alias("unit_price"), F.col("netwr").alias("net_value"), F.col("h_waers").alias("currency"),
    )
