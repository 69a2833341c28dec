"""Masking of tax numbers, as a column function and as a SQL function."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from erpweave.functions._cols import ColumnLike, as_col

# Fixed mask that follows the two visible characters.
TAX_ID_MASK = ".***.***/***-**"


def mask_tax_id(col: ColumnLike, privileged: bool | Column = False) -> Column:
    """Keep the first two characters unless the reader is privileged."""
    c = as_col(col)
    masked = F.concat(F.substring(c, 1, 2), F.lit(TAX_ID_MASK))
    if isinstance(privileged, bool):
        return c if privileged else masked
    return F.when(privileged, c).otherwise(masked)


def register_mask_udf(spark: SparkSession, name: str = "mask_cnpj") -> str:
    """Register the mask as a SQL function of ``(tax_id, privileged)``."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(tax_id STRING, privileged BOOLEAN) RETURNS STRING "
        f"RETURN IF(privileged, tax_id, concat(substr(tax_id, 1, 2), '{TAX_ID_MASK}'))"
    )
    return name
