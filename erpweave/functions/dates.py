"""ERP dates: eight-digit strings, sentinels, month buckets, differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from erpweave.functions._cols import ColumnLike, as_col

# Fixed values of the ERP date format.
INITIAL_DATE = "00000000"
OPEN_END_DATE = "99991231"
DATE_PATTERN = "yyyyMMdd"


def sap_date(col: ColumnLike, open_end: str = "keep") -> Column:
    """Parse ``yyyyMMdd``; anything unparsable, the initial date included, is NULL.

    ``open_end="null"`` also maps the open-ended date 99991231 to NULL, as reports
    do; ``"keep"`` leaves it a real date, as validity intervals need.
    """
    if open_end not in ("keep", "null"):
        raise ValueError("open_end must be 'keep' or 'null'")
    c = as_col(col)
    parsed = F.try_to_date(c, DATE_PATTERN)
    if open_end == "null":
        return F.when(c != OPEN_END_DATE, parsed)
    return parsed


def month_start(col: ColumnLike) -> Column:
    """First day of the month, as DATE (``date_trunc`` would give a timestamp)."""
    return F.trunc(as_col(col), "month")


def year_of(col: ColumnLike) -> Column:
    return F.year(as_col(col)).cast("bigint")


def month_of(col: ColumnLike) -> Column:
    return F.month(as_col(col)).cast("bigint")


def days_between(start: ColumnLike, end: ColumnLike) -> Column:
    """Days from ``start`` to ``end``; NULL while either milestone is missing."""
    return F.datediff(as_col(end), as_col(start)).cast("bigint")
