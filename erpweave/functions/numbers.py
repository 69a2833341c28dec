"""Exact numbers: amounts (17,2), quantities (17,3), rates (7,4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from erpweave.functions._cols import ColumnLike, as_col

MONEY = "decimal(17,2)"
QUANTITY = "decimal(17,3)"
RATE = "decimal(7,4)"


def money(col: ColumnLike) -> Column:
    """Amount; text that is no number becomes NULL instead of failing the job."""
    return as_col(col).try_cast(MONEY)


def quantity(col: ColumnLike) -> Column:
    return as_col(col).try_cast(QUANTITY)


def rate(col: ColumnLike) -> Column:
    return as_col(col).try_cast(RATE)


def signed_amount(amount: ColumnLike, indicator: ColumnLike, debit: str = "S") -> Column:
    """Debit counts positive, everything else negative."""
    a = as_col(amount)
    return F.when(as_col(indicator) == debit, a).otherwise(-a)


def guarded_ratio(part: ColumnLike, whole: ColumnLike, factor: float = 100.0) -> Column:
    """``part / whole * factor``, NULL unless ``whole`` is positive."""
    w = as_col(whole)
    return F.when(w > 0, F.try_divide(as_col(part), w) * factor)
