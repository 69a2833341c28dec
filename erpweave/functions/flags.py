"""Null-safe tests on ERP flags; a blank field may arrive as '' or as NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from erpweave.functions._cols import ColumnLike, as_col


def is_blank(col: ColumnLike) -> Column:
    return F.coalesce(as_col(col), F.lit("")) == ""


def not_flag(col: ColumnLike, value: str = "X") -> Column:
    """True unless the field holds ``value``; NULL counts as not set."""
    return ~as_col(col).eqNullSafe(value)


def flag_to_bool(col: ColumnLike, value: str = "X") -> Column:
    return as_col(col).eqNullSafe(value)


def code_label(col: ColumnLike, labels: dict[str, str], default: str | None = None) -> Column:
    """Simple CASE: code to label. The key '' stands for blank, NULL included."""
    result = None
    for code, label in labels.items():
        test = is_blank(col) if code == "" else as_col(col) == code
        result = F.when(test, label) if result is None else result.when(test, label)
    return result.otherwise(F.lit(default))
