"""Document and object keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from erpweave.functions._cols import ColumnLike, as_col


def strip_leading_zeros(col: ColumnLike) -> Column:
    """Display form of a zero-padded key."""
    return F.ltrim(as_col(col), F.lit("0"))


def object_key(*parts: ColumnLike) -> Column:
    """Key of the originating document: its number followed by its year."""
    return F.concat(*[as_col(p) for p in parts])


def hierarchy_level(col: ColumnLike, level: int, width: int = 5) -> Column:
    """One level of a product hierarchy coded in fixed-width pieces; levels start at 1."""
    return F.trim(F.substring(as_col(col), (level - 1) * width + 1, width))
