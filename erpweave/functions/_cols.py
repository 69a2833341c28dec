"""Shared helpers: a column or a column name, names for working columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def unused(name: str, *columns: Iterable[str]) -> str:
    """``name``, with leading underscores added until none of the columns is called so (in any case)."""
    taken = {c.lower() for group in columns for c in group}
    while name.lower() in taken:
        name = f"_{name}"
    return name
