"""One row per key, always with a complete order so that results repeat.

``row_number() = 1`` lets Spark keep one row per key before the shuffle (a window
group limit), so a key with very many rows costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from erpweave.functions._cols import unused


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key; remaining columns break ties."""
    named = {o for o in order if isinstance(o, str)}
    ties = [F.col(c) for c in df.columns if c not in named and c not in keys]
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    place = unused("_rn", df.columns)
    return df.withColumn(place, F.row_number().over(window)).filter(F.col(place) == 1).drop(place)


def latest_per_key(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    return first_per_key(df, keys, [F.col(version).desc()])


def adjacent_duplicates_removed(df: DataFrame, keys: Sequence[str], sort: Sequence[Column | str]) -> DataFrame:
    """Sort, then keep the first of rows equal in ``keys``."""
    return first_per_key(df, keys, sort)


def distinct_dimension(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def read_index(df: DataFrame, order: Sequence[Column | str], index: int = 1) -> DataFrame:
    """The n-th row of the sorted table (1 = first)."""
    ordered = df.orderBy(*order, *[F.col(c) for c in df.columns])
    return ordered.offset(index - 1).limit(1) if index > 1 else ordered.limit(1)
