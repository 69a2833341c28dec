"""Sorting, top rows, pages and the structured query reader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from erpweave.operators.joins import expand_items


def sorted_by(df: DataFrame, *order: Column | str) -> DataFrame:
    """Total sort. Remaining columns break ties, which also lets the range shuffle
    split a sort value that very many rows share."""
    return df.orderBy(*order, *[F.col(c) for c in df.columns])


def top_rows(df: DataFrame, order: Sequence[Column | str], n: int | None) -> DataFrame:
    """First ``n`` rows in order; None or 0 means no cap."""
    ordered = sorted_by(df, *order)
    return ordered.limit(n) if n else ordered


def page(df: DataFrame, order: Sequence[Column | str], skip: int, top: int) -> DataFrame:
    """Skip / top page. Cost grows with ``skip``; see ``page_after`` for deep paging."""
    return sorted_by(df, *order).offset(skip).limit(top)


def page_after(df: DataFrame, key: str, last: object | None, top: int) -> DataFrame:
    """Page of a unique key after the last key seen: the filter reaches the scan."""
    rows = df if last is None else df.filter(F.col(key) > F.lit(last))
    return rows.orderBy(key).limit(top)


def single_row(df: DataFrame, **key: object) -> DataFrame:
    """One row by its full key."""
    for column, value in key.items():
        df = df.filter(F.col(column) == F.lit(value))
    return df.limit(1)


def read_entities(
    df: DataFrame,
    filter: Column | None = None,
    select: Sequence[str] | None = None,
    orderby: Sequence[Column | str] | None = None,
    top: int | None = None,
    skip: int = 0,
    expand: tuple[DataFrame, Sequence[str], Sequence[str]] | None = None,
) -> DataFrame:
    """Filter, order, page, project and expand, as the query options of a data service.

    The page is cut before the expansion, so only the items of its rows are read into it.
    ``expand`` is (items, keys, item fields).
    """
    rows = df if filter is None else df.filter(filter)
    if orderby:
        rows = sorted_by(rows, *orderby)
    if skip:
        rows = rows.offset(skip)
    if top:
        rows = rows.limit(top)
    if select:
        keys = list(expand[1]) if expand else []
        rows = rows.select(*dict.fromkeys([*select, *keys]))
    if expand:
        items, keys, fields = expand
        related = items.join(rows.select(*keys), list(keys), "left_semi")
        rows = expand_items(rows, related, keys, fields)
    return rows
