"""Grouped totals. All of them combine map-side, so a hot group is no hot task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from erpweave.functions.numbers import signed_amount


def exact_sums(df: DataFrame, keys: Sequence[Column | str], sums: Mapping[str, tuple[Column | str, str]]) -> DataFrame:
    """Group totals with the result type pinned: name -> (value, decimal type)."""
    return df.groupBy(*keys).agg(*[F.sum(value).cast(kind).alias(name) for name, (value, kind) in sums.items()])


def distinct_counts(df: DataFrame, keys: Sequence[Column | str], counts: Mapping[str, str]) -> DataFrame:
    """Several exact distinct counts per group."""
    return df.groupBy(*keys).agg(*[F.count_distinct(column).alias(name) for name, column in counts.items()])


def sums_and_distincts(
    df: DataFrame, keys: Sequence[str], sums: Mapping[str, str], document: tuple[str, str], other: tuple[str, str]
) -> DataFrame:
    """Group sums (name -> column) and the distinct counts (name, column) of a document key and of another column.

    Two distinct counts in one aggregation repeat every row per count. Here one row per group and document is marked
    first, which needs no shuffle where a join has dealt the rows by document. The rest is added up by other value and then
    by group, both combined before their shuffle. NULLs are not counted, as in any distinct count.
    """
    group = [f"k{i}" for i in range(len(keys))]
    parts = [f"s{i}" for i in range(len(sums))]
    narrow = df.select(
        *[F.col(f"`{k}`").alias(g) for k, g in zip(keys, group, strict=True)],
        *[F.col(f"`{c}`").alias(s) for c, s in zip(sums.values(), parts, strict=True)],
        F.col(f"`{document[1]}`").alias("document"), F.col(f"`{other[1]}`").alias("other"),
    )
    added = [F.sum(s).alias(s) for s in parts]
    place = F.row_number().over(Window.partitionBy(*group, "document").orderBy("other"))
    marked = narrow.select(
        *group, "other", *parts, F.when((place == 1) & F.col("document").isNotNull(), 1).otherwise(0).alias("first"))
    by_other = marked.groupBy(*group, "other").agg(*added, F.sum("first").alias("first"))
    totals = by_other.groupBy(*group).agg(
        *added, F.sum("first").alias("documents"), F.count("other").alias("others"))
    return totals.select(
        *[F.col(g).alias(k) for g, k in zip(group, keys, strict=True)],
        *[F.col(s).alias(name) for s, name in zip(parts, sums, strict=True)],
        F.col("documents").alias(document[0]), F.col("others").alias(other[0]),
    )


def event_totals(
    history: DataFrame, keys: Sequence[str], event: str, totals: Mapping[str, tuple[str, str, str]]
) -> DataFrame:
    """Totals per event type in one pass: name -> (event code, value column, decimal type).

    Keys without a row of a type get zero.
    """
    aggregates = [
        F.coalesce(F.sum(F.when(F.col(event) == code, F.col(value))), F.lit(0)).cast(kind).alias(name)
        for name, (code, value, kind) in totals.items()
    ]
    codes = list({code for code, _, _ in totals.values()})
    return history.filter(F.col(event).isin(codes)).groupBy(*keys).agg(*aggregates)


def first_milestone(df: DataFrame, keys: Sequence[str], date: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(date).alias(name))


def account_balance(open_items: DataFrame, cleared_items: DataFrame, keys: Sequence[str], kind: str) -> DataFrame:
    """Debits minus credits over open and cleared items."""
    both = open_items.unionByName(cleared_items)
    return both.groupBy(*keys).agg(F.sum(signed_amount("dmbtr", "shkzg")).cast(kind).alias("balance"))


def positive_groups(df: DataFrame, keys: Sequence[str], value: str, name: str, kind: str) -> DataFrame:
    """Groups whose total is above zero."""
    return df.groupBy(*keys).agg(F.sum(value).cast(kind).alias(name)).filter(F.col(name) > 0)
