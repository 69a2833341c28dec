"""Clustered layouts over several columns, so that a filter on any one of them skips most files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from erpweave.functions._cols import unused
from erpweave.session import materialize


def value_bounds(df: DataFrame, column: str, pieces: int) -> list:
    """Ascending values that cut the rows of ``df`` into at most ``pieces`` parts of like size.

    Counted over all rows and without sorting them: values are grouped first, value ranges are added up by range totals
    and sums inside a range. A value is never divided, so a very frequent one is a part by itself. NULLs are before
    the first part. Fewer than ``pieces`` values reach the driver.
    """
    value = F.col(f"`{column}`")
    counted = df.where(value.isNotNull()).groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranged = materialize(
        counted.repartitionByRange("value").withColumn("range", F.spark_partition_id()), "layout-values")
    # One row per value range: as few as shuffle partitions.
    ranges = ranged.groupBy("range").agg(F.sum("n").alias("held"))
    before = F.sum("held").over(Window.orderBy("range")) - F.col("held")
    ranges = ranges.select("range", before.alias("before"), F.sum("held").over(Window.partitionBy()).alias("total"))
    inside = F.sum("n").over(Window.partitionBy("range").orderBy("value")) - F.col("n")
    placed = ranged.withColumn("inside", inside).join(F.broadcast(ranges), "range")
    piece = F.floor((F.col("before") + F.col("inside")) * pieces / F.col("total"))
    starts = placed.groupBy(piece.alias("piece")).agg(F.min("value").alias("value")).where("piece > 0")
    return sorted(r.value for r in starts.collect())


def rank_among(value: Column, bounds: Sequence, bits: int) -> Column:
    """How many of the sorted ``bounds`` (fewer than 2^bits) do not exceed the value, by bisection; NULL ranks 0."""
    if not bounds:
        return F.lit(0).cast("long")
    known = F.array(*[F.lit(b) for b in bounds])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])

    def step(at: Column, width: Column) -> Column:
        return F.when(F.try_element_at(known, at + width) <= value, at + width).otherwise(at)

    return F.aggregate(steps, F.lit(0), step).cast("long")


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """The bits of all ranks in turn, highest first, as one number: rows near in every rank are near in it."""
    if len(ranks) * bits > 62:
        raise ValueError("the key has no room for so many bits")
    key = F.lit(0).cast("long")
    for b in range(bits):
        for i, rank in enumerate(ranks):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(bit, b * len(ranks) + i))
    return key


def curve_layout(df: DataFrame, columns: Sequence[str], partitions: int | None = None, bits: int = 8) -> DataFrame:
    """Rows ordered along a space-filling curve over ``columns``, dealt to partitions (files) by ranges of it.

    A column enters by the rank of its value among 2^``bits`` parts of like size, so skewed values and any
    sortable type are served alike. ``range_layout`` sorts by its first column and prunes by that one only; here every column
    prunes, each a little less. A row hash ends the order, so rows equal in all columns still spread.

    The rows are stored once first: the bounds of every column, the sample of the ranges and the layout read them, and
    what ``df`` is made of is not made again. Ranks, key and hash are columns, worked out once a row and not at
    every comparison of the sort.
    """
    rows = materialize(df, "layout-rows")
    ranks = {
        unused(f"_rank{i}", df.columns): rank_among(F.col(f"`{c}`"), value_bounds(rows, c, 1 << bits), bits)
        for i, c in enumerate(columns)
    }
    key, spread = unused("_key", df.columns), unused("_spread", df.columns)
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    keyed = rows.withColumns(ranks).withColumns({key: interleaved([F.col(r) for r in ranks], bits), spread: hashed})
    keyed = keyed.drop(*ranks)
    ranged = keyed.repartitionByRange(partitions, key, spread) if partitions else keyed.repartitionByRange(key, spread)
    return ranged.sortWithinPartitions(key, spread).drop(key, spread)
