"""Incremental extraction: high-water marks and full / delta / recovery modes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from erpweave.sources.tables import stored_table


class WatermarkStore:
    """Control table (table name, watermark as text): every run appends a row, the last one of a source counts."""

    SCHEMA = "source string, watermark string, set_at timestamp"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def get(self, source: str) -> str | None:
        control = stored_table(self.spark, self.path, StructType.fromDDL(self.SCHEMA))
        if control is None:
            return None
        return control.filter(F.col("source") == source).agg(F.max_by("watermark", "set_at")).first()[0]

    def set(self, source: str, watermark: str) -> None:
        entry = self.spark.range(1).select(
            F.lit(source).alias("source"), F.lit(watermark).alias("watermark"), F.current_timestamp().alias("set_at")
        )
        entry.write.mode("append").parquet(self.path)


def extract_since(df: DataFrame, column: str, watermark: str | None) -> DataFrame:
    """Rows at or after the watermark; the filter reaches the scan. None means all."""
    return df if watermark is None else df.filter(F.col(column) >= F.lit(watermark).cast(df.schema[column].dataType))


def extract_and_advance(df: DataFrame, source: str, column: str, store: WatermarkStore, path: str) -> DataFrame:
    """Copy the new slice to ``path``, then store its highest value as the watermark.

    The watermark moves only after the copy has committed, so a failed run repeats its
    slice; the boundary value is read again, which an upsert downstream absorbs.
    """
    extract_since(df, column, store.get(source)).write.mode("overwrite").parquet(path)
    copied = df.sparkSession.read.schema(df.schema).parquet(path)
    high = copied.agg(F.max(column).cast("string")).first()[0]
    if high is not None:
        store.set(source, high)
    return copied


@dataclass(frozen=True)
class Slice:
    """Extracted rows; ``confirm`` moves the pointer and is called when they are stored."""

    rows: DataFrame
    confirm: Callable[[], None]


class DeltaQueue:
    """Extraction pointer over a change log with an increasing batch number.

    full ignores the pointer, delta reads what came after it, recovery repeats the last
    confirmed delta. Only a confirmed delta moves the pointer, so a caller that fails before it
    has stored the rows gets them again.
    """

    SCHEMA = "subscriber string, low bigint, high bigint, confirmed_at timestamp"

    def __init__(self, spark: SparkSession, path: str, subscriber: str):
        self.spark, self.path, self.subscriber = spark, path, subscriber

    def pointer(self) -> tuple[int, int]:
        """Bounds of the last confirmed delta; every confirmation is a row, with the time that orders equal bounds."""
        control = stored_table(self.spark, self.path, StructType.fromDDL(self.SCHEMA))
        if control is None:
            return (-1, -1)
        mine = control.filter(F.col("subscriber") == self.subscriber)
        last = mine.agg(F.max_by(F.struct("low", "high"), F.struct("high", "confirmed_at"))).first()[0]
        return (last["low"], last["high"]) if last else (-1, -1)

    def extract(self, log: DataFrame, batch: str, mode: str) -> Slice:
        low, high = self.pointer()
        if mode == "full":
            return Slice(log, lambda: None)
        if mode == "recovery":
            return Slice(log.filter((F.col(batch) > low) & (F.col(batch) <= high)), lambda: None)
        if mode != "delta":
            raise ValueError(f"unknown mode {mode!r}")
        newest = log.agg(F.max(batch)).first()[0]
        newest = high if newest is None else max(high, newest)

        def confirm() -> None:
            entry = self.spark.range(1).select(
                F.lit(self.subscriber).alias("subscriber"), F.lit(high).cast("bigint").alias("low"),
                F.lit(newest).cast("bigint").alias("high"), F.current_timestamp().alias("confirmed_at"),
            )
            entry.write.mode("append").parquet(self.path)

        return Slice(log.filter((F.col(batch) > high) & (F.col(batch) <= newest)), confirm)
