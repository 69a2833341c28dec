"""Stream deduplication and micro-batch upserts."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from erpweave.functions._cols import unused
from erpweave.operators.maintenance import upsert_table
from erpweave.sources.tables import overwrite_partitions, stored_table


def dedupe_stream(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """First row per key among those at most ``delay`` apart in event time; older state expires.

    For continuous streams whose duplicates come close together. Rows later than the watermark are dropped, and a key
    comes again after its state has expired: ``append_first`` is exact over any distance.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def append_first(
    stream: DataFrame, path: str, keys: Sequence[str], checkpoint: str, buckets: int = 64
) -> DataFrame:
    """Append the rows whose key the table at ``path`` does not hold yet; returns the table.

    One row per key over the life of the table, whatever lies between two copies: the first to arrive stays,
    and of one batch the least by its other columns. The stored table takes the place of stream state, so nothing is kept in
    memory and nothing expires. It is laid out by key hash; a batch reads the key columns of the buckets it touches
    only. A hot key is reduced to one row in every task before anything is shuffled.

    Each batch has a partition of its own, named after stream and batch: a repeated batch does not see its
    first try and replaces it. NULL keys are equal to each other.
    """
    if {"_bucket", "_load"} & set(stream.columns):
        raise ValueError("_bucket and _load are names of the table's own columns")
    columns = [F.col(f"`{c}`") for c in stream.columns]
    stored_schema = StructType([*stream.schema.fields, StructField("_bucket", IntegerType()), StructField("_load", StringType())])

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        load = json.loads(session.read.text(f"{checkpoint}/metadata").first()[0])["id"] + f"-{batch_id}"
        bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")
        fresh = batch.select(*columns, bucket.alias("_bucket"))
        touched = [r[0] for r in fresh.select("_bucket").distinct().collect()]
        known = stored_table(session, path, stored_schema)
        held, place = unused("_held", fresh.columns), unused("_rn", fresh.columns)
        every = fresh.withColumn(held, F.lit(False))
        if known is not None:
            # Stored keys come first in their group, so one shuffle finds both the new keys and the row of each.
            known = known.where(F.col("_bucket").isin(touched) & (F.col("_load") != load)).select(
                *[F.col(f"`{k}`") for k in keys], F.lit(True).alias(held))
            every = every.unionByName(known, allowMissingColumns=True)
        others = [F.col(f"`{c}`") for c in batch.columns if c not in keys]
        window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(F.col(held).desc(), *others)
        first = every.withColumn(place, F.row_number().over(window)).filter(F.col(place) == 1)
        new = first.filter(~F.col(held)).drop(held, place)
        overwrite_partitions(new.withColumn("_load", F.lit(load)), path, ["_bucket", "_load"], only_touched=True)

    stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start().awaitTermination()
    session = stream.sparkSession
    table = stored_table(session, path, stored_schema)
    return session.createDataFrame([], stream.schema) if table is None else table.select(*columns)


def upsert_stream(
    stream: DataFrame, path: str, keys: Sequence[str], order: str, checkpoint: str, buckets: int = 64
) -> DataFrame:
    """Merge every micro-batch into the table at ``path``; returns the table.

    A batch is known by the stream's id in its checkpoint and its number. A stream repeats the batch that
    failed before it goes on, and ``upsert_table`` finishes what the first try has begun.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        name = json.loads(batch.sparkSession.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        upsert_table(batch, path, keys, order, buckets, load=f"{name}-{batch_id}")

    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start().awaitTermination()
    session = stream.sparkSession
    table = stored_table(session, path, stream.schema)
    return session.createDataFrame([], stream.schema) if table is None else table.select(*stream.columns)
