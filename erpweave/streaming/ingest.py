"""Incremental file ingestion: each run reads only files it has not seen."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from erpweave.sources.discovery import discover, stored_schema, typed
from erpweave.sources.files import parse_with_rescue, with_ingestion_metadata
from erpweave.sources.schemas import SchemaLog
from erpweave.streaming.metrics import recorded_rules


def json_stream(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """Stream of typed rows plus ingestion time and source file."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_ingestion_metadata(reader.json(path))


def json_stream_with_rescue(
    spark: SparkSession, path: str, schema: StructType, max_files: int | None = None
) -> DataFrame:
    """As ``json_stream``; unknown and mistyped fields stay in ``_rescued_data``."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return parse_with_rescue(with_ingestion_metadata(reader.text(path)), schema)


def parquet_stream(
    spark: SparkSession, path: str, schema: StructType, source: str, max_files: int | None = None
) -> DataFrame:
    """Stream over landed Parquet files with lineage columns."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).withColumns({"_ingestion_ts": F.current_timestamp(), "_source": F.lit(source)})


def event_stream(
    spark: SparkSession, payload: StructType, path: str | None = None, kafka: dict[str, str] | None = None
) -> DataFrame:
    """Business events as JSON text, from landed files or from a broker topic."""
    if kafka:
        text = spark.readStream.format("kafka").options(**kafka).load().select(F.col("value").cast("string"))
    else:
        text = spark.readStream.text(path)
    return text.select(F.from_json("value", payload).alias("event")).select("event.*")


# Stored tables are written once and read often.
STORED_AS = {"compression": "zstd"}


def run_available(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None) -> None:
    """Append everything available to a Parquet table, then stop."""
    writer = stream.writeStream.format("parquet").options(**STORED_AS).option("checkpointLocation", checkpoint)
    writer = writer.outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.trigger(availableNow=True).start(path)
    query.awaitTermination()


def ingest_table(
    spark: SparkSession, landing: str, bronze: str, checkpoints: str, table: str, schema: StructType
) -> DataFrame:
    """One bronze refresh: new files of ``<landing>/<table>`` appended to the bronze table, nothing lost."""
    stream = json_stream_with_rescue(spark, f"{landing}/{table}", schema)
    run_available(stream, f"{bronze}/{table}", f"{checkpoints}/{table}")
    return spark.read.schema(stream.schema).parquet(f"{bronze}/{table}")


def _finish(queries: list[StreamingQuery]) -> list[StreamingQueryException]:
    """Await all queries; what failed of them."""
    failures = []
    for query in queries:
        try:
            query.awaitTermination()
        except StreamingQueryException as failure:
            failures.append(failure)
    return failures


def append_tables(
    streams: Mapping[str, DataFrame], target: str, checkpoints: str, at_once: int = 8, metrics: str | None = None
) -> dict[str, DataFrame]:
    """Append what is available of many streams, ``at_once`` of them side by side.

    Returns the accumulated tables. Each table has its own checkpoint. When one fails, those beside it
    are awaited before the failure is raised, so the next run finds no query on their checkpoints. With
    ``metrics``, a table path, the rule counters that streams carry are appended there, those of finished
    batches of a failed run too.
    """
    names = list(streams)
    for start in range(0, len(names), at_once):
        together = {name: streams[name] for name in names[start:start + at_once]}
        session = next(iter(together.values())).sparkSession
        with recorded_rules(session, metrics) as runs:
            for name, stream in together.items():
                writer = stream.writeStream.format("parquet").options(**STORED_AS)
                writer = writer.option("checkpointLocation", f"{checkpoints}/{name}")
                runs.append(writer.trigger(availableNow=True).start(f"{target}/{name}"))
            failures = _finish(runs)
        if failures:
            raise failures[0]
    return {
        name: stream.sparkSession.read.schema(stream.schema).parquet(f"{target}/{name}")
        for name, stream in streams.items()
    }


def ingest_tables(
    spark: SparkSession, landing: str, bronze: str, checkpoints: str, schemas: Mapping[str, StructType]
) -> dict[str, DataFrame]:
    """One bronze refresh of every table that has a schema, rescued data included."""
    streams = {name: json_stream_with_rescue(spark, f"{landing}/{name}", schema) for name, schema in schemas.items()}
    return append_tables(streams, bronze, checkpoints)


def _learn_fields(
    spark: SparkSession, landing: str, checkpoints: str, logs: Mapping[str, SchemaLog], at_once: int
) -> None:
    """Bring every schema log up to date with the files that no run has looked at yet."""
    names = list(logs)
    for start in range(0, len(names), at_once):
        runs = []
        for name in names[start:start + at_once]:
            def learn(lines: DataFrame, _: int, log: SchemaLog = logs[name]) -> None:
                log.evolve(discover(lines))

            writer = spark.readStream.text(f"{landing}/{name}").writeStream.foreachBatch(learn)
            writer = writer.option("checkpointLocation", f"{checkpoints}/{name}-fields")
            runs.append(writer.trigger(availableNow=True).start())
        failures = _finish(runs)
        if failures:
            raise failures[0]


def ingest_evolving(
    spark: SparkSession, landing: str, bronze: str, checkpoints: str, logs: str, hints: Mapping[str, StructType],
    at_once: int = 8,
) -> dict[str, DataFrame]:
    """One bronze refresh of tables whose fields may change; returns the typed tables.

    First the fields of the new files are found, one aggregate a batch, and merged into the table's schema log below
    ``logs``. Then the table's query goes on from its checkpoint with the widened schema. Both read new files only. A batch
    that is looked at twice teaches nothing new. Fields that ``hints`` has keep its type, and what does not fit is rescued;
    all others are stored as text and typed when read, so a new field appears as a column (NULL in older rows), a
    widened one changes its type in all rows, and no stored file is rewritten. Files that land between the two steps are
    read by the second with the fields known by then; fields that only they have are in ``_rescued_data``.
    """
    known = {name: SchemaLog(spark, f"{logs}/{name}") for name in hints}
    _learn_fields(spark, landing, checkpoints, known, at_once)
    fields = {name: log.current() for name, log in known.items()}
    streams = {
        name: json_stream_with_rescue(spark, f"{landing}/{name}", stored_schema(schema, fields[name]))
        for name, schema in hints.items()
    }
    stored = append_tables(streams, bronze, checkpoints, at_once)
    return {name: typed(df, hints[name], fields[name]) for name, df in stored.items()}
