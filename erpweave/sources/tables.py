"""Table writes: bronze appends, Parquet tables, partitioned facts, layouts, properties."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from erpweave.session import shuffles_freed


@dataclass(frozen=True)
class Namespace:
    """Environment-dependent names of catalog and layer schemas."""

    catalog: str = "spark_catalog"
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"

    def table(self, layer: str, name: str) -> str:
        return f"{self.catalog}.{getattr(self, layer)}.{name}"

    @classmethod
    def for_target(cls, target: str, settings: Mapping[str, Mapping[str, str]]) -> Namespace:
        return cls(**settings[target])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a Parquet table; splits follow the session (``spark.sql.files.maxPartitionBytes``, ``minPartitionNum``)."""
    return spark.read.parquet(path)


def stored_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The table at ``path``, or None where there is nothing yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def bronze_append(df: DataFrame, path: str, table: str, partition_date: str, source_system: str) -> None:
    """Append with lineage columns, one partition per load date."""
    (
        df.withColumns(
            {
                "_sap_table": F.lit(table),
                "_ingestion_ts": F.current_timestamp(),
                "_source_system": F.lit(source_system),
                "_partition_date": F.lit(partition_date),
            }
        )
        .write.mode("append")
        .partitionBy("_partition_date")
        .parquet(path)
    )


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def write_run(df: DataFrame, path: str, run: str, keep: int = 2) -> str:
    """Write a rebuilt table beside its earlier runs, as ``<path>/run=<run>``, and return that folder.

    Run names sort by time. All but the newest ``keep`` are removed afterwards, so whoever reads the run before is not
    disturbed; a filter on ``run`` over ``path`` reads one of them.
    """
    spark = df.sparkSession
    folder = f"{path}/run={run}"
    df.write.mode("overwrite").parquet(folder)
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    runs = sorted((s.getPath() for s in files.listStatus(root) if s.getPath().getName().startswith("run=")), key=lambda p: p.getName())
    for old in runs[:-keep]:
        files.delete(old, True)
    return folder


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], only_touched: bool = False) -> None:
    """Overwrite a partitioned table, or just the partitions present in ``df``.

    Rows are rebalanced by partition first: a small partition is one file, and one that holds much of
    the data is split by its measured size. What was shuffled for the write is freed with it.
    """
    with shuffles_freed(df.sparkSession):
        (
            df.hint("rebalance", *[F.col(c) for c in partition_by])
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic" if only_touched else "static")
            .option("compression", "zstd")
            .partitionBy(*partition_by)
            .parquet(path)
        )


def range_layout(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Cluster rows by value ranges so that files carry narrow min/max statistics.

    A row hash ends the range key, so one frequent value still spreads over partitions.
    """
    order: list[Column] = [*[F.col(c) for c in columns], F.xxhash64(*[F.col(c) for c in df.columns])]
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*columns)


def register_table(
    df: DataFrame, name: str, comment: str, properties: Mapping[str, str], path: str | None = None
) -> None:
    """Save as a catalog table with a comment and properties."""
    spark: SparkSession = df.sparkSession
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    spark.sql(f"COMMENT ON TABLE {name} IS '{comment}'")
    pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")
