"""String-first schemas, type hints, inference and schema evolution."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from erpweave.sources.discovery import widest


def hinted_schema(columns: Sequence[str], hints: str = "") -> StructType:
    """All columns STRING except those a DDL hint string types."""
    typed = {f.name: f.dataType for f in StructType.fromDDL(hints).fields} if hints else {}
    unknown = set(typed) - set(columns)
    if unknown:
        raise ValueError(f"hints for unknown columns {sorted(unknown)}")
    return StructType([StructField(c, typed.get(c, StringType())) for c in columns])


def infer_json_schema(spark: SparkSession, path: str, sampling: float = 1.0) -> StructType:
    """Schema from the JSON values, to be frozen before a stream starts."""
    return spark.read.option("samplingRatio", sampling).json(path).schema


def merge_schemas(known: StructType, seen: StructType) -> StructType:
    """Add new columns at the end; a column whose type changed takes the widest: DOUBLE for numbers, else STRING."""
    incoming = {f.name: f.dataType for f in seen.fields}
    fields = []
    for f in known.fields:
        kind = incoming.pop(f.name, f.dataType)
        fields.append(StructField(f.name, widest(f.dataType, kind)))
    return StructType(fields + [StructField(n, t) for n, t in incoming.items()])


class SchemaLog:
    """Versions of a table's schema, kept as small text files in a shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        root = self._path(self.path)
        if not self._fs.exists(root):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(root)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("s") and n.endswith(".json"))

    def current(self) -> StructType | None:
        versions = self._versions()
        if not versions:
            return None
        text = self.spark.read.option("wholetext", True).text(f"{self.path}/s{versions[-1]}.json").first()[0]
        return StructType.fromJson(json.loads(text))

    def evolve(self, seen: StructType) -> StructType:
        """Merge a newly seen schema into the log and return the result."""
        known = self.current()
        merged = seen if known is None else merge_schemas(known, seen)
        if known is None or merged != known:
            version = (self._versions() or [-1])[-1] + 1
            out = self._fs.create(self._path(f"{self.path}/s{version}.json"), True)
            out.write(bytearray(merged.json().encode()))
            out.close()
        return merged


def read_evolving_json(spark: SparkSession, path: str, log: SchemaLog, drop: str | None = None) -> DataFrame:
    """Read all drops of a folder with the merged schema of every drop so far.

    Only ``drop`` (a file or folder below ``path``) is scanned for new fields when given:
    the log already knows the earlier ones.
    """
    schema = log.evolve(infer_json_schema(spark, drop or path))
    return spark.read.schema(schema).json(path)
