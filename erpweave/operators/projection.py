"""Column and row selection shared by all layers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def business_names(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep the named columns under their business names, in mapping order."""
    return df.select(*[F.col(source).alias(target) for source, target in names.items()])


def tenant_filter(df: DataFrame, client: str = "100", column: str = "mandt") -> DataFrame:
    return df.filter(F.col(column) == client)


def language_filter(df: DataFrame, language: str = "P", column: str = "spras") -> DataFrame:
    return df.filter(F.col(column) == language)


def by_role(df: DataFrame, roles: Mapping[str, tuple[str, str]], keys: Sequence[str], role_col: str) -> DataFrame:
    """A column per role, in a single pass over the partners.

    ``roles`` maps an output name to (role code, value column). A key with several partners of a
    role has a row for each of them (every combination, if that is so for several roles); a role
    without partner is NULL. The partners of one key and role are held as one array.
    """
    partners = [
        F.sort_array(F.collect_set(F.when(F.col(role_col) == code, F.col(value)))).alias(name)
        for name, (code, value) in roles.items()
    ]
    codes = [code for code, _ in roles.values()]
    rows = df.filter(F.col(role_col).isin(codes)).groupBy(*keys).agg(*partners)
    for name in roles:
        rows = rows.withColumn(name, F.explode_outer(name))
    return rows


def corresponding(df: DataFrame, target: StructType, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Shape ``df`` like ``target``: mapped name, else same name, else a typed NULL."""
    mapping = mapping or {}
    available = set(df.columns)
    columns: list[Column] = []
    for field in target.fields:
        source = mapping.get(field.name, field.name)
        value = F.col(source) if source in available else F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def split_delimited(df: DataFrame, column: str, fields: Sequence[str], separator: str = "|") -> DataFrame:
    """Split one text column into trimmed, named fields; missing ones are NULL."""
    parts = F.split(F.col(column), f"[{separator}]", -1)
    return df.select(*[F.trim(F.get(parts, F.lit(i))).alias(name) for i, name in enumerate(fields)])


def domain_texts(sources: Iterable[tuple[DataFrame, Mapping[str, str], str | None]]) -> DataFrame:
    """Union text tables into (domname, domvalue_l, ddlanguage, ddtext).

    Each source is (frame, renames to the common names, domain name). A source that
    already carries ``domname`` passes None.
    """
    frames = []
    for df, renames, domain in sources:
        frame = df.withColumnsRenamed(dict(renames))
        if domain is not None:
            frame = frame.withColumn("domname", F.lit(domain))
        frames.append(frame.select("domname", "domvalue_l", "ddlanguage", "ddtext"))
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def with_processing_time(df: DataFrame) -> DataFrame:
    """Add the time a table was computed."""
    return df.withColumn("_processed_time", F.current_timestamp())
