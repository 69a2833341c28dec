"""Row-set changes: append, conditional update and delete."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def append_rows(df: DataFrame, rows: Sequence[Mapping[str, object]]) -> DataFrame:
    """Append literal rows; fields they leave out are NULL."""
    values = [tuple(row.get(c) for c in df.columns) for row in rows]
    return df.unionByName(df.sparkSession.createDataFrame(values, df.schema))


def update_where(df: DataFrame, condition: Column, **changes: Column | object) -> DataFrame:
    """Change the named fields of matching rows; a NULL condition does not match."""
    return df.withColumns(
        {
            name: F.when(condition, new if isinstance(new, Column) else F.lit(new)).otherwise(F.col(name))
            for name, new in changes.items()
        }
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    return df.filter(~F.coalesce(condition, F.lit(False)))


def union_rows(*frames: DataFrame) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
