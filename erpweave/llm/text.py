"""Word and source expressions that several operators share (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other code point as it is."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Words of a text between ASCII blanks; NULL and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row, also when ``use`` repeats it in a lambda."""
    return F.transform(F.array(value), use)[0]


def packed(df: DataFrame, name: str = "_row") -> DataFrame:
    """The whole row in one struct column, so that no input column can clash with a working column."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))
