"""Field discovery: the columns of JSON lines and their types, as one aggregate over the values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    LongType,
    NullType,
    StringType,
    StructField,
    StructType,
)

SYSTEM = ("_ingestion_time", "_source_file", "_rescued_data")  # columns that ingestion adds
MOST_FIELDS = 10_000  # beyond it the names are data, not columns

# Kinds of a field, narrowest first: unseen, one kind of value, text for whatever does not go together.
KINDS: dict[str, DataType] = {
    "void": NullType(), "boolean": BooleanType(), "bigint": LongType(), "double": DoubleType(), "string": StringType(),
}


def widest(a: DataType, b: DataType) -> DataType:
    """Narrowest type that holds the values of both: whole numbers go into fractions, all else into text."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if {a, b} == {LongType(), DoubleType()}:
        return DoubleType()
    return StringType()


def _named(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def _value_kind(value: Column) -> Column:
    """Kind of one JSON value. A whole number beyond 64 bits is text, which keeps its digits; so are lists and objects."""
    found = F.schema_of_variant(value)
    name = F.regexp_extract(found, "^[A-Z]+", 0)
    huge = F.regexp_extract(found, r"^DECIMAL\((\d+),0\)$", 1).try_cast("int") >= 19
    return (
        F.when(value.isNull() | (name == "VOID"), "void").when(name == "BOOLEAN", "boolean").when(name == "BIGINT", "bigint")
        .when(F.coalesce(huge, F.lit(False)), "string").when(name.isin("DECIMAL", "DOUBLE", "FLOAT"), "double")
        .otherwise("string")
    )


def field_kinds(lines: DataFrame, column: str = "value") -> DataFrame:
    """(field, kind) of the JSON objects in a text column; lines that are no JSON object count for nothing.

    Combined map-side: a task hands on one row per field, whatever the number of lines.
    """
    values = lines.select(F.explode(F.from_json(_named(column), "map<string,variant>")).alias("field", "found"))
    kinds = values.select("field", _value_kind(F.col("found")).alias("kind"))
    seen = {k: F.bool_or(F.col("kind") == k) for k in KINDS}
    number = seen["bigint"] | seen["double"]
    return kinds.groupBy("field").agg(
        F.when(seen["string"] | (seen["boolean"] & number), "string").when(seen["double"], "double")
        .when(seen["bigint"], "bigint").when(seen["boolean"], "boolean").otherwise("void").alias("kind")
    )


def discover(lines: DataFrame, column: str = "value") -> StructType:
    """Schema of JSON lines, fields by name. One row per field reaches the driver, ``MOST_FIELDS`` at most."""
    found = field_kinds(lines, column).limit(MOST_FIELDS + 1).collect()
    if len(found) > MOST_FIELDS:
        raise ValueError(f"more than {MOST_FIELDS} field names: a map is wanted here, not columns")
    return StructType([StructField(r["field"], KINDS[r["kind"]]) for r in sorted(found, key=lambda r: r["field"])])


def stored_schema(hints: StructType, known: StructType | None) -> StructType:
    """How an evolving table is stored: hinted fields by their hint, every other known field as text.

    Text holds whatever the field becomes later, so a widened type rewrites nothing. Column names differ in more than
    case: a field named like a column before it is none of its own, so its values are rescued.
    """
    fields, taken = list(hints.fields), {n.lower() for n in [*hints.names, *SYSTEM]}
    for f in known.fields if known is not None else []:
        if f.name.lower() not in taken:
            taken.add(f.name.lower())
            fields.append(StructField(f.name, StringType()))
    return StructType(fields)


def typed(stored: DataFrame, hints: StructType, known: StructType | None) -> DataFrame:
    """The stored table with every discovered field in its present type."""
    kept = {*hints.names, *SYSTEM}
    kinds = {f.name: f.dataType for f in known.fields if f.name not in kept} if known is not None else {}

    def column(name: str) -> Column:
        kind = kinds.get(name, StringType())
        return _named(name) if isinstance(kind, (NullType, StringType)) else _named(name).try_cast(kind).alias(name)

    return stored.select(*[column(c) for c in stored.columns])


def records_to_frame(lines: DataFrame, column: str = "value") -> DataFrame:
    """Records, one JSON object a row, as typed columns beside the other columns of ``lines``.

    Two passes: the first finds the names and whether any value is a number with a fraction, which makes the column DOUBLE;
    every other column is STRING, whole numbers included. A row that is no JSON object has NULL in all of them. A
    field gives way to another column of its name.
    """
    others = [c for c in lines.columns if c != column]
    fields = [f for f in discover(lines, column).fields if f.name not in others]
    parsed = F.from_json(_named(column), "map<string,string>")
    value = lambda f: F.try_element_at(F.col("_fields"), F.lit(f.name))
    rows = lines.select(F.struct(*[_named(c) for c in others], F.lit(0).alias("_none")).alias("_others"), parsed.alias("_fields"))
    return rows.select(
        *[F.col("_others")[c].alias(c) for c in others],
        *[(value(f).try_cast("double") if isinstance(f.dataType, DoubleType) else value(f)).alias(f.name) for f in fields],
    )
