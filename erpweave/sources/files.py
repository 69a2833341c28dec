"""JSON-lines parsing with rescued data, lineage columns, delimited files."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from erpweave.functions._cols import unused
from erpweave.operators.quality import Rule, row_status


def with_ingestion_metadata(df: DataFrame) -> DataFrame:
    """Add ingestion time and source file to rows read from files."""
    return df.select(
        "*", F.current_timestamp().alias("_ingestion_time"), F.col("_metadata.file_path").alias("_source_file")
    )


def parse_with_rescue(df: DataFrame, schema: StructType, column: str = "value") -> DataFrame:
    """Parse JSON text by schema; what does not fit stays in ``_rescued_data``.

    Fields the schema does not know are rescued as JSON, and so are known fields whose text does not
    convert to the declared type (their typed column is NULL). A line that is no JSON object is
    rescued as it stands, with all typed columns NULL. Blank lines are no rows. Any field name is allowed,
    that of the text column included; other columns of ``df`` of a declared name give way to the field.
    """
    names = [f.name for f in schema.fields]
    others = [c for c in df.columns if c != column and c not in names]
    kept = [F.col(f"`{c}`") for c in others]
    text, keys, plain, fields = (F.col(f"_line.{c}") for c in ("text", "keys", "plain", "fields"))
    broken = unused("_broken", names)
    checked = [f.name for f in schema.fields if not isinstance(f.dataType, StringType)]

    def value(name: str) -> Column:
        return F.col("_line.row").getField(name)

    # A sound line whose fields are all known and named once is read straight into the row; the map of its fields is
    # made for other lines only, and for those with a value that does not convert.
    row = StructType([StructField(n, StringType()) for n in [*names, broken]])
    lines = df.filter(F.length(F.trim(F.col(column))) > 0).select(
        *kept, F.struct(
            F.col(column).alias("text"), F.json_object_keys(F.col(column)).alias("keys"),
            F.from_json(F.col(column), row, {"columnNameOfCorruptRecord": broken}).alias("row"),
        ).alias("_line"),
    )
    there = reduce(add, [value(n).isNotNull().cast("int") for n in names], F.lit(0))
    known = reduce(add, [F.array_contains(keys, n).cast("int") for n in names], F.lit(0))
    sound = F.coalesce(value(broken).isNull() & ((F.size(keys) == there) | (F.size(keys) == known)), F.lit(False))
    unfit = [value(f.name).isNotNull() & value(f.name).try_cast(f.dataType).isNull() for f in schema.fields if f.name in checked]
    lines = lines.select(
        *kept, F.struct(
            text.alias("text"), F.col("_line.row").alias("row"), sound.alias("plain"),
            F.when(reduce(or_, unfit, ~sound), F.from_json(text, "map<string,string>")).alias("fields"),
        ).alias("_line"),
    )
    typed = {
        f.name: F.when(plain, value(f.name)).otherwise(F.try_element_at(fields, F.lit(f.name))).try_cast(f.dataType)
        for f in schema.fields
    }

    def misfit(key: Column, value: Column) -> Column:
        wrong = ~key.isin(names)
        for name in checked:
            wrong = wrong | ((key == name) & value.isNotNull() & typed[name].isNull())
        return wrong

    rest = F.map_filter(fields, misfit)
    rescued = F.when(plain & fields.isNull(), F.lit(None)).when(fields.isNull(), text).when(F.size(rest) > 0, F.to_json(rest))
    return lines.select(*kept, *[c.alias(n) for n, c in typed.items()], rescued.alias("_rescued_data"))


def write_delimited(df: DataFrame, path: str, separator: str = ";") -> None:
    """One header line per file, every partition writes its own file."""
    df.write.mode("overwrite").option("sep", separator).option("header", True).option("emptyValue", "").csv(path)


def read_delimited(spark, path: str, schema: StructType, rules: list[Rule], separator: str = ";") -> DataFrame:
    """Load a delimited file: text columns first, typed by layout, with STATUS and MESSAGE.

    Dates are ``yyyyMMdd`` and numbers use a decimal point. A value that does not convert
    makes its row an error named after the column; further rules follow.
    """
    raw_schema = StructType([type(f)(f.name, StringType()) for f in schema.fields])
    raw = spark.read.schema(raw_schema).option("sep", separator).option("header", True).csv(path)
    typed: dict[str, Column] = {}
    layout: list[Rule] = []
    for f in schema.fields:
        kind = f.dataType.simpleString()
        if kind == "string":
            continue
        value = F.try_to_date(F.col(f.name), "yyyyMMdd") if kind == "date" else F.col(f.name).try_cast(f.dataType)
        typed[f"_t_{f.name}"] = value
        layout.append(Rule(f"bad_{f.name}", f"`{f.name}` IS NULL OR `_t_{f.name}` IS NOT NULL"))
    status = row_status(raw.withColumns(typed), layout)
    names = [F.col(f"_t_{f.name}").alias(f.name) if f"_t_{f.name}" in typed else F.col(f.name) for f in schema.fields]
    loaded = status.select(*names, F.col("status").alias("_s"), F.col("message").alias("_m"))
    checked = row_status(loaded, rules) if rules else loaded.withColumns({"status": F.lit("S"), "message": F.lit("")})
    return checked.withColumns(
        {
            "status": F.when(F.col("_s") == "E", "E").otherwise(F.col("status")),
            "message": F.when(F.col("_s") == "E", F.col("_m")).otherwise(F.col("message")),
        }
    ).drop("_s", "_m")
