"""Compare registered queries with their SQL twins on one folder.

Usage: python tests/check_oracle.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import datetime
import sys
import time
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

DUCK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean",
    "DOUBLE": "double", "TIMESTAMP": "timestamp_ntz",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, Decimal):
        return format(value.normalize() + 0, "f")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _rows(rows, order):
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, folder: str, name: str, build, sql: str) -> str | None:
    """None when equal, else what differs."""
    df = build(spark, folder)
    result = con.execute(sql)
    duck_names = [d[0] for d in result.description]
    duck_rows = result.fetchall()
    if sorted(df.columns) != sorted(duck_names):
        return f"columns {sorted(df.columns)} != {sorted(duck_names)}"
    kinds = {d[0]: str(d[1]) for d in con.execute(f"DESCRIBE {sql}").fetchall()}
    spark_kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for column, kind in kinds.items():
        want = DUCK_TYPES.get(kind, kind.lower())
        if want != spark_kinds[column]:
            return f"type of {column}: {spark_kinds[column]} != {kind}"
    spark_rows = [tuple(r) for r in df.collect()]
    if len(spark_rows) != len(duck_rows):
        return f"rows {len(spark_rows)} != {len(duck_rows)}"
    order = sorted(df.columns)
    a = _rows(spark_rows, [df.columns.index(c) for c in order])
    b = _rows(duck_rows, [duck_names.index(c) for c in order])
    for x, y in zip(a, b):
        if x != y:
            return f"values {order}\n   spark {x}\n   duck  {y}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from erpweave.session import build_session

    args = sys.argv[1:]
    folder = "/root/testdata/sf0.01"
    if args[:1] == ["--sf"]:
        folder, args = args[1], args[2:]
    spark = build_session("check")
    con = connect(folder)
    queries, twins = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not args or any(n.startswith(a) for a in args)]
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in twins:
                problem = compare(spark, con, folder, name, queries[name], twins[name])
            else:
                problem = None if queries[name](spark, folder).count() >= 0 else "no rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name} {'' if name in twins else '(rows only) '}{time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
