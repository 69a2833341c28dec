"""The whole refresh on generated data: 41 raw, 18 typed, 8 domain, 5 key-figure tables."""

from __future__ import annotations

import duckdb
import pytest

from frames import rows
from erpweave.datagen import build as B
from erpweave.datagen.specs import erp_tables
from erpweave.plans import layers
from erpweave.plans.report import REPORT_COLUMNS
from erpweave.plans.silver import SILVER
from erpweave.queries.models import _REPORT
from erpweave.session import work_folder
from erpweave.sources.tables import write_run

SCALE = 0.02


@pytest.fixture(scope="module")
def store(spark):
    base = work_folder(spark, "layers")
    tables = erp_tables()
    for name in tables:
        B.write_json_chunks(B.generate_table(spark, tables, name, SCALE).coalesce(1), f"{base}/landing/{name}")
    schemas = {name: B.string_schema(t, tables) for name, t in tables.items()}
    gold = layers.refresh(spark, f"{base}/landing", base, schemas)
    return base, tables, schemas, gold


def test_every_table_of_every_layer(spark, store):
    base, tables, _, gold = store
    assert len(tables) == 41 and len(SILVER) == 18 and len(gold) == 5
    for name, table in tables.items():
        assert spark.read.parquet(f"{base}/bronze/{name}").count() == table.count(SCALE), name
    for name in SILVER:
        assert spark.read.parquet(f"{base}/silver/{name}").count() == tables[name].count(SCALE), name
    assert all(df.count() > 0 for df in gold.values())


def test_nothing_was_rescued(spark, store):
    base, tables, _, _ = store
    for name in ("vbak", "vbap", "ekbe", "eket"):
        assert spark.read.parquet(f"{base}/bronze/{name}").filter("_rescued_data IS NOT NULL").count() == 0


def test_second_refresh_adds_nothing(spark, store):
    base, _, schemas, gold = store
    before = rows(gold["kpi_order_to_cash"].drop("_processed_time"))
    again = layers.refresh(spark, f"{base}/landing", base, {k: schemas[k] for k in schemas})
    assert rows(again["kpi_order_to_cash"].drop("_processed_time")) == before


def test_two_runs_are_kept(spark, store):
    base, _, _, gold = store
    runs = spark.read.parquet(f"{base}/gold/kpi_order_to_cash").select("run").distinct().count()
    assert runs in (1, 2)  # the second refresh is a test of its own
    path = f"{base}/kept"
    for run in ("1", "2", "3"):
        last = write_run(spark.range(int(run)), path, run)
    assert spark.read.parquet(last).count() == 3
    assert sorted(r[0] for r in spark.read.parquet(path).select("run").distinct().collect()) == [2, 3]


def test_report_equals_plain_sql_on_generated_data(spark, store):
    base, tables, _, gold = store
    con = duckdb.connect()
    for name in tables:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{base}/bronze/{name}/*.parquet'")
    result = con.execute(_REPORT)
    names = [d[0] for d in result.description]
    want = sorted(result.fetchall(), key=repr)
    report = gold["open_orders_report"]
    assert report.columns == [*REPORT_COLUMNS, "_processed_time"] and len(REPORT_COLUMNS) == 34
    got = sorted((tuple(r) for r in report.select(*names).collect()), key=repr)
    assert got == want
