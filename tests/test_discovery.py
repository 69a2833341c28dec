"""Fields found in the data: kinds, evolving raw tables, records."""

from __future__ import annotations

import json

import pytest
from pyspark.sql.types import StructType

from frames import rows
from erpweave.datagen import build as B
from erpweave.datagen.specs import erp_tables
from erpweave.plans import layers
from erpweave.session import work_folder
from erpweave.sources import discovery as D
from erpweave.sources.schemas import SchemaLog
from erpweave.streaming import ingest


def _lines(spark, *records):
    return spark.createDataFrame([(r if isinstance(r, str) or r is None else json.dumps(r),) for r in records], "value string")


def test_kind_of_every_field(spark):
    lines = _lines(
        spark, {"whole": 1, "mixed": 1, "flag": True, "odd": True, "none": None, "list": [1], "big": 10**24, "text": "5", "x.y": 2.0, "late": None},
        {"whole": 2, "mixed": 2.5, "flag": False, "odd": 3, "object": {"a": 1}, "late": 4, "b`t": 1}, "{broken", "[1]", "", None)
    found = {f.name: f.dataType.simpleString() for f in D.discover(lines).fields}
    assert found == {
        "whole": "bigint", "mixed": "double", "flag": "boolean", "odd": "string", "none": "void", "list": "string",
        "big": "string", "text": "string", "x.y": "double", "late": "bigint", "object": "string", "b`t": "bigint"}
    assert D.discover(lines.limit(0)).fields == []


def test_too_many_names_are_refused(spark, monkeypatch):
    monkeypatch.setattr(D, "MOST_FIELDS", 3)
    D.discover(_lines(spark, {"a": 1, "b": 1, "c": 1}))
    with pytest.raises(ValueError):
        D.discover(_lines(spark, {"a": 1, "b": 1}, {"c": 1, "d": 1}))


def _land(spark, path, *records):
    spark.createDataFrame([(json.dumps(r),) for r in records], "value string").coalesce(1).write.mode("append").text(path)


def test_new_and_widened_fields_over_three_runs(spark):
    base = work_folder(spark, "evolving")
    hints = {"t": StructType.fromDDL("k string, amount double")}

    def run():
        return ingest.ingest_evolving(spark, f"{base}/landing", f"{base}/bronze", f"{base}/cp", f"{base}/schemas", hints)["t"]

    _land(spark, f"{base}/landing/t", {"k": "a", "amount": 1, "n": 1, "gone": None})
    first = run()
    assert dict(first.dtypes)["n"] == "bigint" and dict(first.dtypes)["gone"] == "string"
    _land(spark, f"{base}/landing/t", {"k": "b", "amount": "oops", "n": 2.5, "s": True})
    second = run()
    assert {**dict(second.dtypes)}["n"] == "double" and dict(second.dtypes)["s"] == "boolean"
    assert rows(second, "k", "amount", "n", "s", "_rescued_data") == [
        ("a", 1.0, 1.0, None, None), ("b", None, 2.5, True, '{"amount":"oops"}')]
    stored = {r[0] for r in spark.read.parquet(f"{base}/bronze/t").select("_metadata.file_path").distinct().collect()}
    # Fields that are columns already but for their case, or like a column of ingestion, are rescued.
    _land(spark, f"{base}/landing/t", {"k": "c", "n": "three", "N": 9, "_source_file": "x", "a b`c.d": 7})
    third = run()
    assert rows(third, "k", "n", "s") == [("a", "1", None), ("b", "2.5", True), ("c", "three", None)]
    assert third.filter("k = 'c'").select("`a b``c.d`").first()[0] == 7
    assert json.loads(third.filter("k = 'c'").first()["_rescued_data"]) == {"N": "9", "_source_file": "x"}
    # Stored files stay as they are, and a run without new files adds nothing.
    after = {r[0] for r in spark.read.parquet(f"{base}/bronze/t").select("_metadata.file_path").distinct().collect()}
    assert stored < after and run().count() == 3


def test_a_batch_learnt_twice_teaches_nothing_new(spark):
    log = SchemaLog(spark, work_folder(spark, "log-twice"))
    for _ in range(2):
        log.evolve(D.discover(_lines(spark, {"a": 1}, {"b": 0.5})))
    assert log._versions() == [0] and log.current().simpleString() == "struct<a:bigint,b:double>"


def test_silver_reads_evolving_tables(spark):
    base = work_folder(spark, "evolving-silver")
    hints = {name: StructType.fromDDL("mandt string") for name in layers.SILVER}
    tables = erp_tables()
    for name in layers.SILVER:
        B.write_json_chunks(B.generate_table(spark, tables, name, 0.01).coalesce(1), f"{base}/landing/{name}")
    bronze = ingest.ingest_evolving(spark, f"{base}/landing", f"{base}/bronze", f"{base}/cp", f"{base}/schemas", hints)
    assert dict(bronze["vbak"].dtypes)["netwr"] == "double" and dict(bronze["vbak"].dtypes)["vbeln"] == "string"
    assert all(df.filter("_rescued_data IS NOT NULL").isEmpty() for df in bronze.values())
    silver = layers.silver_layer(spark, bronze, base, hints=hints)
    assert all(silver[name].count() == tables[name].count(0.01) for name in layers.SILVER)


def test_records_are_typed_by_all_of_them(spark):
    df = _lines(spark, {"a": None, "b": 1, "k": 5}, {"a": 2.5, "b": 2, "c": "x"}, "broken").selectExpr("'own' AS k", "value")
    out = D.records_to_frame(df)
    assert out.dtypes == [("k", "string"), ("a", "double"), ("b", "string"), ("c", "string")]
    assert rows(out) == [("own", 2.5, "2", "x"), ("own", None, "1", None), ("own", None, None, None)]
    assert D.records_to_frame(df.limit(0)).columns == ["k"]
