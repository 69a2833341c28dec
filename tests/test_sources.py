from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from frames import rows
from erpweave.operators.quality import Rule
from erpweave.session import work_folder
from erpweave.sources import extraction, files, schemas, tables


def test_hints():
    schema = schemas.hinted_schema(["a", "b"], "b DOUBLE")
    assert schema.simpleString() == "struct<a:string,b:double>"
    with pytest.raises(ValueError):
        schemas.hinted_schema(["a"], "z INT")


def test_merge_schemas_adds_and_widens():
    known, seen = StructType.fromDDL("a int, b string"), StructType.fromDDL("a double, c date")
    assert schemas.merge_schemas(known, seen).simpleString() == "struct<a:string,b:string,c:date>"


def test_schema_log_keeps_versions(spark):
    log = schemas.SchemaLog(spark, work_folder(spark, "log"))
    assert log.current() is None
    log.evolve(StructType.fromDDL("a string"))
    log.evolve(StructType.fromDDL("a string"))
    assert log._versions() == [0]
    assert log.evolve(StructType.fromDDL("b bigint")).names == ["a", "b"]
    assert log.current().names == ["a", "b"] and log._versions() == [0, 1]


def test_rescue_keeps_unknown_and_mistyped(spark):
    df = spark.createDataFrame([
        ('{"k":"a","n":1.5}',), ('{"k":"b","n":"oops","extra":"x"}',), ('{"k":"c"}',), ("not json",),
    ], "value string")
    out = files.parse_with_rescue(df, StructType.fromDDL("k string, n double"))
    got = {r["k"]: (r["n"], r["_rescued_data"]) for r in out.collect()}
    assert got["a"] == (1.5, None) and got["c"] == (None, None)
    assert got["b"] == (None, '{"n":"oops","extra":"x"}')


def test_delimited_load_reports_bad_rows(spark):
    path = work_folder(spark, "csv")
    text = spark.createDataFrame([("1", "20240101", "1.5"), ("2", "20241399", "2"), ("3", None, "x"), (None, "20240101", "1")], "k string, d string, n string")
    files.write_delimited(text, path)
    layout = StructType.fromDDL("k string, d date, n decimal(9,2)")
    out = files.read_delimited(spark, path, layout, [Rule("no_key", "k IS NOT NULL")])
    assert {r["k"]: (r["status"], r["message"]) for r in out.collect()} == {
        "1": ("S", ""), "2": ("E", "bad_d"), "3": ("E", "bad_n"), None: ("E", "no_key"),
    }


def test_watermark_moves_only_forward(spark):
    base = work_folder(spark, "wm")
    store = extraction.WatermarkStore(spark, f"{base}/control")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-05")], "k int, d string").withColumn("d", F.col("d").cast("date"))
    assert store.get("t") is None
    assert extraction.extract_and_advance(df, "t", "d", store, f"{base}/1").count() == 2
    assert store.get("t") == "2024-01-05"
    again = extraction.extract_and_advance(df.filter("k = 1"), "t", "d", store, f"{base}/2")
    assert again.count() == 0 and store.get("t") == "2024-01-05"


def test_delta_queue(spark):
    queue = extraction.DeltaQueue(spark, work_folder(spark, "q"), "s")
    log = spark.range(6).withColumnRenamed("id", "b")
    for _ in range(2):  # not confirmed: the same rows again
        first = queue.extract(log.filter("b < 3"), "b", "delta")
        assert rows(first.rows) == [(0,), (1,), (2,)]
    first.confirm()
    second = queue.extract(log, "b", "delta")
    assert rows(second.rows) == [(3,), (4,), (5,)]
    second.confirm()
    assert rows(queue.extract(log, "b", "recovery").rows) == [(3,), (4,), (5,)]
    assert queue.extract(log, "b", "full").rows.count() == 6
    assert queue.extract(log, "b", "delta").rows.count() == 0
    with pytest.raises(ValueError):
        queue.extract(log, "b", "other")


def test_namespace():
    names = tables.Namespace.for_target("dev", {"dev": {"catalog": "lab", "silver": "sap_silver"}})
    assert names.table("silver", "vbak") == "lab.sap_silver.vbak"


def test_range_layout_spreads_one_value(spark):
    df = spark.range(8000).select(F.lit("P1").alias("plant"), "id")
    laid = tables.range_layout(df, ["plant"], 4)
    sizes = [r["count"] for r in laid.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 4000


def test_overwrite_touches_only_present_partitions(spark):
    path = work_folder(spark, "po")
    df = spark.createDataFrame([(1, 2023), (2, 2024)], "v int, y int")
    tables.overwrite_partitions(df, path, ["y"])
    tables.overwrite_partitions(spark.createDataFrame([(9, 2024)], "v int, y int"), path, ["y"], only_touched=True)
    assert rows(spark.read.parquet(path), "v", "y") == [(1, 2023), (9, 2024)]


def test_work_folder_is_below_the_session_setting(spark):
    assert work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
