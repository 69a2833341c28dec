from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from frames import rows
from erpweave import crosswalk
from erpweave.operators.quality import Rule, expect
from erpweave.plans.silver import silver_table
from erpweave.session import work_folder
from erpweave.sources.schemas import hinted_schema
from erpweave.streaming import ingest, state
from erpweave.streaming.metrics import METRICS, rule_totals


def test_new_files_only_and_new_columns_are_rescued(spark):
    base = work_folder(spark, "s")
    schema = hinted_schema(["k", "n"], "n DOUBLE")

    def land(text):
        spark.createDataFrame([(t,) for t in text], "value string").write.mode("append").text(f"{base}/in")

    def run():
        stream = ingest.json_stream_with_rescue(spark, f"{base}/in", schema)
        ingest.run_available(stream, f"{base}/out", f"{base}/cp")
        return spark.read.parquet(f"{base}/out")

    land(['{"k":"a","n":1}'])
    assert run().count() == 1
    assert run().count() == 1
    land(['{"k":"b","n":2,"zz":"new"}'])
    out = run()
    assert rows(out, "k", "n", "_rescued_data") == [("a", 1.0, None), ("b", 2.0, '{"zz":"new"}')]
    assert out.filter(F.col("_source_file").isNull() | F.col("_ingestion_time").isNull()).count() == 0


def test_stream_equals_batch_for_a_typed_table(spark, folder):
    base = work_folder(spark, "sb")
    raw = crosswalk.bronze(spark, folder, "vbrk")
    raw.write.json(f"{base}/in")
    typed = silver_table(ingest.json_stream(spark, f"{base}/in", raw.schema, max_files=1), "vbrk")
    ingest.run_available(typed, f"{base}/out", f"{base}/cp")
    assert rows(spark.read.parquet(f"{base}/out")) == rows(silver_table(raw, "vbrk"))


def test_dedupe_within_a_watermark(spark):
    base = work_folder(spark, "d")
    schema = "k string, ts timestamp"
    for values in ([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:01:00")], [("a", "2024-01-01 00:02:00"), ("b", "2024-01-01 00:03:00")]):
        df = spark.createDataFrame(values, "k string, t string").select("k", F.to_timestamp("t").alias("ts"))
        df.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(schema).parquet(f"{base}/in")
        ingest.run_available(state.dedupe_stream(stream, ["k"], "ts", "1 hour"), f"{base}/window", f"{base}/cp")
    assert rows(spark.read.parquet(f"{base}/window"), "k") == [("a",), ("b",)]


def _land(spark, base, values, schema="k string, n int"):
    spark.createDataFrame(values, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
    return spark.readStream.schema(schema).parquet(f"{base}/in")


def test_first_rows_are_exact_across_runs_and_streams(spark):
    base = work_folder(spark, "first")
    loads = [
        [("a", 2), ("a", 1), (None, 5), (None, 4)],  # of one load the least by the other columns
        [("a", 0), ("b", 7), (None, 1)],  # keys stored before, years ago for all it matters
        [("b", 1), ("c", 1), ("c", 3)],
    ]
    for values in loads:
        table = state.append_first(_land(spark, base, values), f"{base}/out", ["k"], f"{base}/cp", buckets=4)
    want = rows(spark.createDataFrame([("a", 1), (None, 4), ("b", 7), ("c", 1)], "k string, n int"))
    assert rows(table) == want
    # Nothing new: nothing added. A new checkpoint reads all again, and all of it is known.
    again = spark.readStream.schema("k string, n int").parquet(f"{base}/in")
    assert rows(state.append_first(again, f"{base}/out", ["k"], f"{base}/cp", buckets=4)) == want
    assert rows(state.append_first(again, f"{base}/out", ["k"], f"{base}/cp2", buckets=4)) == want


def test_first_rows_of_a_table_of_keys_only(spark):
    base = work_folder(spark, "keys")
    for values in ([("a", 1), ("a", 1)], [("a", 1), ("b", 1)]):
        table = state.append_first(_land(spark, base, values), f"{base}/out", ["n", "k"], f"{base}/cp", buckets=2)
    assert rows(table) == [("a", 1), ("b", 1)]


def test_a_repeated_batch_replaces_its_first_try(spark):
    base = work_folder(spark, "repeat")
    state.append_first(_land(spark, base, [("a", 1)]), f"{base}/out", ["k"], f"{base}/cp", buckets=4)
    stream = _land(spark, base, [("a", 2), ("b", 2)])
    state.append_first(stream, f"{base}/out", ["k"], f"{base}/cp", buckets=4)
    # The second batch was written but never committed: it runs again.
    commit = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/cp/commits/1")
    assert commit.getFileSystem(spark._jsc.hadoopConfiguration()).delete(commit, False)
    assert rows(state.append_first(stream, f"{base}/out", ["k"], f"{base}/cp", buckets=4)) == [("a", 1), ("b", 2)]


def test_first_rows_keep_no_state_and_read_touched_buckets_only(spark):
    base = work_folder(spark, "flat")
    seen = []

    class Watch(StreamingQueryListener):
        def onQueryStarted(self, event): pass
        def onQueryTerminated(self, event): pass
        def onQueryProgress(self, event): seen.append(len(event.progress.stateOperators))

    watch = Watch()
    spark.streams.addListener(watch)
    for i in range(3):
        table = state.append_first(_land(spark, base, [(f"k{i}", j) for j in range(500)]), f"{base}/out", ["k"], f"{base}/cp", buckets=8)
    spark.streams.removeListener(watch)
    assert sorted(r.k for r in table.collect()) == ["k0", "k1", "k2"] and set(seen) <= {0}
    plan = table.sparkSession.read.schema("k string, n int, _bucket int, _load string").parquet(f"{base}/out").where("_bucket IN (1)")
    assert "PartitionFilters: [isnotnull(_bucket" in plan._jdf.queryExecution().executedPlan().toString()


def test_rule_counters_become_a_table(spark):
    base = work_folder(spark, "rules")
    rules = [Rule("key", "k IS NOT NULL"), Rule("small", "n < 10", "warn")]
    for values in ([("a", 1), (None, 2), ("b", 20)], [("c", None), (None, 30)], []):
        stream = expect(_land(spark, base, values), rules, "orders")
        out = ingest.append_tables({"orders": stream}, f"{base}/out", f"{base}/cp", metrics=f"{base}/metrics")
    assert rows(out["orders"], "k") == [("a",), ("b",), ("c",)]
    assert rows(rule_totals(spark, f"{base}/metrics"), "table_name", "rule", "passed", "failed") == [
        ("orders", "key", 3, 2), ("orders", "small", 2, 3)]
    # A batch recorded twice counts once.
    spark.read.schema(METRICS).parquet(f"{base}/metrics").withColumn("recorded_at", F.current_timestamp()).coalesce(1).write.parquet(f"{base}/copy")
    spark.read.schema(METRICS).parquet(f"{base}/copy").write.mode("append").parquet(f"{base}/metrics")
    assert rows(rule_totals(spark, f"{base}/metrics"), "rule", "passed", "failed") == [("key", 3, 2), ("small", 2, 3)]


def test_counters_of_finished_batches_survive_a_failing_table(spark):
    base = work_folder(spark, "failing")
    good = expect(_land(spark, f"{base}/g", [("a", 1)]), [Rule("key", "k IS NOT NULL")], "good")
    bad = _land(spark, f"{base}/b", [("a", 1)]).select(F.raise_error(F.lit("broken")).cast("string").alias("k"))
    with pytest.raises(StreamingQueryException):
        ingest.append_tables({"bad": bad, "good": good}, f"{base}/out", f"{base}/cp", metrics=f"{base}/metrics")
    assert rows(rule_totals(spark, f"{base}/metrics"), "table_name", "passed", "failed") == [("good", 1, 0)]


def test_stream_upserts(spark):
    base = work_folder(spark, "u")
    schema = "k string, n int"
    table = None
    for values in ([("a", 1), ("b", 1)], [("a", 2), ("c", 2), ("c", 1)]):
        spark.createDataFrame(values, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(schema).parquet(f"{base}/in")
        table = state.upsert_stream(stream, f"{base}/t", ["k"], "n", f"{base}/cp", buckets=4)
    assert rows(table, "k", "n") == [("a", 2), ("b", 1), ("c", 2)]
    # A new checkpoint reads everything again and changes nothing.
    again = state.upsert_stream(stream, f"{base}/t", ["k"], "n", f"{base}/cp2", buckets=4)
    assert rows(again, "k", "n") == [("a", 2), ("b", 1), ("c", 2)]


def test_landed_tables_are_packed_and_stored_tables_zstd(spark):
    import glob
    import os

    import pyarrow.parquet as pq
    from erpweave.queries import files
    from erpweave.session import work_folder
    from erpweave.streaming import ingest

    base = work_folder(spark, "packed")
    df = spark.range(3000).selectExpr("cast(id AS string) AS key_of_document", "cast(id AS double) AS amount_of_document",
                                      "IF(id % 3 = 0, NULL, 'x') AS flag_of_document")
    files._land_json(df, f"{base}/plain/t")
    files._land_json(df, f"{base}/landing/t", packed=True)
    size = lambda pattern: sum(map(os.path.getsize, glob.glob(pattern)))
    assert 0 < size(f"{base}/landing/t/*.json.gz") < size(f"{base}/plain/t/*.json") / 4
    assert not glob.glob(f"{base}/landing/t/*.json")
    stored = ingest.ingest_tables(spark, f"{base}/landing", f"{base}/bronze", f"{base}/cp", {"t": df.schema})["t"]
    assert sorted(map(str, stored.select(df.columns).collect())) == sorted(map(str, df.collect()))
    for name in glob.glob(f"{base}/bronze/t/*.parquet"):
        assert pq.ParquetFile(name).metadata.row_group(0).column(0).compression == "ZSTD"


def test_stored_keys_and_first_rows_are_found_by_one_shuffle(spark, monkeypatch):
    """No join beside the choice of the first row, stored keys win, and what is stored is packed."""
    import glob

    import pyarrow.parquet as pq
    from erpweave.session import work_folder
    from erpweave.streaming import state

    base = work_folder(spark, "one-shuffle")

    def refused(*_, **__):
        raise AssertionError("joined")

    monkeypatch.setattr(type(spark.range(1)), "join", refused)
    for rows_ in ([("a", 2), (None, 1), ("a", 1)], [("a", 0), (None, 0), ("b", 5), ("b", 4)]):
        spark.createDataFrame(rows_, "k string, v int").write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema("k string, v int").parquet(f"{base}/in")
        table = state.append_first(stream, f"{base}/out", ["k"], f"{base}/cp", buckets=2)
    assert sorted(map(str, table.collect())) == ["Row(k='a', v=1)", "Row(k='b', v=4)", "Row(k=None, v=1)"]
    for name in glob.glob(f"{base}/out/*/*/*.parquet"):
        assert pq.ParquetFile(name).metadata.row_group(0).column(0).compression == "ZSTD"
