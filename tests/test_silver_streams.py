"""Typed tables fed by streams over the given tables: no second copy of the raw rows."""

from __future__ import annotations

import glob

from frames import rows
from erpweave.queries import files
from erpweave.queries.registry import Tables
from erpweave.session import work_folder
from erpweave.streaming import ingest


def test_a_raw_stream_has_the_rows_of_the_raw_table(spark, folder):
    t = Tables(spark, folder)
    for name in ("vbak", "ekbe"):
        base = work_folder(spark, "raw-stream")
        ingest.run_available(t.raw_stream(name), f"{base}/out", f"{base}/cp")
        assert rows(spark.read.parquet(f"{base}/out").select(t.raw(name).columns)) == rows(t.raw(name))


def test_rule_metrics_store_no_raw_tables(spark, folder, monkeypatch, tmp_path):
    monkeypatch.setattr(files, "work_folder", lambda _, label: f"{tmp_path}/{label}")
    metrics = files.silver_metrics(Tables(spark, folder))
    assert metrics.count() == sum(map(len, files._REQUIRED.values()))
    assert len(glob.glob(f"{tmp_path}/silver-metrics/silver/*")) == 18 and not glob.glob(f"{tmp_path}/silver-metrics/bronze")
