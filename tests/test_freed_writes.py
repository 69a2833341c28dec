"""Partition writes give back the disk that their shuffle took, and the purchase fact is joined once."""

from __future__ import annotations

import time
from pathlib import Path

import pytest

from erpweave.queries import documented
from erpweave.queries.registry import Tables
from erpweave.session import FREE_SHUFFLES, work_folder
from erpweave.sources.tables import overwrite_partitions


def test_shuffle_files_of_a_partition_write_go_with_it(spark):
    local = [Path(d.getPath()) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def files():
        return {f for d in local for f in d.rglob("shuffle_*.data")}

    before, held, path = spark.conf.get(FREE_SHUFFLES), files(), work_folder(spark, "freed-write")
    overwrite_partitions(spark.range(10_000).selectExpr("id", "id % 3 AS part"), path, ["part"])
    for _ in range(50):
        if not files() - held:
            break
        time.sleep(0.1)
    assert not files() - held and spark.conf.get(FREE_SHUFFLES) == before
    assert spark.read.parquet(path).count() == 10_000


def test_the_purchase_fact_is_joined_once_for_both_writes(spark, folder, monkeypatch):
    plans = []

    def write(fact, path):
        plans.append(fact._jdf.queryExecution().optimizedPlan().toString())
        raise_after(2)

    def raise_after(n):
        if len(plans) == n:
            raise InterruptedError

    monkeypatch.setattr(documented.L, "write_po_fact", write)
    with pytest.raises(InterruptedError):
        documented.q26_table(Tables(spark, folder))
    assert len(plans) == 2 and not any("Join" in p for p in plans)
