"""The whole pipeline as the driver calls it: stored stages over a folder with edge rows, and over an empty table."""

from __future__ import annotations

import corpus_pipeline
from erpweave.session import work_folder


def test_run_over_edge_rows(spark, edges):
    folder = work_folder(spark, "edge-documents")
    edges.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    got = corpus_pipeline.run(spark, folder).collect()
    ids = {r.doc_id for r in edges.select("doc_id").collect()}
    assert {r.doc_id for r in got} <= ids
    fills: dict[int, list] = {}
    for r in got:
        assert 1 <= r.length <= 4096
        fills.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in fills.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096


def test_run_over_an_empty_table(spark, nothing):
    folder = work_folder(spark, "no-documents")
    nothing.write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
