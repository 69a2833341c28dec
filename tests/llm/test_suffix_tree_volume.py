"""Disk and memory that the suffix tree takes on the way."""

from __future__ import annotations

import time
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa

from erpweave.llm import suffix_tree as st
from erpweave.session import FREE_SHUFFLES, materialize


def test_shuffle_files_go_when_their_result_is_stored(spark):
    local = [Path(d.getPath()) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def files():
        return {f for d in local for f in d.rglob("shuffle_*.data")}

    before, held = spark.conf.get(FREE_SHUFFLES), files()
    stored = materialize(spark.range(10_000).selectExpr("id % 5000 AS key").groupBy("key").count(), "freed")
    for _ in range(50):
        if not files() - held:
            break
        time.sleep(0.1)
    assert not files() - held
    assert stored.count() == 5000 and spark.conf.get(FREE_SHUFFLES) == before


def test_bit_tables_are_as_large_as_their_keys_need(spark):
    keys = [st.word_id(b"w%d" % i) for i in range(1000)]
    table = st.bit_table(spark.createDataFrame([(k,) for k in keys], "key long"))
    assert table.nbytes <= 8192 and st.may_hold(table, np.array(keys)).all()
    others = np.array([st.word_id(b"x%d" % i) for i in range(10_000)])
    assert st.may_hold(table, others).mean() < 0.05
    assert not st.bit_table(spark.createDataFrame([], "key long")).any()


def test_asked_keys_travel_as_differences():
    rng = np.random.default_rng(3)
    keys, rows = rng.integers(-(1 << 63), 1 << 63, 100_000), rng.integers(0, 500, 100_000)
    sent = list(st.blocks(keys, rows, 64))
    back = [(st.unplanes(a).cumsum(), st.unplanes(b)) for _, a, b in sent]
    assert sorted(zip(keys.tolist(), rows.tolist(), strict=True)) == sorted(zip(*(np.concatenate(x).tolist() for x in zip(*back, strict=True)), strict=True))
    assert [of for of, *_ in sent] == list(range(64))
    assert all((st.range_of(k, 64) == of).all() for (of, *_), (k, _) in zip(sent, back, strict=True))
    size = sum(len(pa.compress(x, "lz4", asbytes=True)) for _, *parts in sent for x in parts)
    assert size < 9 * len(keys)  # 16 bytes as two numbers
    assert list(st.blocks(keys[:0], rows[:0], 64)) == []


def test_ranges_are_the_same_on_columns(spark):
    keys = [0, 1, -1, 1 << 62, -(1 << 63), (1 << 63) - 1, st.word_id(b"a"), st.word_id(b"b")]
    got = [r[0] for r in spark.createDataFrame([(k,) for k in keys], "key long").coalesce(1).select(st._range_of(77)).collect()]
    assert got == st.range_of(np.array(keys), 77).tolist()


def test_state_sums():
    asked = list(st.blocks(np.array([5, 9, 5, -7, 9]), np.array([0, 0, 1, 2, 2]), 1))
    table = pa.table({"row": [100], "span": [0], "keys": [asked[0][1]], "rows": [asked[0][2]]})
    got = st._state_sums(table, pa.table({"key": [9, 5], "value": [0.5, 2.0]}))
    assert dict(zip(*(c.to_pylist() for c in got.columns), strict=True)) == {100: 2.5, 101: 2.0, 102: 0.5}
    nothing = pa.table({"key": pa.array([], pa.int64()), "value": pa.array([], pa.float64())})
    assert st._state_sums(table, nothing).num_rows == 0 and st._state_sums(table.slice(0, 0), nothing).num_rows == 0


def test_counting_sequences_holds_little_memory():
    rng = np.random.default_rng(4)
    texts = [b" ".join(b"w%d" % x for x in rng.integers(0, 50_000, 50_000)) for _ in range(70)]
    words = [b"w%d" % i for i in range(50_000)] + [st.END]
    tree = st.Tree(words, np.ones(len(words), np.int64), len(words), len(words))
    batches = [pa.RecordBatch.from_pydict({"text": texts})]
    tracemalloc.start()
    n = sum(int(np.sum(b.column("n").to_numpy())) for b in tree.pair_counter(0, np.full(1 << 21, -1, np.int64))(batches))
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert n == 70 * 50_000
    assert most < 220
