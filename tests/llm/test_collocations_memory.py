"""What a worker holds while it makes transducers of a shard."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from erpweave.llm import collocations as co


class Everything:
    value = None

    def __call__(self, hashes):
        return np.ones(len(hashes), bool)


Everything.value = Everything()


@pytest.mark.parametrize("size", [0, 1, 5000])
def test_distinct_is_unique(size):
    keys = np.random.default_rng(size).integers(-50, 50, size)
    for got, want in zip(co.distinct(keys), np.unique(keys, return_inverse=True, return_counts=True), strict=True):
        assert got.tolist() == want.tolist()


def test_phrases_become_objects_one_range_at_a_time():
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 20_000, 2_000)) for _ in range(100)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 100, "text": [t.encode() for t in texts]})
    tracemalloc.start()
    n = sum(b.num_rows for b in co._shards(2, 4000, Everything, Everything)([batch]))
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert n > 3900
    assert most < 150
