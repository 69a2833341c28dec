"""What a Python worker keeps from one operator to the next: executors share their memory with it."""

from __future__ import annotations

import random
import re
from pathlib import Path

import public_tokenizers
import pyarrow as pa
import pytest

from erpweave.llm import jaccard_join, packing, worker


def test_words_of_packing_go_with_the_next_operator():
    path = public_tokenizers.path(packing.TOKENIZER)
    table = pa.RecordBatch.from_pydict({"doc_id": [1], "text": [b"some words to keep"]})
    list(packing._cut(path, 4096, 1, False, pa.int64())([table]))
    assert packing._WORD_IDS[path].words
    worker.focus()
    assert not packing._WORD_IDS


def _private_mb() -> float:
    return sum(map(int, re.findall(r"\nPrivate_\w+:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory can't be read here")
def test_shingle_sets_hold_little_memory():
    draw = random.Random(7)
    words = [f"w{i}" for i in range(50_000)]
    texts = [" ".join(draw.choices(words, k=2_000)) for _ in range(1_500)]
    batches = [pa.RecordBatch.from_pydict({"doc_id": list(range(1_500)), "text": texts})]
    worker.focus()
    before = _private_mb()
    most = 0.0
    for _ in jaccard_join._sets(pa.int64())(batches):
        most = max(most, _private_mb())
    after = _private_mb()
    assert most - before < 40
    assert after - before < 20
