"""Small helpers that run inside Python workers, and bounded samples for fitting."""

from __future__ import annotations

import ctypes
import weakref
import zlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


_CACHES: list[weakref.ref] = []


def focus(*kept: Cache) -> None:
    """Empty every other cache: a worker that goes on to another operator starts with free memory."""
    for held in [ref() for ref in _CACHES]:
        if held is not None and not any(held is k for k in kept):
            held.clear()
    release()


def release() -> None:
    """Give memory that Python and Arrow have freed back to the system; idle workers and the JVM share the executor's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


class Cache(dict):
    """``make(key)`` remembered; emptied when it holds ``limit`` entries, so memory stays bounded.

    Kept in a module variable it lives as long as the Python worker and is only a speed-up.
    """

    def __init__(self, make: Callable, limit: int = 400_000):
        super().__init__()
        self.make, self.limit = make, limit
        _CACHES.append(weakref.ref(self, _CACHES.remove))

    def __hash__(self):
        return id(self)

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


def bucket(data: bytes, size: int) -> int:
    """Stable hash bucket (the same in every process)."""
    return zlib.crc32(data) % size


def bounded_sample(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """About ``rows`` rows of ``df`` (all, if there are fewer), chosen by the hash of the keys.

    Only for fitting classifiers; whatever is counted over the corpus uses all rows.
    """
    n = df.count()
    if n <= rows:
        return df
    cut = int((1 << 31) * rows / n)
    return df.where(F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit("sample")), F.lit(1 << 31)) < cut)

