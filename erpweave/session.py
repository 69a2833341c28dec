"""Session settings and the shared work folder.

The library never assumes it owns the session: operators read what they need
from the session they are given. ``build_session`` is for tests, the bench and
interactive use.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Largest plan-estimated size that an operator may broadcast explicitly.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "erpweave", cpus: int | None = None, **conf: str) -> SparkSession:
    """Local session with the settings the library is tuned for."""
    cores = cpus or os.cpu_count() or 4
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Split a hot join key even where that costs the following aggregation a shuffle.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        # Parquet expands several times in memory: estimate by that, or sides that are small
        # on disk only get broadcast.
        .config("spark.sql.sources.fileCompressionFactor", "3.0")
        # Hash instead of sort a join whose measured partitions all fit this size.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared checkpoint folder of the session.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local
    session without one gets a temporary folder; on a cluster a machine-local
    folder would be lost with its executor, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = current.get() if current.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="erpweave-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/erpweave/{label}-{uuid.uuid4().hex}"


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate for the optimized plan of ``df``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries built and run inside remove their shuffle files at their end, not when the driver next collects garbage."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def materialize(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where one result feeds several consumers: it cuts the lineage and, as
    a written table, survives the loss of executors. What was shuffled for it is freed.
    """
    path = work_folder(df.sparkSession, label)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)
