"""Upserts, change application and change capture on plain Parquet tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from erpweave.operators.dedupe import first_per_key, latest_per_key
from erpweave.session import materialize
from erpweave.sources.tables import overwrite_partitions, stored_table


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], version: str | None = None) -> DataFrame:
    """Source rows replace target rows of the same key; new keys are added.

    The source is first reduced to one row per key (the latest by ``version``), so a key
    that changed very often costs one row. Merging the same source again changes nothing.
    """
    changes = latest_per_key(source, keys, version) if version else first_per_key(source, keys, [])
    kept = target.join(changes.select(*keys), list(keys), "left_anti")
    return kept.unionByName(changes.select(*target.columns))


def apply_images(snapshot: DataFrame, changes: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Apply after-images: per key the last change decides; before-images carry no state.

    ``changes`` has the columns of the snapshot plus ``change_type`` (AIM, BIM, DEL) and
    the sequence. A key whose last entry is DEL disappears.
    """
    last = latest_per_key(changes.filter(F.col("change_type") != "BIM"), keys, seq)
    untouched = snapshot.join(last.select(*keys), list(keys), "left_anti")
    alive = last.filter(F.col("change_type") != "DEL").select(*snapshot.columns)
    return untouched.unionByName(alive)


def apply_additive(
    balances: DataFrame, changes: DataFrame, keys: Sequence[str], values: Mapping[str, str]
) -> DataFrame:
    """Apply additive changes: ADD adds, ABR (reversal) and BIM subtract, AIM adds.

    ``values`` maps value columns to their decimal type. Sums commute, so no order is
    needed and everything combines before the shuffle.
    """
    sign = F.when(F.col("change_type").isin("ABR", "BIM"), F.lit(-1)).otherwise(F.lit(1))
    signed = changes.select(*keys, *[(F.col(v) * sign).cast(t).alias(v) for v, t in values.items()])
    start = balances.select(*keys, *[F.col(v).cast(t).alias(v) for v, t in values.items()])
    return (
        start.unionByName(signed).groupBy(*keys).agg(*[F.sum(v).cast(t).alias(v) for v, t in values.items()])
    )


def change_history(
    headers: DataFrame, positions: DataFrame, object_class: str, field: str, low: str, high: str
) -> DataFrame:
    """Old and new values of one field over a period, newest first."""
    header = headers.filter((F.col("objectclas") == object_class) & F.col("udate").between(low, high))
    position = positions.filter(F.col("fname") == field)
    return (
        header.join(position, ["mandt", "changenr"])
        .select("changenr", "objectid", "udate", "utime", "username", "tabname", "fname", "value_old", "value_new")
        .orderBy(F.desc("udate"), F.desc("utime"), "changenr", "objectid")
    )


def _paired(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key and occurrence the old and the new row (``_old``, ``_new``), where they differ.

    Equal rows of a key on both sides cancel out. What is left is paired in row order, so a key that a
    snapshot repeats loses no row; with unique keys that is the one old and the one new row.
    """
    values = [c for c in new.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in values])
    sides = old.select(*keys, F.lit(-1).alias("_n"), row.alias("_row")).unionByName(
        new.select(*keys, F.lit(1).alias("_n"), row.alias("_row"))
    )
    # Copies of a row are one entry with a count, combined before the shuffle.
    left = sides.groupBy(*keys, "_row").agg(F.sum("_n").alias("_n")).filter(F.col("_n") != 0)
    single = left.select(
        *keys, "_row", (F.col("_n") > 0).alias("_is_new"), F.explode(F.sequence(F.lit(1), F.abs("_n"))).alias("_copy")
    )
    place = F.row_number().over(Window.partitionBy(*keys, "_is_new").orderBy("_row", "_copy"))
    return single.withColumn("_place", place).groupBy(*keys, "_place").agg(
        F.max(F.when(~F.col("_is_new"), F.col("_row"))).alias("_old"),
        F.max(F.when(F.col("_is_new"), F.col("_row"))).alias("_new"),
    )


def snapshot_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change feed between two snapshots: insert, delete, update_pre and update_post rows."""

    def entry(kind: str, side: str):
        return F.struct(F.lit(kind).alias("change_type"), F.col(side).alias("_image"))

    images = F.when(F.col("_old").isNull(), F.array(entry("insert", "_new"))).when(
        F.col("_new").isNull(), F.array(entry("delete", "_old"))
    ).otherwise(F.array(entry("update_pre", "_old"), entry("update_post", "_new")))
    return _paired(old, new, keys).select(*keys, F.inline(images)).select(*keys, "change_type", "_image.*")


def field_changes(old: DataFrame, new: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Field-level log of updated keys: (keys, field, value_old, value_new) as text."""
    pairs = _paired(old.select(*keys, *fields), new.select(*keys, *fields), keys)
    entries = [
        F.struct(F.lit(f).alias("field"), F.col(f"_old.{f}").cast("string").alias("value_old"),
                 F.col(f"_new.{f}").cast("string").alias("value_new"))
        for f in fields
    ]
    return (
        pairs.filter(F.col("_old").isNotNull() & F.col("_new").isNotNull())
        .select(*keys, F.inline(F.array(*entries)))
        .filter(~F.col("value_old").eqNullSafe(F.col("value_new")))
    )


BUCKET = "key_bucket"


def _staged(spark: SparkSession, folder: str, load: str | None) -> bool:
    """Whether the merged rows of a load are there, complete."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    if load is None or not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        return False
    row = spark.read.schema("_load string").parquet(folder).first()
    return row is not None and row[0] == load


def upsert_table(
    source: DataFrame, path: str, keys: Sequence[str], order: str | None = None, buckets: int = 64,
    load: str | None = None,
) -> DataFrame:
    """Upsert into the Parquet table at ``path``, partitioned by a hash bucket of the key; returns the table.

    Only the buckets that the source touches are read, merged and replaced (dynamic partition overwrite); the first call
    creates the table, with the number of buckets to be kept from then on. Of several source rows of a key the latest by
    ``order`` counts, or the least by its columns.

    Merging the same rows again changes nothing. With ``load``, a name of the batch, the merged rows are also the way back
    from a crash: they are written beside the table before it is touched, and the same load called again replaces its
    partitions from them, so that rows of a partition that was being replaced are not lost.
    The load that failed is to be repeated before the next one, as a stream does. One writer at a time, and readers wait for
    it: tables with several belong to a table format.
    """
    spark = source.sparkSession
    if {BUCKET, "_load"} & set(source.columns):
        raise ValueError(f"{BUCKET} and _load are names of the table's own columns")
    schema = StructType([*source.schema.fields, StructField(BUCKET, IntegerType())])
    staging = f"{path}/_merged"  # readers of the table pass over names with an underscore
    if not _staged(spark, staging, load):
        bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")
        latest = latest_per_key(source, keys, order) if order else first_per_key(source, keys, [])
        # Written once: it names the buckets, removes old rows and supplies new ones.
        changes = materialize(latest.withColumn(BUCKET, bucket), "changes")
        target = stored_table(spark, path, schema)
        merged = changes
        if target is not None:
            touched = [r[0] for r in changes.select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
            same = [*keys, BUCKET]
            kept = target.where(F.col(BUCKET).isin(touched)).join(changes.select(*same), same, "left_anti")
            merged = kept.select(*schema.names).unionByName(changes)
        merged.withColumn("_load", F.lit(load).cast("string")).write.mode("overwrite").parquet(staging)
    overwrite_partitions(spark.read.schema(schema).parquet(staging), path, [BUCKET], only_touched=True)
    return spark.read.schema(schema).parquet(path).drop(BUCKET)
