from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from frames import rows
from erpweave.operators import maintenance as M
from erpweave.session import work_folder


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, ver int")


@pytest.fixture
def source(spark):
    return spark.createDataFrame([(2, "B", 2), (3, "c", 2), (3, "C", 3)], "k int, v string, ver int")


def test_merge_is_idempotent(target, source):
    once = M.merge_upsert(target, source, ["k"], "ver")
    assert rows(once) == [(1, "a", 1), (2, "B", 2), (3, "C", 3)]
    assert rows(M.merge_upsert(once, source, ["k"], "ver")) == rows(once)


def test_images_and_additive(spark, target):
    log = spark.createDataFrame(
        [(1, "x", 5, "BIM"), (1, "y", 6, "AIM"), (2, "b", 7, "DEL"), (4, "n", 8, "AIM")],
        "k int, v string, ver int, change_type string",
    )
    assert rows(M.apply_images(target, log, ["k"], "ver")) == [(1, "y", 6), (4, "n", 8)]
    stock = spark.createDataFrame([("m", 10.0)], "k string, q double")
    moves = spark.createDataFrame([("m", 5.0, "ADD"), ("m", 2.0, "ABR"), ("n", 1.0, "ADD")], "k string, q double, change_type string")
    out = M.apply_additive(stock, moves, ["k"], {"q": "decimal(9,1)"})
    assert [(k, float(q)) for k, q in rows(out)] == [("m", 13.0), ("n", 1.0)]


def test_snapshot_feed_rebuilds_the_new_snapshot(target, source):
    new = M.merge_upsert(target, source, ["k"], "ver").filter(F.col("k") != 1)
    feed = M.snapshot_changes(target, new, ["k"])
    kinds = sorted(r["change_type"] for r in feed.collect())
    assert kinds == ["delete", "insert", "update_post", "update_pre"]
    gone = feed.filter(F.col("change_type") == "delete").select("k")
    alive = feed.filter(F.col("change_type").isin("insert", "update_post")).select(*target.columns)
    rebuilt = M.merge_upsert(target, alive, ["k"]).join(gone, "k", "left_anti")
    assert rows(rebuilt) == rows(new)


def test_snapshot_feed_with_a_key_repeated_many_times(spark):
    # A third of the old rows share one key: no pair of rows is ever formed.
    old = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.lit("x").alias("v"))
    new = old.withColumn("v", F.when(F.col("k") == 0, "y").otherwise(F.col("v")))
    feed = M.snapshot_changes(old, new, ["k"])
    assert feed.count() == 2000 and feed.distinct().count() == 2
    assert rows(feed.distinct()) == [(0, "update_post", "y"), (0, "update_pre", "x")]


def test_field_changes(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 5)], "k int, s string, n int")
    new = spark.createDataFrame([(1, "a", 3), (2, "c", 5), (3, "z", 1)], "k int, s string, n int")
    assert rows(M.field_changes(old, new, ["k"], ["s", "n"])) == [(1, "n", None, "3"), (2, "s", "b", "c")]


def _upsert(path, df, **options):
    return M.upsert_table(df, path, ["k"], "ver", buckets=4, **options)


def test_a_repeated_batch_changes_nothing(spark, target, source):
    path = work_folder(spark, "t")
    want = rows(M.merge_upsert(target, source, ["k"], "ver"))
    _upsert(path, target, load="s-0")
    assert rows(_upsert(path, source, load="s-1")) == want
    assert rows(_upsert(path, source, load="s-1")) == want
    assert rows(_upsert(path, source, load="s-2")) == want
    assert rows(_upsert(path, source)) == want


def test_a_new_checkpoint_is_a_new_stream(spark, target, source):
    path = work_folder(spark, "t")
    _upsert(path, target, load="old-0")
    # Numbers start again, rows must not be lost.
    assert rows(_upsert(path, source, load="new-0")) == rows(M.merge_upsert(target, source, ["k"], "ver"))


def test_a_crash_before_the_merge_is_written_leaves_the_table(spark, target, source, monkeypatch):
    path = work_folder(spark, "t")
    want = rows(_upsert(path, target, load="s-0"))
    broken = source.withColumn("v", F.raise_error(F.lit("crash")).cast("string"))
    with pytest.raises(Exception, match="crash"):
        _upsert(path, broken, load="s-1")
    assert rows(spark.read.parquet(path).drop(M.BUCKET)) == want
    assert rows(_upsert(path, source, load="s-1")) == rows(M.merge_upsert(target, source, ["k"], "ver"))


def test_a_crash_amid_the_replacement_is_mended_by_the_same_load(spark, target, source, monkeypatch):
    path = work_folder(spark, "t")
    many = target.unionByName(spark.range(100, 200).selectExpr("cast(id AS int) AS k", "'m' AS v", "1 AS ver"))
    _upsert(path, many, load="s-0")

    def crash(df, place, *_, **__):
        hit = source.select(F.pmod(F.xxhash64("k"), F.lit(4))).first()[0]
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{place}/{M.BUCKET}={hit}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        raise RuntimeError("crash")

    with monkeypatch.context() as patch:
        patch.setattr(M, "overwrite_partitions", crash)
        with pytest.raises(RuntimeError):
            _upsert(path, source, load="s-1")
    want = rows(M.merge_upsert(many, source, ["k"], "ver"))
    assert spark.read.parquet(path).count() < len(want)
    assert rows(_upsert(path, source, load="s-1")) == want


def test_upserts_replace_touched_buckets_only(spark, source):
    many = spark.range(1000).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v"), F.lit(1).alias("ver"))
    path = work_folder(spark, "b")
    M.upsert_table(many, path, ["k"], buckets=8)

    def files():
        read = spark.read.parquet(path).groupBy(M.BUCKET).agg(F.collect_set("_metadata.file_path").alias("f"))
        return {r[0]: sorted(r[1]) for r in read.collect()}

    before = files()
    table = M.upsert_table(source.filter("k = 2"), path, ["k"], "ver", buckets=8)
    after = files()
    assert table.count() == 1000 and rows(table.filter("k = 2")) == [(2, "B", 2)]
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1


def test_upserts_of_no_rows_and_of_own_names(spark, target):
    path = work_folder(spark, "e")
    assert _upsert(path, target.limit(0)).count() == 0
    assert rows(_upsert(path, target)) == rows(target) == rows(_upsert(path, target.limit(0)))
    with pytest.raises(ValueError):
        _upsert(path, target.withColumn(M.BUCKET, F.lit(1)))


def test_snapshot_feed_keeps_every_row_of_a_repeated_key(spark):
    old = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "x")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (1, "c"), (2, "x"), (2, "y")], "k int, v string")
    assert rows(M.snapshot_changes(old, new, ["k"])) == [
        (1, "delete", "b"), (1, "update_post", "c"), (1, "update_pre", "a"), (2, "insert", "y")]
