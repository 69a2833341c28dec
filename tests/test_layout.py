"""Space-filling layouts: bounds, ranks, and files that a filter can skip."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from erpweave import crosswalk
from erpweave.plans import purchasing_lakehouse as L
from erpweave.session import work_folder
from erpweave.sources.layout import curve_layout, interleaved, rank_among, value_bounds
from erpweave.sources.tables import range_layout
from frames import rows


def _skew(spark, n=4000):
    """A third of the rows share one plant and one date; NULLs in both."""
    return spark.range(n).select(
        "id",
        F.when(F.col("id") % 3 == 0, "P050").when(F.col("id") % 101 == 0, None).otherwise(
            F.format_string("P%03d", F.pmod(F.xxhash64("id"), F.lit(100)))).alias("plant"),
        F.when(F.col("id") % 3 == 1, F.lit("2020-06-01").cast("date")).when(F.col("id") % 97 == 0, None).otherwise(
            F.date_add(F.lit("2015-01-01"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3000)).cast("int"))).alias("day"),
    )


def test_bounds_cut_rows_evenly_for_any_type(spark):
    df = _skew(spark).withColumn("number", F.col("id").cast("decimal(12,2)"))
    for column in ("plant", "day", "number"):
        bounds = value_bounds(df, column, 16)
        assert bounds == sorted(set(bounds)) and 4 <= len(bounds) < 16
        sizes = dict(df.where(f"{column} IS NOT NULL").groupBy(rank_among(F.col(column), bounds, 4).alias("r")).count().collect())
        biggest = max(sizes.values())
        held = df.groupBy(column).count().where(f"{column} IS NOT NULL").agg(F.max("count")).first()[0]
        assert biggest <= held + 2 * df.count() // 16
    assert value_bounds(df.where("plant IS NULL"), "plant", 16) == []
    assert value_bounds(df.limit(1), "id", 16) == []


def test_rank_counts_the_bounds_not_above_a_value(spark):
    bounds = ["b", "d", "dd", "f", "g"]
    values = ["", "a", "b", "c", "d", "dc", "dd", "e", "f", "g", "z", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = dict(df.select("v", rank_among(F.col("v"), bounds, 3).alias("r")).collect())
    assert got == {v: 0 if v is None else sum(b <= v for b in bounds) for v in values}


def test_key_interleaves_bits(spark):
    df = spark.createDataFrame([(x, y) for x in range(8) for y in range(8)], "x long, y long")
    for r in df.select("x", "y", interleaved([F.col("x"), F.col("y")], 3).alias("k")).collect():
        assert r.k == sum(((r.x >> b) & 1) << (2 * b) | ((r.y >> b) & 1) << (2 * b + 1) for b in range(3))
    with pytest.raises(ValueError):
        interleaved([F.col("x")] * 8, 8)


def _files_to_read(path: str, column: str, value) -> tuple[int, int]:
    """Files whose statistics cannot exclude the value, of all files."""
    names = glob.glob(f"{path}/*.parquet")
    hits = 0
    for name in names:
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.to_arrow_schema().get_field_index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            if stats is None or (stats.has_min_max and stats.min <= value <= stats.max):
                hits += 1
                break
    return hits, len(names)


def test_a_filter_on_either_column_reads_a_minority_of_the_files(spark):
    df = _skew(spark, 20_000)
    base = work_folder(spark, "curve")
    curve_layout(df, ["day", "plant"], 32).write.parquet(f"{base}/curve")
    range_layout(df, ["day", "plant"], 32).write.parquet(f"{base}/range")
    assert rows(spark.read.parquet(f"{base}/curve")) == rows(df)
    import datetime

    for column, value in (("plant", "P017"), ("plant", "P083"), ("day", datetime.date(2016, 5, 5)), ("day", datetime.date(2021, 2, 2))):
        hits, files = _files_to_read(f"{base}/curve", column, value)
        assert files >= 24 and hits < files / 2, (column, value, hits, files)
    # What the layout by ranges of the first column cannot do.
    hits, files = _files_to_read(f"{base}/range", "plant", "P017")
    assert hits > files / 2


def test_layout_of_the_fact_and_of_nothing(spark, folder):
    fact = L.gold_po_fact(
        L.typed_item(crosswalk.bronze(spark, folder, "ekpo")), L.typed_header(crosswalk.bronze(spark, folder, "ekko")),
        crosswalk.bronze(spark, folder, "lfa1"), crosswalk.bronze(spark, folder, "makt").filter("spras = 'P'"))
    assert rows(curve_layout(fact, ["order_date", "plant"], 8)) == rows(fact)
    assert curve_layout(fact.limit(0), ["order_date", "plant"]).count() == 0


def test_fact_table_replaces_touched_months_and_prunes(spark, folder):
    fact = L.gold_po_fact(
        L.typed_item(crosswalk.bronze(spark, folder, "ekpo")), L.typed_header(crosswalk.bronze(spark, folder, "ekko")),
        crosswalk.bronze(spark, folder, "lfa1"), crosswalk.bronze(spark, folder, "makt").filter("spras = 'P'"))
    path = work_folder(spark, "po-fact")
    L.write_po_fact(fact, path)
    first = L.read_po_fact(spark, path, fact.schema)
    before = {(r.order_year, r.order_month): r.at for r in first.groupBy("order_year", "order_month").agg(F.max("_updated_at").alias("at")).collect()}
    L.write_po_fact(fact.filter("order_year = 1996 AND order_month = 3"), path)
    again = L.read_po_fact(spark, path, fact.schema)
    after = {(r.order_year, r.order_month): r.at for r in again.groupBy("order_year", "order_month").agg(F.max("_updated_at").alias("at")).collect()}
    assert {k for k in after if after[k] != before[k]} == {(1996, 3)}
    assert rows(again.drop("_updated_at").select(fact.columns)) == rows(fact)
    plan = again.filter("order_year = 1996")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan


def test_layout_makes_its_rows_once_and_sorts_by_columns(spark):
    """What the rows are made of is worked out once; no rank is worked out per use or per comparison."""
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    df = _skew(spark, 3000)
    laid = curve_layout(df.mapInArrow(seen, df.schema), ["day", "plant"], 8)
    assert rows(laid) == rows(df) and laid.columns == df.columns
    assert made.value == 3000
    plan = laid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 2
    # Names of working columns that the input has.
    own = df.withColumns({"_key": F.lit(1), "_spread": F.lit(2), "_rank0": F.lit(3)})
    assert rows(curve_layout(own, ["day"], 4)) == rows(own)
