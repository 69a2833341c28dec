from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from frames import rows
from erpweave import functions as E


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "c string").select(column.alias("r")).first()[0]


@pytest.mark.parametrize("text, keep, null", [
    ("20240131", dt.date(2024, 1, 31), dt.date(2024, 1, 31)),
    ("00000000", None, None), ("99991231", dt.date(9999, 12, 31), None), ("20240230", None, None),
    ("", None, None), ("abc", None, None), (None, None, None),
])
def test_sap_date(spark, text, keep, null):
    assert one(spark, text, E.sap_date("c")) == keep
    assert one(spark, text, E.sap_date("c", open_end="null")) == null


def test_sap_date_rejects_unknown_mode():
    with pytest.raises(ValueError):
        E.sap_date("c", open_end="maybe")


@pytest.mark.parametrize("flag, blank, unset, set_", [
    ("", True, True, False), (None, True, True, False), ("X", False, False, True), (" ", False, True, False),
])
def test_flags(spark, flag, blank, unset, set_):
    assert one(spark, flag, E.is_blank("c")) is blank
    assert one(spark, flag, E.not_flag("c")) is unset
    assert one(spark, flag, E.flag_to_bool("c")) is set_


def test_code_label_default_and_blank(spark):
    label = E.code_label("c", {"": "none", "A": "first"}, "other")
    assert [one(spark, v, label) for v in (None, "", "A", "B")] == ["none", "none", "first", "other"]


@pytest.mark.parametrize("key, shown", [
    ("000000000000012345", "12345"), ("000000", ""), ("123", "123"), ("0A0", "A0"), (None, None),
])
def test_strip_leading_zeros(spark, key, shown):
    assert one(spark, key, E.strip_leading_zeros("c")) == shown


def test_hierarchy_level(spark):
    assert one(spark, "00001  0100001", E.hierarchy_level("c", 1)) == "00001"
    assert one(spark, "00001  0100001", E.hierarchy_level("c", 2)) == "010"


def test_decimals_round_half_up_and_survive_text(spark):
    df = spark.createDataFrame([(2.345, "x"), (-2.345, "1.005")], "d double, s string")
    assert rows(df.select(E.money("d"), E.quantity("s"))) == [
        (Decimal("-2.35"), Decimal("1.005")), (Decimal("2.35"), None)
    ]


def test_guarded_ratio_and_sign(spark):
    df = spark.createDataFrame([(5.0, 10.0, "S"), (5.0, 0.0, "H"), (5.0, None, None)], "a double, b double, s string")
    got = [tuple(r) for r in df.select(E.guarded_ratio("a", "b"), E.signed_amount("a", "s")).collect()]
    assert got == [(50.0, 5.0), (None, -5.0), (None, -5.0)]


def test_month_and_days(spark):
    df = spark.sql("SELECT DATE'2024-02-10' a, DATE'2024-03-01' b, CAST(NULL AS DATE) n")
    got = df.select(E.month_start("a"), E.days_between("a", "b"), E.days_between("a", "n")).first()
    assert tuple(got) == (dt.date(2024, 2, 1), 20, None)


def test_mask(spark):
    assert one(spark, "12345678000190", E.mask_tax_id("c")) == "12.***.***/***-**"
    assert one(spark, "12345678000190", E.mask_tax_id("c", True)) == "12345678000190"
    name = E.register_mask_udf(spark, "mask_test")
    assert spark.sql(f"SELECT {name}('99887', false), {name}('99887', true)").first()[:] == ("99.***.***/***-**", "99887")


def test_ranges(spark):
    O = E.SelectOption
    df = spark.createDataFrame([(c,) for c in "ABCDEFG"], "c string")
    include = [O("I", "BT", "B", "E"), O("I", "EQ", "G"), O("E", "EQ", "C"), O("E", "CP", "D*")]
    assert [r[0] for r in df.filter(E.in_ranges("c", include)).collect()] == ["B", "E", "G"]
    assert df.filter(E.in_ranges("c", [])).count() == 7
    assert df.filter(E.in_ranges("c", [O("E", "GT", "B")])).count() == 2
    with pytest.raises(ValueError):
        E.in_ranges("c", [O("I", "??", "B")])


def test_object_key(spark):
    assert one(spark, "5000000001", E.object_key("c", F.lit("2024"))) == "50000000012024"
