"""Lines without surprises are read once; the map of all fields is made for the others only."""

from __future__ import annotations

import re

from pyspark.sql.types import StructType

from erpweave.sources.files import parse_with_rescue

LINES = {
    '{"a":"1","n":2.5}': ("1", 2.5, None), '{"a":"1"}': ("1", None, None), "{}": (None, None, None),
    '{"a":null,"n":null}': (None, None, None), '{"a":"1","z":3}': ("1", None, '{"z":"3"}'),
    '{"n":"x"}': (None, None, '{"n":"x"}'), '{"a":"1","a":"2"}': ("1", None, None), '{"a":"1"': (None, None, '{"a":"1"'),
    '{"a":"tab\there"}': (None, None, '{"a":"tab\there"}'), '{"_broken":"x"}': (None, None, '{"_broken":"x"}'),
    "{'a':'q'}": ("q", None, None), '{"a":{"k":[1]}}': ('{"k":[1]}', None, None), "[1]": (None, None, "[1]"),
}


def test_rows_and_what_is_rescued(spark):
    lines = spark.createDataFrame([(text,) for text in LINES], "value string")
    got = parse_with_rescue(lines, StructType.fromDDL("a string, n double")).collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, LINES.values()))


def test_the_map_of_all_fields_is_made_under_a_condition(spark):
    lines = spark.createDataFrame([("{}",)], "value string")
    plan = parse_with_rescue(lines, StructType.fromDDL("a string, n double"))._jdf.queryExecution().optimizedPlan().toString()
    maps = [m.start() for m in re.finditer(r"from_json\(MapType", plan)]
    assert maps and all("CASE WHEN" in plan[plan.rindex("struct(", 0, at):at] for at in maps)
