"""Data-quality operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from erpweave.operators import quality as Q
from erpweave.operators.rows import append_rows
from erpweave.queries.oracle import twin
from erpweave.queries.registry import Tables, query

_PO_RULES = [
    Q.Rule("has_vendor", "lifnr IS NOT NULL"),
    Q.Rule("sane_date", "bedat >= '19960101'"),
    Q.Rule("large_value", "netwr >= 1000", "warn"),
]
_PO_TESTS = "lifnr IS NOT NULL AND bedat >= '19960101'"


@query("expect_or_drop", twin("SELECT kunnr, name1 FROM kna1 WHERE kunnr IS NOT NULL"))
def drop(t: Tables):
    return Q.expect(t.raw("kna1"), [Q.Rule("valid_kunnr", "kunnr IS NOT NULL")]).select("kunnr", "name1")


@query("expect_multi", twin("SELECT vbeln, posnr, netwr FROM vbap WHERE vbeln IS NOT NULL AND posnr IS NOT NULL AND fkrel <> ' '"))
def multi(t: Tables):
    rules = [
        Q.Rule("valid_vbeln", "vbeln IS NOT NULL"), Q.Rule("valid_posnr", "posnr IS NOT NULL"),
        Q.Rule("billing_relevant", "fkrel <> ' '"),
    ]
    return Q.expect(t.raw("vbap"), rules).select("vbeln", "posnr", "netwr")


@query("expect_warn_metrics", twin("""SELECT 'has_vendor' AS rule, 'drop' AS action,
    count(*) FILTER (lifnr IS NOT NULL) AS passed, count(*) FILTER (lifnr IS NULL) AS failed FROM ekko
    UNION ALL SELECT 'sane_date', 'drop', count(*) FILTER (bedat >= '19960101'), count(*) FILTER (NOT bedat >= '19960101') FROM ekko
    UNION ALL SELECT 'large_value', 'warn', count(*) FILTER (netwr >= 1000), count(*) FILTER (NOT netwr >= 1000) FROM ekko"""))
def metrics(t: Tables):
    return Q.rule_metrics(t.raw("ekko"), _PO_RULES)


@query("quality_profile", twin("""WITH p AS (SELECT mandt, lifnr, CAST(netwr AS DECIMAL(17,2)) - 5000 AS netwr,
    CAST(try_strptime(bedat, '%Y%m%d') AS DATE) AS bedat FROM ekko),
    n AS (SELECT count(*) AS total_rows, count(DISTINCT mandt) AS clients, count(*) FILTER (lifnr IS NULL) AS null_keys,
    count(*) FILTER (netwr < 0) AS negative_amounts, count(*) FILTER (bedat > DATE '2001-01-01') AS future_dates,
    count(*) FILTER (bedat < DATE '1996-01-01') AS old_dates FROM p)
    SELECT total_rows, clients, null_keys, negative_amounts, future_dates, old_dates,
    CAST(null_keys * 100.0 / total_rows AS DECIMAL(9,2)) AS null_key_pct,
    CAST((1 - CAST(null_keys + negative_amounts + future_dates + old_dates AS DOUBLE) / total_rows) * 100 AS DECIMAL(9,1)) AS quality_score
    FROM n"""))
def profile(t: Tables):
    rows = t.raw("ekko").select(
        "mandt", "lifnr", (F.col("netwr").cast("decimal(17,2)") - 5000).alias("netwr"),
        F.try_to_date("bedat", "yyyyMMdd").alias("bedat"),
    )
    result = Q.quality_profile(rows, "lifnr", "netwr", "bedat", F.lit("2001-01-01").cast("date"), "1996-01-01")
    return result.withColumns({
        "null_key_pct": F.col("null_key_pct").cast("decimal(9,2)"),
        "quality_score": F.col("quality_score").cast("decimal(9,1)"),
    })


@query("reconcile_totals", """WITH s AS (SELECT count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(17,2))) AS v FROM orders),
    t AS (SELECT count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(17,2))) AS v FROM orders WHERE o_orderpriority <> '5-LOW')
    SELECT s.n AS source_count, t.n AS target_count, CAST(s.v AS DECIMAL(38,2)) AS source_total,
    CAST(t.v AS DECIMAL(38,2)) AS target_total, abs(s.n - t.n) AS delta_count,
    CAST(abs(s.v - t.v) AS DECIMAL(38,2)) AS delta_total, (s.n = t.n AND abs(s.v - t.v) <= 0.01) AS consistent FROM s, t""")
def reconcile(t: Tables):
    orders = t.source("orders")
    return Q.reconcile(orders, orders.filter(F.col("o_orderpriority") != "5-LOW"), "o_totalprice")


@query("grain_check", """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def grain(t: Tables):
    return Q.grain_violations(t.source("lineitem"), ["l_orderkey", "l_linenumber"])


@query("schema_conformance", """SELECT 'o_orderkey' AS "column", 'bigint' AS expected, 'bigint' AS actual, 'ok' AS verdict,
        count(*) FILTER (o_orderkey IS NOT NULL AND try_cast(o_orderkey AS BIGINT) IS NULL) AS bad_values FROM orders
    UNION ALL SELECT 'o_orderstatus', 'int', 'string', 'type', count(*) FILTER (o_orderstatus IS NOT NULL AND try_cast(o_orderstatus AS INTEGER) IS NULL) FROM orders
    UNION ALL SELECT 'clerk', 'int', 'string', 'type', count(*) FILTER (o_custkey % 3 <> 0) FROM orders
    UNION ALL SELECT 'o_currency', 'string', NULL, 'missing', NULL
    UNION ALL SELECT 'o_custkey', NULL, 'bigint', 'unexpected', NULL""")
def conformance(t: Tables):
    expected = StructType.fromDDL("o_orderkey bigint, o_orderstatus int, clerk int, o_currency string")
    code = F.when(F.col("o_custkey") % 3 == 0, F.col("o_custkey").cast("string")).otherwise("none").alias("clerk")
    return Q.schema_conformance(t.source("orders").select("o_orderkey", "o_custkey", "o_orderstatus", code), expected)


_STATUS = """CASE WHEN lifnr IS NULL OR NOT coalesce(bedat >= '19960101', FALSE) THEN 'E' WHEN NOT netwr >= 1000 THEN 'W' ELSE 'S' END"""


@query("row_status_log", twin(f"""SELECT ebeln, {_STATUS} AS status, CASE WHEN lifnr IS NULL THEN 'has_vendor'
    WHEN NOT coalesce(bedat >= '19960101', FALSE) THEN 'sane_date' WHEN NOT netwr >= 1000 THEN 'large_value' ELSE '' END AS message
    FROM ekko"""))
def status(t: Tables):
    return Q.row_status(t.raw("ekko"), _PO_RULES).select("ebeln", "status", "message")


@query("first_error_message", """SELECT user_id, arg_min(concat(event_type, '#', CAST(event_id AS STRING)), event_id) AS message
    FROM events WHERE event_type IN ('error', 'view') GROUP BY user_id""")
def first_error(t: Tables):
    log = t.source("events").select(
        "user_id", "event_id", F.concat_ws("#", "event_type", F.col("event_id").cast("string")).alias("message"),
        F.when(F.col("event_type") == "error", "E").when(F.col("event_type") == "view", "A").otherwise("W").alias("type"),
    )
    return Q.first_error_message(log, ["user_id"], "event_id")


@query("prevalidate_existing", """SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
    AND o_orderstatus = 'P') THEN 'SKIP' ELSE 'NEW' END AS status FROM customer""")
def prevalidate(t: Tables):
    known = t.source("orders").filter(F.col("o_orderstatus") == "P")
    return Q.prevalidate_existing(t.source("customer").select("c_custkey"), known, {"c_custkey": "o_custkey"})


@query("reprocess_failed", """WITH last AS (SELECT user_id, arg_max(event_type, event_id) AS s FROM events GROUP BY user_id)
    SELECT c_custkey, c_name FROM customer JOIN last ON user_id = c_custkey WHERE s = 'error'""")
def reprocess(t: Tables):
    log = t.source("events").select(
        F.col("user_id").alias("c_custkey"), F.col("event_id").alias("run"),
        F.when(F.col("event_type") == "error", "E").otherwise("S").alias("status"),
    )
    return Q.failed_rows(t.source("customer").select("c_custkey", "c_name"), log, ["c_custkey"])


@query("append_inline_rows", twin("""SELECT ebeln, lifnr, bedat FROM ekko
    UNION ALL VALUES ('4500000001', 'FORN001', NULL), ('4500000002', 'FORN002', '20240101')"""))
def append(t: Tables):
    return append_rows(t.raw("ekko").select("ebeln", "lifnr", "bedat"), [
        {"ebeln": "4500000001", "lifnr": "FORN001"},
        {"ebeln": "4500000002", "lifnr": "FORN002", "bedat": "20240101"},
    ])
