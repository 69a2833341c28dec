"""Upserts, change application and change capture."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from erpweave.operators import maintenance as M
from erpweave.plans import purchasing_lakehouse as L
from erpweave.queries.oracle import twin
from erpweave.queries.registry import Tables, query
from erpweave.session import work_folder
from erpweave.sources.tables import bronze_append

# Target: what events said before a date; source: everything after it.
_CUT = "2024-01-16"
_STATE = "user_id, event_id, event_type, value"


def _state(t: Tables):
    return t.source("events").select("user_id", "event_id", "event_type", "value", "ts")


def _before(t: Tables):
    cut = F.lit(_CUT).cast("timestamp_ntz")
    rows = _state(t).filter(F.col("ts") < cut).drop("ts")
    return M.latest_per_key(rows, ["user_id"], "event_id")


def _after(t: Tables):
    return _state(t).filter(F.col("ts") >= F.lit(_CUT).cast("timestamp_ntz")).drop("ts")


_LATEST = f"SELECT {_STATE} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1"
_BEFORE = f"SELECT {_STATE} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events WHERE ts < TIMESTAMP '{_CUT}') WHERE rn = 1"


@query("merge_upsert", _LATEST)
def merge(t: Tables):
    return M.merge_upsert(_before(t), _after(t), ["user_id"], "event_id")


@query("merge_versioned_table", _LATEST)
def merge_table(t: Tables):
    """The table by stream batches; the last one is repeated."""
    path = work_folder(t.spark, "merge-table")
    M.upsert_table(_before(t), path, ["user_id"], "event_id", buckets=1, load="s-0")
    for _ in range(2):
        table = M.upsert_table(_after(t), path, ["user_id"], "event_id", buckets=1, load="s-1")
    return table


@query("merge_touched_buckets", _LATEST)
def merge_buckets(t: Tables):
    path = work_folder(t.spark, "merge-buckets")
    M.upsert_table(_before(t), path, ["user_id"], "event_id", buckets=16)
    M.upsert_table(_after(t), path, ["user_id"], "event_id", buckets=16)
    return M.upsert_table(_after(t), path, ["user_id"], "event_id", buckets=16)


@query("silver_refresh_slice", twin("""WITH c AS (SELECT ebeln, bukrs, lifnr, CAST(try_strptime(bedat, '%Y%m%d') AS DATE) AS bedat,
    CAST(netwr AS DECIMAL(15,2)) AS netwr, waers, CAST('20240101' AS VARCHAR) AS load FROM ekko WHERE bedat < '19990101' AND ebeln IS NOT NULL
    UNION ALL SELECT ebeln, bukrs, lifnr, CAST(try_strptime(bedat, '%Y%m%d') AS DATE), CAST(netwr + 10 AS DECIMAL(15,2)), waers, '20240102'
    FROM ekko WHERE bedat >= '19980101' AND ebeln IS NOT NULL)
    SELECT ebeln, bukrs, lifnr, bedat, netwr, waers FROM (SELECT *, row_number() OVER (PARTITION BY ebeln ORDER BY load DESC) AS rn FROM c) WHERE rn = 1"""))
def refresh_slice(t: Tables):
    orders = t.raw("ekko").select("ebeln", "bukrs", "lifnr", "bedat", "netwr", "waers")
    bronze = work_folder(t.spark, "slice-bronze")
    bronze_append(orders.filter(F.col("bedat") < "19990101"), bronze, "ekko", "20240101", "ERP")
    late = orders.filter(F.col("bedat") >= "19980101").withColumn("netwr", F.col("netwr") + 10)
    bronze_append(late, bronze, "ekko", "20240102", "ERP")
    path = work_folder(t.spark, "slice-silver")
    partitioned = StructType([*orders.schema.fields, StructField("_partition_date", StringType())])
    landed = t.spark.read.schema(partitioned).parquet(bronze)
    for day in ("20240101", "20240102"):
        silver = M.upsert_table(L.silver_slice(landed, day).select(orders.columns), path, ["ebeln"], buckets=8, load=day)
    return silver


_KIND = "CASE WHEN event_type = 'signup' THEN 'DEL' WHEN event_type = 'error' THEN 'BIM' ELSE 'AIM' END"


@query("apply_changes_image", f"""WITH b AS ({_BEFORE}), c AS (SELECT {_STATE}, {_KIND} AS change_type FROM events WHERE ts >= TIMESTAMP '{_CUT}'),
    l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM c WHERE change_type <> 'BIM') WHERE rn = 1)
    SELECT {_STATE} FROM b WHERE user_id NOT IN (SELECT user_id FROM l)
    UNION ALL SELECT {_STATE} FROM l WHERE change_type <> 'DEL'""")
def images(t: Tables):
    kind = F.when(F.col("event_type") == "signup", "DEL").when(F.col("event_type") == "error", "BIM").otherwise("AIM")
    return M.apply_images(_before(t), _after(t).withColumn("change_type", kind), ["user_id"], "event_id")


@query("apply_changes_additive", f"""SELECT user_id, CAST(sum(v) AS DECIMAL(17,2)) AS value FROM
    (SELECT user_id, CAST(value AS DECIMAL(17,2)) AS v FROM ({_BEFORE}) UNION ALL
     SELECT user_id, CAST(value AS DECIMAL(17,2)) * CASE WHEN event_type IN ('error', 'signup') THEN -1 ELSE 1 END FROM events
     WHERE ts >= TIMESTAMP '{_CUT}') GROUP BY user_id""")
def additive(t: Tables):
    kind = F.when(F.col("event_type") == "error", "ABR").when(F.col("event_type") == "signup", "BIM").otherwise("ADD")
    return M.apply_additive(
        _before(t), _after(t).withColumn("change_type", kind), ["user_id"], {"value": "decimal(17,2)"}
    )


# Two states of the order table: urgent orders are new, low ones are gone, processing ones
# were finished and high ones repriced.
_OLD = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderpriority <> '1-URGENT'"
_NEW = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
    FROM orders WHERE o_orderpriority <> '5-LOW'"""


def _snapshots(t: Tables):
    priority = F.col("o_orderpriority")
    rows = t.source("orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    new = rows.filter(priority != "5-LOW").withColumns({
        "o_orderstatus": F.when(F.col("o_orderstatus") == "P", "F").otherwise(F.col("o_orderstatus")),
        "o_totalprice": F.when(priority == "2-HIGH", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
    })
    return rows.filter(priority != "1-URGENT").drop("o_orderpriority"), new.drop("o_orderpriority")


@query("snapshot_change_feed", f"""WITH o AS ({_OLD}), n AS ({_NEW}),
    u AS (SELECT o.o_orderkey FROM o JOIN n ON o.o_orderkey = n.o_orderkey
          WHERE o.o_orderstatus <> n.o_orderstatus OR o.o_totalprice <> n.o_totalprice)
    SELECT o_orderkey, 'delete' AS change_type, o_orderstatus, o_totalprice FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM n)
    UNION ALL SELECT o_orderkey, 'insert', o_orderstatus, o_totalprice FROM n WHERE o_orderkey NOT IN (SELECT o_orderkey FROM o)
    UNION ALL SELECT o_orderkey, 'update_pre', o_orderstatus, o_totalprice FROM o WHERE o_orderkey IN (SELECT o_orderkey FROM u)
    UNION ALL SELECT o_orderkey, 'update_post', o_orderstatus, o_totalprice FROM n WHERE o_orderkey IN (SELECT o_orderkey FROM u)""")
def feed(t: Tables):
    old, new = _snapshots(t)
    return M.snapshot_changes(old, new, ["o_orderkey"])


@query("field_change_log", f"""WITH o AS ({_OLD}), n AS ({_NEW}), j AS (SELECT o.o_orderkey, o.o_orderstatus AS s0, n.o_orderstatus AS s1,
    CAST(CAST(o.o_totalprice AS DECIMAL(17,2)) AS VARCHAR) AS p0, CAST(CAST(n.o_totalprice AS DECIMAL(17,2)) AS VARCHAR) AS p1
    FROM o JOIN n ON o.o_orderkey = n.o_orderkey)
    SELECT o_orderkey, 'o_orderstatus' AS field, s0 AS value_old, s1 AS value_new FROM j WHERE s0 <> s1
    UNION ALL SELECT o_orderkey, 'o_totalprice', p0, p1 FROM j WHERE p0 <> p1""")
def fields(t: Tables):
    old, new = (df.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(17,2)")) for df in _snapshots(t))
    return M.field_changes(old, new, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])
