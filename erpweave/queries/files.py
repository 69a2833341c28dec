"""Sources, sinks and streams: each query lands data derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from erpweave import crosswalk
from erpweave.datagen.specs import erp_tables
from erpweave.operators.quality import Rule, expect
from erpweave.plans import purchasing_lakehouse as L
from erpweave.plans.domain import dim_customer
from erpweave.plans.gold import tax_summary
from erpweave.plans.layers import silver_layer
from erpweave.plans.silver import silver_table
from erpweave.queries.models import TAX_SUMMARY
from erpweave.queries.oracle import twin
from erpweave.queries.registry import Tables, query
from erpweave.session import work_folder
from erpweave.sources import extraction, files, schemas, tables
from erpweave.streaming import ingest, state
from erpweave.streaming.metrics import rule_totals


# Rows of a packed file: such a file is read by one task.
_PACKED_ROWS = 1_000_000


def _land_json(df: DataFrame, path: str, mode: str = "append", packed: bool = False) -> None:
    # NULL fields are left out of the JSON lines, as extractors do.
    writer = df.write.mode(mode)
    if packed:
        # Field names are repeated in every line: packed, a whole table takes a small part of its text.
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", _PACKED_ROWS)
    writer.json(path)


def _even(key: str):
    return F.col(key).substr(-1, 1).isin("0", "2", "4", "6", "8")


@query("ingest_jsonl_stream", twin("SELECT vbeln, kunnr, audat, netwr FROM vbak"))
def jsonl_stream(t: Tables):
    base = work_folder(t.spark, "jsonl")
    rows = t.raw("vbak").select("vbeln", "kunnr", "audat", "netwr")
    schema = schemas.hinted_schema(rows.columns, "netwr DOUBLE")
    even = _even("kunnr")
    result = None
    for part in (rows.filter(even), rows.filter(~even)):
        _land_json(part, f"{base}/landing/vbak")
        result = ingest.ingest_table(t.spark, f"{base}/landing", f"{base}/bronze", f"{base}/checkpoints", "vbak", schema)
    return result.select(rows.columns)


@query("stream_restart", twin("SELECT count(*) AS landed, count(*) AS after_restart FROM vbak"))
def restart(t: Tables):
    base = work_folder(t.spark, "restart")
    rows = t.raw("vbak").select("vbeln", "kunnr")
    _land_json(rows, f"{base}/landing/vbak")
    schema = schemas.hinted_schema(rows.columns)

    def run(name: str) -> DataFrame:
        result = ingest.ingest_table(t.spark, f"{base}/landing", f"{base}/bronze", f"{base}/cp", "vbak", schema)
        return result.agg(F.count(F.lit(1)).alias("n")).withColumn("run", F.lit(name))

    first = run("landed")
    first.write.parquet(f"{base}/counts/first")
    # No new files: the second run of the same checkpoint must add nothing.
    second = run("after")
    counts = t.spark.read.parquet(f"{base}/counts/first").unionByName(second)
    return counts.agg(
        F.max(F.when(F.col("run") == "landed", F.col("n"))).alias("landed"),
        F.max(F.when(F.col("run") == "after", F.col("n"))).alias("after_restart"),
    )


@query("schema_hints_cast", twin("SELECT matnr, prdha, ntgew, brgew FROM mara"))
def hints(t: Tables):
    path = work_folder(t.spark, "hints")
    rows = t.raw("mara").select("matnr", "prdha", "ntgew", "brgew")
    _land_json(rows, path)
    return t.spark.read.schema(schemas.hinted_schema(rows.columns, "ntgew DOUBLE, brgew DOUBLE")).json(path)


@query("infer_schema_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def infer(t: Tables):
    path = work_folder(t.spark, "infer")
    t.source("events").select(
        "event_id", F.from_json("props", "k bigint")["k"].alias("k")
    ).write.json(path)
    schema = schemas.infer_json_schema(t.spark, path)
    return t.spark.read.schema(schema).json(path).select("event_id", "k")


@query("schema_evolution_merge", twin("""SELECT kunnr, name1, CAST(NULL AS VARCHAR) AS ort01 FROM kna1 WHERE ktokd <> 'BUILDING'
    UNION ALL SELECT kunnr, name1, ort01 FROM kna1 WHERE ktokd = 'BUILDING'"""))
def evolution(t: Tables):
    base = work_folder(t.spark, "evolution")
    log = schemas.SchemaLog(t.spark, f"{base}/schema")
    rows = t.raw("kna1").select("kunnr", "name1", "ort01", "ktokd")
    _land_json(rows.filter(F.col("ktokd") != "BUILDING").select("kunnr", "name1"), f"{base}/landing")
    log.evolve(schemas.infer_json_schema(t.spark, f"{base}/landing"))
    _land_json(rows.filter(F.col("ktokd") == "BUILDING").select("kunnr", "name1", "ort01"), f"{base}/landing")
    return schemas.read_evolving_json(t.spark, f"{base}/landing", log).select("kunnr", "name1", "ort01")


@query("schema_evolution_refresh", twin("""SELECT vbeln, CASE WHEN kunnr LIKE '%1' THEN floor(netwr) ELSE netwr END AS netwr,
    CASE WHEN kunnr LIKE '%1' THEN NULL ELSE audat END AS audat,
    CASE WHEN kunnr LIKE '%1' THEN '7' ELSE vkorg END AS vkorg, TRUE AS nothing_rescued FROM vbak"""))
def evolution_refresh(t: Tables):
    """Two runs: whole numbers, then fractions (DOUBLE), text in a number's place (STRING) and a new field."""
    base = work_folder(t.spark, "evolution-refresh")
    rows = t.raw("vbak").select("vbeln", "kunnr", "audat", "vkorg", "netwr")
    early = F.col("kunnr").endswith("1")
    drops = (
        rows.filter(early).select("vbeln", F.floor("netwr").alias("netwr"), F.lit(7).alias("vkorg")),
        rows.filter(~early).select("vbeln", "netwr", "vkorg", "audat"),
    )
    table = None
    for drop in drops:
        _land_json(drop, f"{base}/landing/vbak")
        table = ingest.ingest_evolving(
            t.spark, f"{base}/landing", f"{base}/bronze", f"{base}/cp", f"{base}/schemas",
            {"vbak": schemas.hinted_schema(["vbeln"])},
        )["vbak"]
    return table.select("vbeln", "netwr", "audat", "vkorg", F.col("_rescued_data").isNull().alias("nothing_rescued"))


@query("rescued_data", """SELECT CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey END AS o_orderkey,
    CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 4 = 1 THEN NULL ELSE o_custkey END AS o_custkey,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS value,
    CASE WHEN o_orderkey % 5 = 0 THEN concat('{broken ', o_orderkey)
         WHEN o_orderkey % 3 = 0 AND o_orderkey % 4 = 1 THEN '{"o_custkey":"n/a","zz_new_field":"new"}'
         WHEN o_orderkey % 4 = 1 THEN '{"o_custkey":"n/a"}' WHEN o_orderkey % 3 = 0 THEN '{"zz_new_field":"new"}' END AS rescued
    FROM orders""")
def rescued(t: Tables):
    """Unknown and mistyped fields, broken lines, and a field that is named like the text column."""
    path = work_folder(t.spark, "rescue")
    key = F.col("o_orderkey")
    fields = F.to_json(F.struct(
        key,
        F.when(key % 4 == 1, "n/a").otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.col("o_orderstatus").alias("value"), F.when(key % 3 == 0, "new").alias("zz_new_field"),
    ))
    broken = F.concat(F.lit("{broken "), key.cast("string"))
    t.source("orders").select(F.when(key % 5 == 0, broken).otherwise(fields)).write.text(path)
    schema = StructType.fromDDL("o_orderkey bigint, o_custkey bigint, value string")
    parsed = files.parse_with_rescue(t.spark.read.text(path), schema)
    return parsed.select("o_orderkey", "o_custkey", "value", F.col("_rescued_data").alias("rescued"))


@query("ingest_metadata", twin("SELECT lifnr, TRUE AS has_time, TRUE AS has_file FROM lfa1"))
def metadata(t: Tables):
    path = work_folder(t.spark, "metadata")
    _land_json(t.raw("lfa1"), path)
    rows = files.with_ingestion_metadata(t.spark.read.schema("lifnr string").json(path))
    return rows.select(
        "lifnr", F.col("_ingestion_time").isNotNull().alias("has_time"),
        F.col("_source_file").endswith(".json").alias("has_file"),
    )


@query("ingest_parquet_stream", "SELECT l_orderkey, l_linenumber, l_quantity, 'ERP' AS _source FROM lineitem")
def parquet_stream(t: Tables):
    base = work_folder(t.spark, "parquet-stream")
    t.source("lineitem").select("l_orderkey", "l_linenumber", "l_quantity").write.parquet(f"{base}/landing")
    schema = t.spark.read.parquet(f"{base}/landing").schema
    stream = ingest.parquet_stream(t.spark, f"{base}/landing", schema, "ERP", max_files=4)
    ingest.run_available(stream, f"{base}/bronze", f"{base}/cp")
    return t.spark.read.parquet(f"{base}/bronze").drop("_ingestion_ts")


@query("bronze_append_partitioned", twin("""SELECT '20240101' AS load_date, count(*) AS rows FROM ekko WHERE bedat < '19980101'
    UNION ALL SELECT '20240102', count(*) FROM ekko WHERE bedat >= '19980101'"""))
def append(t: Tables):
    path = work_folder(t.spark, "bronze-append")
    orders = t.raw("ekko")
    tables.bronze_append(orders.filter(F.col("bedat") < "19980101"), path, "ekko", "20240101", "ERP")
    tables.bronze_append(orders.filter(F.col("bedat") >= "19980101"), path, "ekko", "20240102", "ERP")
    landed = t.spark.read.parquet(path)
    return landed.groupBy(F.col("_partition_date").cast("string").alias("load_date")).agg(F.count(F.lit(1)).alias("rows"))


@query("parquet_roundtrip", "SELECT p_partkey, p_name, p_size FROM part")
def roundtrip(t: Tables):
    path = work_folder(t.spark, "parquet")
    return t.spark.read.parquet(tables.write_table(t.source("part").select("p_partkey", "p_name", "p_size"), path))


@query("gold_partitioned_overwrite", twin("""SELECT CAST(substr(bedat, 1, 4) AS INT) AS order_year, count(*) AS orders,
    CAST(sum(CAST(CASE WHEN bedat >= '20000101' AND bedat < '20010101' THEN netwr + 1 ELSE netwr END AS DECIMAL(17,2))) AS DECIMAL(27,2)) AS total
    FROM ekko GROUP BY 1"""))
def overwrite(t: Tables):
    path = work_folder(t.spark, "gold-overwrite")
    orders = t.raw("ekko").select(
        "ebeln", "netwr", F.substring("bedat", 1, 4).cast("int").alias("order_year"),
        F.substring("bedat", 5, 2).cast("int").alias("order_month"),
    )
    tables.overwrite_partitions(orders, path, ["order_year", "order_month"])
    again = orders.filter(F.col("order_year") == 2000).withColumn("netwr", F.col("netwr") + 1)
    tables.overwrite_partitions(again, path, ["order_year", "order_month"], only_touched=True)
    return t.spark.read.parquet(path).groupBy("order_year").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.col("netwr").cast("decimal(17,2)")).cast("decimal(27,2)").alias("total")
    )


@query("csv_export_roundtrip", twin("SELECT ebeln, ebelp, matnr, CAST(netwr AS DECIMAL(13,2)) AS netwr FROM ekpo"))
def csv_export(t: Tables):
    path = work_folder(t.spark, "csv")
    rows = t.raw("ekpo").select("ebeln", "ebelp", "matnr", F.col("netwr").cast("decimal(13,2)").alias("netwr"))
    files.write_delimited(rows, path)
    return t.spark.read.schema(rows.schema).option("sep", ";").option("header", True).csv(path)


@query("csv_load_with_status", twin("""SELECT vbeln, CAST(try_strptime(vdatu, '%Y%m%d') AS DATE) AS vdatu, TRY_CAST(netwr_text AS DECIMAL(15,2)) AS netwr,
    CASE WHEN vdatu = '00000000' OR netwr_text LIKE '%x' OR vbeln IS NULL THEN 'E' ELSE 'S' END AS status,
    CASE WHEN vdatu = '00000000' THEN 'bad_vdatu' WHEN netwr_text LIKE '%x' THEN 'bad_netwr' WHEN vbeln IS NULL THEN 'no_key' ELSE '' END AS message
    FROM (SELECT vbeln, vdatu, concat(CAST(CAST(netwr AS DECIMAL(15,2)) AS VARCHAR), CASE WHEN gbstk = 'P' THEN 'x' ELSE '' END) AS netwr_text FROM vbak)"""))
def csv_load(t: Tables):
    path = work_folder(t.spark, "csv-load")
    amount = F.concat(
        F.col("netwr").cast("decimal(15,2)").cast("string"), F.when(F.col("gbstk") == "P", "x").otherwise("")
    )
    files.write_delimited(t.raw("vbak").select("vbeln", "vdatu", amount.alias("netwr")), path)
    layout = StructType.fromDDL("vbeln string, vdatu date, netwr decimal(15,2)")
    return files.read_delimited(t.spark, path, layout, [Rule("no_key", "vbeln IS NOT NULL")])


@query("watermark_extract", """SELECT count(*) AS copied, max(CAST(o_orderdate AS DATE)) AS high FROM orders
    WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')""")
def watermark(t: Tables):
    base = work_folder(t.spark, "watermark")
    store = extraction.WatermarkStore(t.spark, f"{base}/control")
    orders = t.source("orders").select("o_orderkey", "o_orderdate")
    # The source as it was, then as it is: the second run copies from the stored mark on.
    early = orders.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    extraction.extract_and_advance(early, "orders", "o_orderdate", store, f"{base}/run1")
    copied = extraction.extract_and_advance(orders, "orders", "o_orderdate", store, f"{base}/run2")
    return copied.agg(
        F.count(F.lit(1)).alias("copied"), F.max(F.col("o_orderdate").cast("date")).alias("high")
    )


def _queue(t: Tables):
    """A change log in two loads, the first already extracted."""
    base = work_folder(t.spark, "queue")
    queue = extraction.DeltaQueue(t.spark, base, "lake")
    log = t.source("events").select("event_id", "user_id", F.day("ts").cast("bigint").alias("batch"))
    for day in (10, 20):
        part = queue.extract(log.filter(F.col("batch") <= day), "batch", "delta")
        part.rows.write.parquet(f"{base}-{day}")
        part.confirm()
    # Extracted but never stored: it must come again.
    queue.extract(log, "batch", "delta")
    return queue, log


@query("delta_mode_full", "SELECT event_id, user_id, CAST(day(ts) AS BIGINT) AS batch FROM events")
def mode_full(t: Tables):
    queue, log = _queue(t)
    return queue.extract(log, "batch", "full").rows


@query("delta_mode_delta", "SELECT event_id, user_id, CAST(day(ts) AS BIGINT) AS batch FROM events WHERE day(ts) > 20")
def mode_delta(t: Tables):
    queue, log = _queue(t)
    return queue.extract(log, "batch", "delta").rows


@query("delta_mode_recovery", "SELECT event_id, user_id, CAST(day(ts) AS BIGINT) AS batch FROM events WHERE day(ts) > 10 AND day(ts) <= 20")
def mode_recovery(t: Tables):
    queue, log = _queue(t)
    return queue.extract(log, "batch", "recovery").rows


@query("event_stream_parse", twin("SELECT bwart, matnr, werks, menge FROM mseg"))
def events(t: Tables):
    base = work_folder(t.spark, "events")
    t.raw("mseg").select(F.to_json(F.struct("bwart", "matnr", "werks", "menge")).alias("value")).write.text(f"{base}/in")
    payload = StructType.fromDDL("bwart string, matnr string, werks string, menge double")
    ingest.run_available(ingest.event_stream(t.spark, payload, f"{base}/in"), f"{base}/out", f"{base}/cp")
    return t.spark.read.schema(payload).parquet(f"{base}/out")


@query("layout_range_sorted", "SELECT l_shipdate, l_suppkey, l_orderkey, l_linenumber FROM lineitem")
def layout(t: Tables):
    path = work_folder(t.spark, "layout")
    rows = t.source("lineitem").select("l_shipdate", "l_suppkey", "l_orderkey", "l_linenumber")
    tables.range_layout(rows, ["l_shipdate", "l_suppkey"]).write.parquet(path)
    return t.spark.read.parquet(path)


@query("table_properties", """SELECT * FROM (VALUES ('quality', 'bronze'), ('sap.mandt', '100'), ('sap.table', 'EKKO')) v(key, value)
    WHERE (SELECT count(*) FROM orders) > 0""")
def properties(t: Tables):
    path = work_folder(t.spark, "table")
    # A name of its own: a table the session already has stays as it is.
    name = "erpweave_ekko_" + path.rpartition("-")[2]
    tables.register_table(
        t.raw("ekko"), name, "Purchase order headers", {"quality": "bronze", "sap.table": "EKKO", "sap.mandt": "100"}, path)
    try:
        shown = t.spark.sql(f"SHOW TBLPROPERTIES {name}")  # read at once
    finally:
        t.spark.sql(f"DROP TABLE {name}")
    return shown.filter(F.col("key").isin("quality", "sap.table", "sap.mandt"))


# ---- streams over typed tables ---------------------------------------------------


def _stream_of(t: Tables, df: DataFrame, base: str, files_per_run: int | None = None) -> DataFrame:
    """Land a raw table as JSON lines and open it as a string-first stream."""
    _land_json(df, f"{base}/landing", packed=True)
    return ingest.json_stream(t.spark, f"{base}/landing", df.schema, files_per_run)


@query("stream_silver_orders", twin("SELECT * FROM silver_vbak"))
def stream_silver(t: Tables):
    base = work_folder(t.spark, "stream-silver")
    typed = silver_table(_stream_of(t, t.raw("vbak"), base), "vbak")
    ingest.run_available(typed, f"{base}/silver", f"{base}/cp")
    return t.spark.read.schema(typed.schema).parquet(f"{base}/silver")


@query("stream_expect_drop", twin("SELECT ebeln, lifnr, netwr FROM ekko WHERE lifnr IS NOT NULL AND netwr > 200000"))
def stream_expect(t: Tables):
    base = work_folder(t.spark, "stream-expect")
    stream = _stream_of(t, t.raw("ekko"), base)
    kept = expect(stream, [Rule("vendor", "lifnr IS NOT NULL"), Rule("large", "netwr > 200000")])
    kept = kept.select("ebeln", "lifnr", "netwr")
    ingest.run_available(kept, f"{base}/out", f"{base}/cp")
    return t.spark.read.schema(kept.schema).parquet(f"{base}/out")


@query("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(t: Tables):
    """Two loads; most keys of the second are stored since the first."""
    base = work_folder(t.spark, "stream-dedup")
    events = t.source("events")
    half = F.lit("2024-01-16").cast("timestamp_ntz")
    result = None
    for part in (events.filter(F.col("ts") < half), events.filter(~(F.col("ts") < half) | F.col("ts").isNull())):
        rows = part.select("user_id", "event_type")
        stream = _stream_of(t, rows, base).select("user_id", "event_type")
        result = state.append_first(stream, f"{base}/out", ["user_id", "event_type"], f"{base}/cp", buckets=8)
    return result


@query("stream_to_mv", twin("SELECT * FROM dim_customer"))
def stream_to_mv(t: Tables):
    base = work_folder(t.spark, "stream-mv")
    typed = silver_table(_stream_of(t, t.raw("kna1"), base), "kna1")
    ingest.run_available(typed, f"{base}/silver", f"{base}/cp")
    return dim_customer(t.spark.read.schema(typed.schema).parquet(f"{base}/silver"))


@query("stream_upsert", """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER
    (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""")
def stream_upsert(t: Tables):
    base = work_folder(t.spark, "stream-upsert")
    rows = t.source("events").select("user_id", "event_id", "event_type")
    half = F.lit("2024-01-16").cast("timestamp_ntz")
    events = t.source("events")
    table = None
    # Two loads in event order, one checkpoint: the later load updates the earlier one.
    for part in (events.filter(F.col("ts") < half), events.filter(F.col("ts") >= half)):
        _land_json(part.select(rows.columns), f"{base}/landing")
        stream = ingest.json_stream(t.spark, f"{base}/landing", rows.schema).select(rows.columns)
        table = state.upsert_stream(stream, f"{base}/table", ["user_id"], "event_id", f"{base}/cp", buckets=8)
    return table


@query("procure_to_pay_layers", twin("""WITH i AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ebeln, ebelp ORDER BY menge, netpr, netwr, elikz NULLS FIRST) AS rn
    FROM ekpo) WHERE rn = 1), h AS (SELECT DISTINCT ebeln, lifnr, ekorg, bukrs, CAST(try_strptime(bedat, '%Y%m%d') AS DATE) AS bedat, waers FROM ekko
    WHERE ebeln IS NOT NULL AND bedat >= '20000101')
    SELECT i.ebeln AS purchase_order, i.ebelp AS line_item, h.lifnr AS supplier_id, h.ekorg AS purchasing_org, h.bukrs AS company_code,
    i.matnr AS material_id, i.werks AS plant, h.bedat AS order_date, CAST(year(h.bedat) AS BIGINT) AS order_year,
    CAST(month(h.bedat) AS BIGINT) AS order_month, CAST(i.menge AS DECIMAL(13,3)) AS quantity, i.meins AS uom,
    CAST(i.netpr AS DECIMAL(11,2)) AS unit_price, CAST(i.netwr AS DECIMAL(13,2)) AS net_value, h.waers AS currency
    FROM i LEFT JOIN h ON i.ebeln = h.ebeln"""))
def p2p(t: Tables):
    fact, _ = _p2p_layers(t)
    return fact


def _p2p_layers(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Landed files, checked streams, one row per key, the fact; and what the rules counted on the way."""
    base = work_folder(t.spark, "p2p")
    silver = {"ekko": (L.silver_header, ["ebeln"]), "ekpo": (L.silver_item, ["ebeln", "ebelp"])}
    stored: dict[str, DataFrame] = {}
    # Every row lands twice, in two runs: the second brings no new key.
    for _ in range(2):
        streams = {}
        for name, (checked, _) in silver.items():
            t.raw(name).write.mode("append").options(**ingest.STORED_AS).parquet(f"{base}/landing/{name}")
            landed = t.spark.read.parquet(f"{base}/landing/{name}").schema
            stream = ingest.parquet_stream(t.spark, f"{base}/landing/{name}", landed, "ERP").drop("_ingestion_ts", "_source")
            streams[name] = checked(stream, name)
        checked = ingest.append_tables(streams, f"{base}/checked", f"{base}/cp", metrics=f"{base}/metrics")
        for name, (_, keys) in silver.items():
            stream = t.spark.readStream.schema(checked[name].schema).parquet(f"{base}/checked/{name}")
            stored[name] = state.append_first(stream, f"{base}/silver/{name}", keys, f"{base}/cp-first/{name}", buckets=8)
    return L.gold_p2p_fact(stored["ekpo"], stored["ekko"]), rule_totals(t.spark, f"{base}/metrics")


_P2P_RULES = {
    "ekko": {"ebeln_not_null": "ebeln IS NOT NULL", "valid_date": "try_strptime(bedat, '%Y%m%d') >= DATE '2000-01-01'",
             "valid_amount": "try_cast(netwr AS DECIMAL(15,2)) >= 0"},
    "ekpo": {"ebeln_not_null": "ebeln IS NOT NULL", "ebelp_not_null": "ebelp IS NOT NULL",
             "valid_quantity": "try_cast(menge AS DECIMAL(13,3)) >= 0"},
}


def _rule_sql(table: str, rule: str, test: str, source: str, times: int = 1) -> str:
    return (f"SELECT '{table}' AS table_name, '{rule}' AS rule, CAST({times} * count(*) FILTER ({test}) AS BIGINT) AS passed, "
            f"CAST({times} * count(*) FILTER (({test}) IS NOT TRUE) AS BIGINT) AS failed FROM {source}")


@query("procure_to_pay_rule_metrics", twin(" UNION ALL ".join(
    _rule_sql(table, rule, test, table, 2) for table, rules in _P2P_RULES.items() for rule, test in rules.items())))
def p2p_metrics(t: Tables):
    """Counters of both runs, dropping and warning rules."""
    _, totals = _p2p_layers(t)
    return totals


# The key field that each typed table requires.
_REQUIRED = {
    "kna1": ["kunnr"], "lfa1": ["lifnr"], "mara": ["matnr"], "makt": ["matnr"], "pa0001": ["pernr"], "vbak": ["vbeln"],
    "vbap": ["vbeln", "posnr"], "vbrk": ["vbeln"], "vbrp": ["vbeln"], "likp": ["vbeln"], "lips": ["vbeln"], "ekko": ["ebeln"],
    "ekpo": ["ebeln"], "ekbe": ["ebeln"], "j_1bnfdoc": ["docnum"], "j_1bnflin": ["docnum"], "j_1bnfstx": ["docnum"],
    "bkpf": ["belnr"],
}


@query("silver_rule_metrics", twin(" UNION ALL ".join(
    _rule_sql(table, f"valid_{key}", f"{key} IS NOT NULL", f"{table} WHERE mandt = '100'" + (" AND spras = 'P'" if table == "makt" else ""))
    for table, keys in _REQUIRED.items() for key in keys)))
def silver_metrics(t: Tables):
    """What every rule of the 18 typed tables let pass and dropped, as recorded by the layer's streams over the given tables."""
    base = work_folder(t.spark, "silver-metrics")
    silver_layer(t.spark, {}, base, opened=t.raw_stream)
    return rule_totals(t.spark, f"{base}/metrics/silver")


@query("stream_fiscal_layers", twin(TAX_SUMMARY))
def fiscal_layers(t: Tables):
    from erpweave.plans.domain import fact_fiscal_note

    base = work_folder(t.spark, "fiscal-layers")

    def silver(name: str) -> DataFrame:
        typed = silver_table(_stream_of(t, t.raw(name), f"{base}/{name}"), name)
        ingest.run_available(typed, f"{base}/{name}/silver", f"{base}/{name}/cp")
        return t.spark.read.schema(typed.schema).parquet(f"{base}/{name}/silver")

    return tax_summary(fact_fiscal_note(silver("j_1bnfdoc"), silver("j_1bnflin"), silver("j_1bnfstx")))


# All raw tables of the bronze layer.
BRONZE_NAMES = tuple(erp_tables())


def _checksum_sql(name: str) -> str:
    """Rows of a raw table and the content of all its columns: text lengths, numbers in hundredths."""
    parts = [
        f"CASE WHEN try_cast({c} AS DOUBLE) IS NULL OR typeof({c}) = 'VARCHAR' THEN coalesce(length(CAST({c} AS VARCHAR)), 0) "
        f"ELSE CAST(round(try_cast({c} AS DOUBLE) * 100) AS BIGINT) END" for c in _columns(name)
    ]
    return f"SELECT '{name}' AS table_name, count(*) AS rows, CAST(sum({' + '.join(parts)}) AS DECIMAL(38,0)) AS checksum FROM {name}"


def _columns(name: str) -> list[str]:
    return [text.rpartition(" AS ")[2].strip() for text in crosswalk.BRONZE[name][1]]


def _checksum(df: DataFrame, name: str) -> DataFrame:
    text = {f.name: f.dataType.simpleString() == "string" for f in df.schema.fields}
    parts = [
        F.coalesce(F.length(c), F.lit(0)) if text[c] else
        F.coalesce(F.round(F.col(c).cast("double") * 100).cast("bigint"), F.lit(0)) for c in _columns(name)
    ]
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(sum(parts[1:], parts[0])).cast("decimal(38,0)").alias("checksum")
    ).select(F.lit(name).alias("table_name"), "rows", "checksum")


@query("bronze_all_tables", twin(" UNION ALL ".join(map(_checksum_sql, BRONZE_NAMES))))
def bronze_all(t: Tables):
    base = work_folder(t.spark, "bronze-all")
    known = {}
    for name in BRONZE_NAMES:
        raw = t.raw(name)
        _land_json(raw, f"{base}/landing/{name}", packed=True)
        known[name] = raw.schema
    bronze = ingest.ingest_tables(t.spark, f"{base}/landing", f"{base}/bronze", f"{base}/cp", known)
    counts = [_checksum(df, name) for name, df in bronze.items()]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result
