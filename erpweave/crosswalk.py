"""ERP-shaped bronze tables derived from a star schema of orders and items.

Each bronze table is one source table plus a select list. The lists use only
SQL that Spark and other engines read alike, so that the same text can shape
the input on both sides of a result comparison; ``EACH(...)`` stands for the
engine's list-to-rows generator.

The lists also produce the awkward cases real ERP extracts have: a foreign
client, NULL keys, blank against NULL flags, sentinel and impossible dates.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from erpweave.sources.tables import read_table

# Client of a document row: every tenth document belongs to another client.
_CLIENT = "CASE WHEN {k} % 10 = 9 THEN '200' ELSE '100' END AS mandt"
_ORDER_CLIENT = _CLIENT.format(k="o_orderkey")
_ITEM_CLIENT = _CLIENT.format(k="l_orderkey")


def _doc(key: str, prefix: str = "") -> str:
    return f"concat('{prefix}', lpad(CAST({key} AS STRING), {12 - len(prefix)}, '0'))"


def _digits(key: str, n: int) -> str:
    return f"lpad(CAST({key} AS STRING), {n}, '0')"


def _dats(date: str, plus: str = "0") -> str:
    return f"replace(CAST(CAST({date} AS DATE) + CAST({plus} AS INT) AS STRING), '-', '')"


def _item(step: int = 10, width: int = 6) -> str:
    # Line numbers repeat inside a document; part and supplier make the item unique.
    return (
        f"concat_ws('-', lpad(CAST(l_linenumber * {step} AS STRING), {width}, '0'), "
        "CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING))"
    )


_ITEM = _item()
_PLANT = "concat('P', lpad(CAST(l_suppkey % 25 AS STRING), 3, '0'))"
_MATNR = _digits("l_partkey", 18)
_MONEY = "l_extendedprice"

BRONZE: dict[str, tuple[str, list[str]]] = {
    # ---- master data -------------------------------------------------------
    "kna1": ("customer", [
        _CLIENT.format(k="c_custkey"),
        f"CASE WHEN c_custkey % 97 = 5 THEN NULL ELSE {_digits('c_custkey', 10)} END AS kunnr",
        "c_name AS name1", "upper(c_name) AS mcod1",
        f"{_digits('c_custkey * 7', 14)} AS stcd1", "c_mktsegment AS ktokd",
        "concat('CITY', CAST(c_custkey % 40 AS STRING)) AS ort01",
        f"{_digits('c_nationkey', 2)} AS regio", "'BR' AS land1",
    ]),
    "lfa1": ("supplier", [
        "'100' AS mandt", f"{_digits('s_suppkey', 10)} AS lifnr", "s_name AS name1",
        "upper(s_name) AS mcod1", "concat('CITY', CAST(s_suppkey % 9 AS STRING)) AS ort01",
        f"{_digits('s_nationkey', 2)} AS regio",
        "CASE WHEN s_nationkey % 5 = 0 THEN 'AR' ELSE 'BR' END AS land1",
        f"{_digits('s_suppkey * 13', 14)} AS stcd1",
    ]),
    "mara": ("part", [
        "'100' AS mandt", f"{_digits('p_partkey', 18)} AS matnr",
        "CASE WHEN p_size % 5 = 0 THEN NULL ELSE concat('OLD', CAST(p_partkey AS STRING)) END AS bismt",
        "concat(rpad(p_type, 5, ' '), rpad(p_brand, 5, ' ')) AS prdha", "p_brand AS matkl",
        "CASE WHEN p_size % 4 = 1 THEN 'FERT' WHEN p_size % 4 = 2 THEN 'ROH' ELSE 'HAWA' END AS mtart",
        "CASE WHEN p_size % 2 = 0 THEN 'KG' ELSE 'UN' END AS meins", "'KG' AS gewei",
        "CAST(p_size AS DOUBLE) AS ntgew", "p_retailprice AS brgew",
    ]),
    "makt": ("part", [
        "'100' AS mandt", f"{_digits('p_partkey', 18)} AS matnr",
        "CASE WHEN p_partkey % 4 = 3 THEN 'E' ELSE 'P' END AS spras",
        "p_name AS maktx", "upper(p_name) AS maktg",
    ]),
    "pa0001": ("supplier", [
        "'100' AS mandt", f"{_digits('s_suppkey', 8)} AS pernr", "'19900101' AS begda",
        "'99991231' AS endda", "s_name AS ename",
        f"{_digits('s_nationkey', 8)} AS plans", f"{_digits('s_suppkey % 7', 8)} AS orgeh",
    ]),
    "t001w": ("nation", [
        "'100' AS mandt", f"concat('P', {_digits('n_nationkey', 3)}) AS werks", "n_name AS name1",
        f"concat('P', {_digits('n_nationkey', 3)}) AS bwkey",
        "concat('BR0', CAST(n_regionkey AS STRING)) AS bukrs", "'BR' AS land1",
        f"{_digits('n_regionkey', 2)} AS regio", "lower(n_name) AS ort01",
    ]),
    "tvsbt": ("region", [
        "'100' AS mandt", "EACH('P', 'E') AS spras",
        f"{_digits('r_regionkey + 1', 2)} AS vsbed", "r_name AS vtext",
    ]),
    # ---- sales -------------------------------------------------------------
    "vbak": ("orders", [
        _ORDER_CLIENT,
        f"CASE WHEN o_orderkey % 211 = 7 THEN NULL ELSE {_doc('o_orderkey')} END AS vbeln",
        f"{_digits('o_custkey', 10)} AS kunnr",
        f"CASE WHEN o_orderkey % 89 = 3 THEN '00000000' ELSE {_dats('o_orderdate')} END AS audat",
        f"{_dats('o_orderdate')} AS erdat", "'120000' AS erzet",
        f"CASE WHEN o_orderkey % 11 = 2 THEN '00000000' WHEN o_orderkey % 13 = 4 THEN '99991231' "
        f"WHEN o_orderkey % 17 = 5 THEN NULL ELSE {_dats('o_orderdate', '30')} END AS vdatu",
        "concat('Z', substr(o_orderpriority, 1, 1)) AS auart", "'C' AS vbtyp",
        "concat('BR0', CAST(o_custkey % 6 AS STRING)) AS vkorg", "'10' AS vtweg",
        f"{_digits('o_orderkey % 5', 2)} AS spart", f"{_doc('o_orderkey', '7')} AS knumv",
        "o_totalprice AS netwr", "'BRL' AS waerk",
        "CASE WHEN o_orderkey % 4 = 0 THEN '001' ELSE NULL END AS augru",
        "CASE WHEN o_orderkey % 8 = 1 THEN 'Z1' WHEN o_orderkey % 3 = 0 THEN '' ELSE NULL END AS faksk",
        "CASE WHEN o_orderkey % 6 = 1 THEN '01' WHEN o_orderkey % 2 = 0 THEN '' ELSE NULL END AS lifsk",
        "o_orderstatus AS gbstk", f"{_digits('o_custkey % 5', 3)} AS vkgrp",
        "concat('BR0', CAST(o_custkey % 4 AS STRING)) AS vkbur",
        f"{_digits('o_orderkey % 7 + 1', 2)} AS vsbed",
        f"CASE WHEN o_orderkey % 5 = 0 THEN {_doc('o_orderkey', '6')} ELSE NULL END AS vgbel",
    ]),
    "vbap": ("lineitem", [
        _ITEM_CLIENT, f"{_doc('l_orderkey')} AS vbeln",
        f"CASE WHEN l_partkey % 193 = 8 THEN NULL ELSE {_ITEM} END AS posnr",
        f"{_MATNR} AS matnr", "concat('G', CAST(l_partkey % 9 AS STRING)) AS matkl",
        f"{_PLANT} AS werks", f"{_digits('l_suppkey % 10', 4)} AS lgort",
        "'UN' AS meins", "CASE WHEN l_partkey % 2 = 0 THEN 'KG' ELSE 'UN' END AS vrkme",
        f"{_MONEY} AS netwr", "CASE WHEN l_suppkey % 8 = 0 THEN 'USD' ELSE 'BRL' END AS waerk",
        "l_quantity AS kwmeng", "l_quantity AS kbmeng",
        f"{_digits('l_partkey % 1000', 10)} AS charg",
        f"{_digits('l_orderkey % 4', 4)} AS route", f"{_dats('l_shipdate', '-10')} AS abdat",
        "l_returnflag AS fksta", "l_linestatus AS lfsta",
        "CASE WHEN l_linenumber = 7 THEN ' ' WHEN l_linenumber = 6 THEN NULL ELSE 'A' END AS fkrel",
        "CASE WHEN l_returnflag = 'R' THEN '01' WHEN l_linenumber % 2 = 0 THEN '' ELSE NULL END AS abgru",
    ]),
    "vbep": ("lineitem", [
        _ITEM_CLIENT, f"{_doc('l_orderkey')} AS vbeln", f"{_ITEM} AS posnr",
        "EACH('0002', '0001') AS etenr", "l_quantity AS wmeng", "l_quantity AS bmeng", "'UN' AS vrkme",
        f"{_dats('l_shipdate', 'l_linenumber')} AS edatu", f"{_dats('l_shipdate')} AS wadat",
    ]),
    "vbkd": ("orders", [
        _ORDER_CLIENT, f"{_doc('o_orderkey')} AS vbeln",
        "CASE WHEN o_orderkey % 9 = 1 THEN '000010' ELSE '000000' END AS posnr",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'CIF' WHEN o_orderkey % 3 = 1 THEN 'FOB' ELSE 'EXW' END AS inco1",
        f"{_digits('o_orderkey % 8 + 1', 2)} AS vsart", "'Z030' AS zterm",
    ]),
    "vbpa": ("orders", [
        _ORDER_CLIENT, f"{_doc('o_orderkey')} AS vbeln", "'000000' AS posnr",
        "EACH('ZG', 'ZA', 'WE', 'AG') AS parvw",
        f"CASE WHEN o_orderkey % 5 = 2 THEN NULL ELSE {_digits('(o_custkey + 1)', 10)} END AS kunnr",
        f"CASE WHEN o_orderkey % 7 = 3 THEN '' ELSE {_digits('o_custkey % 12', 8)} END AS pernr",
    ]),
    "likp": ("orders", [
        _ORDER_CLIENT, f"{_doc('o_orderkey', '8')} AS vbeln",
        f"{_digits('o_custkey', 10)} AS kunnr", "concat('BR0', CAST(o_custkey % 6 AS STRING)) AS vkorg",
        f"{_digits('o_custkey % 10', 10)} AS tdlnr", f"{_dats('o_orderdate', '12')} AS lfdat",
        f"CASE WHEN o_orderstatus = 'O' THEN '00000000' ELSE {_dats('o_orderdate', 'o_orderkey % 20')} END AS wadat_ist",
        f"{_dats('o_orderdate', '2')} AS erdat", "'LF' AS lfart",
        "CASE WHEN o_orderkey % 5 = 0 THEN '01' ELSE NULL END AS trspg",
    ]),
    "lips": ("lineitem", [
        _ITEM_CLIENT, f"{_doc('l_orderkey', '8')} AS vbeln", f"{_ITEM} AS posnr",
        f"{_MATNR} AS matnr", "'UN' AS meins", "'UN' AS vrkme",
        f"{_digits('l_suppkey % 10 + 1', 4)} AS lgort", f"{_PLANT} AS werks", "l_quantity AS lfimg",
        f"{_doc('l_orderkey')} AS vgbel",
        f"CASE WHEN l_partkey % 6 = 1 THEN '999999' ELSE {_ITEM} END AS vgpos",
        f"{_dats('l_shipdate')} AS dfexp",
    ]),
    "vttp": ("orders", [
        _ORDER_CLIENT, f"{_doc('o_orderkey', '5')} AS tknum", "CAST(o_orderkey % 10 + 1 AS DOUBLE) AS tpnum",
        f"{_doc('o_orderkey', '8')} AS vbeln",
    ]),
    "vttk": ("orders", [
        _ORDER_CLIENT, f"{_doc('o_orderkey', '5')} AS tknum", "'0001' AS shtyp",
        f"{_digits('o_orderkey % 4', 4)} AS route",
        f"CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE {_digits('o_custkey % 10', 10)} END AS tdlnr",
    ]),
    "oigsi": ("orders", [
        _ORDER_CLIENT, f"{_doc('o_orderkey', '4')} AS shnumber", f"{_doc('o_orderkey', '8')} AS doc_number",
        "CASE WHEN o_orderkey % 3 = 1 THEN '7' ELSE 'J' END AS doc_typ", f"{_dats('o_orderdate')} AS erdat",
    ]),
    "vbfa": ("orders", [
        _ORDER_CLIENT, f"{_doc('o_orderkey')} AS vbelv",
        "EACH('J', 'M', 'R') AS vbtyp_n",
        f"concat(CASE WHEN o_orderkey % 2 = 0 THEN '8' ELSE '9' END, {_digits('o_orderkey', 11)}) AS vbeln",
        "'C' AS vbtyp_v", "o_totalprice AS rfwrt",
    ]),
    # ---- billing, fiscal notes, accounting ---------------------------------
    "vbrk": ("orders", [
        _ORDER_CLIENT, f"{_doc('o_orderkey', '9')} AS vbeln", f"{_dats('o_orderdate', '25')} AS fkdat",
        f"{_dats('o_orderdate', '24')} AS erdat", "'ZF2' AS fkart", "'M' AS vbtyp",
        f"{_digits('o_custkey', 10)} AS kunrg", f"{_doc('o_orderkey', '7')} AS knumv",
        "o_totalprice AS netwr", "'BRL' AS waerk", "CAST(o_custkey % 1000 AS DOUBLE) * 0.25 AS mwsbk",
        "CASE WHEN o_orderkey % 7 = 1 THEN 'X' WHEN o_orderkey % 3 = 0 THEN '' ELSE NULL END AS fksto",
        f"CASE WHEN o_orderkey % 12 = 5 THEN {_doc('o_orderkey', '3')} WHEN o_orderkey % 2 = 0 THEN '' ELSE NULL END AS sfakn",
        "'T' AS zlsch", "CASE WHEN o_orderkey % 9 = 4 THEN 'A' ELSE 'C' END AS rfbsk",
    ]),
    "vbrp": ("lineitem", [
        _ITEM_CLIENT, f"{_doc('l_orderkey', '9')} AS vbeln", f"{_ITEM} AS posnr",
        f"{_MATNR} AS matnr", "'UN' AS meins", f"{_MONEY} AS netwr",
        "CASE WHEN l_suppkey % 8 = 0 THEN 'USD' ELSE 'BRL' END AS waerk", "l_quantity AS fklmg",
        "l_quantity * 1.25 AS mwsbp", f"{_doc('l_orderkey', '8')} AS vgbel", f"{_ITEM} AS vgpos",
        f"{_doc('l_orderkey')} AS aubel", f"{_ITEM} AS aupos",
    ]),
    "j_1bnfdoc": ("orders", [
        _ORDER_CLIENT, f"{_digits('o_orderkey', 16)} AS docnum",
        "concat('BR0', CAST(o_custkey % 4 AS STRING)) AS bukrs", "'0001' AS bupla",
        f"{_digits('o_custkey * 7', 14)} AS stcd1",
        "CASE WHEN o_orderkey % 4 = 3 THEN 'I' ELSE 'O' END AS direct",
        f"{_dats('o_orderdate', '26')} AS docdat", f"{_doc('o_orderkey', '9')} AS refkey",
        f"{_digits('o_orderkey', 12)} AS nfnum", "'1' AS serie",
    ]),
    "j_1bnflin": ("lineitem", [
        _ITEM_CLIENT, f"{_digits('l_orderkey', 16)} AS docnum", f"{_ITEM} AS itmnum",
        f"{_MATNR} AS matnr", "CASE WHEN l_linestatus = 'O' THEN '6101' ELSE '5101' END AS cfop",
        "l_quantity AS nfqtd", "l_quantity * 3.5 AS nfpric", f"{_MONEY} AS nfval",
    ]),
    "j_1bnfstx": ("lineitem", [
        _ITEM_CLIENT, f"{_digits('l_orderkey', 16)} AS docnum", f"{_ITEM} AS itmnum",
        "EACH('ICMS', 'IPI', 'PIS') AS taxtyp", "l_quantity * 0.75 AS taxval",
        "l_tax * 100 AS taxrat",
    ]),
    "bkpf": ("orders", [
        _ORDER_CLIENT, "concat('BR0', CAST(o_custkey % 4 AS STRING)) AS bukrs",
        f"{_digits('o_orderkey', 12)} AS belnr", "substr(CAST(o_orderdate AS STRING), 1, 4) AS gjahr",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'MKPF' ELSE 'VBRK' END AS awtyp",
        f"CASE WHEN o_orderkey % 3 = 0 THEN concat({_digits('o_orderkey', 10)}, substr(CAST(o_orderdate AS STRING), 1, 4)) "
        f"ELSE {_doc('o_orderkey', '9')} END AS awkey",
        f"{_dats('o_orderdate', '1')} AS budat", f"{_dats('o_orderdate')} AS bldat", "'BRL' AS waers",
        "CASE WHEN o_orderkey % 2 = 0 THEN 'RE' ELSE 'WE' END AS blart",
    ]),
    "bseg": ("lineitem", [
        _ITEM_CLIENT, f"{_digits('l_orderkey', 12)} AS belnr", f"{_item(1, 3)} AS buzei",
        f"{_digits('l_partkey % 20', 10)} AS saknr", f"{_MONEY} AS dmbtr",
        "CASE WHEN l_returnflag = 'R' THEN 'H' ELSE 'S' END AS shkzg",
        "CASE WHEN l_linenumber % 3 = 0 THEN 'K' ELSE 'S' END AS koart",
        f"{_digits('l_suppkey', 10)} AS lifnr",
        "CASE WHEN l_linestatus = 'O' THEN '' ELSE '20240101' END AS augdt",
    ]),
    # ---- purchasing, stock, production -------------------------------------
    "ekko": ("orders", [
        _ORDER_CLIENT, f"{_doc('o_orderkey', '45')} AS ebeln",
        "concat('BR0', CAST(o_custkey % 4 AS STRING)) AS bukrs",
        f"CASE WHEN o_orderkey % 50 = 11 THEN NULL ELSE {_digits('o_custkey % 10', 10)} END AS lifnr",
        f"{_digits('o_custkey % 5', 3)} AS ekgrp", "concat('BR0', CAST(o_custkey % 3 AS STRING)) AS ekorg",
        "CASE WHEN o_orderkey % 4 = 1 THEN 'FO' ELSE 'NB' END AS bsart",
        "CASE WHEN o_orderkey % 6 = 5 THEN 'K' ELSE 'F' END AS bstyp",
        f"{_dats('o_orderdate')} AS bedat", f"{_dats('o_orderdate', '3')} AS aedat", "'BRL' AS waers",
        "o_totalprice AS netwr",
    ]),
    "ekpo": ("lineitem", [
        _ITEM_CLIENT, f"{_doc('l_orderkey', '45')} AS ebeln", f"{_item(10, 5)} AS ebelp",
        f"{_MATNR} AS matnr", f"{_PLANT} AS werks", f"{_digits('l_suppkey % 10', 4)} AS lgort",
        "'UN' AS meins", "l_quantity AS menge",
        "CASE WHEN l_partkey % 31 = 4 THEN 0 - l_quantity * 2.5 ELSE l_quantity * 2.5 END AS netpr",
        "'1' AS peinh", "'BRL' AS waers", f"{_MONEY} AS netwr",
        "CASE WHEN l_linestatus = 'F' THEN 'X' WHEN l_linenumber % 2 = 0 THEN '' ELSE NULL END AS elikz",
        "CASE WHEN l_linenumber = 5 THEN 'L' WHEN l_linenumber % 2 = 0 THEN '' ELSE NULL END AS loekz",
    ]),
    "ekbe": ("lineitem", [
        _ITEM_CLIENT, f"{_doc('l_orderkey', '45')} AS ebeln", f"{_item(10, 5)} AS ebelp",
        "CAST(l_linenumber AS INT) AS zekkn", "CAST(l_linenumber % 3 + 1 AS STRING) AS vgabe",
        "substr(CAST(l_shipdate AS STRING), 1, 4) AS gjahr",
        "EACH('A', 'B') AS buzei", f"{_digits('l_orderkey', 12)} AS belnr",
        "l_quantity AS menge", f"{_MONEY} AS wrbtr", "'BRL' AS waers",
    ]),
    "mkpf": ("orders", [
        _ORDER_CLIENT, f"{_digits('o_orderkey', 10)} AS mblnr",
        "substr(CAST(o_orderdate AS STRING), 1, 4) AS mjahr", f"{_dats('o_orderdate', '5')} AS budat",
    ]),
    "mseg": ("lineitem", [
        _ITEM_CLIENT, f"{_digits('l_orderkey', 10)} AS mblnr", f"{_item(1, 4)} AS zeile",
        "CASE WHEN l_linenumber % 3 = 0 THEN '261' WHEN l_linenumber % 3 = 1 THEN '101' ELSE '601' END AS bwart",
        f"{_MATNR} AS matnr", f"{_PLANT} AS werks", f"{_digits('l_suppkey % 10', 4)} AS lgort",
        "l_quantity AS menge", "'UN' AS meins", "0 - l_extendedprice AS dmbtr",
        f"{_doc('l_orderkey', '45')} AS ebeln", f"{_item(10, 5)} AS ebelp",
        f"{_doc('l_orderkey', '1')} AS aufnr", f"{_doc('l_orderkey', '9')} AS vbeln", f"{_ITEM} AS posnr",
        f"{_dats('l_shipdate')} AS budat",
    ]),
    "rbkp": ("orders", [
        _ORDER_CLIENT, f"{_doc('o_orderkey', '51')} AS belnr",
        "substr(CAST(o_orderdate AS STRING), 1, 4) AS gjahr", "o_totalprice AS rmwwr",
    ]),
    "aufk": ("orders", [
        _ORDER_CLIENT, f"{_doc('o_orderkey', '1')} AS aufnr", "'P001' AS werks",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'PP01' WHEN o_orderkey % 3 = 1 THEN 'PP02' ELSE 'PM01' END AS auart",
        f"{_dats('o_orderdate')} AS erdat", f"{_dats('o_orderdate', '5')} AS gstrp",
        f"{_dats('o_orderdate', '15')} AS gltrp",
    ]),
    "afpo": ("lineitem", [
        _ITEM_CLIENT, f"{_doc('l_orderkey', '1')} AS aufnr", f"{_item(1, 4)} AS posnr", f"{_MATNR} AS matnr",
        f"{_PLANT} AS werks", "l_quantity AS psmng", "l_quantity * l_discount AS wemng",
    ]),
    "mard": ("lineitem", [
        f"{_MATNR} AS matnr", f"{_PLANT} AS werks", f"{_digits('l_suppkey % 10', 4)} AS lgort",
        "'100' AS mandt",
        "CASE WHEN l_returnflag = 'R' THEN 0 - l_quantity ELSE l_quantity END AS labst",
    ]),
    "mbew": ("part", [
        "'100' AS mandt", f"{_digits('p_partkey', 18)} AS matnr",
        "CASE WHEN p_size % 3 = 0 THEN 'BR01' ELSE 'BR02' END AS bwkey",
        "p_retailprice AS verpr", "p_retailprice / 2 AS stprs", "'V' AS vprsv",
    ]),
    "knvv": ("customer", [
        _CLIENT.format(k="c_custkey"), f"{_digits('c_custkey', 10)} AS kunnr",
        "EACH('BR01', 'BR02') AS vkorg", "c_mktsegment AS kdgrp", f"{_digits('c_nationkey', 6)} AS bzirk",
    ]),
    # ---- change documents --------------------------------------------------
    "cdhdr": ("events", [
        "CASE WHEN event_id % 10 = 9 THEN '200' ELSE '100' END AS mandt", f"{_digits('event_id', 12)} AS changenr",
        "CASE WHEN event_type = 'purchase' THEN 'EINKBELEG' ELSE 'VERKBELEG' END AS objectclas",
        f"{_digits('user_id', 10)} AS objectid", f"{_dats('ts')} AS udate",
        "substr(CAST(ts AS STRING), 12, 8) AS utime", "concat('U', CAST(user_id % 50 AS STRING)) AS username",
    ]),
    "cdpos": ("events", [
        "CASE WHEN event_id % 10 = 9 THEN '200' ELSE '100' END AS mandt", f"{_digits('event_id', 12)} AS changenr",
        "'EKPO' AS tabname", "EACH('NETPR', 'MENGE') AS fname",
        "CAST(CAST(value AS DECIMAL(17,2)) AS STRING) AS value_old",
        "CAST(CAST(value * 2 AS DECIMAL(17,2)) AS STRING) AS value_new",
    ]),
    # ---- texts, conditions, statuses and schedules of the remaining raw tables -------
    "t173t": ("nation", ["'100' AS mandt", "EACH('P', 'E') AS spras", f"{_digits('n_nationkey', 2)} AS vsart", "n_name AS bezei"]),
    "tvrot": ("nation", ["'100' AS mandt", "EACH('P', 'E') AS spras", f"{_digits('n_nationkey', 6)} AS route", "n_name AS bezei"]),
    "tvstt": ("region", ["'100' AS mandt", "EACH('P', 'E') AS spras", f"{_digits('r_regionkey', 4)} AS vstel", "r_name AS vtext"]),
    "tvaut": ("region", ["'100' AS mandt", "EACH('P', 'E') AS spras", f"{_digits('r_regionkey', 3)} AS augru", "r_name AS bezei"]),
    "tvagt": ("region", ["'100' AS mandt", "EACH('P', 'E') AS spras", f"{_digits('r_regionkey', 2)} AS abgru", "r_name AS bezei"]),
    "tvkggt": ("nation", ["'100' AS mandt", "EACH('P', 'E') AS spras", f"{_digits('n_nationkey', 3)} AS kdkgr", "n_name AS vtext"]),
    "dd07t": ("region", [
        "'100' AS mandt", "EACH('CMGST', 'OIG_SSTSF', 'ZZ_ST_DEAL') AS domname", "'P' AS ddlanguage",
        f"{_digits('r_regionkey', 1)} AS domvalue_l", "r_name AS ddtext",
    ]),
    "dd07v": ("region", [
        "'100' AS mandt", "EACH('CMGST', 'OIG_SSTSF', 'LFART') AS domname", "'P' AS ddlanguage",
        f"{_digits('r_regionkey', 1)} AS domvalue_l", "lower(r_name) AS ddtext",
    ]),
    "knmt": ("customer", [
        _CLIENT.format(k="c_custkey"), "EACH('BR01', 'BR02') AS vkorg", "'10' AS vtweg", f"{_digits('c_custkey', 10)} AS kunnr",
        f"{_digits('c_custkey % 200 + 1', 18)} AS matnr", f"{_digits('c_custkey * 3', 35)} AS kdmat", "upper(c_name) AS sortl",
    ]),
    "vbuk": ("orders", [
        _ORDER_CLIENT, f"{_doc('o_orderkey')} AS vbeln", "CASE WHEN o_orderkey % 4 = 0 THEN 'B' ELSE NULL END AS cmgst",
        "o_orderstatus AS lfstk", "o_orderstatus AS fkstk", "o_orderstatus AS gbstk",
    ]),
    "konv": ("lineitem", [
        _ITEM_CLIENT, f"{_doc('l_orderkey', '6')} AS knumv", f"{_ITEM} AS kposn", "l_linenumber AS stunr", "1 AS zaehk",
        "CASE WHEN l_discount > 0.05 THEN 'K004' ELSE 'PR00' END AS kschl", "l_discount AS kbetr", f"{_MONEY} AS kwert",
        "'BRL' AS kwaeh", "'UN' AS kmein", "1 AS kpein",
    ]),
    "vbup": ("lineitem", [
        _ITEM_CLIENT, f"{_doc('l_orderkey', '8')} AS vbeln", f"{_ITEM} AS posnr", "l_linestatus AS lfsta",
        "l_returnflag AS fksta", "l_linestatus AS kosta",
    ]),
    "oigs": ("orders", [
        _ORDER_CLIENT, f"{_doc('o_orderkey', '4')} AS shnumber", f"{_doc('o_orderkey', '8')} AS doc_number", "'J' AS doc_typ",
        "o_orderstatus AS status", f"{_dats('o_orderdate')} AS erdat",
    ]),
    "eket": ("lineitem", [
        _ITEM_CLIENT, f"{_doc('l_orderkey', '45')} AS ebeln", f"{_item(10, 5)} AS ebelp", "EACH('0001', '0002') AS etenr",
        f"{_dats('l_shipdate')} AS eindt", "l_quantity AS menge", "l_quantity AS wemng",
    ]),
}

_EACH = re.compile(r"EACH\(([^)]*)\)")


def select_list(table: str) -> list[str]:
    """Spark select list of a bronze table."""
    return [_EACH.sub(r"explode(array(\1))", text) for text in BRONZE[table][1]]


def shape(source: DataFrame, table: str) -> DataFrame:
    """The ERP-shaped bronze table over its source frame."""
    return source.selectExpr(*select_list(table))


def bronze(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One ERP-shaped bronze table over the given star-schema folder."""
    return shape(read_table(spark, f"{sf_dir}/{BRONZE[table][0]}.parquet"), table)
