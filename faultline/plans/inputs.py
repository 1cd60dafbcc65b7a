"""Stand-ins for interruption data, derived row by row from the given tables.

Dirty values come from literal lists indexed by a row's key, so every row of a table is used
and the amount of dirt grows with it. The SQL texts state the same inputs for the checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Stated, not inferred: no job has to open the files before a query is planned.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list[str | None], key: Column) -> Column:
    """The value at `key` modulo the length of the list."""
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), (key % len(values)).cast("int"))


def sql_text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def sql_values(rows: list[tuple]) -> str:
    """A VALUES list with the row number first."""
    return ", ".join(
        "(" + ", ".join([str(i), *[sql_text(v) for v in row]]) + ")" for i, row in enumerate(rows)
    )


# --- fixed values: raw asset names and the canonical name each must get, stated by hand ----
NAMES: list[tuple[str | None, str]] = [
    ("OLUYOLE", "OLUYOLE"),
    ("INDUSTRIAL 33KV", "INDUSTRIAL"),
    ("INDUSTRIAL 33KV ", "INDUSTRIAL"),
    ("INDUTRIAL 33KV", "INDUSTRIAL"),
    ("M1NISTER 33KV", "MINISTER"),
    ("SAMANDA 33KV", "SAMONDA"),
    ("OLUYOLY 33KV", "OLUYOLE"),
    ("AGODI 1 33KV", "AGODI 1"),
    ("AGODI 1, 33KV", "AGODI 1"),
    ("AGODI LINE 2 33KV", "AGODI 2"),
    ("ERUWA TOWN 33KV FDR", "ERUWA TOWN"),
    ("ERUWA/LANLATE 33KV FDR", "ERUWA/LANLATE"),
    ("ERUW/LANLATE 33KV FDR", "ERUWA/LANLATE"),
    ("T-2B @ JERICHO", "UNMAPPED"),
    ("JERICHO COMPLEX", "UNMAPPED"),
    ("T1 15MVA @ AGODI", "UNMAPPED"),
    ("40MVA @ JERICHO", "UNMAPPED"),
    (None, "UNMAPPED"),
    ("APETE 33KV", "APETE"),
    ("APATA 33KV FDR", "APATA"),
    ("33KV", "OLUYOLE"),
    ("IN", "INTERCHANGE"),
    ("AGODI 33KV", "UNMAPPED"),
    ("AGODI 2 132/33", "AGODI 1"),
    ("15MVA AGODI", "UNMAPPED"),
    ("ERUWA 33KV", "UNMAPPED"),
    ("ERUWA LANALTE", "ERUWA/LANLATE"),
    ("OMI-ADIO 33KV", "OMI ADIO"),
    ("LIBERTY T1", "UNMAPPED"),
    ("oluyole feeder", "OLUYOLE"),
    ("LBERTY 33KV", "LIBERTY"),
    ("INTERCHNAGE LINE", "INTERCHANGE"),
    ("EXPRESS RESTORED", "EXPRESS"),
    ("Fan  Milk 33kv", "FAN MILK"),
    ("IYAGANKU.33KV", "IYAGANKU"),
    ("ELEYELE", "ELEYELE"),
    ("ROM 33KV", "ROM"),
]

# --- fixed values: raw outage types and their canonical ones --------------------------------
TYPES: list[tuple[str | None, str]] = [
    ("EDC F/O", "EDC F/O"),
    ("EDC/F/O", "EDC F/O"),
    ("EDCF/O", "EDC F/O"),
    ("EDC /F/O", "EDC F/O"),
    ("edc/fo", "EDC F/O"),
    ("EDC/P/0", "EDC P/O"),
    ("EDC P-O", "EDC P/O"),
    ("EDC/E/F", "EDC E/F"),
    ("TCN/L/S", "TCN L/S"),
    ("EDC L.S", "EDC L/S"),
    (" EDC/O/C ", "EDC O/C"),
    ("TCN P/O", "TCN P/O"),
    ("TCN F/0", "TCN F/O"),
    ("GEN S/C", "GEN S/C"),
    ("EDC /S", "OTHER"),
    ("", "OTHER"),
    (None, "OTHER"),
]

FILE_NAMES: list[tuple[str, str]] = [
    ("REGION JANUARY 2021.xlsx", "JANUARY"),
    ("region february 2021.XLSX", "FEBRUARY"),
    ("March.xlsx", "MARCH"),
    ("APRIL-2021.xlsx", "APRIL"),
    ("may_2021.xlsx", "MAY"),
    ("report june.xlsx", "JUNE"),
    ("JULY to AUGUST.xlsx", "JULY"),
    ("August 2021.xlsx", "AUGUST"),
    ("september.xlsx", "SEPTEMBER"),
    ("Septem_2021.xlsx", "SEPTEM_2021"),
    ("SEPTEMBR 2021.xlsx", "SEPTEMBR"),
    ("2021october.xlsx", "OCTOBER"),
    ("NOVEMBER.xlsx", "NOVEMBER"),
    ("December 2021.xlsx", "DECEMBER"),
    ("data.xlsx", "UNKNOWN"),
    ("JAN 2021.xlsx", "UNKNOWN"),
]


def outages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as outages of entities, with missing times and durations and with entities
    that have a single event."""
    i = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(i % 1000 == 7, i + 1_000_000_000).otherwise(F.col("user_id")).alias("entity"),
        F.when(i % 97 != 0, F.col("ts")).alias("ts"),
        F.col("event_type").alias("outage_type"),
        F.when(i % 50 != 3, F.sqrt("value")).alias("duration_hours"),
        (F.sqrt("value") * (i % 100)).alias("customer_hours"),
    )


OUTAGES_SQL = """
outages AS (
  SELECT event_id,
         CASE WHEN event_id % 1000 = 7 THEN event_id + 1000000000 ELSE user_id END AS entity,
         CASE WHEN event_id % 97 <> 0 THEN ts END AS ts,
         event_type AS outage_type,
         CASE WHEN event_id % 50 <> 3 THEN sqrt(value) END AS duration_hours,
         sqrt(value) * (event_id % 100) AS customer_hours
  FROM events)
"""

GAPS_SQL = (
    OUTAGES_SQL
    + """,
gaps AS (
  SELECT *, seconds / CAST(3600 AS DOUBLE) AS hours_since_prior_event
  FROM (SELECT *, s - lag(s) OVER (PARTITION BY entity ORDER BY ts, event_id) AS seconds
        FROM (SELECT *, epoch_us(ts) // 1000000 AS s FROM outages WHERE ts IS NOT NULL))),
metrics AS (
  SELECT entity, count(*) AS total_outages,
         round(avg(duration_hours), 2) AS mttr_hours,
         round(sum(seconds) / CAST(count(seconds) * 3600 AS DOUBLE), 2) AS mtbf_hours,
         round(sum(customer_hours), 1) AS total_customer_hours_interruption
  FROM gaps GROUP BY entity)
"""
)


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as asset locations on a strip of land, every fifth one not located. Every
    eighth shares place and radius with its neighbour."""
    k = F.col("s_suppkey")
    at = F.when(k % 8 == 1, k - 1).otherwise(k)
    located = k % 5 != 4
    return table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("feeder_canonical"),
        F.when(located, 7.1 + (at % 20) * 0.03 + F.floor(at / 10000) % 70).alias("latitude"),
        F.when(located, -150.0 + (at % 10000) * 0.03).alias("longitude"),
        F.when(located, 2.5 + (at % 3) * 1.75).alias("service_radius_km"),
        F.when(~located, "unlocated").when(k % 2 == 0, "high").otherwise("low").alias("confidence"),
        F.when(located, "urban").alias("setting"),
        F.concat(F.lit('place "'), "s_name", F.lit('", nation '), "s_nationkey").alias("anchor"),
        k.alias("place_id"),
    )


PLACES_SQL = """
places AS (
  SELECT s_name AS feeder_canonical,
         CASE WHEN s_suppkey % 5 <> 4 THEN CAST(7.1 AS DOUBLE) + (p % 20) * CAST(0.03 AS DOUBLE)
             + (p // 10000) % 70 END AS latitude,
         CASE WHEN s_suppkey % 5 <> 4
           THEN CAST(-150.0 AS DOUBLE) + (p % 10000) * CAST(0.03 AS DOUBLE) END AS longitude,
         CASE WHEN s_suppkey % 5 <> 4 THEN CAST(2.5 AS DOUBLE) + (p % 3) * CAST(1.75 AS DOUBLE)
           END AS service_radius_km,
         CASE WHEN s_suppkey % 5 = 4 THEN 'unlocated' WHEN s_suppkey % 2 = 0 THEN 'high'
           ELSE 'low' END AS confidence,
         CASE WHEN s_suppkey % 5 <> 4 THEN 'urban' END AS setting,
         'place "' || s_name || '", nation ' || s_nationkey AS anchor,
         s_suppkey AS place_id
  FROM (SELECT *, CASE WHEN s_suppkey % 8 = 1 THEN s_suppkey - 1 ELSE s_suppkey END AS p
        FROM supplier))
"""
