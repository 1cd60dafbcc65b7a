"""Casts, event times, quarantine and canonical names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions import text
from faultline.functions.canon import (
    canonical_type,
    with_canonical_name,
    with_canonical_name_by_spelling,
)
from faultline.operators import names, quality, quarantine, reliability
from faultline.plans.inputs import NAMES, TYPES, pick, sql_values, table
from faultline.plans.registry import query
from faultline.sources.tables import union_frames

YEAR = 1997


@query(
    """WITH raw AS (
      SELECT o_orderkey, o_orderdate, o_totalprice, CASE o_orderkey % 8
        WHEN 0 THEN CAST(o_totalprice AS VARCHAR) WHEN 1 THEN ' 3.5 ' WHEN 2 THEN '1,200'
        WHEN 3 THEN 'nan' WHEN 5 THEN '12.0' WHEN 6 THEN '-7'
        WHEN 7 THEN CAST(o_orderkey AS VARCHAR) END AS t FROM orders)
    SELECT o_orderkey,
           CASE o_orderkey % 8 WHEN 0 THEN o_totalprice WHEN 1 THEN 3.5 WHEN 5 THEN 12.0
             WHEN 6 THEN -7.0 WHEN 7 THEN CAST(o_orderkey AS DOUBLE) END AS as_double,
           CASE WHEN t <> 'nan' THEN CAST(trunc(TRY_CAST(t AS DOUBLE)) AS INTEGER) END AS as_int,
           CASE WHEN o_orderkey % 8 = 0 THEN CAST(o_orderdate AS DATE) END AS as_date
    FROM raw"""
)
def lenient_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and dates in texts that are clean, padded, localized, blank or wrong."""
    k = F.col("o_orderkey")
    price, key = F.col("o_totalprice").cast("string"), k.cast("string")
    number = pick(["", " 3.5 ", "1,200", "nan", None, "12.0", "-7", ""], k)
    number = F.when(k % 8 == 0, price).when(k % 8 == 7, key).otherwise(number)
    day = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    day = F.when(k % 8 == 0, day).otherwise(
        pick(["", "05/01/2021", "33kV FEEDERS OUTAGES", "nan", None, "2021-13-01", "x", ""], k)
    )
    raw = table(spark, sf_dir, "orders").select(k, number.alias("number"), day.alias("day"))
    return raw.select(
        k,
        text.to_double("number").alias("as_double"),
        text.to_int("number").alias("as_int"),
        text.to_date("day").alias("as_date"),
    )


@query(
    """SELECT event_id, date_trunc('second', ts) AS event_timestamp
    FROM events WHERE event_id % 7 <> 2 AND event_id % 7 <> 3 AND event_id % 7 <> 4"""
)
def event_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date and clock text to a time; events with a blank or wrong clock are left out."""
    i = F.col("event_id")
    clock = (
        F.when(i % 7 == 2, F.lit(None).cast("string"))
        .when(i % 7 == 3, "nan")
        .when(i % 7 == 4, "1900-01-01 00:00:00")
        .otherwise(F.date_format("ts", "HH:mm:ss"))
    )
    raw = table(spark, sf_dir, "events").select(
        i, F.col("ts").cast("date").alias("event_date"), clock.alias("start_time")
    )
    return reliability.with_event_time(raw).select("event_id", "event_timestamp")


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    dirty = pick(["33kV FEEDERS OUTAGES", "05/01/1997", None, "nan"], k)
    day = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    raw = table(spark, sf_dir, "orders").select(
        k, "o_orderpriority", F.when(k % 10 < 4, dirty).otherwise(day).alias("date_raw")
    )
    return quarantine.with_quarantine_flag(
        raw.withColumn("event_date", text.to_date("date_raw")), "event_date", YEAR
    )


_DATED_SQL = f"""
dated AS (
  SELECT o_orderkey, o_orderpriority,
         CASE WHEN o_orderkey % 10 >= 4 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
              WHEN o_orderkey % 4 = 0 THEN '33kV FEEDERS OUTAGES'
              WHEN o_orderkey % 4 = 1 THEN '05/01/1997'
              WHEN o_orderkey % 4 = 3 THEN 'nan' END AS date_raw,
         CASE WHEN o_orderkey % 10 >= 4 THEN CAST(o_orderdate AS DATE) END AS event_date,
         o_orderkey % 10 >= 4 AND year(o_orderdate) = {YEAR} AS ok
  FROM orders)
"""
_DATED_COLUMNS = "o_orderkey, o_orderpriority, date_raw, event_date"


@query(f"WITH {_DATED_SQL} SELECT {_DATED_COLUMNS} FROM dated WHERE ok")
def quarantine_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine.split_quarantine(_dated_orders(spark, sf_dir))[0]


@query(f"WITH {_DATED_SQL} SELECT {_DATED_COLUMNS} FROM dated WHERE NOT ok")
def quarantine_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine.split_quarantine(_dated_orders(spark, sf_dir))[1]


@query(
    f"""WITH {_DATED_SQL},
    parts AS (SELECT {_DATED_COLUMNS} FROM dated WHERE ok
              UNION ALL SELECT {_DATED_COLUMNS} FROM dated WHERE NOT ok),
    swapped AS (
      SELECT o_orderkey, CASE WHEN o_orderkey % 1000 = 0 THEN date_raw ELSE o_orderpriority END
               AS o_orderpriority,
             CASE WHEN o_orderkey % 1000 = 0 THEN o_orderpriority ELSE date_raw END AS date_raw, event_date
      FROM parts),
    lost AS (SELECT * FROM parts WHERE o_orderkey % 1000 <> 0)
    {" UNION ALL ".join(
        f"SELECT '{case}' AS case_name, (SELECT count(*) FROM dated) AS n_whole,"
        f" (SELECT count(*) FROM {case}) AS n_parts,"
        f" (SELECT count(*) FROM (SELECT {_DATED_COLUMNS} FROM dated EXCEPT ALL"
        f" SELECT {_DATED_COLUMNS} FROM {case})) = 0 AS covered"
        for case in ("parts", "swapped", "lost"))}"""
)
def quarantine_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean and rejected rows are the input, row by row; a swap of two cells is noticed."""
    whole = _dated_orders(spark, sf_dir)
    parts = list(quarantine.split_quarantine(whole))
    columns = parts[0].columns
    odd, first, second = F.col("o_orderkey") % 1000 == 0, F.col("o_orderpriority"), F.col("date_raw")
    swaps = {
        "o_orderpriority": F.when(odd, second).otherwise(first),
        "date_raw": F.when(odd, first).otherwise(second),
    }
    cases = {
        "parts": parts,
        "swapped": [p.withColumns(swaps) for p in parts],
        "lost": [p.filter(~odd) for p in parts],
    }
    found = [
        quality.cover(whole.select(*columns), case).select(F.lit(name).alias("case_name"), "*")
        for name, case in cases.items()
    ]
    return union_frames(found)


@query(
    f"""WITH {_DATED_SQL}
    SELECT count(*) FILTER (ok) AS clean_rows, count(*) FILTER (NOT ok) AS quarantined_rows,
           count(*) FILTER (ok AND o_orderpriority = '4-NOT SPECIFIED') AS unmapped_rows,
           count(*) FILTER (NOT ok) / CAST(count(*) AS DOUBLE) AS quarantine_ratio
    FROM dated"""
)
def quarantine_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    unmapped = F.col("o_orderpriority") == "4-NOT SPECIFIED"
    return quarantine.quarantine_metrics(_dated_orders(spark, sf_dir), unmapped=unmapped)


def named_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw names with a voltage behind them, which the rules take off: nearly as many spellings
    as rows, with the same answers."""
    raw = pick([name for name, _ in NAMES], F.col("event_id"))
    raw = F.concat(raw, F.lit(" "), F.col("event_id").cast("string"), F.lit("KV"))
    return table(spark, sf_dir, "events").select("event_id", raw.alias("raw_name"), "value")


NAMED_SQL = f"""
named AS (
  SELECT event_id, raw_name || ' ' || event_id || 'KV' AS raw_name, feeder_canonical, value
  FROM events JOIN (VALUES {sql_values(NAMES)}) AS v(i, raw_name, feeder_canonical)
    ON event_id % {len(NAMES)} = i)
"""


@query(f"WITH {NAMED_SQL} SELECT event_id, raw_name, feeder_canonical FROM named")
def canon_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = with_canonical_name(named_events(spark, sf_dir), "raw_name")
    return named.select("event_id", "raw_name", "feeder_canonical")


@query(f"WITH {NAMED_SQL} SELECT event_id, raw_name, feeder_canonical FROM named")
def canon_name_by_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = with_canonical_name_by_spelling(named_events(spark, sf_dir), "raw_name")
    return named.select("event_id", "raw_name", "feeder_canonical")


@query(
    f"""WITH {NAMED_SQL}
    SELECT feeder_canonical, feeder_canonical = 'UNMAPPED' AS is_transformer_event,
           count(*) AS n_events
    FROM named GROUP BY ALL"""
)
def canon_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("feeder_canonical") == "UNMAPPED"
    flagged = canon_name(spark, sf_dir).withColumn("is_transformer_event", flag)
    return flagged.groupBy("feeder_canonical", "is_transformer_event").agg(
        F.count(F.lit(1)).alias("n_events")
    )


@query(
    f"""WITH {NAMED_SQL}
    SELECT event_id, feeder_canonical FROM named WHERE feeder_canonical <> 'UNMAPPED'"""
)
def canon_feeders_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = canon_name(spark, sf_dir).filter(F.col("feeder_canonical") != "UNMAPPED")
    return named.select("event_id", "feeder_canonical")


@query(
    f"""SELECT event_id, raw_type, outage_type_canonical
    FROM events JOIN (VALUES {sql_values(TYPES)}) AS v(i, raw_type, outage_type_canonical)
      ON event_id % {len(TYPES)} = i"""
)
def canon_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = pick([name for name, _ in TYPES], F.col("event_id"))
    typed = table(spark, sf_dir, "events").select("event_id", raw.alias("raw_type"))
    return typed.withColumn("outage_type_canonical", canonical_type("raw_type"))


@query(
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent'
             WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'medium' WHEN '5-LOW' THEN 'low'
             ELSE 'OTHER' END AS priority
    FROM orders"""
)
def canon_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = {"1URGENT": "urgent", "2HIGH": "high", "3MEDIUM": "medium", "5LOW": "low"}
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", canonical_type("o_orderpriority", known).alias("priority")
    )


@query(
    f"""WITH {NAMED_SQL}
    SELECT raw_name, count(*) AS n_rows, feeder_canonical AS canonical
    FROM named GROUP BY ALL"""
)
def canon_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine.canon_audit(named_events(spark, sf_dir), "raw_name")


@query(
    f"""WITH {NAMED_SQL}
    SELECT CAST(count(*) AS BIGINT) AS n_rows,
           count(*) FILTER (feeder_canonical <> 'UNMAPPED') AS mapped_rows,
           count(DISTINCT coalesce(raw_name, '?')) FILTER (feeder_canonical <> 'UNMAPPED')
             AS mapped_spellings,
           count(DISTINCT coalesce(raw_name, '?')) FILTER (feeder_canonical = 'UNMAPPED')
             AS unmapped_spellings,
           round(100.0 * count(*) FILTER (feeder_canonical <> 'UNMAPPED') / count(*), 2)
             AS match_pct
    FROM named"""
)
def canon_match_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine.match_rate(canon_audit(spark, sf_dir))


def _listed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of names, as many as there are parts: in the list's order, and bare."""
    part = table(spark, sf_dir, "part")
    name = F.concat_ws(" ", "p_name", "p_partkey")
    return part.select(
        F.col("p_partkey").alias("position"), name.alias("name"), F.translate(name, " ", "").alias("bare")
    )


def _dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a key that holds a part's name, is held by one, or neither."""
    line = table(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "position")
    k, n, bare = F.col("l_orderkey"), F.col("l_linenumber"), F.col("bare")
    key = (
        F.when(k % 4 == 0, F.concat(F.lit("LOT"), n, F.lit("/"), bare, F.lit("FDR")))
        .when(k % 4 == 1, F.substring("bare", 4, 40))
        .when(k % 4 == 2, F.concat(F.lit("x"), F.substring("bare", 3, 40), n))
        .otherwise(F.when(k % 8 == 3, F.substring("bare", 1, 5)).otherwise(bare))
    )
    return line.join(_listed_parts(spark, sf_dir), "position").select(
        "l_orderkey", "l_linenumber", key.alias("key")
    )


_LISTED_SQL = """
listed AS (
  SELECT p_partkey AS position, p_name || ' ' || p_partkey AS name,
         replace(p_name, ' ', '') || p_partkey AS bare FROM part),
lines AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_orderkey % 4 = 0 THEN 'LOT' || l_linenumber || '/' || bare || 'FDR'
              WHEN l_orderkey % 4 = 1 THEN substr(bare, 4, 40)
              WHEN l_orderkey % 4 = 2 THEN 'x' || substr(bare, 3, 40) || l_linenumber
              WHEN l_orderkey % 8 = 3 THEN substr(bare, 1, 5) ELSE bare END AS key
  FROM lineitem JOIN listed ON l_partkey = position)
"""


@query(
    f"""WITH {_LISTED_SQL},
    found AS (
      SELECT key, min(position) AS position
      FROM (SELECT DISTINCT key FROM lines) JOIN listed ON contains(key, bare) OR contains(bare, key)
      GROUP BY key)
    SELECT l_orderkey, l_linenumber, lines.key, listed.name AS canonical
    FROM lines LEFT JOIN found USING (key) LEFT JOIN listed ON listed.position = found.position"""
)
def canon_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names out of a table instead of out of code: an index, not a chain of conditions."""
    return names.with_listed_name(
        _dirty_lines(spark, sf_dir), "key", _listed_parts(spark, sf_dir), "name", "bare", "position", "canonical"
    )


def _misspelt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per spelling of a part's name: a character lost, changed or added, or far off."""
    k, n, name = F.col("l_orderkey"), F.col("l_linenumber"), F.col("p_name")
    at = (k % F.length(name) + 1).cast("int")
    before, behind = F.substr(name, F.lit(1), at - 1), F.substr(name, at + 1)
    spelling = (
        F.when(n == 1, F.concat(before, behind))
        .when(n == 2, F.concat(before, F.lit("q"), behind))
        .when(n == 3, F.concat(before, F.lit("zz"), F.substr(name, at)))
        .when(n == 4, F.concat(F.lit("33KV "), name, k % 1000))
        .otherwise(F.concat(before, k % 100, F.substr(name, at + 2)))
    )
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    lines = table(spark, sf_dir, "lineitem").join(part, "l_partkey")
    return lines.groupBy(spelling.alias("spelling")).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    """WITH base AS (
      SELECT l_linenumber AS n, l_orderkey AS k, p_name, l_orderkey % length(p_name) + 1 AS i
      FROM lineitem JOIN part ON l_partkey = p_partkey),
    spelled AS (
      SELECT CASE n WHEN 1 THEN substr(p_name, 1, i - 1) || substr(p_name, i + 1)
                    WHEN 2 THEN substr(p_name, 1, i - 1) || 'q' || substr(p_name, i + 1)
                    WHEN 3 THEN substr(p_name, 1, i - 1) || 'zz' || substr(p_name, i)
                    WHEN 4 THEN '33KV ' || p_name || (k % 1000)
                    ELSE substr(p_name, 1, i - 1) || (k % 100) || substr(p_name, i + 2) END AS spelling
      FROM base),
    audit AS (SELECT spelling, count(*) AS n_rows FROM spelled GROUP BY spelling)
    SELECT spelling, name, levenshtein(spelling, name) AS distance, n_rows
    FROM audit, (SELECT DISTINCT p_name AS name FROM part) WHERE levenshtein(spelling, name) <= 2"""
)
def canon_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names within two edits of a spelling, with the rows that a rule would map."""
    parts = table(spark, sf_dir, "part").select("p_name")
    found = names.proposals(_misspelt(spark, sf_dir), "spelling", parts, "p_name")
    return found.withColumn("distance", F.col("distance").cast("bigint"))
