"""Reliability, rankings and reports over events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.operators import mapping, reliability, summaries
from faultline.plans.inputs import GAPS_SQL, OUTAGES_SQL, PLACES_SQL, outages, places, table
from faultline.plans.registry import query
from faultline.session import shared_dir, stored
from faultline.sources.tables import gathered, read_table, union_frames, write_table

METRICS = ("entity", "ts", "duration_hours", "customer_hours")


@query(
    f"""WITH {GAPS_SQL}
    SELECT event_id, entity, ts, outage_type, duration_hours, customer_hours,
           hours_since_prior_event
    FROM gaps"""
)
def prior_event_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reliability.prior_event_gap(outages(spark, sf_dir), "entity", "ts", "event_id")


@query(f"WITH {GAPS_SQL} SELECT * FROM metrics")
def reliability_by_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reliability.reliability_by_seconds(outages(spark, sf_dir), *METRICS)


@query(f"WITH {GAPS_SQL} SELECT * FROM metrics")
def reliability_windowless(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reliability.reliability(outages(spark, sf_dir), *METRICS)


@query(
    f"""WITH {GAPS_SQL}
    SELECT *, CAST(rank() OVER (ORDER BY mtbf_hours ASC NULLS LAST) AS BIGINT)
             AS reliability_rank
    FROM metrics"""
)
def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = stored(reliability_windowless(spark, sf_dir), "metrics")
    return summaries.leaderboard(metrics)


@query(
    f"""WITH {GAPS_SQL}
    SELECT entity, mtbf_hours,
           row_number() OVER (ORDER BY mtbf_hours ASC NULLS LAST, entity) AS position
    FROM metrics"""
)
def leaderboard_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order in which a reader sees the leaderboard."""
    metrics = reliability_windowless(spark, sf_dir).select("entity", "mtbf_hours")
    return summaries.in_order(metrics, F.col("mtbf_hours").asc_nulls_last(), F.col("entity"))


@query(
    f"""WITH {GAPS_SQL}
    SELECT *, CAST(rank() OVER (ORDER BY mtbf_hours ASC NULLS LAST) AS BIGINT)
             AS reliability_rank
    FROM metrics ORDER BY mtbf_hours ASC NULLS LAST, entity LIMIT 10"""
)
def leaderboard_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.leaderboard_top(reliability_windowless(spark, sf_dir), 10, "entity")


@query(
    f"""WITH {OUTAGES_SQL}
    SELECT outage_type, count(*) AS total_events,
           round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct_of_all_events,
           round(avg(duration_hours), 2) AS avg_duration_hours,
           round(sum(customer_hours), 1) AS total_customer_hours_interruption
    FROM outages GROUP BY outage_type"""
)
def type_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = outages(spark, sf_dir)
    return summaries.type_summary(events, "outage_type", "duration_hours", "customer_hours")


@query(
    f"""WITH {OUTAGES_SQL}
    SELECT outage_type, count(*) AS total_events,
           row_number() OVER (ORDER BY count(*) DESC, outage_type) AS position
    FROM outages GROUP BY outage_type"""
)
def type_summary_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order in which a reader sees the summary."""
    summary = type_summary(spark, sf_dir).select("outage_type", "total_events")
    return summaries.in_order(summary, F.col("total_events").desc(), F.col("outage_type"))


@query(
    f"""WITH {GAPS_SQL}, {PLACES_SQL}
    SELECT m.*, l.confidence AS location_confidence, l.setting, l.latitude, l.longitude,
           l.service_radius_km,
           'POINT (' || regexp_replace(CAST(l.longitude AS VARCHAR), '\\.0$', '') || ' '
             || regexp_replace(CAST(l.latitude AS VARCHAR), '\\.0$', '') || ')' AS location_wkt
    FROM metrics m LEFT JOIN places l ON m.entity = l.place_id"""
)
def reliability_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = places(spark, sf_dir).withColumn("entity", F.col("place_id"))
    return mapping.reliability_map(reliability_windowless(spark, sf_dir), located, "entity")


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def union_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of parts of the month, each from a folder of its own, put together again."""
    events = table(spark, sf_dir, "events")
    part = F.coalesce(F.floor((F.dayofmonth("ts") - 1) / 8), F.lit(-1)).cast("int")
    path = shared_dir(spark, "months")
    write_table(gathered(events.withColumn("part", part), "part"), path, "part")
    whole = read_table(spark, path, events.withColumn("part", part).schema)
    return union_frames([whole.filter(F.col("part") == i).drop("part") for i in range(-1, 4)])
