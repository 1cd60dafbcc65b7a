"""Raw sheets, files, sinks, catalog tables and file streams."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline import schemas
from faultline.functions.sql import register_sql_functions
from faultline.functions.text import month_from_name, null_tokens
from faultline.operators import quality, quarantine, rawlayout, reliability, summaries
from faultline.plans import medallion
from faultline.plans.inputs import (
    FILE_NAMES,
    GAPS_SQL,
    NAMES,
    PLACES_SQL,
    TYPES,
    outages,
    pick,
    places,
    sql_values,
    table,
)
from faultline.plans.registry import query
from faultline.session import shared_dir, stored
from faultline.sources import catalog
from faultline.sources.tables import gathered, read_locations, union_frames, write_table
from faultline.streaming.ingest import ingest_parquet

_IS_HEADER = "assistant"


@query(
    f"""SELECT c.conv_id, c.turn, c.role, c.text, h.header_idx
    FROM conversations c JOIN (
      SELECT conv_id, min(turn) AS header_idx FROM conversations
      WHERE turn < 10 AND role = '{_IS_HEADER}' GROUP BY conv_id) h USING (conv_id)
    WHERE c.turn > h.header_idx"""
)
def header_detect_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows after the first row near the top that has the marker cell, per group."""
    grid = table(spark, sf_dir, "conversations")
    marker = rawlayout.has_cell(F.array("role"), _IS_HEADER)
    below = rawlayout.rows_after_header(grid, marker, "conv_id", "turn", on_missing="report")
    return below.select("conv_id", "turn", "role", "text", "header_idx")


@query(
    f"""SELECT conv_id FROM conversations GROUP BY conv_id
    HAVING count(*) FILTER (turn < 10 AND role = '{_IS_HEADER}') = 0"""
)
def header_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = table(spark, sf_dir, "conversations")
    marker = rawlayout.has_cell(F.array("role"), _IS_HEADER)
    return rawlayout.files_without_header(grid, marker, "conv_id", "turn")


@query(
    """SELECT strftime(l_shipdate, '%Y-%m-%d') AS date_raw, l_returnflag AS location,
      CASE l_linestatus WHEN 'F' THEN NULL ELSE l_linestatus END AS name_of_affected_feeder,
      CAST(l_orderkey AS VARCHAR) AS event_no, CAST(l_partkey AS VARCHAR) AS type_of_outage,
      CAST(l_suppkey AS VARCHAR) AS nature_cause_of_outage,
      CAST(l_linenumber AS VARCHAR) AS relay_target,
      CAST(l_quantity AS VARCHAR) AS start_time, CAST(l_extendedprice AS VARCHAR) AS time_restored,
      CAST(l_discount AS VARCHAR) AS duration_hours, CAST(l_tax AS VARCHAR) AS load_loss_mw,
      CAST(NULL AS VARCHAR) AS no_of_customers_restored,
      CAST(NULL AS VARCHAR) AS total_customers_served,
      l_linestatus || l_returnflag AS customer_hours_interruption, 'end' AS remarks
    FROM lineitem"""
)
def positional_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen cells to fifteen named columns; blank and missing-value texts become null."""
    status = F.col("l_linestatus")
    cells = [
        F.date_format("l_shipdate", "yyyy-MM-dd"),
        F.col("l_returnflag"),
        F.when(status == "F", "nan").otherwise(status),
        *[
            F.col(c).cast("string")
            for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                      "l_extendedprice", "l_discount", "l_tax")
        ],
        F.lit(""),
        F.lit(None).cast("string"),
        F.concat(status, "l_returnflag"),
        F.lit("end"),
        F.lit("cut"),
    ]
    grid = table(spark, sf_dir, "lineitem").select(F.array(*cells).alias("cells"))
    return grid.select(*rawlayout.named_cells("cells"))


@query(
    f"""SELECT event_id, source_file, source_month
    FROM events JOIN (VALUES {sql_values(FILE_NAMES)}) AS v(i, source_file, source_month)
      ON event_id % {len(FILE_NAMES)} = i"""
)
def month_from_file_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = pick([name for name, _ in FILE_NAMES], F.col("event_id"))
    named = table(spark, sf_dir, "events").select("event_id", name.alias("source_file"))
    return named.withColumn("source_month", month_from_name("source_file"))


@query(
    f"""SELECT source_file, min(source_month) AS source_month, count(*) AS n_rows,
           CAST(1 AS BIGINT) AS n_loads
    FROM events JOIN (VALUES {sql_values(FILE_NAMES)}) AS v(i, source_file, source_month)
      ON event_id % {len(FILE_NAMES)} = i
    GROUP BY source_file"""
)
def provenance_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per source file; all rows of a run carry the same load time."""
    path = F.concat(F.lit("file:/raw/in/"), pick([n for n, _ in FILE_NAMES], F.col("event_id")))
    landed = table(spark, sf_dir, "events").select(*rawlayout.provenance(path))
    return landed.groupBy("source_file", "source_month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("ingested_at").alias("n_loads")
    )


@query(
    f"""SELECT count(*) AS n_rows, count(DISTINCT source_month) AS n_months
    FROM events JOIN (VALUES {sql_values(FILE_NAMES)}) AS v(i, source_file, source_month)
      ON event_id % {len(FILE_NAMES)} = i"""
)
def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rawlayout.load_summary(month_from_file_name(spark, sf_dir))


def _sheet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw sheet rows with dirty names, types, dates and clock texts."""
    i = F.col("event_id")
    clock = F.when(i % 41 == 5, F.lit(None).cast("string")).otherwise(
        F.date_format("ts", "HH:mm:ss")
    )
    day = F.date_format("ts", "yyyy-MM-dd 00:00:00")
    return table(spark, sf_dir, "events").select(
        i,
        F.when(i % 29 == 3, "1900-01-07 00:00:00").otherwise(day).alias("date_raw"),
        pick([name for name, _ in NAMES], i).alias("name_of_affected_feeder"),
        i.alias("event_no"),
        pick([name for name, _ in TYPES], i).alias("type_of_outage"),
        clock.alias("start_time"),
        F.when(i % 50 != 3, F.sqrt("value")).alias("duration_hours"),
        (F.col("value") * 2).alias("load_loss_mw"),
        (i % 100).alias("no_of_customers_restored"),
        (F.sqrt("value")).alias("customer_hours_interruption"),
    )


_SILVER_SQL = f"""
silver AS (
  SELECT event_id, feeder_canonical, outage_type_canonical, event_id % 29 <> 3 AS clean,
         CASE WHEN event_id % 41 <> 5 THEN ts END AS ts,
         CASE WHEN event_id % 50 <> 3 THEN sqrt(value) END AS duration, sqrt(value) AS burden
  FROM events
  JOIN (VALUES {sql_values(NAMES)}) AS n(i, raw_name, feeder_canonical)
    ON event_id % {len(NAMES)} = n.i
  JOIN (VALUES {sql_values(TYPES)}) AS t(i, raw_type, outage_type_canonical)
    ON event_id % {len(TYPES)} = t.i)
"""


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheet rows by position to bronze columns, all text, to silver."""
    rows = _sheet_rows(spark, sf_dir)
    cells = [F.col(c).cast("string") if c in rows.columns else F.lit("") for c in schemas.RAW_COLUMNS]
    grid = rows.select(
        F.array(*cells).alias("cells"),
        F.concat(F.lit("file:/raw/"), pick([n for n, _ in FILE_NAMES], F.col("event_id"))).alias("source_file"),
        F.lit(1).alias("row_idx"),
        F.lit(0).alias("header_idx"),
    )
    return quarantine.to_silver(rawlayout.to_bronze(grid), 2024)


@query(
    f"""WITH {_SILVER_SQL},
    gaps AS (SELECT *, s - lag(s) OVER (PARTITION BY feeder_canonical ORDER BY s) AS gap
             FROM (SELECT *, epoch_us(ts) // 1000000 AS s FROM silver
                   WHERE clean AND feeder_canonical <> 'UNMAPPED' AND ts IS NOT NULL))
    SELECT feeder_canonical, count(*) AS total_outages, round(avg(duration), 2) AS mttr_hours,
           round(sum(gap) / CAST(count(gap) * 3600 AS DOUBLE), 2) AS mtbf_hours,
           round(sum(burden), 1) AS total_customer_hours_interruption
    FROM gaps GROUP BY feeder_canonical"""
)
def sheet_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheet rows to bronze to silver to gold, all stages in one plan."""
    clean = quarantine.split_quarantine(_silver(spark, sf_dir))[0]
    return medallion.feeder_reliability(clean)


@query(
    f"""WITH {_SILVER_SQL}
    SELECT outage_type_canonical, count(*) AS total_events,
           round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct_of_all_events,
           round(avg(duration), 2) AS avg_duration_hours,
           round(sum(burden), 1) AS total_customer_hours_interruption
    FROM silver WHERE clean AND feeder_canonical <> 'UNMAPPED'
    GROUP BY outage_type_canonical"""
)
def sheet_type_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = quarantine.split_quarantine(_silver(spark, sf_dir))[0]
    features = clean.select(*schemas.FEATURES.names)
    return summaries.type_summary(features.filter(~F.col("is_transformer_event")))


def _locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations whose texts hold commas, quotes and line breaks."""
    rows = places(spark, sf_dir)
    return rows.withColumn("anchor", F.concat("anchor", F.lit("\n, second line"))).select(
        *schemas.LOCATIONS.names
    )


def _locations_csv(spark: SparkSession, sf_dir: str) -> str:
    path = shared_dir(spark, "locations")
    _locations(spark, sf_dir).write.option("header", "true").option("escape", '"').csv(path)
    return path


@query(
    f"""WITH {PLACES_SQL}
    SELECT feeder_canonical, latitude, longitude, service_radius_km, confidence, setting,
           anchor || chr(10) || ', second line' AS anchor
    FROM places"""
)
def csv_quoted_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_locations(spark, _locations_csv(spark, sf_dir))


@contextmanager
def _scratch_database(spark: SparkSession) -> Iterator[str]:
    """A database that is gone afterwards; its tables are external, so their files stay."""
    name = f"scratch_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION :path", args={"path": shared_dir(spark, "database")})
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


@query(
    """SELECT l_returnflag, count(*) AS n_rows, round(sum(l_quantity), 2) AS sum_qty,
           count(DISTINCT l_orderkey) AS n_orders
    FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_returnflag"""
)
def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write by partition, register as a table, replace one partition, read one back."""
    items = table(spark, sf_dir, "lineitem")
    path = shared_dir(spark, "lineitem")
    marred = F.when(F.col("l_returnflag") == "R", 0.0).otherwise(F.col("l_quantity"))
    flag = "l_returnflag"
    write_table(gathered(items.withColumn("l_quantity", marred), flag), path, flag)
    fixed = items.filter(F.col(flag) == "R")
    write_table(gathered(fixed, flag), path, flag, replace_only_written=True)
    order = [c for c in items.columns if c != flag] + [flag]
    with _scratch_database(spark) as database:
        catalog.create_parquet_table(
            spark, database, "lineitem", items.select(*order).schema, path, flag
        )
        one = spark.table(f"{database}.lineitem").filter(F.col(flag) == "R")
        totals = one.groupBy(flag).agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
            F.countDistinct("l_orderkey").alias("n_orders"),
        )
        return stored(totals, "one-partition")


@query(
    """SELECT reading, count(*) AS n_rows, round(sum(l_quantity), 2) AS sum_qty
    FROM lineitem,
      (SELECT unnest(['1 first', '2 after a refused one', '3 corrected']) AS reading)
    WHERE l_returnflag = 'R' AND (reading[1] <> '3' OR l_quantity > 10)
    GROUP BY reading"""
)
def atomic_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partition is published, kept when its successor does not hold, and replaced as a whole."""
    flag, path = "l_returnflag", shared_dir(spark, "published")
    items = table(spark, sf_dir, "lineitem")
    returned = items.filter(F.col(flag) == "R")
    rules = [
        quality.Constraint("positive", "l_quantity > 0"),
        quality.Constraint("cheap", "l_extendedprice < 1000", fails=False),
    ]
    versions = [
        ("1 first", returned),
        ("2 after a refused one", returned.withColumn("l_quantity", -F.col("l_quantity"))),
        ("3 corrected", returned.filter("l_quantity > 10")),
    ]
    order = [c for c in items.columns if c != flag] + [flag]
    write_table(items.limit(0), f"{path}/table", flag)
    readings = []
    with _scratch_database(spark) as database:
        catalog.create_parquet_table(
            spark, database, "lineitem", items.select(*order).schema, f"{path}/table", flag
        )
        for reading, rows in versions:
            try:
                catalog.publish_partition(spark, rows, database, "lineitem", (flag, "R"), path, rules)
            except quality.ViolatedError:
                pass  # the second one
            totals = spark.table(f"{database}.lineitem").filter(F.col(flag) == "R").agg(
                F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("l_quantity"), 2).alias("sum_qty")
            )
            readings.append(stored(totals.select(F.lit(reading).alias("reading"), "*"), "reading"))
    return union_frames(readings)


def _lake(spark: SparkSession, sf_dir: str) -> str:
    """A lake with the gold metrics of the events, and the other tables empty but there."""
    lake = shared_dir(spark, "lake")
    metrics = reliability.reliability(
        outages(spark, sf_dir), "entity", "ts", "duration_hours", "customer_hours"
    ).withColumnRenamed("entity", "feeder_canonical")
    named = metrics.withColumn(
        "feeder_canonical",
        F.concat(F.lit("Supplier#"), F.lpad(F.col("feeder_canonical").cast("string"), 9, "0")),
    )
    i = F.col("event_id")
    events = table(spark, sf_dir, "events").select(
        F.lit("x").alias("feeder_canonical"),
        F.col("event_type").alias("outage_type_canonical"),
        F.when(i % 50 != 3, F.sqrt("value")).alias("duration_hours_num"),
        (F.sqrt("value") * (i % 100)).alias("customer_hours_interruption_num"),
        (i % 19 == 2).alias("is_transformer_event"),
        F.date_format("ts", "yyyy-MM").alias("source_month"),
        F.col("event_type").alias("predicted_outage_type"),
        (i % 3 != 0).alias("correct"),
    )
    filled = {
        "mttr_mtbf_by_feeder": named,
        "classifier_features": events,
        "classifier_predictions": events.filter(i % 5 == 0),
    }
    for name, (schema, folder, partition_by) in catalog.LAKE_TABLES.items():
        rows = filled.get(name, spark.createDataFrame([], schema))
        columns = [
            F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        ]
        write_table(rows.select(*columns), f"{lake}/{folder}", partition_by)
    return lake


_VIEW_SQL = f"""WITH {GAPS_SQL}, {PLACES_SQL},
named AS (SELECT * REPLACE ('Supplier#' || lpad(CAST(entity AS VARCHAR), 9, '0') AS entity) FROM metrics)
"""


@query(
    f"""{_VIEW_SQL}
    SELECT m.entity AS feeder_canonical, m.mtbf_hours, l.confidence AS location_confidence,
           l.latitude, l.longitude, l.service_radius_km
    FROM named m LEFT JOIN places l ON m.entity = l.feeder_canonical"""
)
def view_reliability_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through the catalog: tables, all-text locations, a stored view, and query text."""
    lake, csv = _lake(spark, sf_dir), _locations_csv(spark, sf_dir)
    with _scratch_database(spark) as database:
        catalog.register_lake(spark, database, lake, csv)
        catalog.create_views(spark, database)
        return stored(
            spark.sql(
                f"""SELECT feeder_canonical, mtbf_hours, location_confidence, latitude, longitude,
                service_radius_km FROM {database}.feeder_reliability_map"""
            ),
            "view-map",
        )


@query(
    f"""{_VIEW_SQL}
    SELECT entity AS feeder_canonical, mtbf_hours,
           CAST(rank() OVER (ORDER BY mtbf_hours ASC NULLS LAST) AS BIGINT) AS reliability_rank
    FROM named"""
)
def view_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, csv = _lake(spark, sf_dir), _locations_csv(spark, sf_dir)
    with _scratch_database(spark) as database:
        catalog.register_lake(spark, database, lake, csv)
        catalog.create_views(spark, database)
        return stored(
            spark.sql(
                f"""SELECT feeder_canonical, mtbf_hours, CAST(reliability_rank AS BIGINT)
                AS reliability_rank FROM {database}.mttr_mtbf_leaderboard"""
            ),
            "view-board",
        )


def _view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    lake, csv = _lake(spark, sf_dir), _locations_csv(spark, sf_dir)
    with _scratch_database(spark) as database:
        catalog.register_lake(spark, database, lake, csv)
        catalog.create_views(spark, database)
        spark.sql("USE IDENTIFIER(:name)", args={"name": database})
        try:
            return stored(spark.sql(text), "view-rows")
        finally:
            spark.sql("USE default")


@query(
    """SELECT event_type AS outage_type_canonical, count(*) AS total_events,
           round(CAST(100 AS DOUBLE) * count(*) / sum(count(*)) OVER (), 1) AS pct_of_all_events,
           round(avg(CASE WHEN event_id % 50 <> 3 THEN sqrt(value) END), 2) AS avg_duration_hours,
           round(sum(sqrt(value) * (event_id % 100)), 1) AS total_customer_hours_interruption
    FROM events WHERE event_id % 19 <> 2 GROUP BY event_type"""
)
def view_type_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "SELECT * FROM outage_type_summary")


@query(
    """SELECT event_type AS actual_outage_type, count(*) AS test_set_events,
           count(*) FILTER (event_id % 3 <> 0) AS correct_predictions,
           round(CAST(100 AS DOUBLE) * count(*) FILTER (event_id % 3 <> 0) / count(*), 1) AS accuracy_pct
    FROM events WHERE event_id % 5 = 0 GROUP BY event_type"""
)
def view_accuracy_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "SELECT * FROM classifier_accuracy_by_type")


@query(
    f"""SELECT event_id, raw_name, feeder_canonical, outage_type_canonical
    FROM (SELECT event_id, n.raw_name || ' ' || event_id || 'KV' AS raw_name, feeder_canonical,
                 outage_type_canonical
          FROM events
          JOIN (VALUES {sql_values(NAMES)}) AS n(i, raw_name, feeder_canonical)
            ON event_id % {len(NAMES)} = n.i
          JOIN (VALUES {sql_values(TYPES)}) AS t(i, raw_type, outage_type_canonical)
            ON event_id % {len(TYPES)} = t.i)"""
)
def canon_in_query_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules as functions of SQL text."""
    register_sql_functions(spark)
    raw = pick([name for name, _ in NAMES], F.col("event_id"))
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(raw, F.lit(" "), F.col("event_id").cast("string"), F.lit("KV")).alias("raw_name"),
        pick([name for name, _ in TYPES], F.col("event_id")).alias("raw_type"),
    )
    return spark.sql(
        """SELECT event_id, raw_name, canonical_feeder(raw_name) AS feeder_canonical,
        canonical_outage_type(raw_type) AS outage_type_canonical FROM {rows}""",
        rows=rows,
    )


@query("SELECT event_type, count(*) AS n_events, max(value) AS max_value FROM events GROUP BY 1")
def single_file_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small aggregate in one file."""
    path = shared_dir(spark, "single")
    totals = table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.max("value").alias("max_value")
    )
    write_table(totals, path, single_file=True)
    return spark.read.schema(totals.schema).parquet(path)


@query(
    """SELECT event_id, ts, user_id, value,
           CASE event_type WHEN 'click' THEN NULL ELSE event_type END AS event_type
    FROM events"""
)
def stream_file_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events dropped as several files, taken up by a stream in two runs; equals the batch."""
    events = table(spark, sf_dir, "events").drop("props")
    landing, target = shared_dir(spark, "landing"), shared_dir(spark, "streamed")
    checkpoint = shared_dir(spark, "offsets")
    days = F.dayofmonth("ts")

    def cleaned(df: DataFrame) -> DataFrame:
        kind = F.when(F.col("event_type") == "click", "nan").otherwise(F.col("event_type"))
        return df.withColumn("event_type", null_tokens(kind))

    whole = None
    for drop in (days <= 15, ~F.coalesce(days <= 15, F.lit(False))):
        events.filter(drop).write.mode("append").parquet(landing)
        whole = ingest_parquet(
            spark, landing, events.schema, target, checkpoint, cleaned, "event_type", 3
        )
    return whole.select("event_id", "ts", "user_id", "value", "event_type")
