"""Explicit schema of every table. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: the columns of the raw sheet by position, and the names of all tables -----
RAW_COLUMNS = (
    "date_raw",
    "location",
    "name_of_affected_feeder",
    "event_no",
    "type_of_outage",
    "nature_cause_of_outage",
    "relay_target",
    "start_time",
    "time_restored",
    "duration_hours",
    "load_loss_mw",
    "no_of_customers_restored",
    "total_customers_served",
    "customer_hours_interruption",
    "remarks",
)
MONTH_COLUMN = "source_month"

STRING, DOUBLE, INT, LONG = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()
DATE, BOOLEAN = T.DateType(), T.BooleanType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


BRONZE = _schema(
    **dict.fromkeys(RAW_COLUMNS, STRING),
    source_file=STRING,
    ingested_at=STRING,
    source_month=STRING,
)

SILVER = T.StructType(
    BRONZE.fields[:-1]
    + _schema(
        event_date=DATE,
        feeder_canonical=STRING,
        outage_type_canonical=STRING,
        is_transformer_event=BOOLEAN,
        duration_hours_num=DOUBLE,
        load_loss_mw_num=DOUBLE,
        no_of_customers_restored_num=DOUBLE,
        customer_hours_interruption_num=DOUBLE,
        event_no_num=INT,
        source_month=STRING,
    ).fields
)

RELIABILITY = _schema(
    feeder_canonical=STRING,
    total_outages=LONG,
    mttr_hours=DOUBLE,
    mtbf_hours=DOUBLE,
    total_customer_hours_interruption=DOUBLE,
)

FEATURES = _schema(
    feeder_canonical=STRING,
    outage_type_canonical=STRING,
    duration_hours_num=DOUBLE,
    load_loss_mw_num=DOUBLE,
    no_of_customers_restored_num=DOUBLE,
    customer_hours_interruption_num=DOUBLE,
    event_no_num=INT,
    is_transformer_event=BOOLEAN,
    source_month=STRING,
)

PREDICTIONS = _schema(
    feeder_canonical=STRING,
    outage_type_canonical=STRING,
    source_month=STRING,
    predicted_outage_type=STRING,
    correct=BOOLEAN,
)

LOCATIONS = _schema(
    feeder_canonical=STRING,
    latitude=DOUBLE,
    longitude=DOUBLE,
    service_radius_km=DOUBLE,
    confidence=STRING,
    setting=STRING,
    anchor=STRING,
)

METRICS = _schema(
    accuracy=DOUBLE,
    train_rows=LONG,
    test_rows=LONG,
    classes=T.ArrayType(STRING),
    per_class=T.MapType(STRING, _schema(precision=DOUBLE, recall=DOUBLE, f1=DOUBLE)),
)

BINARY_FILE = _schema(
    path=STRING, modificationTime=T.TimestampType(), length=LONG, content=T.BinaryType()
)
