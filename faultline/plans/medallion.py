"""The batch pipeline: bronze, silver, gold, classifier."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline import schemas
from faultline.functions import rules
from faultline.operators import classify, quarantine, rawlayout, reliability
from faultline.operators.classify import ClassifierConfig
from faultline.schemas import MONTH_COLUMN
from faultline.sources.tables import (
    gathered,
    read_table,
    read_table_or_fail,
    write_checked,
    write_json,
    write_table,
)
from faultline.sources.workbooks import read_workbooks

FLAG = "quarantined"
_SILVER_STORED = T.StructType(
    [*schemas.SILVER.fields[:-1], T.StructField(FLAG, T.BooleanType()), schemas.SILVER.fields[-1]]
)


@dataclass(frozen=True)
class PipelineConfig:
    year: int = 2021
    name_rules: rules.NameRules = rules.FEEDER_RULES
    single_file_reliability: bool = False
    classifier: ClassifierConfig = field(default_factory=ClassifierConfig)


def land_bronze(spark: SparkSession, raw_dir: str, lake: str) -> DataFrame:
    """Workbooks to bronze, checked by reading back. Returns rows and months landed."""
    path = f"{lake}/bronze/interruptions"
    bronze = rawlayout.to_bronze(read_workbooks(spark, raw_dir))
    write_checked(spark, gathered(bronze, MONTH_COLUMN), path, MONTH_COLUMN)
    return rawlayout.load_summary(read_table(spark, path, schemas.BRONZE))


def read_silver(spark: SparkSession, lake: str, quarantined: bool = False) -> DataFrame:
    """Clean or quarantined rows; the other half is pruned by folder."""
    stored = read_table(spark, f"{lake}/silver/interruptions", _SILVER_STORED)
    return stored.filter(F.col(FLAG) == quarantined).select(*schemas.SILVER.names)


def refine_silver(spark: SparkSession, lake: str, cfg: PipelineConfig) -> DataFrame:
    """Bronze to silver. Both halves are written by one pass: the flag is a partition column.

    Returns clean, quarantined and unmapped counts, read from the stored flag column.
    """
    bronze = read_table_or_fail(spark, f"{lake}/bronze/interruptions", schemas.BRONZE)
    silver = quarantine.to_silver(bronze, cfg.year, cfg.name_rules, stored=True)
    path = f"{lake}/silver/interruptions"
    write_table(gathered(silver, FLAG, MONTH_COLUMN), path, [FLAG, MONTH_COLUMN])
    stored = read_table(spark, path, _SILVER_STORED)
    return quarantine.quarantine_metrics(stored, FLAG, F.col("is_transformer_event"))


def feeder_reliability(clean: DataFrame) -> DataFrame:
    events = reliability.with_event_time(clean.filter(~F.col("is_transformer_event")))
    return reliability.reliability(
        events,
        "feeder_canonical",
        "event_timestamp",
        "duration_hours_num",
        "customer_hours_interruption_num",
    )


def aggregate_gold(spark: SparkSession, lake: str, cfg: PipelineConfig) -> DataFrame:
    """Silver to gold. Returns the row counts of both tables."""
    clean = read_silver(spark, lake)
    metrics_path, features_path = f"{lake}/gold/mttr_mtbf_by_feeder", f"{lake}/gold/classifier_features"
    write_table(
        feeder_reliability(clean), metrics_path, single_file=cfg.single_file_reliability
    )
    features = gathered(clean.select(*schemas.FEATURES.names), MONTH_COLUMN)
    write_table(features, features_path, MONTH_COLUMN)
    feeders = read_table(spark, metrics_path, schemas.RELIABILITY).agg(F.count(F.lit(1)))
    features = read_table(spark, features_path, schemas.FEATURES)
    return features.agg(F.count(F.lit(1)).alias("n_features")).withColumn(
        "n_feeders", feeders.scalar()
    )


def classify_outages(spark: SparkSession, lake: str, cfg: PipelineConfig) -> DataFrame:
    """Train, predict the held-out rows, store model, predictions and metrics."""
    features = read_table_or_fail(spark, f"{lake}/gold/classifier_features", schemas.FEATURES)
    labeled = classify.with_row_ids(classify.labeled_rows(features, cfg.classifier))
    model, predictions, split = classify.train_and_predict(labeled, "row_id", cfg.classifier)
    models = f"{lake}/models/outage_classifier"
    classify.save_model(spark, model, f"{models}/model")
    path = f"{lake}/gold/classifier_predictions"
    write_table(predictions, path)
    stored = read_table(spark, path, schemas.PREDICTIONS)
    write_json(classify.metrics_document(split, stored, cfg.classifier), f"{models}/metrics")
    return spark.read.schema(schemas.METRICS).json(f"{models}/metrics")


def run_pipeline(
    spark: SparkSession, raw_dir: str, lake: str, cfg: PipelineConfig = PipelineConfig()
) -> dict[str, DataFrame]:
    """All four stages in order; returns the run metrics of each."""
    return {
        "bronze": land_bronze(spark, raw_dir, lake),
        "silver": refine_silver(spark, lake, cfg),
        "gold": aggregate_gold(spark, lake, cfg),
        "classifier": classify_outages(spark, lake, cfg),
    }
