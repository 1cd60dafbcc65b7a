"""Report tables over the gold data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.text import percent
from faultline.operators.ranking import counted_before, global_rank, top_ranked

RANK = "reliability_rank"


def ranked(metrics: DataFrame) -> DataFrame:
    return global_rank(metrics, "mtbf_hours", RANK)


def in_order(df: DataFrame, *order: Column, out: str = "position") -> DataFrame:
    """The rows numbered from 1 in a strict order, without gathering them in one task."""
    before = counted_before(df.withColumn("__one", F.lit(1)), list(order), "__one", "__before")
    return before.select(*df.columns, (F.col("__before") + 1).alias(out))


def leaderboard(metrics: DataFrame) -> DataFrame:
    """Ranked metrics, least reliable first in rank; entities with a single event have no mean
    gap and the last one. Readers sort: see :func:`in_order`."""
    return ranked(metrics)


def leaderboard_top(metrics: DataFrame, k: int, entity: str = "feeder_canonical") -> DataFrame:
    """The k least reliable entities; each task keeps only its own k candidates."""
    return top_ranked(metrics, "mtbf_hours", entity, RANK, k)


def type_summary(
    features: DataFrame,
    outage_type: str = "outage_type_canonical",
    duration: str = "duration_hours_num",
    burden: str = "customer_hours_interruption_num",
) -> DataFrame:
    """Events, share, mean duration and total burden per outage type.

    The window over everything sees one row per type, after the aggregation.
    """
    total = F.sum("total_events").over(Window.partitionBy())
    return (
        features.groupBy(outage_type)
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.round(F.avg(duration), 2).alias("avg_duration_hours"),
            F.round(F.sum(burden), 1).alias("total_customer_hours_interruption"),
        )
        .withColumn("pct_of_all_events", percent(F.col("total_events"), total))
        .select(
            outage_type,
            "total_events",
            "pct_of_all_events",
            "avg_duration_hours",
            "total_customer_hours_interruption",
        )
    )


def accuracy_by_class(
    predictions: DataFrame, actual: str = "outage_type_canonical", correct: str = "correct"
) -> DataFrame:
    """Held-out events, hits and hit rate per actual class."""
    hits = F.count_if(F.col(correct))
    return (
        predictions.groupBy(F.col(actual).alias("actual_outage_type"))
        .agg(
            F.count(F.lit(1)).alias("test_set_events"),
            hits.alias("correct_predictions"),
            percent(hits, F.count(F.lit(1))).alias("accuracy_pct"),
        )
    )
