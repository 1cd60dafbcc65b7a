"""Typing of bronze rows and routing of rows without a usable date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions import rules
from faultline.functions.canon import (
    canonical_type,
    with_canonical_name,
    with_canonical_name_by_spelling,
)
from faultline.functions.text import as_column, to_date, to_double, to_int
from faultline.schemas import SILVER

MEASURES = (
    "duration_hours",
    "load_loss_mw",
    "no_of_customers_restored",
    "customer_hours_interruption",
)


def in_year(date: Column | str, year: int) -> Column:
    """Date lies in the year; false, never null, for a missing date."""
    days = F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year}-12-31").cast("date")
    return F.coalesce(as_column(date).between(*days), F.lit(False))


def with_quarantine_flag(df: DataFrame, date: str, year: int, out: str = "quarantined") -> DataFrame:
    return df.withColumn(out, ~in_year(date, year))


def split_quarantine(df: DataFrame, flag: str = "quarantined") -> tuple[DataFrame, DataFrame]:
    """(clean, rejected): disjoint, and together the whole input."""
    return df.filter(~F.col(flag)).drop(flag), df.filter(F.col(flag)).drop(flag)


def to_silver(
    bronze: DataFrame,
    year: int,
    name_rules: rules.NameRules = rules.FEEDER_RULES,
    stored: bool = False,
) -> DataFrame:
    """Typed and canonical rows with their `quarantined` flag; no row is dropped.

    From a stored bronze table, names are looked up by spelling.
    """
    canonicalize = with_canonical_name_by_spelling if stored else with_canonical_name
    named = canonicalize(bronze, "name_of_affected_feeder", cfg=name_rules)
    typed = named.withColumns(
        {
            "event_date": to_date("date_raw"),
            "outage_type_canonical": canonical_type("type_of_outage"),
            "is_transformer_event": F.col("feeder_canonical") == name_rules.unmapped,
            **{f"{m}_num": to_double(m) for m in MEASURES},
            "event_no_num": to_int("event_no"),
        }
    )
    return with_quarantine_flag(typed, "event_date", year).select(*SILVER.names, "quarantined")


def quarantine_metrics(
    df: DataFrame, flag: str = "quarantined", unmapped: Column | None = None
) -> DataFrame:
    """Clean, rejected and unmapped counts and the rejected share, in one pass."""
    rejected = F.col(flag)
    counts = [
        F.count_if(~rejected).alias("clean_rows"),
        F.count_if(rejected).alias("quarantined_rows"),
    ]
    if unmapped is not None:
        counts.append(F.count_if(~rejected & unmapped).alias("unmapped_rows"))
    return df.agg(*counts).withColumn(
        "quarantine_ratio",
        F.try_divide(
            F.col("quarantined_rows").cast("double"), F.col("clean_rows") + F.col("quarantined_rows")
        ),
    )


def canon_audit(
    df: DataFrame, raw: str, name_rules: rules.NameRules = rules.FEEDER_RULES
) -> DataFrame:
    """Rows per raw spelling with the name it maps to.

    Spellings are counted first, so the rules run once per distinct spelling.
    """
    spellings = df.groupBy(raw).agg(F.count(F.lit(1)).alias("n_rows"))
    return with_canonical_name(spellings, raw, "canonical", name_rules)


def match_rate(audit: DataFrame, unmapped: str = rules.UNMAPPED) -> DataFrame:
    """Share of rows, and number of spellings, that map to a canonical name."""
    mapped = F.col("canonical") != unmapped
    return audit.agg(
        F.sum("n_rows").alias("n_rows"),
        F.coalesce(F.sum(F.when(mapped, F.col("n_rows"))), F.lit(0)).alias("mapped_rows"),
        F.count_if(mapped).alias("mapped_spellings"),
        F.count_if(~mapped).alias("unmapped_spellings"),
    ).withColumn(
        "match_pct", F.round(F.try_divide(100.0 * F.col("mapped_rows"), F.col("n_rows")), 2)
    )
