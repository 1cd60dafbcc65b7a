"""The canonicalization rules as SQL functions, for use in query text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from faultline.functions import rules
from faultline.functions.canon import key_sql, name_sql, type_sql


def register_sql_functions(
    spark: SparkSession, name_rules: rules.NameRules = rules.FEEDER_RULES
) -> None:
    """Temporary functions canonical_feeder(raw) and canonical_outage_type(raw)."""
    name = f"""(SELECT {name_sql("t", "k", name_rules)}
      FROM (SELECT t, {key_sql("t", name_rules)} AS k FROM (SELECT upper(raw) AS t)))"""
    for function, body in {"canonical_feeder": name, "canonical_outage_type": type_sql("raw")}.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {function}(raw STRING) RETURNS STRING RETURN {body}"
        )
