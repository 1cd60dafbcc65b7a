"""Ranks over a whole table without a window that gathers it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.session import stored


def counted_before(counts: DataFrame, order: list[Column], n: str, out: str) -> DataFrame:
    """Adds the sum of `n` over all rows before each in the order, which is strict.

    Rows are dealt to ranges of the order and stored, so that every reader sees the same
    ranges. Sums run inside a range; the ranges' totals are one row each.
    """
    ranged = stored(
        counts.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "ranges"
    )
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("__range").agg(F.sum(n).alias("__total"))
    lower = totals.select(
        F.col("__range").alias("__of"),
        F.coalesce(F.sum("__total").over(before.orderBy("__range")), F.lit(0)).alias("__lower"),
    )
    inside = F.coalesce(F.sum(n).over(before.partitionBy("__range").orderBy(*order)), F.lit(0))
    return (
        ranged.withColumn("__inside", inside)
        .join(lower, F.col("__range") == F.col("__of"))
        .select(*counts.columns, (F.col("__lower") + F.col("__inside")).cast("bigint").alias(out))
    )


def global_rank(df: DataFrame, value: str, out: str) -> DataFrame:
    """RANK() over (ORDER BY value ASC NULLS LAST).

    A rank is one more than the number of rows with a smaller value: rows are counted per
    distinct value, and counts are added up over ranges of values. Ranks return to the rows by
    a join on the value, which Spark splits where very many rows share one. `df` is read
    twice, so it should be a stored table.
    """
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("__n"))
    before = counted_before(counts, [F.col(value).asc_nulls_last()], "__n", "__before")
    ranks = before.select(F.col(value).alias("__v"), (F.col("__before") + 1).alias(out))
    return df.join(ranks, F.col(value).eqNullSafe(F.col("__v"))).select(*df.columns, out)


def top_ranked(df: DataFrame, value: str, key: str, out: str, k: int) -> DataFrame:
    """The k first rows of the ranking. Ties are cut by key; their ranks are those of the
    whole table, because every row with a smaller value is among the k rows too."""
    first = df.orderBy(F.col(value).asc_nulls_last(), key).limit(k)
    rank = F.rank().over(Window.orderBy(F.col(value).asc_nulls_last()))
    return first.withColumn(out, rank.cast("bigint"))
