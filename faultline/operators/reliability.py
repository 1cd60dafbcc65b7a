"""Repair and failure times per entity."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.text import epoch_seconds, to_event_time

DAY_SECONDS = 86_400
# Wider than the 64-bit numbers, so that ids never reach into the next microsecond.
ID_RANGE = Decimal(10) ** 20
NULL_ID = Decimal(-(10**19))
# A second of an entity is dealt into so many parts.
PARTS = 1024


def with_event_time(
    clean: DataFrame, date: str = "event_date", time: str = "start_time",
    out: str = "event_timestamp",
) -> DataFrame:
    """Events that have a usable time."""
    return clean.withColumn(out, to_event_time(date, time)).filter(F.col(out).isNotNull())


def _metrics(mtbf: Column, duration: str, burden: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_outages"),
        F.round(F.avg(duration), 2).alias("mttr_hours"),
        F.round(mtbf, 2).alias("mtbf_hours"),
        F.round(F.sum(burden), 1).alias("total_customer_hours_interruption"),
    ]


def reliability(
    events: DataFrame, entity: str, ts: str, duration: str, burden: str
) -> DataFrame:
    """Events, mean hours to restore, mean hours between events and total burden per entity.

    The gaps between consecutive events add up to last minus first, so their mean needs no
    window and no sort: each task sends one partial row per entity, and an entity that holds
    a third of all events costs no more than any other.
    """
    timed = events.filter(F.col(ts).isNotNull())
    span = epoch_seconds(F.max(ts)) - epoch_seconds(F.min(ts))
    mean_gap = F.try_divide(span, (F.count(F.lit(1)) - 1) * 3600)
    return timed.groupBy(entity).agg(*_metrics(mean_gap, duration, burden))


def _with_previous(seconds: DataFrame, entity: str) -> DataFrame:
    """One row per active second of an entity (`__s`), with the one before it as `__previous`.

    The lag runs within one entity and day, which is at most 86,400 rows however many events
    the entity has. Only the first second of a day looks further back, to the last second of
    the entity's previous active day, and that second lag sees one row per day.
    """
    seconds = seconds.withColumn("__day", F.floor(F.col("__s") / DAY_SECONDS))
    last = seconds.groupBy(entity, "__day").agg(F.max("__s").alias("__last"))
    earlier = last.select(
        entity,
        "__day",
        F.lag("__last").over(Window.partitionBy(entity).orderBy("__day")).alias("__before"),
    )
    in_day = F.lag("__s").over(Window.partitionBy(entity, "__day").orderBy("__s"))
    return (
        seconds.withColumn("__in_day", in_day)
        .join(earlier, [entity, "__day"], "left")
        .withColumn("__previous", F.coalesce(F.col("__in_day"), F.col("__before")))
    )


def _first_events(timed: DataFrame, entity: str, ts: str, event_id: str) -> DataFrame:
    """One row per active second of an entity: the part that holds its first event, and the
    hours from the entity's previous active second."""
    # Microsecond, id and part as one number: a number's minimum is taken by hash aggregation.
    micros = F.pmod(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(1_000_000)).cast("decimal(6,0)")
    known = F.coalesce(F.col(event_id), F.lit(NULL_ID)).cast("decimal(20,0)")
    order = (micros * F.lit(ID_RANGE) + known) * F.lit(Decimal(PARTS)) + F.col("__part")
    first = F.min(order.cast("decimal(34,0)")).alias("__first")
    return _with_previous(timed.groupBy(entity, "__s").agg(first), entity).select(
        entity,
        "__s",
        F.pmod(F.col("__first"), F.lit(Decimal(PARTS))).cast("int").alias("__part"),
        ((F.col("__s") - F.col("__previous")) / 3600.0).alias("__gap"),
        F.lit(True).alias("__has_first"),
    )


def reliability_by_seconds(
    events: DataFrame, entity: str, ts: str, duration: str, burden: str
) -> DataFrame:
    """The metrics of `reliability`, with every gap between consecutive events looked at.

    Events within a second have gap 0 between them, so a row per active second carries all
    there is to add up: the events are read once, and their rows never travel.
    """
    timed = events.filter(F.col(ts).isNotNull()).withColumn("__s", epoch_seconds(ts))
    seconds = timed.groupBy(entity, "__s").agg(
        F.count(F.lit(1)).alias("__n"),
        F.sum(duration).alias("__hours"),
        F.count(duration).alias("__timed"),
        F.sum(burden).alias("__burden"),
    )
    n, gaps = F.sum("__n"), F.coalesce(F.sum(F.col("__s") - F.col("__previous")), F.lit(0))
    # events of no entity follow no other
    between = F.when(F.col(entity).isNotNull(), (n - 1) * 3600)
    return _with_previous(seconds, entity).groupBy(entity).agg(
        n.alias("total_outages"),
        F.round(F.try_divide(F.sum("__hours"), F.sum("__timed")), 2).alias("mttr_hours"),
        F.round(F.try_divide(gaps, between), 2).alias("mtbf_hours"),
        F.round(F.sum("__burden"), 1).alias("total_customer_hours_interruption"),
    )


def prior_event_gap(
    events: DataFrame, entity: str, ts: str, event_id: str, out: str = "hours_since_prior_event"
) -> DataFrame:
    """Every timed event with the hours since the same entity's event before it.

    Null for an entity's first event, and for events of no entity. Events within one second
    are ordered by time, then `event_id` (an integer; nulls first, and it need not be unique);
    all but the first of them have gap 0. So rows only need to be numbered within a second,
    which is dealt into parts by the rows' hashes, and the first of one part takes the gap:
    events are shuffled once, and no task holds all events of an entity or of one second.
    """
    timed = events.filter(F.col(ts).isNotNull()).withColumn("__s", epoch_seconds(ts))
    parted = timed.withColumn(
        "__part", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in events.columns]), F.lit(PARTS)).cast("int")
    )
    firsts = _first_events(parted, entity, ts, event_id)
    order = Window.partitionBy(entity, "__s", "__part").orderBy(ts, event_id)
    numbered = parted.withColumn("__turn", F.row_number().over(order))
    later = F.when(F.col(entity).isNotNull(), F.lit(0.0))
    is_first = F.col("__has_first") & (F.col("__turn") == 1)
    gap = F.when(is_first, F.col("__gap")).otherwise(later)
    return (
        numbered.join(firsts, [entity, "__s", "__part"], "left")
        .withColumn(out, gap)
        .select(*events.columns, out)
    )


def reliability_from_gaps(
    gaps: DataFrame,
    entity: str,
    duration: str,
    burden: str,
    gap: str = "hours_since_prior_event",
) -> DataFrame:
    """The metrics of `reliability`, from events that already carry their gaps.

    Gaps are whole seconds, so they are added up as such: the mean does not depend on the
    order in which partial sums arrive.
    """
    seconds = F.round(F.col(gap) * 3600).cast("bigint")
    mean_gap = F.try_divide(F.sum(seconds), F.count(seconds) * 3600)
    return gaps.groupBy(entity).agg(*_metrics(mean_gap, duration, burden))
