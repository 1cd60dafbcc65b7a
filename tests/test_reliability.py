import datetime as dt
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faultline.operators import ranking, reliability, summaries

EPOCH = dt.datetime(2021, 1, 1)
SCHEMA = "id long, entity string, ts timestamp_ntz, hours double, burden double"


def events(spark, rows):
    """rows: (entity, seconds or None)."""
    data = [
        (i, e, None if s is None else EPOCH + dt.timedelta(seconds=s), 1.0 + i % 3, 2.0)
        for i, (e, s) in enumerate(rows)
    ]
    return spark.createDataFrame(data, SCHEMA)


def expected_gaps(rows):
    """Sorted gaps in whole seconds per entity, first event None."""
    out = {}
    for entity in {e for e, _ in rows}:
        times = sorted(s for e, s in rows if e == entity and s is not None)
        whole = [int(s // 1) for s in times]
        if whole:
            out[entity] = [None, *[b - a for a, b in zip(whole, whole[1:])]]
    return out


def got_gaps(spark, rows):
    gaps = reliability.prior_event_gap(events(spark, rows), "entity", "ts", "id").collect()
    out = {}
    for r in sorted(gaps, key=lambda r: (r.ts, r.id)):
        gap = r.hours_since_prior_event
        out.setdefault(r.entity, []).append(None if gap is None else round(gap * 3600))
    return out


FIXTURE = [("a", 0), ("b", 5), ("a", 7200), ("c", None), ("a", 7200), ("a", 10800)]


def test_gaps_stay_within_the_entity(spark):
    assert got_gaps(spark, FIXTURE) == {"a": [None, 7200, 0, 3600], "b": [None]}


def both(spark, rows):
    df = events(spark, rows)
    spans = reliability.reliability(df, "entity", "ts", "hours", "burden")
    gaps = reliability.prior_event_gap(df, "entity", "ts", "id")
    from_gaps = reliability.reliability_from_gaps(gaps, "entity", "hours", "burden")
    by_seconds = reliability.reliability_by_seconds(df, "entity", "ts", "hours", "burden")
    return [sorted(map(tuple, x.collect()), key=repr) for x in (spans, from_gaps, by_seconds)]


def test_metrics(spark):
    spans, from_gaps, by_seconds = both(spark, FIXTURE)
    assert spans == from_gaps == by_seconds
    assert [(r[0], r[1], r[3], r[4]) for r in spans] == [("a", 4, 1.0, 8.0), ("b", 1, None, 2.0)]


def test_one_heavy_entity_with_one_heavy_second(spark):
    rng = random.Random(1)
    rows = [("hot", 86_400 * 3 + 0.25) for _ in range(400)]
    rows += [("hot", rng.randrange(0, 86_400 * 9)) for _ in range(300)]
    rows += [(f"e{i % 40}", rng.random() * 86_400 * 40) for i in range(500)]
    rng.shuffle(rows)
    assert got_gaps(spark, rows) == expected_gaps(rows)


@settings(max_examples=10, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from("abc"), st.none() | st.integers(0, 400_000)),
        min_size=1, max_size=60,
    )
)
def test_both_forms_agree(spark, rows):
    assert got_gaps(spark, rows) == expected_gaps(rows)
    spans, from_gaps, by_seconds = both(spark, rows)
    assert from_gaps == by_seconds
    assert spans == from_gaps


def test_metrics_need_one_shuffle_and_no_sort(spark, plan_of):
    plan = plan_of(reliability.reliability(events(spark, FIXTURE), "entity", "ts", "hours", "burden"))
    assert plan.count("Exchange") == 1 and "Window" not in plan and "Sort" not in plan


def test_events_are_shuffled_once(spark, plan_of):
    wide = events(spark, FIXTURE).selectExpr("*", "'x' AS payload")
    plan = plan_of(reliability.prior_event_gap(wide, "entity", "ts", "id"))
    lines = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    parted = [line for line in lines if "__part" in line]
    by_entity_alone = [x for x in lines if re.search(r"hashpartitioning\(entity#\d+, 8\)", x)]
    # events with their columns, and the first of each second; by entity alone only its days
    assert len(parted) == 2 and len(by_entity_alone) <= 1


def test_ids_may_repeat_or_be_null(spark):
    at = lambda s: EPOCH + dt.timedelta(seconds=s)
    rows = [
        (1, "a", at(0), 1.0, 1.0), (1, "a", at(3600), 1.0, 1.0), (2, "a", at(7200), 1.0, 1.0),
        (None, "b", at(0), 1.0, 1.0), (None, "b", at(10800), 1.0, 1.0), (None, "b", at(10800), 2.0, 1.0),
        (3, None, at(0), 1.0, 1.0), (3, None, at(5), 1.0, 1.0),
    ]
    gaps = reliability.prior_event_gap(spark.createDataFrame(rows, SCHEMA), "entity", "ts", "id")
    got = sorted((r.entity, r.hours_since_prior_event) for r in gaps.collect() if r.entity and r.hours_since_prior_event is not None)
    assert got == [("a", 1.0), ("a", 1.0), ("b", 0.0), ("b", 3.0)] and gaps.count() == len(rows)


def test_a_third_of_all_rows_in_one_entity(spark):
    rng = random.Random(3)
    rows = [("hot", 500_000.0)] * 2000 + [("hot", rng.randrange(10**6)) for _ in range(2000)]
    rows += [(f"e{i % 300}", rng.randrange(10**6)) for i in range(8000)]
    assert got_gaps(spark, rows) == expected_gaps(rows)


def test_events_of_nobody_have_no_gaps(spark):
    rows = [(None, 0), (None, 3600), ("a", 10), ("a", 86_400 * 5), ("a", 86_400 * 5 + 0.5), ("b", None)]
    spans, from_gaps, by_seconds = both(spark, rows)
    assert from_gaps == by_seconds
    assert [r[:2] + r[3:4] for r in by_seconds] == [("a", 3, 60.0), (None, 2, None)]


METRICS = (
    "feeder_canonical string, total_outages long, mttr_hours double, mtbf_hours double, "
    "total_customer_hours_interruption double"
)


def metrics(spark, values):
    rows = [(f"f{i:03d}", 1, 1.0, v, 1.0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, METRICS)


def sql_ranks(values):
    present = [v for v in values if v is not None]
    return [
        1 + sum(1 for w in present if v is None or w < v) for v in values
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_rank_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([None, 5.0, 5.0, round(rng.uniform(0, 30), 2)]) for _ in range(150)]
    rows = summaries.ranked(metrics(spark, values)).orderBy("feeder_canonical").collect()
    assert [r.reliability_rank for r in rows] == sql_ranks(values)


def test_leaderboard_order_and_single_events_last(spark):
    board = summaries.leaderboard(metrics(spark, [None, 2.5, 1.0, 2.5]))
    order = F.col("reliability_rank"), F.col("feeder_canonical")
    rows = summaries.in_order(board, *order).orderBy("position").collect()
    assert [r.position for r in rows] == [1, 2, 3, 4]
    assert [(r.feeder_canonical, r.reliability_rank) for r in rows] == [
        ("f002", 1), ("f001", 2), ("f003", 2), ("f000", 4),
    ]


def test_top_is_the_head_of_the_leaderboard(spark, plan_of):
    values = [3.0, 1.0, None, 1.0, 2.0, 7.25]
    top = summaries.leaderboard_top(metrics(spark, values), 3)
    board = summaries.leaderboard(metrics(spark, values))
    assert top.collect() == board.orderBy("reliability_rank", "feeder_canonical").take(3)
    assert "TakeOrderedAndProject" in plan_of(top)


def test_rank_has_no_window_over_entity_rows(spark, plan_of):
    plan = ranking.global_rank(metrics(spark, [1.0, 2.0]), "mtbf_hours", "r")
    windows = [line for line in plan_of(plan).splitlines() if " Window " in line]
    assert windows and all("feeder_canonical" not in line for line in windows)


def test_type_summary(spark):
    rows = [("x", 1.0, 2.0), ("x", 2.0, 2.0), ("y", None, 4.25)]
    df = spark.createDataFrame(
        rows, "outage_type_canonical string, duration_hours_num double, customer_hours_interruption_num double"
    )
    got = sorted(tuple(r) for r in summaries.type_summary(df).collect())
    assert got == [("x", 2, 66.7, 1.5, 4.0), ("y", 1, 33.3, None, 4.3)]
