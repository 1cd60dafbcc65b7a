from dataclasses import replace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from faultline.functions import canon, rules
from faultline.functions.sql import register_sql_functions
from faultline.operators import quarantine
from faultline.plans.inputs import NAMES, TYPES

CASES = [
    *NAMES,
    ("", "OLUYOLE"),
    ("nan", "UNMAPPED"),
    ("INDUSTRIAL 33KV", "INDUSTRIAL"),
    ("\tROM\n", "ROM"),
    ("PROMINENT", "ROM"),
    ("AGODI-2", "AGODI 2"),
    ("TI AGODI", "UNMAPPED"),
    ("T 1", "UNMAPPED"),
    ("COMPEX", "UNMAPPED"),
    ("ERUWA", "UNMAPPED"),
    ("SAMODA", "SAMONDA"),
    ("MINSTER 33KLV", "MINISTER"),
    ("LIBERTRY", "LIBERTY"),
    ("EXPRESS@33KV", "EXPRESS"),
]


def canonical(spark, raws, cfg=rules.FEEDER_RULES, how=canon.with_canonical_name, **kwargs):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw string")
    rows = how(df, "raw", "out", cfg, **kwargs).orderBy("i").collect()
    assert [r.raw for r in rows] == list(raws)
    return [r.out for r in rows]


def test_names(spark):
    got = canonical(spark, [raw for raw, _ in CASES])
    assert list(zip([raw for raw, _ in CASES], got)) == CASES


def test_lookup_by_spelling_gives_the_same(spark):
    raws = [raw for raw, _ in CASES] * 3
    how = canon.with_canonical_name_by_spelling
    assert canonical(spark, raws, how=how) == canonical(spark, raws)


def test_lookup_by_spelling_plans_alike_at_every_size(spark, plan_of):
    df = spark.range(60_000).selectExpr("concat('ROM ', id, 'KV') AS raw")
    out = canon.with_canonical_name_by_spelling(df, "raw", "out")
    assert "Join" in plan_of(out) and "HashAggregate" in plan_of(out)
    assert out.filter("out = 'ROM'").count() == 60_000


def test_short_fragments_can_be_kept_out(spark):
    safe = replace(rules.FEEDER_RULES, min_reverse_len=3)
    assert canonical(spark, ["", "33KV", "IN", "ROM", "INTER"], safe) == [
        "UNMAPPED", "UNMAPPED", "UNMAPPED", "ROM", "INTERCHANGE",
    ]


def test_other_names_can_be_configured(spark):
    cfg = rules.NameRules(names=("NORTH", "SOUTH 2"), typos=(("NROTH", "NORTH"),), unmapped="?")
    assert canonical(spark, ["nroth 11kv", "south.2", "T1 south 2", "east"], cfg) == [
        "NORTH", "SOUTH 2", "SOUTH 2", "?",
    ]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=" 1230.-/@,AGODIERUWTNLBKVMPCXY", max_size=14), max_size=40))
def test_output_is_always_an_allowed_name(spark, raws):
    allowed = {*rules.CANONICAL_FEEDERS, rules.UNMAPPED}
    assert set(canonical(spark, raws)) <= allowed


def test_types(spark):
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(TYPES)], "i int, raw string")
    got = df.select("i", canon.canonical_type("raw").alias("t")).orderBy("i").collect()
    assert [r.t for r in got] == [t for _, t in TYPES]


@pytest.mark.parametrize("condition", ["true", "out <> 'UNMAPPED'"])
def test_no_python_and_compiled_in_one_stage(spark, plan_of, condition):
    df = spark.range(10).selectExpr("cast(id as string) AS raw")
    named = canon.with_canonical_name(df, "raw", "out").filter(condition)
    plan = plan_of(named)
    assert "Python" not in plan and "Exchange" not in plan
    assert plan.count("INDUSRIAL") == 1, "the corrections run once per row"
    stages = named._jdf.queryExecution().debug().codegenToSeq()
    assert stages.size() == 1
    # Beyond 8000 bytes the JVM would interpret the method instead of compiling it.
    assert stages.apply(0)._3().maxMethodCodeSize() < 8000


def test_audit_counts_every_row(spark):
    rows = [("ROM 33KV",)] * 5 + [("ROM",)] * 2 + [("T1",)] + [(None,)] * 2
    audit = quarantine.canon_audit(spark.createDataFrame(rows, "raw string"), "raw")
    assert {(r.raw, r.canonical): r.n_rows for r in audit.collect()} == {
        ("ROM 33KV", "ROM"): 5, ("ROM", "ROM"): 2, ("T1", "UNMAPPED"): 1, (None, "UNMAPPED"): 2,
    }
    rate = quarantine.match_rate(audit).first()
    assert (rate.n_rows, rate.mapped_rows, rate.mapped_spellings, rate.match_pct) == (10, 7, 2, 70.0)


def test_sql_functions_follow_the_same_rules(spark, plan_of):
    register_sql_functions(spark)
    rows = [(i, raw) for i, (raw, _) in enumerate(CASES + TYPES)]
    df = spark.createDataFrame(rows, "i int, raw string")
    named = canon.with_canonical_name(df, "raw", "name")
    expected = named.withColumn("type", canon.canonical_type("raw"))
    df.createOrReplaceTempView("raw_values")
    got = spark.sql(
        "SELECT i, raw, canonical_feeder(raw) AS name, canonical_outage_type(raw) AS type "
        "FROM raw_values"
    )
    assert got.orderBy("i").collect() == expected.select(*got.columns).orderBy("i").collect()
    assert "Python" not in plan_of(got) and "Join" not in plan_of(got)
