import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from llm_cases import ascii_lower, odd_texts, prose, rows_of, table, words_of
from pyspark.sql import functions as F

from faultline.llm import near_dedup
from faultline.llm.graph import components

COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


def shingles(text):
    words = words_of(ascii_lower(text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """Components over the rows; each row of an unlinked set by itself."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 75 * len(sets[i] | sets[j]):
                label[max(top(i), top(j))] = min(top(i), top(j))
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[top(i)] = min(doc_id, low.get(top(i), doc_id))
    out = []
    for i, (doc_id, _) in enumerate(rows):
        lowest = low.get(top(i)) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), lowest, doc_id == lowest))
    return sorted(out, key=repr)


def edited(text, edits, seed):
    dice, words = random.Random(seed), text.split()
    for _ in range(edits):
        words[dice.randrange(len(words))] = f"e{dice.randrange(10**6)}"
    return " ".join(words)


def corpus():
    rows, next_id = [], iter(range(10**6))
    for seed in range(8):
        base = prose(seed, 120, 5000)
        rows += [(next(next_id), edited(base, e, 100 * seed + e)) for e in (0, 0, 1, 2, 4, 5, 8, 30)]
    chain = prose(99, 100, 5000)
    for step in range(10):  # each is close to the next, the ends are not
        rows.append((next(next_id), chain))
        chain = edited(chain, 1, 1000 + step)
    random.Random(0).shuffle(rows)
    return rows


def test_against_brute_force(spark):
    rows = corpus() + [(None if i is None else 10**6 + i, t) for i, t in odd_texts()]
    rows = [r for r in rows if r[1] is None or len(r[1]) < 250_000]
    assert rows_of(near_dedup.near_groups(table(spark, rows)), *COLUMNS) == brute(rows)


def test_one_stays_with_all_columns(spark):
    rows = corpus() + [(None, "x y z"), (None, "x y z")]
    df = table(spark, rows)
    kept = near_dedup.keep_one(df)
    assert kept.columns == df.columns
    want = [i for i, _, low, _ in brute(rows) if i == low or i is None]
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(want)


def test_empty_tables(spark):
    assert near_dedup.near_groups(table(spark, odd_texts()).limit(0)).count() == 0
    assert near_dedup.near_groups(table(spark, [(1, None), (2, "")])).count() == 2


def test_fewer_tables_than_needed_are_not_the_default():
    how = near_dedup.Near()
    p = 0.75**2
    miss = (1 - p) ** how.small + how.small * p * (1 - p) ** (how.small - 1)
    assert miss < 1e-3


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    dice = random.Random(seed)
    links = [(dice.randrange(200), dice.randrange(200)) for _ in range(130)] + [(i, i + 1) for i in range(300, 340)]
    links += [(5, 5), links[0], links[0][::-1]]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    label = {}
    for a, b in links * 50:
        low = min(label.get(a, a), label.get(b, b))
        label[a] = label[b] = low
    assert got == {n: c for n, c in label.items() if any(n in link and link[0] != link[1] for link in links)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sql_on_the_same_rows(spark):
    rows = corpus()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({near_dedup.GROUPS_SQL})").fetchall()
    assert sorted(want, key=repr) == brute(rows)


def test_sample_bits_rule_out_no_small_similar_sets(spark):
    dice, rows = np.random.default_rng(11), []
    for k, (n, m, both) in enumerate([(4, 3, 3)] * 1500 + [(8, 6, 6)] * 300 + [(14, 14, 12)] * 300 + [(24, 18, 18)] * 300):
        own = dice.integers(1, 2**63, n + m - both, dtype=np.uint64)
        one, two = (near_dedup.sample_bits(x).tolist() for x in (own[:n], np.concatenate([own[:both], own[n:]])))
        rows.append((k, n, n - both, *one, m, m - both, *two))
    names = ["n", "lone", *near_dedup._LONGS]
    pairs = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in ["k", *names, *[f"o_{c}" for c in names]]))
    assert pairs.filter(near_dedup._possible(near_dedup.Near(), "", "o_")).count() == len(rows)


def compared(monkeypatch):
    """What is handed to the comparison of full sets, round by round."""
    pairs, inner = [], near_dedup.verified

    def counting(some, sets, how):
        some = near_dedup.stored(some, "counted-pairs")
        pairs.append(some.count())
        return inner(some, sets, how)

    monkeypatch.setattr(near_dedup, "verified", counting)
    return pairs


def test_a_crowd_of_near_misses_takes_linearly_many_comparisons(spark, monkeypatch):
    pairs, base = compared(monkeypatch), prose(1, 30, 5000)
    seen = {}
    for n in (300, 600):
        rows = [(i, edited(base, 1, i)) for i in range(n)]
        pairs.clear()
        got = rows_of(near_dedup.near_groups(table(spark, rows)), *COLUMNS)
        assert got == brute(rows)  # recall 1
        seen[n] = list(pairs)
    assert sum(seen[600]) < 2.6 * sum(seen[300])
    assert seen[600][2] < 60  # what the bound by the leader lets pass


def test_bound_by_the_leader_holds_for_all_pairs(spark):
    dice = random.Random(4)
    base = list(range(1, 1 + 40))
    sets = {}
    for k in range(60):
        own = set(dice.sample(base, 40 - dice.randrange(12)))
        own |= {100 + dice.randrange(30) for _ in range(dice.randrange(9))}
        sets[f"c{k:02}".encode()] = np.array(sorted(own), np.uint64)
    times = Counter(int(x) for s in sets.values() for x in s)
    rows = [(1, c, len(s), sum(times[int(x)] == 1 for x in s)) for c, s in sets.items()]
    df = spark.createDataFrame(rows, "key long, cls binary, n long, lone long")
    stored = spark.createDataFrame([(c, s.tobytes()) for c, s in sets.items()], "cls binary, set binary")
    led = near_dedup.lacking(df, stored)
    other = led.select(*[F.col(c).alias(f"o_{c}") for c in led.columns])
    pairs = led.crossJoin(other).filter(near_dedup._in_common(near_dedup.Near()))
    passed = {(bytes(r["cls"]), bytes(r["o_cls"])) for r in pairs.select("cls", "o_cls").collect()}
    alike = {
        (a, b)
        for a in sets
        for b in sets
        if 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))
    }
    assert alike <= passed and len(passed) < len(sets) ** 2 / 2


def test_lone_shingles(spark):
    dice = random.Random(2)
    sets = {f"c{k}".encode(): sorted({dice.randrange(300) for _ in range(20)} | {10**6}) for k in range(50)}
    times = Counter(x for s in sets.values() for x in s)
    stored = spark.createDataFrame(
        [(c, np.array(s, np.uint64).tobytes()) for c, s in sets.items()], "cls binary, set binary"
    )
    found = near_dedup.lone_shingles(stored.select("cls").repartition(5), stored.repartition(7)).collect()
    assert {bytes(r["cls"]): r["lone"] for r in found if r["lone"]} == {
        c: n for c, s in sets.items() if (n := sum(times[x] == 1 for x in s))
    }


def test_few_tables_are_stored(spark, monkeypatch):
    names, inner = [], near_dedup.stored

    def counting(df, purpose):
        names.append(purpose)
        return inner(df, purpose)

    monkeypatch.setattr(near_dedup, "stored", counting)
    base = prose(1, 30, 5000)
    near_dedup.near_groups(table(spark, [(i, edited(base, 1, i)) for i in range(100)]))
    # each costs a write, a scan and their tasks on every partition; there were 27
    assert len(names) <= 9


def test_pairs_of_a_bucket_are_judged_by_a_condition_that_is_compiled(spark):
    """Longer methods than 8,000 bytes of code are interpreted by the JVM."""
    longs = ", ".join(f"{c} long" for c in [*near_dedup._LONGS, *near_dedup._LACKS])
    kinds = f"key long, cls binary, n long, i int, j int, lone long, label binary, main binary, small array<long>, {longs}"
    zero = [0] * (len(near_dedup._LONGS) + len(near_dedup._LACKS))
    small = list(range(near_dedup.Near().small))
    rows = [(1, bytes([k]), 20, 0, 1, 0, bytes([k]), b"x", small, *zero) for k in range(3)]
    led = spark.createDataFrame([(*r, 20, 0) for r in rows], f"{kinds}, n_lead long, beside long")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    inner = near_dedup.lacking
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    near_dedup.lacking = lambda some, sets: led
    try:
        pairs = near_dedup.rest_pairs(led, led, near_dedup.Near())
        parts = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(pairs._jdf.queryExecution().debug().codegenToSeq())
        assert max(p._3().maxMethodCodeSize() for p in parts) < 8000
        assert pairs.count() == 3
    finally:
        near_dedup.lacking = inner
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
