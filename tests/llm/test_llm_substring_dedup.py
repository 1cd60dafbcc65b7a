import random

import pytest
from llm_cases import odd_texts, prose, table, words_of

from faultline.llm.substring_dedup import (
    Windows,
    lists_of_documents,
    pack_lists,
    remove_repeats,
    shared_in_bucket,
    sliding,
    stretches,
)

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WINDOW = 20


def brute(rows, window=WINDOW):
    """Rows that repeat doc_id and text are one document; those that share a doc_id alone are not in these cases."""
    docs = sorted({(i is not None, i or 0, t or "") for i, t in rows})
    words = {d: words_of(d[2]) for d in docs}
    first = {}
    for d in docs:
        for at in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][at : at + window]), (d, at))
    out = {}
    for d in docs:
        gone = set()
        for at in range(len(words[d]) - window + 1):
            if first[tuple(words[d][at : at + window])] != (d, at):
                gone |= set(range(at, at + window))
        kept = [w for k, w in enumerate(words[d]) if k not in gone]
        out[d] = (len(words[d]), len(gone), " ".join(kept))
    return sorted(((i, *out[i is not None, i or 0, t or ""]) for i, t in rows), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "text").collect()), key=repr)


def corpus():
    shared = [prose(100 + i, 60) for i in range(3)]
    rows = []
    for i in range(40):
        parts = [prose(i, 30), shared[i % 3], prose(1000 + i, 25)]
        if i % 5 == 0:
            parts.append(shared[0])  # twice in one document
        if i % 4 == 0:
            parts[1] = " ".join(parts[1].split()[: 15 + i % 10])  # around the window's length
        rows.append((i * 7 % 40, "  \n".join(parts)))
    rows += [(50 + i, "a " * (15 + 3 * i)) for i in range(4)]
    return rows


@pytest.mark.parametrize(
    "how",
    [Windows(), Windows(crowd=0, times=0), Windows(crowd=12, times=0, bucket=10)]
    + [Windows(part=part) for part in (1, 2, 20)],
)
def test_against_brute_force(spark, how):
    assert got(remove_repeats(table(spark, corpus()), how)) == brute(corpus())


@pytest.mark.parametrize("how", [Windows(), Windows(crowd=0, times=0)])
def test_odd_texts(spark, how):
    rows = [r for r in odd_texts() if r != (12, "another text under the id") and r[0] is not None]
    rows += [(None, prose(1, 300)), (None, prose(1, 300)), (90, prose(1, 300)), (90, prose(1, 300))]
    assert got(remove_repeats(table(spark, rows), how)) == brute(rows)


def test_one_id_with_several_texts(spark):
    text = prose(3, 50)
    rows = got(remove_repeats(table(spark, [(1, text), (1, text + " more"), (2, text)])))
    assert sorted(r[2] for r in rows if r[0] == 1) == [0, 50] and [r[2] for r in rows if r[0] == 2] == [50]


def test_empty_table(spark):
    assert remove_repeats(table(spark, odd_texts()).limit(0)).count() == 0


def test_equal_windows_have_one_minimiser():
    dice = random.Random(1)
    passage = prose(9, 40)
    texts = [f"{prose(i, dice.randrange(30))} {passage} {prose(50 + i, 20)}" for i in range(6)]
    how = Windows()
    own = stretches(pa.array(texts), how)
    seen = {}
    for row, start, count, least in zip(own.row, own.start, own.count, own.minimiser):
        words = texts[row].split()
        for at in range(start, start + count):
            assert seen.setdefault(tuple(words[at : at + how.window]), least) == least
    assert sum(own.count) == sum(len(t.split()) - how.window + 1 for t in texts)


@pytest.mark.parametrize("width", range(1, 12))
def test_sliding(width):
    values = np.random.default_rng(width).integers(0, 1000, 40)
    want = [min(values[i : i + width]) for i in range(40 - width + 1)]
    assert sliding(values, width, np.minimum).tolist() == want


def test_texts_are_dealt_out_once(spark, plan_of):
    df = remove_repeats(table(spark, corpus()))
    df.collect()
    assert "ReusedExchange" in plan_of(df)


def test_rows_of_a_bucket_do_not_grow_with_its_documents():
    """Documents that are in many buckets bring no row in each of them, and each one list in the end."""
    n, buckets = 5000, 8
    ids = pa.array([None, *range(1, n)], pa.int64())
    twins = pa.array(np.arange(n) % 3)
    packed = []
    for b in range(buckets):
        named = (np.asarray(ids.is_valid()).astype(np.int64), np.asarray(ids.fill_null(0)), np.asarray(twins))
        row, minimiser = np.arange(n), (np.arange(n) // 2 + b * n).astype(np.uint64)
        keys = pack_lists("bucket", np.zeros(n, np.int64), named, row, np.zeros(n, np.int64), minimiser)
        columns = [keys.column(c).to_pylist() for c in ("documents", "n", "payload")]
        packed.append(shared_in_bucket(*columns, 16))
        assert packed[-1].num_rows == 16
    together = pa.concat_tables(packed)
    got = {}
    for deal in range(16):
        own = together.filter(pc.equal(together["deal"], deal))
        for r in lists_of_documents(*(own[c].to_pylist() for c in ("documents", "n", "payload"))).to_pylist():
            assert (r["doc_id"], r["twin"]) not in got
            got[r["doc_id"], r["twin"]] = sorted(r["minimisers"])
    want = {(i, t): [k // 2 + b * n for b in range(buckets)] for k, (i, t) in enumerate(zip(ids.to_pylist(), twins.to_pylist()))}
    assert got == want
