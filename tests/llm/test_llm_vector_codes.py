import hashlib
import math
import random

import numpy as np
import pytest
from llm_cases import CLASH
from pyspark.sql import functions as F

from faultline.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label string"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("other") for c in (*CLASH, "code", "ints", "of")})


def brute(rows, scale, parts, entries, rounds):
    """Plain Python integers: the codes, errors and sums by label, and the entries."""
    kept = [
        (i, [math.floor(scale * x) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0], np.array(r[1], "<i4").tobytes()))
    length = len(order[0][1]) // parts if order else 0
    cut = [[v[p * length : (p + 1) * length] for p in range(parts)] for _, v, _ in kept]
    first = [[v[p * length : (p + 1) * length] for _, v, _ in order[:entries]] for p in range(parts)]

    def away(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [
            [min((away(x, c), e) for e, c in enumerate(first[p])) for p, x in enumerate(vector)] for vector in cut
        ]

    for _ in range(rounds):
        near = assign()
        for p in range(parts):
            for e in range(len(first[p])):
                own = [cut[k][p] for k in range(len(cut)) if near[k][p][1] == e]
                if own:
                    first[p][e] = [sum(xs) // len(own) for xs in zip(*own)]
    found = [("".join(f"{e:02x}" for _, e in n), sum(d for d, _ in n)) for n in assign()]
    by_label = {}
    for (_, _, label), (_, error) in zip(kept, found):
        by_label[label] = by_label.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for p in first for c in p for x in c).encode()).hexdigest()
    return sorted(((i, *f, by_label[label], digest) for (i, _, label), f in zip(kept, found)), key=repr)


def got(spark, rows, how):
    out = vc.with_label_errors(*vc.compress(table(spark, rows), how))
    return sorted((tuple(r) for r in out.collect()), key=repr)


def random_rows(seed, n, width, size=1.0):
    dice = random.Random(seed)
    rows = [(i, [dice.gauss(0, size) for _ in range(width)], dice.choice(["a", "b", None])) for i in range(n)]
    dice.shuffle(rows)
    return rows


@pytest.mark.parametrize("size", [0.2, 1000.0])
def test_against_plain_integers(spark, size):
    rows = random_rows(1, 150, 24, size)
    rows += [(0, rows[0][1], "a"), (None, rows[1][1], None), (None, rows[1][1], None), rows[5], rows[5]]
    rows += [(900 + i, rows[7][1], "b") for i in range(60)]  # a hot vector, tied everywhere
    bad = [(-1, None, "a"), (-2, [0.0] * 23 + [None], "a"), (-3, [math.nan] * 24, "a"), (-4, [math.inf] * 24, "b")]
    how = vc.Codes(parts=8, entries=16, rounds=3)
    assert got(spark, rows + bad, how) == brute(rows, 4096, 8, 16, 3)


def test_fewer_vectors_than_entries(spark):
    rows = random_rows(2, 5, 8)
    assert got(spark, rows, vc.Codes()) == brute(rows, 4096, 8, 16, 6)
    assert all(r[2] == 0 for r in got(spark, rows, vc.Codes(rounds=0)))


def test_vectors_that_cannot_be_coded_keep_their_row(spark):
    rows = random_rows(3, 40, 16)
    odd = [(-5, [], "a"), (-4, [0.5] * 15, "a"), (-3, [1e300] + [0.0] * 15, "b"), (100, [0.5] * 24, "zz")]
    want = {r[0]: r[1:3] for r in brute(rows, 4096, 8, 16, 6)}
    found = {r[0]: r[1:] for r in got(spark, rows + odd, vc.Codes())}
    assert all(found.pop(i)[:2] == (None, None) for i, _, _ in odd)
    assert {i: r[:2] for i, r in found.items()} == want


def test_empty_tables(spark):
    assert got(spark, [], vc.Codes()) == []
    assert got(spark, [(1, None, "a")], vc.Codes()) == []
    assert got(spark, [(1, [], "a")], vc.Codes()) == [(1, None, None, None, hashlib.sha256(b"").hexdigest())]


def test_limbs_multiply_exactly():
    dice = np.random.default_rng(4)
    for high, width in ((2**12, 8), (2**26, 64), (2**29, 7), (2**29, 1)):
        a, b = dice.integers(-high, high, (30, width)), dice.integers(-high, high, (width, 9))
        a[0], b[:, 0] = -high, -high
        want = [[sum(int(x) * int(y) for x, y in zip(r, c)) for c in b.T] for r in a]
        assert vc.exact_matmul(a, b).tolist() == want
    # rounded by plain float64
    a = np.array([[2**29 + 1, 1]])
    assert vc.exact_matmul(a, a.T.copy()).tolist() == [[(2**29 + 1) ** 2 + 1]]
    assert len(vc.limbs(np.array([2**29]), 25)) == 2


def test_codes_stand_for_their_entries(spark):
    rows = random_rows(5, 60, 16)
    how = vc.Codes(rounds=2)
    codes, books = vc.compress(table(spark, rows), how)
    error = {r["vec_id"]: r["error"] for r in codes.collect()}
    approx = {r["vec_id"]: r["approx"] for r in vc.decode(codes, books, how).collect()}
    for i, v, _ in rows:
        whole = [math.floor(4096 * x) for x in v]
        assert sum((x - round(4096 * y)) ** 2 for x, y in zip(whole, approx[i])) == error[i]
