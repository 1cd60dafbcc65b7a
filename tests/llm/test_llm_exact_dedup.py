import hashlib
from collections import defaultdict

import numpy as np
import pytest
from llm_cases import ascii_lower, odd_texts, rows_of, table

from faultline.llm.exact_dedup import Fingerprints, _powers, combine, exact_groups, fingerprint

COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def brute(rows):
    groups = defaultdict(set)
    for doc_id, text in rows:
        groups[ascii_lower(text)].add(doc_id)
    out = set()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        out |= {(i, keep, len(ids), i == keep, sha) for i in ids}
    return sorted(out, key=repr)


def test_odd_texts(spark):
    assert rows_of(exact_groups(table(spark, odd_texts())), *COLUMNS) == brute(odd_texts())


def test_empty_table(spark):
    assert exact_groups(table(spark, odd_texts()).limit(0)).collect() == []


@pytest.mark.parametrize("chunk", [1, 3, 1 << 15])
def test_collisions_are_told_apart(spark, chunk):
    # with such moduli nearly all texts of one length collide
    weak = Fingerprints(chunk=chunk, moduli=(2, 3), bases=(1, 1))
    rows = [(i, text) for i, text in enumerate(["abcd", "abdc", "ABCD", "bbbb", "abcd", "dcba", "", None])] + [(2, "dcba")]
    assert rows_of(exact_groups(table(spark, rows), weak), *COLUMNS) == brute(rows)


def test_parts_combine_to_the_whole():
    how = Fingerprints(chunk=7)
    powers = [_powers(b, m, 1000) for b, m in zip(how.bases, how.moduli)]
    data = np.random.default_rng(0).integers(0, 256, 600, dtype=np.uint8)
    own = [p[-how.chunk :] for p in powers]
    whole = Fingerprints(chunk=1000)
    assert fingerprint(data, how, own) == fingerprint(data, whole, powers)
    left, right = fingerprint(data[:250], whole, powers), fingerprint(data[250:], whole, powers)
    both = tuple(combine(a, b, 350, base, m) for a, b, base, m in zip(left, right, how.bases, how.moduli))
    assert both == fingerprint(data, whole, powers)


def test_zero_bytes_count(spark):
    rows = [(1, "\x00"), (2, "\x00\x00"), (3, ""), (4, "\x00")]
    assert rows_of(exact_groups(table(spark, rows)), *COLUMNS) == brute(rows)
