import random

import pytest
from llm_cases import odd_texts, prose, table

from faultline.llm.decontaminate import Items, Matching, blocks, drop_leaking, find_leaks, myers, normalised, pieces


def masks(item):
    out = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


def distance(item, text):
    """Fewest edits between the item and any part of the text."""
    before = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        row = [i]
        for j, d in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (c != d)))
        before = row
    return min(before)


@pytest.mark.parametrize("seed", range(300))
def test_bit_parallel_distance(seed):
    dice = random.Random(seed)
    item = "".join(dice.choices("abc", k=dice.randrange(1, 90)))
    text = "".join(dice.choices("abc", k=dice.randrange(1, 120)))
    want = distance(item, text)
    found = myers(item, masks(item), text, len(item))
    assert (found[0] if found else len(item)) == want
    if want:
        assert myers(item, masks(item), text, want - 1) is None


def test_pieces_cover_the_item():
    for n in range(1, 60):
        for edits in range(min(n, 6)):
            own = pieces("x" * n, edits)
            assert len(own) == edits + 1 and "".join(p for _, p in own) == "x" * n
            assert all(p for _, p in own)


def edited(text, edits, dice):
    out = list(text)
    for _ in range(edits):
        at = dice.randrange(len(out))
        kind = dice.randrange(3)
        if kind == 0:
            out[at] = dice.choice("qxz")
        elif kind == 1:
            out.insert(at, dice.choice("qxz"))
        else:
            del out[at]
    return "".join(out)


def corpus():
    dice = random.Random(4)
    items = [(i, prose(500 + i, 20 + i)) for i in range(12)] + [(90, "short"), (91, None), (None, prose(7, 30)), (5, prose(8, 30))]
    rows = []
    for i in range(60):
        item = items[i % 12][1]
        leak = edited(item, dice.randrange(0, len(item) // 10), dice)
        rows.append((i, f"{prose(i, 30)} {leak.upper() if i % 2 else leak}  {prose(900 + i, 30)}"))
    rows += [(100 + i, prose(2000 + i, 100)) for i in range(20)]
    rows += [(200, "  \n ".join(items[3][1].split())), (201, items[3][1] * 3), (202, items[14][1])]
    return rows, items


def brute(rows, items, how):
    out = []
    for doc_id, text in rows:
        for item_id, item in items:
            own = normalised(item or "")
            if len(own) >= how.shortest:
                found = distance(own, normalised(text or ""))
                if found <= int(how.rate * len(own)):
                    out.append((doc_id, item_id, found))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_against_brute_force(spark, block):
    rows, items = corpus()
    rows += [(None if i is None else 1000 + i, t) for i, t in odd_texts() if not t or len(t) < 1000]
    how = Matching(block_chars=block)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    df = table(spark, rows)
    got = find_leaks(df, benchmark, how)
    assert sorted(((r.doc_id, r.item_id, r.edits) for r in got.collect()), key=repr) == brute(rows, items, how)
    kept = drop_leaking(df, benchmark, how)
    leaking = {d for d, _, _ in brute(rows, items, how)}
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((i for i, _ in rows if i not in leaking), key=repr)


def test_blocks_are_bounded(spark):
    benchmark = spark.createDataFrame(corpus()[1], "item_id long, text string")
    own = list(blocks(benchmark, Matching(block_chars=300)))
    assert len(own) > 3 and sum(len(b.rows) for b in own) == 14
    assert all(len(b.rows) == 1 or sum(len(t) for _, t in b.rows) <= 300 for b in own)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    df = table(spark, odd_texts())
    assert find_leaks(df, none).count() == 0 and drop_leaking(df, none).count() == df.count()
    some = spark.createDataFrame([(1, prose(1, 30))], "item_id long, text string")
    assert find_leaks(df.limit(0), some).count() == 0


def test_long_repeats_are_quick():
    item = "abcdefghij" * 5
    items = Items([(1, item)], Matching())
    assert items.leaks("abcdefghij" * 30_000) == [(1, 0, 50)]
