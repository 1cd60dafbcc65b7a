import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from llm_cases import odd_texts, prose, rows_of, table
from tokenizers import Tokenizer

from faultline.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LETTERS = "aabbccx  \n\t'sStTlLdm0123.,!?éüß漢字😀 　-=_́"


@pytest.fixture(scope="module")
def own():
    return bpe.codec(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


def random_text(dice):
    text = "".join(dice.choice(LETTERS) for _ in range(dice.randrange(60)))
    return text[:10] + "<|endoftext|>" * dice.randrange(3) + text[10:] if dice.random() < 0.2 else text


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_random_texts_as_the_library(own, library):
    dice = random.Random(3)
    texts = [random_text(dice) for _ in range(4000)]
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert list(map(ids_of, own.encode(texts))) == want
    assert ["".join(own.decode(np.array(ids, np.uint32))) for ids in want] == texts
    assert 0 < own.speculator.failed < own.speculator.seen  # both ways were taken


def test_long_words_and_texts_as_the_library(own, library):
    texts = ["x" * 100_000, "ab" * 20_000, "no white space," * 9000, "a " * 200_000, " \n" * 150_000, prose(1, 90_000)]
    for text in texts:
        assert ids_of(own.encode([text])[0]) == library.encode(text, add_special_tokens=False).ids


def test_pairs_and_merges_by_brute_force(own):
    merges, dice = own.speculator.merges, random.Random(5)
    tokens = [i for i in range(merges.n) if merges.bytes[i]]
    a, b = (np.array([dice.choice(some) for _ in range(8000)]) for some in (tokens, tokens[:2000]))
    want = [merges.merge(merges.bytes[x] + merges.bytes[y]) == [x, y] for x, y in zip(a, b)]
    assert merges.compatible(a, b).tolist() == want
    words = [merges.bytes[x] + merges.bytes[y] for x, y in zip(a, b)]
    assert [x.tolist() for x in merges.merge_all(words)] == [merges.merge(w) for w in words]


def test_a_token_that_its_bytes_do_not_give_is_never_proposed():
    singles = {bytes([b]): b for b in range(256)}
    # "abc" is made of a + bc, but its own bytes merge to ab + c
    merges = [(b"a", b"b"), (b"b", b"c"), (b"a", b"bc")]
    made = bpe.Speculator(bpe.Merges(singles | {b"ab": 256, b"bc": 257, b"abc": 258}, merges))
    words = [b"abc", b"abcabc", b"bcbc", b"aabcc"]
    assert [x.tolist() for x in made.encode(words)] == [made.merges.merge(w) for w in words]
    assert made.encode([b"abc"])[0].tolist() == [256, 99]


def test_vocabularies_that_pairs_cannot_judge_are_refused():
    singles = {bytes([b]): b for b in range(256)}
    two_ways = [(b"a", b"b"), (b"b", b"c"), (b"a", b"bc"), (b"ab", b"c")]
    with pytest.raises(ValueError):
        bpe.Merges(singles | {b"ab": 256, b"bc": 257, b"abc": 258}, two_ways)
    with pytest.raises(ValueError):
        bpe.Merges(singles | {b"ab": 256, b"abc": 257}, [(b"ab", b"c"), (b"a", b"b")])
    with pytest.raises(ValueError):
        bpe.Merges({b"a": 0}, [])


def test_cache_may_be_dropped_at_any_time(own, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_CHARS", 100)
    monkeypatch.setattr(bpe, "GROUP_CHARS", 50)
    monkeypatch.setattr(bpe, "CUT_CHARS", 40)
    texts = [prose(i, 80) for i in range(30)]
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert list(map(ids_of, own.encode(texts))) == want


def test_bytes_that_are_no_text(own, library):
    ids = library.encode("漢😀é", add_special_tokens=False).ids
    for part in ([ids[0]], ids[1:], ids[:-1], ids[::-1]):
        assert "".join(own.decode(np.array(part, np.uint32))) == library.decode(part, skip_special_tokens=False)


def test_tables(spark, library):
    rows = odd_texts() + [(20 + i, random_text(random.Random(i))) for i in range(50)]
    df = table(spark, rows)
    each = [(i, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in rows]
    want = sorted(((i, len(x), sha(",".join(map(str, x))), sha(t)) for i, x, t in each), key=repr)
    assert rows_of(bpe.round_trip(df, PATH), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    encoded = bpe.encode(df, PATH)
    got = sorted(((r[0], r[1], sha(",".join(map(str, r[2])))) for r in encoded.collect()), key=repr)
    assert got == [r[:3] for r in want]
    texts = sorted(((r[0], sha(r[1])) for r in bpe.decode(encoded, PATH).collect()), key=repr)
    assert texts == sorted(((i, sha(t)) for i, _, t in each), key=repr)


def test_empty_tables(spark):
    empty = table(spark, odd_texts()).limit(0)
    assert bpe.round_trip(empty, PATH).count() == 0
    assert bpe.decode(bpe.encode(empty, PATH), PATH).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, []), (3, [10**6])], "doc_id long, ids array<int>")
    assert rows_of(bpe.decode(nulls, PATH), "doc_id", "text") == [(1, ""), (2, ""), (3, "")]
