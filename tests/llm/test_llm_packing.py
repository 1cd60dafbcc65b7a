import random
import zlib

import public_tokenizers
import pytest
from llm_cases import odd_texts, prose, table
from tokenizers import Tokenizer

from faultline.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_pieces_are_the_binary_digits():
    for n in [*range(1, 70), 2047, 2048, 2049, 10_000]:
        pieces = packing.piece_lengths(n, 16)
        assert sum(pieces) == n and all(p & (p - 1) == 0 and p <= 16 for p in pieces)
        assert pieces == sorted(pieces, reverse=True) and len({p for p in pieces if p < 16}) == len([p for p in pieces if p < 16])


def test_encoder_gives_the_tokenizers_ids(tokenizer):
    encoder, dice = packing.Encoder(PATH), random.Random(2)
    parts = [" ", "  ", "\n", "\t", "word", "Straße", "don't", "'s", "123", "<|endoftext|>", ".", ",!", "　", "\x1c", "漢字", "😀", "ʼn", "\xa0"]
    for _ in range(5000):
        text = "".join(dice.choice(parts) for _ in range(dice.randrange(12)))
        assert encoder.encode(text) == encoder.plain(text), text


def test_cache_may_overflow(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 50)
    encoder = packing.Encoder(PATH)
    for seed in range(5):
        text = prose(seed, 500)
        assert encoder.encode(text) == encoder.plain(text)


def test_long_texts_are_cut_where_tokens_end(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CUT_CHARS", 50)
    text = prose(1, 300) + "  \n " * 40 + "x" * 500 + " end"
    assert "".join(packing.long_units(text)) == text and len(list(packing.long_units(text))) > 10
    encoder = packing.Encoder(PATH)
    assert b"".join(map(encoder.encode, packing.long_units(text))) == encoder.plain(text)


def test_round_trip(spark, tokenizer):
    rows = [(i if i is None else 1000 * i + k, t) for k, (i, t) in enumerate(odd_texts())]
    rows += [(500 + i, prose(i, 40 * i)) for i in range(20)]
    got = packing.pack(table(spark, rows), PATH, longest=256).collect()
    assert len({r["sequence_id"] for r in got}) == len(got)
    back = {}
    for r in sorted(got, key=lambda r: (r["doc_id"] or -1, r["start"])):
        assert r["length"] == r["bucket"] == len(r["ids"]) // 4 and r["length"] & (r["length"] - 1) == 0
        assert r["offset"] == 0 and r["length"] <= 256
        back.setdefault(r["doc_id"], b"")
        if r["doc_id"] is not None:
            assert r["start"] == len(back[r["doc_id"]]) // 4
        back[r["doc_id"]] += r["ids"]
    for doc_id, text in rows:
        if doc_id is not None:
            own = b"".join(i.to_bytes(4, "little") for i in ids(tokenizer, text))
            assert back[doc_id] == own
    digests = packing.piece_digests(packing.pack(table(spark, rows), PATH, longest=256)).collect()
    assert sorted(r["ids_crc32"] for r in digests) == sorted(zlib.crc32(r["ids"]) for r in got)


def test_empty_table_and_wrong_length(spark):
    assert packing.pack(table(spark, odd_texts()).limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pack(table(spark, odd_texts()), PATH, longest=100)


def test_buckets_are_stored_apart(spark, tmp_path):
    packing.write_buckets(packing.pack(table(spark, [(1, prose(1, 300))]), PATH, 64), str(tmp_path / "out"))
    folders = sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir())
    assert "bucket=64" in folders and len(folders) > 1
