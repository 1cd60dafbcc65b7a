"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are the binary digits of n: as many pieces of the longest
length as fit, then one for each set bit of the rest, the longest first. Each piece is a sequence of its own, full to
its last token, so nothing is padded and no sequence crosses documents; sequences of one length form a bucket.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator
from functools import cache, lru_cache
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import map_batches

END_OF_DOCUMENT = 1
CACHE_WORDS = 300_000
CUT_CHARS = 1 << 18

_ODD_SPACE = re.compile(r" \s")
_CUT = re.compile(r"(?<=\S) | (?=\S)")
_TAIL = ".,;:!?"
_LETTERS = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ɏ]+")  # with the space before them, one pre-token
_LINES = re.compile(r"(?<=\S)\n(?=\S)")


def piece_lengths(n: int, longest: int) -> list[int]:
    """The pieces of n tokens; ``longest`` is a power of two."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]


class Encoder:
    """A tokenizer's ids as little-endian 32-bit numbers, with the ids of the words seen last remembered.

    Text is looked up in words that begin at a space. That is exact for byte-level BPE with this kind of pre-tokenizer:
    a space that follows a character other than white space, or is followed by one, always begins a new pre-token, and
    pre-tokens are encoded one by one. A line feed between two characters that are not white space is one, and
    punctuation behind a letter begins one. Runs of letters are single pre-tokens; they are most of the distinct words,
    and only the merges are needed for them: these are run by tiktoken on the ranks that the tokenizer's own file
    states, which gives the same ids in a fifth of the time. Everything else goes through ``tokenizers``.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        special = {t["content"] for t in stated["added_tokens"]}
        byte = {c: b for b, c in enumerate(byte_characters())}
        ranks = {bytes(byte[c] for c in k): v for k, v in stated["model"]["vocab"].items() if k not in special}
        merges = tiktoken.Encoding("merges", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
        self.merged = merges._core_bpe.encode_single_piece
        self.words = Words(self.part)
        self.plain = lru_cache(maxsize=10_000)(self._plain)  # punctuation, mostly

    def _plain(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        odd = _ODD_SPACE.search(text) or text[:1] == " "
        first, *units = _CUT.split(text) if odd else text.split(" ")
        return b"".join(map(self.part, parts(first))) + b"".join(map(self.words.__getitem__, units))

    def part(self, part: str) -> bytes:
        if _LETTERS.fullmatch(part):
            return array("I", self.merged(part.encode())).tobytes()
        return self.plain(part) if part else b""


class Words(dict):
    """Ids of words, each with the space before it. What was not asked for lately is forgotten."""

    def __init__(self, part: Callable[[str], bytes]) -> None:
        self.part = part
        self.older: dict[str, bytes] = {}

    def __missing__(self, unit: str) -> bytes:
        found = self.older.get(unit) or b"".join(map(self.part, parts(" " + unit)))
        if len(self) >= CACHE_WORDS:
            self.older = dict(self)
            self.clear()
        self[unit] = found
        return found


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level BPE vocabulary: itself if printable, else from 256 on."""
    shown = [33 <= b < 127 or 161 <= b < 173 or b >= 174 for b in range(256)]
    spare = count(256)
    return [chr(b) if shown[b] else chr(next(spare)) for b in range(256)]


def parts(unit: str) -> list[str]:
    """A word in parts that are encoded alike on their own."""
    out = []
    for i, line in enumerate(_LINES.split(unit) if "\n" in unit else (unit,)):
        stem = line.rstrip(_TAIL)
        out += ["\n"] * (i > 0)
        if len(stem) < len(line) and _LETTERS.fullmatch(stem):
            out += [stem, line[len(stem) :]]
        else:
            out.append(line)
    return out


def long_units(text: str) -> Iterator[str]:
    """A long text in parts that are encoded alike on their own: cut before a space that follows another character."""
    begin = 0
    while len(text) - begin > CUT_CHARS:
        at = begin + CUT_CHARS
        while 0 < (at := text.find(" ", at)) and text[at - 1].isspace():
            at += 1
        if at < 0:
            break
        yield text[begin:at]
        begin = at
    yield text[begin:]


@cache
def encoder(path: str) -> Encoder:
    """The encoder of this Python worker, kept between tasks."""
    return Encoder(path)


def pack(docs: DataFrame, tokenizer: str, longest: int = 2048) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids, doc_tokens, sequence_id, offset, bucket.

    ``ids`` are the piece's tokens as little-endian 32-bit numbers: what a trainer maps into memory. A document's ids
    are the tokenizer's, without special ones, and a closing 1; null and empty texts have only that. ``start`` counts
    the document's ids before the piece. ``sequence_id`` is unique; each sequence is one piece, so ``offset`` is 0.
    ``bucket`` is the length of the sequence, a power of two. Rows are cut one by one: null or repeated ids, and
    repeated rows, are documents of their own. Nothing is shuffled; ``write_buckets`` stores the buckets apart.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        row, starts, lengths, sizes, ids = [], [], [], [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            whole = b"".join(map(encode, long_units(text or ""))) + END_OF_DOCUMENT.to_bytes(4, "little")
            n, at = len(whole) // 4, 0
            for length in piece_lengths(n, longest):
                row.append(i)
                starts.append(at)
                lengths.append(length)
                sizes.append(n)
                ids.append(whole[4 * at : 4 * (at + length)])
                at += length
        columns = [pa.array(c, pa.int64()) for c in (starts, lengths, sizes)]
        doc_ids = batch.column("doc_id").take(pa.array(row, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [doc_ids, *columns, pa.array(ids, pa.binary())], ["doc_id", "start", "length", "doc_tokens", "ids"]
        )

    pieces = map_batches(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        run,
        "doc_id long, start long, length long, doc_tokens long, ids binary",
    )
    return pieces.select(
        "*",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.col("length").cast("int").alias("bucket"),
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The sequences as Parquet, one folder for each length; every file is gathered from several tasks' rows."""
    pieces.hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(path)


def piece_digests(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )
