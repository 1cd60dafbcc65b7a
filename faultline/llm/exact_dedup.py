"""Exact duplicates by polynomial fingerprints that are put together from the hashes of chunks.

A text is cut into chunks of equal length. A chunk's hash is its bytes' polynomial at two fixed points modulo two
primes; the hash of a longer text follows from those of its parts: H(ab) = H(a) * base ** len(b) + H(b). Texts with the
same length and fingerprint are then compared chunk by chunk with one of their group, so that a collision splits the
group instead of merging different texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import map_batches, stored, utf8


@dataclass(frozen=True)
class Fingerprints:
    """``chunk``: bytes that are hashed at once, and compared at once. ``moduli``: primes below 2 ** 31."""

    chunk: int = 1 << 15
    moduli: tuple[int, int] = (2147483647, 2147483629)
    bases: tuple[int, int] = (1103515249, 69069069)


def chunk_hash(data: np.ndarray, powers: np.ndarray, modulus: int) -> int:
    """The polynomial of up to ``len(powers)`` bytes; ``powers`` holds the base's powers, the highest first."""
    own = powers[len(powers) - len(data) :]
    return int(np.dot(data.astype(np.uint64) + np.uint64(1), own) % np.uint64(modulus))


def combine(left: int, right: int, right_length: int, base: int, modulus: int) -> int:
    """The hash of two parts, one behind the other."""
    return (left * pow(base, right_length, modulus) + right) % modulus


def _powers(base: int, modulus: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    value = 1
    for i in range(n - 1, -1, -1):
        out[i] = value
        value = value * base % modulus
    return out


def fingerprint(data: np.ndarray, how: Fingerprints, powers: list[np.ndarray]) -> tuple[int, int]:
    """Both hashes of a text's bytes, from its chunks."""
    out = [0, 0]
    for start in range(0, len(data), how.chunk):
        part = data[start : start + how.chunk]
        for k in (0, 1):
            own = chunk_hash(part, powers[k], how.moduli[k])
            out[k] = combine(out[k], own, len(part), how.bases[k], how.moduli[k])
    return out[0], out[1]


KEY = ["n_bytes", "fp1", "fp2"]
_KEY_TYPE = "n_bytes long, fp1 long, fp2 long, text_sha256 string"


def fingerprints(docs: DataFrame, how: Fingerprints = Fingerprints(), chunks: bool = False) -> DataFrame:
    """doc_id, length, fingerprint and digest of each lower-cased text; with ``chunks``, a row for each chunk."""
    names = ["doc_id", *KEY, "text_sha256", *(["chunk_no", "chunk"] if chunks else [])]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        powers = [_powers(b, m, how.chunk) for b, m in zip(how.bases, how.moduli)]
        data, offsets = utf8(batch.column("text"))
        row, prints, shas, numbers, parts = [], [], [], [], []
        for i in range(batch.num_rows):
            text = data[offsets[i] : offsets[i + 1]].tobytes().lower()  # of bytes: A-Z only
            cuts = range(0, max(1, len(text)), how.chunk) if chunks else [0]
            own = (len(text), *fingerprint(np.frombuffer(text, np.uint8), how, powers))
            row += [i] * len(cuts)
            prints += [own] * len(cuts)
            shas += [hashlib.sha256(text).hexdigest()] * len(cuts)
            if chunks:
                numbers += range(len(cuts))
                parts += [text[at : at + how.chunk] for at in cuts]
        arrays = [batch.column("doc_id").take(pa.array(row, pa.int64()))]
        arrays += [pa.array(column, pa.int64()) for column in zip(*prints)] + [pa.array(shas, pa.string())]
        if chunks:
            arrays += [pa.array(numbers, pa.int32()), pa.array(parts, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names)

    return map_batches(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        run,
        f"doc_id long, {_KEY_TYPE}" + (", chunk_no int, chunk binary" if chunks else ""),
    )


def collisions(docs: DataFrame, shared: DataFrame, how: Fingerprints = Fingerprints()) -> DataFrame:
    """doc_id, fingerprint and digest of texts that differ in some chunk from the leading text of their fingerprint.

    ``shared`` has the fingerprints of several documents, and the doc_id that leads each (``lead``).
    """
    chunks = stored(fingerprints(docs, how, chunks=True).join(shared.hint("merge"), KEY), "exact-chunks")
    own = chunks.filter(F.col("doc_id").eqNullSafe(F.col("lead")))
    # stored, so that Spark can split the join where one text has very many copies
    leads = stored(own.groupBy(*KEY, "chunk_no").agg(F.min("chunk").alias("lead_chunk")), "exact-leads")
    return (
        chunks.join(leads.hint("merge"), [*KEY, "chunk_no"])
        .filter("chunk != lead_chunk")
        .select("doc_id", *KEY, "text_sha256")
        .distinct()
    )


def exact_groups(docs: DataFrame, how: Fingerprints = Fingerprints()) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text is an empty one. Of equal texts the largest
    doc_id stays. Rows that repeat both doc_id and text are one document and come back once; a null doc_id is smaller
    than any other, and stays only where its group has no other. Rows that share a doc_id but not the text are
    documents of their own. An empty table gives an empty result. Other columns are ignored.
    """
    prints = stored(fingerprints(docs, how).distinct(), "exact-prints")
    groups = stored(_sizes(prints, KEY), "exact-groups")
    shared = groups.filter("group_size > 1").select(*KEY, F.col("keep_id").alias("lead"))
    other = stored(collisions(docs, shared, how), "exact-collisions")
    key = KEY
    if not other.isEmpty():  # such texts form groups by their digests
        apart = prints.join(other.withColumn("apart", F.lit(True)), ["doc_id", *KEY, "text_sha256"], "left")
        prints = apart.withColumn("part", F.when(F.col("apart"), F.col("text_sha256")).otherwise(""))
        key = [*KEY, "part"]
        groups = stored(_sizes(prints, key), "exact-groups")
    return prints.join(groups.hint("merge"), key).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def _sizes(prints: DataFrame, key: list[str]) -> DataFrame:
    return prints.groupBy(*key).agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"))
