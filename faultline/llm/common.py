"""What the operators share: batches of bounded size, words as arrays, tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from faultline.session import stored

__all__ = [
    "documents",
    "fresh",
    "lower_ascii",
    "map_batches",
    "map_in_arrow",
    "mix",
    "sliced",
    "stored",
    "token_hashes",
    "token_spans",
    "utf8",
]

SLICE_BYTES = 2 << 20
HASH_BYTES = 1 << 20
ARROW_BYTES = 8 << 20
ARROW_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
UPPER = "".join(map(chr, range(ord("A"), ord("Z") + 1)))

_BYTE_CODES = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that the table does not have yet."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name in taken:
            name = f"_{name}"
        out.append(name)
        taken.add(name)
    return out


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """fn over slices of the rows that hold few bytes, or one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch):
                yield from fn(part)

    return map_in_arrow(df, run, schema)


def map_in_arrow(
    df: DataFrame,
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | StructType,
) -> DataFrame:
    """mapInArrow with batches of a few MB: the session's bound on their bytes is lowered where it is higher."""
    conf = df.sparkSession.conf
    now = str(conf.get(ARROW_CONF)).lower().removesuffix("b")
    if not now.isdigit() or int(now) > ARROW_BYTES:
        conf.set(ARROW_CONF, str(ARROW_BYTES))
    return df.mapInArrow(run, schema)


def sliced(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of consecutive rows with at most ``limit`` bytes of text, or one row each."""
    if batch.num_rows == 0:
        return
    sizes = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            sizes += np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64)
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    yield batch.slice(start)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins in them, with the end of the last; null counts as empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return bytes_[starts[0] : starts[-1]], starts - starts[0]


def token_spans(
    data: np.ndarray, offsets: np.ndarray, white: np.ndarray = WHITE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of the first word of each text (with the total at the end).

    A word is a run of bytes that are not ``white``; it never crosses the end of a text.
    """
    inside = ~white[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data) + 1, bool)
    before[0] = False
    before[1:] = inside
    first = inside & (~before[:-1] | edge[:-1])
    after = np.empty(len(data) + 1, bool)
    after[:-1] = inside
    after[-1] = False
    last = inside & (~after[1:] | edge[1:])
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A well-spread permutation of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def token_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    out = np.empty(len(starts), np.uint64)
    lengths = ends - starts
    begin = 0
    while begin < len(starts):
        # as many words as fill a slice of bytes, one at least
        stop = max(begin + 1, int(np.searchsorted(ends, starts[begin] + HASH_BYTES)))
        base, n = starts[begin], lengths[begin:stop]
        codes = _BYTE_CODES[data[base : ends[stop - 1]]]
        own = np.zeros(len(codes), np.int64)
        own[starts[begin:stop] - base] = 1
        word = np.cumsum(own) - 1
        at = np.arange(len(codes)) - (starts[begin:stop] - base)[word]
        powers = np.cumprod(np.full(int(at.max()) + 1, _STEP, np.uint64))
        codes *= powers[at]
        codes[at >= n[word]] = 0  # white space between words
        out[begin:stop] = mix(np.add.reduceat(codes, starts[begin:stop] - base))
        begin = stop
    return out
