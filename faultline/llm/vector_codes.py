"""Product codes of vectors, fitted in whole numbers by limb-split exact GEMM.

Components become integers, vectors are cut into parts of equal length, and each part position has a codebook of a few
entries, fitted by rounds of assignment and floored means. Everything is a whole number, so a code does not depend on
the order in which rows are added up, on the number of tasks, or on the BLAS at hand.

The inner products run through float64 BLAS nevertheless. Integers are split into limbs so narrow that no sum of
products reaches 2^53; the products of limbs are then exact, and are put together in int64. Numbers that fit into one
limb (all of the given embeddings do) need one product, larger ones four.

A round is one pass over the vectors, stored once as packed integers: every task adds up its own parts by entry, and
parts x entries x length sums are all that is shuffled and all that the driver sees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import map_in_arrow, sliced, stored


@dataclass(frozen=True)
class Codes:
    """``scale``: a component x becomes floor(scale * x). ``entries``: at most 256, for two hex digits each."""

    scale: int = 4096
    parts: int = 8
    entries: int = 16
    rounds: int = 6

    def __post_init__(self) -> None:
        if not (0 < self.entries <= 256 and self.parts > 0 and self.rounds >= 0):
            raise ValueError("1 to 256 entries, at least one part")


# ---- exact products


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """x = sum of limb[i] << (bits * i): all but the last are in [0, 2^bits), the last holds the sign."""
    out = []
    while len(x.ravel()) and int(np.abs(x).max()) >> bits:
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return [*out, x.astype(np.float64)]


def exact_matmul(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b of int64 arrays, by float64 BLAS over limbs. The result itself must fit int64."""
    bits = (53 - max(1, a.shape[-1]).bit_length()) // 2
    out = np.zeros((*np.broadcast_shapes(a.shape[:-2], b.shape[:-2]), a.shape[-2], b.shape[-1]), np.int64)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(limbs(b, bits)):
            out += (x @ y).astype(np.int64) << (bits * (i + j))
    return out


def nearest(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For x (parts, rows, length) and books (parts, entries, length): the nearest entry's number, the lowest of equals,
    and its squared distance, both (parts, rows)."""
    away = (books**2).sum(axis=2)[:, None, :] - 2 * exact_matmul(x, books.transpose(0, 2, 1))
    code = away.argmin(axis=2)
    return code, np.take_along_axis(away, code[:, :, None], axis=2)[:, :, 0] + (x**2).sum(axis=2)


# ---- vectors as packed integers


def largest(width: int) -> int:
    """Components up to this size leave all squared distances, and their sum over a vector, below 2^63."""
    return isqrt((1 << 61) // max(1, width)) // 2


def integers(vectors: DataFrame, how: Codes) -> DataFrame:
    """vec_id, label, ints (little-endian 32-bit) of the rows whose vector is whole and finite.

    ``ints`` is null where a vector cannot be coded: its length is not a positive multiple of ``how.parts``, or a
    component is beyond :func:`largest`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            sizes = np.asarray(pc.fill_null(pc.list_value_length(column), 0), np.int64)
            flat = np.asarray(pc.fill_null(column.flatten().cast(pa.float64()), np.nan))
            ends = np.cumsum(sizes)
            row = np.repeat(np.arange(len(sizes)), sizes)
            kept = np.bincount(row, ~np.isfinite(flat), len(sizes)) == 0
            kept &= np.asarray(pc.is_valid(column))
            with np.errstate(over="ignore", invalid="ignore"):
                whole = np.floor(flat * how.scale)
            bound = np.array([largest(n) for n in np.unique(sizes)])[np.unique(sizes, return_inverse=True)[1]]
            far = np.bincount(row, ~(np.abs(whole) <= bound[row]), len(sizes)) > 0
            fit = kept & ~far & (sizes > 0) & (sizes % how.parts == 0)
            packed = np.where(np.isfinite(whole) & fit[row], whole, 0).astype("<i4")
            rows = np.flatnonzero(kept)
            ints = [packed[ends[i] - sizes[i] : ends[i]].tobytes() if fit[i] else None for i in rows.tolist()]
            own = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(own), batch.column("label").take(own), pa.array(ints, pa.binary())],
                ["vec_id", "label", "ints"],
            )

    label = vectors.schema["label"].dataType.simpleString()
    return map_in_arrow(vectors, run, f"vec_id long, label {label}, ints binary")


def _parts(ints: pa.Array, how: Codes) -> np.ndarray:
    """(parts, rows, length) of vectors of one width."""
    whole = np.frombuffer(b"".join(x.as_buffer() for x in ints), "<i4").astype(np.int64)
    return whole.reshape(len(ints), how.parts, -1).transpose(1, 0, 2)


# ---- fitting and coding


def first_books(vectors: DataFrame, how: Codes) -> np.ndarray:
    """(parts, entries, length): the vectors of the smallest ids, of the first one's width. Null ids come last; rows
    that share an id are ordered by their packed integers."""
    ordered = vectors.filter("ints IS NOT NULL").orderBy(F.col("vec_id").asc_nulls_last(), "ints")
    first = ordered.limit(1).collect()
    if not first:
        return np.zeros((how.parts, 0, 0), np.int64)
    same = ordered.filter(F.octet_length("ints") == len(first[0]["ints"]))
    return _parts(pa.array([r["ints"] for r in same.limit(how.entries).collect()], pa.binary()), how).copy()


def _sums(vectors: DataFrame, books: np.ndarray, how: Codes) -> DataFrame:
    """part, entry, n, position, total: the parts of the vectors by their nearest entry, added up."""
    entries, length = books.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, n = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for part in sliced(batch):
                x = _parts(part.column("ints"), how)
                of = (nearest(x, books)[0][:, None, :] == np.arange(entries)[None, :, None]).astype(np.int64)
                totals += exact_matmul(of, x)
                n += of.sum(axis=2)
        at = [np.repeat(np.arange(how.parts), entries), np.tile(np.arange(entries), how.parts), n.ravel()]
        rows = pa.array(totals.reshape(-1, length).tolist(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*map(pa.array, at), rows], ["part", "entry", "n", "totals"])

    each = map_in_arrow(vectors.select("ints"), run, "part long, entry long, n long, totals array<long>")
    long = each.filter("n > 0").select("part", "entry", "n", F.posexplode("totals").alias("position", "total"))
    return long.groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def fit_books(vectors: DataFrame, how: Codes = Codes()) -> np.ndarray:
    """The codebooks after all rounds. An entry that no part is nearest to stays as it is."""
    books = first_books(vectors, how)
    same = _codable(vectors, books)
    for _ in range(how.rounds if books.size else 0):
        # at most parts x entries x length rows
        for part, entry, position, n, total in _sums(same, books, how).collect():
            books[part, entry, position] = total // n
    return books


def _codable(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    return vectors.filter(F.octet_length("ints") == 4 * books.shape[0] * books.shape[2])


def encode(vectors: DataFrame, books: np.ndarray, how: Codes = Codes()) -> DataFrame:
    """vec_id, label, code (two hex digits per part), error; the last two null for vectors that cannot be coded."""
    width = 4 * books.shape[0] * books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch):
                ints = part.column("ints")
                fit = np.asarray(pc.fill_null(pc.equal(pc.binary_length(ints), width), False)) & bool(books.size)
                code, error = np.full(len(ints), None, object), np.zeros(len(ints), np.int64)
                if fit.any():
                    codes, away = nearest(_parts(ints.filter(pa.array(fit)), how), books)
                    digits = np.ascontiguousarray(codes.T.astype(np.uint8))
                    code[fit] = [row.tobytes().hex() for row in digits]
                    error[fit] = away.sum(axis=0)
                columns = [pa.array(code, pa.string()), pa.array(error, mask=~fit)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("label"), *columns], ["vec_id", "label", "code", "error"]
                )

    label = vectors.schema["label"].dataType.simpleString()
    return map_in_arrow(vectors, run, f"vec_id long, label {label}, code string, error long")


def decode(codes: DataFrame, books: np.ndarray, how: Codes = Codes()) -> DataFrame:
    """vec_id, approx (the vector that the code stands for), null for a null code."""
    entry = books.reshape(*books.shape[:2], -1) / how.scale

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [None if c is None else bytes.fromhex(c) for c in batch.column("code").to_pylist()]
            whole = [None if c is None else np.concatenate([entry[p, e] for p, e in enumerate(c)]) for c in each]
            approx = pa.array(whole, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), approx], ["vec_id", "approx"])

    return map_in_arrow(codes.select("vec_id", "code"), run, "vec_id long, approx array<double>")


def compress(
    table: DataFrame, how: Codes = Codes(), vector: str = "embedding"
) -> tuple[DataFrame, np.ndarray]:
    """The codes of all vectors of ``table`` (vec_id, label, ``vector``), and the codebooks (parts, entries, length).

    Rows are dropped whose vector is null or holds a null or non-finite component. A vector whose length differs from
    that of the smallest kept id's, or is no positive multiple of ``how.parts``, or that has a component too large for
    exact distances in int64 (beyond 2^25 in vectors of 64) keeps its row, with a null code and error, and fits nothing.
    Repeated rows and ids are vectors of their own. With fewer vectors than entries the codebooks are shorter; an empty
    table gives no rows and empty codebooks. Other columns are ignored.
    """
    own = table.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col(vector).alias("vector"))
    vectors = stored(integers(own, how), "vector-integers")
    books = fit_books(vectors, how)
    return encode(vectors, books, how), books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_errors(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, code, error, label_error (summed over equal labels, nulls together), codebooks_sha256.

    One row per label is what returns to the rows; Spark sees the size of that table before it picks the join.
    """
    codes = stored(codes, "vector-codes")
    sums = stored(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "vector-labels")
    joined = codes.join(sums.withColumnRenamed("label", "of"), F.col("label").eqNullSafe(F.col("of")))
    return joined.select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )


def _round_sql(r: int) -> str:
    """The parts' nearest entries by book r, and from them book r + 1."""
    return f"""
away{r} AS MATERIALIZED (
  SELECT vec_id, part, entry, sum((c.x - b.x) * (c.x - b.x))::BIGINT AS d
  FROM component c JOIN book{r} b USING (part, position) GROUP BY vec_id, part, entry),
near{r} AS MATERIALIZED (
  SELECT vec_id, part, min((d, entry)) AS best FROM away{r} GROUP BY vec_id, part),
"""


def _book_sql(r: int) -> str:
    return f"""
mean{r} AS (
  SELECT part, best[2] AS entry, position, floor(sum(x)::DOUBLE / count(*))::BIGINT AS x
  FROM near{r} JOIN component USING (vec_id, part) GROUP BY ALL),
book{r + 1} AS MATERIALIZED (
  SELECT part, entry, position, coalesce(m.x, b.x) AS x
  FROM book{r} b LEFT JOIN mean{r} m USING (part, entry, position)),
"""


_SIX = "".join(_round_sql(r) + _book_sql(r) for r in range(Codes().rounds)) + _round_sql(Codes().rounds)

CODES_SQL = f"""
WITH vector AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
flat AS (SELECT vec_id, len(v) // 8 AS length, unnest(range(len(v))) AS i, unnest(v) AS x FROM vector),
component AS MATERIALIZED (SELECT vec_id, i // length AS part, i % length AS position, x FROM flat),
start AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM vector ORDER BY vec_id LIMIT 16),
book0 AS MATERIALIZED (SELECT part, entry, position, x FROM component JOIN start USING (vec_id)),
{_SIX}
code AS (
  SELECT vec_id, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, sum(best[1])::BIGINT AS error
  FROM near{Codes().rounds} GROUP BY vec_id),
digest AS (
  SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, position)) AS codebooks_sha256
  FROM book{Codes().rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM vector JOIN code USING (vec_id), digest
"""
