"""Repeated passages, found by super-k-mers of words.

Every window of ``window`` consecutive words has a minimiser: the smallest hash among its runs of ``part`` words. Equal
windows have equal minimisers, and neighbouring windows mostly share one, so they travel together: a super-k-mer is the
stretch of words that a run of windows with one minimiser covers, sent as one packed string to the minimiser's bucket.
There the words are coded exactly, the windows sorted and each run of equal windows judged: all but the earliest go.

Text that repeats nothing does not travel to be sorted. The minimisers alone, eight bytes each with their document's
number, are dealt to buckets first; only stretches whose minimiser occurs at two places or more are packed and sent.

A minimiser that far too many stretches share, such as one inside a passage of a third of all documents, is counted
beforehand and takes another way: equal stretches are first brought down to their earliest, by aggregation, and the
windows of those are then spread by the hash of the whole window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import map_batches, map_in_arrow, mix, sliced, stored, token_hashes, token_spans, utf8

_ODD = np.random.default_rng(4).integers(1, 2**62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SLICE = 5 << 20
# Deals that documents' lists are gathered in, for each so many buckets of minimisers.
DEALS, MANY_BUCKETS = 256, 4096


@dataclass(frozen=True)
class Windows:
    """``bucket``: stretches per bucket, about. ``crowd``: a minimiser counts as hot with more stretches than this, and
    than ``times`` the mean of the counters. ``bits``: there are 2 ** bits counters, however large the input.
    ``samples``: texts, each of 4,000 characters at most, that the compression dictionary is made from; it changes how
    small the packed rows are, and no result."""

    window: int = 20
    part: int = 8
    bucket: int = 1 << 15
    crowd: int = 4096
    times: int = 8
    bits: int = 22
    samples: int = 1000


@dataclass
class Stretches:
    """Super-k-mers of a batch: document row, first word in it, windows, minimiser, and the bytes each covers; ``word``
    is the first word among all of the batch, whose ``parts`` are hashed."""

    row: np.ndarray
    start: np.ndarray
    count: np.ndarray
    minimiser: np.ndarray
    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    word: np.ndarray | None = None
    parts: np.ndarray | None = None

    def take(self, which: np.ndarray) -> Stretches:
        own = ("row", "start", "count", "minimiser", "begin", "end", "word")
        some = {name: getattr(self, name) for name in own}
        return replace(self, **{name: x[which] for name, x in some.items() if x is not None})

    def recurs(self, how: Windows) -> np.ndarray:
        """Whether the minimiser occurs at several places of its stretch, whose windows may then be equal."""
        places = self.count + how.window - how.part
        own = np.repeat(np.arange(len(places)), places)
        first = np.cumsum(places) - places
        at = self.word[own] + np.arange(len(own)) - first[own]
        return np.bincount(own, self.parts[at] == self.minimiser[own], len(places)) > 1


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words' bytes with one space behind each, and where each word begins in them, with the end of the last."""
    lengths = ends - starts
    begins = np.concatenate([[0], np.cumsum(lengths + 1)])
    out = np.full(begins[-1], 32, np.uint8)
    inside = np.ones(begins[-1], bool)
    inside[begins[1:] - 1] = False
    change = np.zeros(len(data) + 1, np.int8)
    change[starts] += 1
    change[ends] -= 1
    out[inside] = data[np.cumsum(change[:-1], dtype=np.int8).astype(bool)]
    return out, begins


def sliding(values: np.ndarray, width: int, step: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """``step`` over all runs of ``width`` values, put together from runs of powers of two."""
    out, own, done = None, values, 0
    n = len(values) - width + 1
    size = 1
    while True:
        if width & size:
            part = own[done : done + n]
            out = part if out is None else step(out, part)
            done += size
        size *= 2
        if size > width:
            return out
        own = step(own[: len(own) - size // 2], own[size // 2 :])


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _ODD[0] + b * _ODD[1]
    return x ^ (x >> np.uint64(32))


def stretches(texts: pa.Array, how: Windows) -> Stretches:
    data, offsets = utf8(texts)
    starts, ends, first = token_spans(data, offsets)
    n = len(starts) - how.window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        empty = none.astype(np.uint64)
        return Stretches(none, none, none, empty, np.zeros(0, np.uint8), none, none, none, empty)
    packed, begins = joined_words(data, starts, ends)
    runs = mix(sliding(token_hashes(data, starts, ends), how.part, _pair))
    least = sliding(runs, how.window - how.part + 1, np.minimum)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    whole = row[:n] == row[how.window - 1 :]
    new = np.ones(n, bool)
    new[1:] = (least[1:] != least[:-1]) | ~whole[:-1]
    begin = np.flatnonzero(new & whole)
    stop = np.append(np.flatnonzero(new | ~whole), n)
    end = stop[np.searchsorted(stop, begin, side="right")]
    return Stretches(
        row[begin],
        begin - first[row[begin]],
        end - begin,
        least[begin],
        packed,
        begins[begin],
        begins[end + how.window - 1],
        begin,
        runs,
    )


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(hashes + np.uint64(1)) % np.uint64(buckets)).astype(np.int64)


def _slot(minimisers: np.ndarray, bits: int) -> np.ndarray:
    return (mix(minimisers + np.uint64(2)) >> np.uint64(64 - bits)).astype(np.int64)


# ---- packing and the buckets


PACKED = "bucket long, n long, payload binary"
WIDTHS = tuple(np.dtype(t) for t in ("<i1", "<i2", "<i4", "<i8"))


def text_dictionary(docs: DataFrame, how: Windows) -> bytes:
    """A compression dictionary of these texts' usual strings, for rows too short to have any; empty if there is little
    text."""
    some = docs.filter("octet_length(text) > 100").select(F.substring("text", 1, 4000).alias("text"))
    samples = [r["text"].encode() for r in some.limit(how.samples).collect()]
    if len(samples) < 20:
        return b""
    try:
        return zstandard.train_dictionary(64 << 10, samples).as_bytes()
    except zstandard.ZstdError:  # too little text, or all alike
        return b""


@lru_cache(maxsize=4)
def zstd(dictionary: bytes) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """Of this Python worker; a dictionary is prepared once."""
    if not dictionary:
        return zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
    own = zstandard.ZstdCompressionDict(dictionary)
    own.precompute_compress(level=3)
    return zstandard.ZstdCompressor(level=3, dict_data=own), zstandard.ZstdDecompressor(dict_data=own)


def narrow(column: np.ndarray) -> bytes:
    """The numbers in the fewest bytes that hold the largest, with the width before them."""
    kind = next(t for t in WIDTHS if np.iinfo(t).min <= column.min() and column.max() <= np.iinfo(t).max)
    return bytes([kind.itemsize]) + column.astype(kind).tobytes()


def pack(
    own: Stretches, ids: pa.Array, twins: pa.Array, bucket: np.ndarray, dictionary: bytes = b""
) -> pa.RecordBatch:
    """One row for each bucket: the stretches' columns and bytes behind each other, compressed."""
    order = np.argsort(bucket, kind="stable")
    own, bucket = own.take(order), bucket[order]
    known = np.asarray(pc.is_valid(ids))[own.row].astype(np.int64)
    ids_ = np.asarray(pc.fill_null(ids, 0))[own.row]
    twins_ = np.asarray(pc.fill_null(twins, 0))[own.row]
    sizes = own.end - own.begin
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1)) if len(bucket) else np.zeros(0, np.int64)
    squeeze = zstd(dictionary)[0]
    view = memoryview(own.data)
    rows: list[tuple[int, int, bytes]] = []
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)]):
        head = b"".join(narrow(c[a:b]) for c in (known, ids_, twins_, own.start, own.count, sizes))
        text = b"".join([view[x:y] for x, y in zip(own.begin[a:b].tolist(), own.end[a:b].tolist())])
        rows.append((int(bucket[a]), b - a, squeeze.compress(head + text)))
    kinds = (pa.int64(), pa.int64(), pa.binary())
    columns = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["bucket", "n", "payload"])


def unpack(counts: list[int], payloads: list[bytes], dictionary: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """Columns (known, id, twin, start, count, bytes) as rows of a table, and all bytes of all stretches."""
    expand = zstd(dictionary)[1]
    heads, texts = [], []
    for n, payload in zip(counts, payloads):
        whole, at = expand.decompress(payload), 0
        head = np.empty((6, n), np.int64)
        for column in head:
            width = whole[at]
            column[:] = np.frombuffer(whole, f"<i{width}", n, at + 1)
            at += 1 + width * n
        heads.append(head)
        texts.append(whole[at:])
    return np.concatenate(heads, axis=1), np.frombuffer(b"".join(texts), np.uint8)


REPEATS = "doc_id long, twin long, first long, stop long"


def repeats_in_bucket(counts: list[int], payloads: list[bytes], window: int, dictionary: bytes = b"") -> pa.Table:
    """Words (from ``first`` to before ``stop``) of documents that a window covers which starts earlier elsewhere."""
    (known, ids, twins, start, count, _), data = unpack(counts, payloads, dictionary)
    words = np.flatnonzero(data == 32) + 1
    coded = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(words), [None, pa.py_buffer(np.concatenate([[0], words])), pa.py_buffer(data)]
    )
    codes = np.asarray(coded.dictionary_encode().indices).astype(np.uint64)
    lengths = count + window - 1
    word = np.cumsum(lengths) - lengths
    order = np.lexsort((start, twins, ids, known))
    known, ids, twins, start, count, word = (x[order] for x in (known, ids, twins, start, count, word))
    # all windows, the earliest first
    own = np.repeat(np.arange(len(count)), count)
    step = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
    at = word[own] + step
    hashes = sliding(codes, window, _pair)[at]
    by = np.argsort(hashes, kind="stable")
    sorted_ = hashes[by]
    new = np.ones(len(by), bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    lead = by[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
    late, lead = by[~new], lead[~new]
    equal = np.ones(len(late), bool)
    for i in range(window):
        equal &= codes[at[late] + i] == codes[at[lead] + i]
    repeated = np.zeros(len(own), bool)
    other = np.isin(lead, lead[~equal])  # different windows with one hash: told apart one by one
    _mark(repeated, late[~other], lead[~other], known, ids, twins, start, own, step)
    for run in np.unique(lead[other]):
        earliest: dict[bytes, int] = {}
        for i in [run, *late[lead == run]]:
            first = earliest.setdefault(codes[at[i] : at[i] + window].tobytes(), i)
            _mark(repeated, np.array([i]), np.array([first]), known, ids, twins, start, own, step)
    begins = np.flatnonzero(repeated & ~(np.append(False, repeated[:-1]) & (step > 0)))
    stops = np.flatnonzero(repeated & ~np.append(repeated[1:] & (step[1:] > 0), False))
    a, first, stop = own[begins], start[own[begins]] + step[begins], start[own[stops]] + step[stops] + window
    return pa.table(
        {
            "doc_id": pa.array(ids[a], pa.int64(), mask=known[a] == 0),
            "twin": twins[a],
            "first": first,
            "stop": stop,
        }
    )


def _mark(repeated, late, lead, known, ids, twins, start, own, step) -> None:
    """Marks windows that start elsewhere than the earliest equal one; the same place of a repeated row is no other."""
    a, b = own[late], own[lead]
    same = (known[a] == known[b]) & (ids[a] == ids[b]) & (twins[a] == twins[b])
    repeated[late] = ~(same & (start[a] + step[late] == start[b] + step[lead]))


def _repeats(packed: DataFrame, window: int, dictionary: bytes) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        return repeats_in_bucket(table["n"].to_pylist(), table["payload"].to_pylist(), window, dictionary)

    return packed.groupBy("bucket").applyInArrow(run, REPEATS)


# ---- the passes over the documents


def _counted(docs: DataFrame, how: Windows, bits: int) -> DataFrame:
    """slot, n: stretches by their minimisers' slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for part in sliced(batch):
                slots, n = np.unique(_slot(stretches(part.column("text"), how).minimiser, bits), return_counts=True)
                counts[slots] += n
        slots = np.flatnonzero(counts)
        for i in range(0, len(slots), 1 << 16):
            some = slots[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["slot", "n"])

    return map_in_arrow(docs.select("text"), run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))


def _is_hot(own: Stretches, hot: np.ndarray, bits: int) -> np.ndarray:
    return np.isin(_slot(own.minimiser, bits), hot)


KEYS = "bucket long, documents long, n long, payload binary"
DEALT = "deal long, documents long, n long, payload binary"
SHARED = "doc_id long, twin long, minimisers array<long>"


def _keys(docs: DataFrame, how: Windows, hot: np.ndarray, bits: int, buckets: int) -> DataFrame:
    """For each batch and bucket, the minimisers of the batch's stretches and the documents they are in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, SLICE):
                own = stretches(part.column("text"), how)
                own = own.take(np.flatnonzero(~_is_hot(own, hot, bits)))
                yield pack_keys(own, part.column("doc_id"), part.column("twin"), how, buckets)

    return map_in_arrow(docs, run, KEYS)


def pack_keys(own: Stretches, ids: pa.Array, twins: pa.Array, how: Windows, buckets: int) -> pa.RecordBatch:
    known = np.asarray(pc.is_valid(ids)).astype(np.int64)
    named = (known, *(np.asarray(pc.fill_null(x, 0)) for x in (ids, twins)))
    bucket = _bucket(own.minimiser, buckets)
    return pack_lists("bucket", bucket, named, own.row, own.recurs(how).astype(np.int64), own.minimiser)


def pack_lists(
    group: str, groups: np.ndarray, named: tuple, row: np.ndarray, again: np.ndarray, minimiser: np.ndarray
) -> pa.RecordBatch:
    """One row per group: the minimisers, and the documents (known, id, twin) whose ``row`` they name."""
    order = np.lexsort((row, groups))
    row, groups, again, minimiser = row[order], groups[order], again[order], minimiser[order].astype("<u8")
    squeeze = zstd(b"")[0]
    rows: list[tuple[int, int, int, bytes]] = []
    cuts = np.flatnonzero(np.diff(groups, prepend=-1)).tolist() if len(groups) else []
    for a, b in zip(cuts, [*cuts[1:], len(groups)]):
        docs, at = np.unique(row[a:b], return_inverse=True)
        heads = (*(x[docs] for x in named), at, again[a:b])
        payload = b"".join(map(narrow, heads)) + minimiser[a:b].tobytes()
        rows.append((int(groups[a]), len(docs), b - a, squeeze.compress(payload)))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    columns = zip(*rows) if rows else ((), (), (), ())
    names = [group, "documents", "n", "payload"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def unpack_lists(documents: list[int], counts: list[int], payloads: list[bytes]) -> list[np.ndarray]:
    """known, id and twin of the documents; row, again and minimiser of the stretches."""
    expand = zstd(b"")[1]
    whole: list[list[np.ndarray]] = [[], [], [], [], [], []]
    base = 0
    for d, n, payload in zip(documents, counts, payloads):
        data, at = expand.decompress(payload), 0
        for i, size in enumerate((d, d, d, n, n)):
            width = data[at]
            whole[i].append(np.frombuffer(data, f"<i{width}", size, at + 1).astype(np.int64))
            at += 1 + width * size
        whole[3][-1] += base
        whole[5].append(np.frombuffer(data, "<i8", n, at))
        base += d
    return list(map(np.concatenate, whole))


def shared_in_bucket(documents: list[int], counts: list[int], payloads: list[bytes], deals: int) -> pa.Table:
    """The documents' minimisers that occur at two places or more, packed by deals of documents."""
    known, ids, twins, row, again, minimiser = unpack_lists(documents, counts, payloads)
    _, of, times = np.unique(minimiser, return_inverse=True, return_counts=True)
    times = times + np.bincount(of, again).astype(np.int64)
    some = np.flatnonzero(times[of] > 1)
    deal = _bucket(_pair(ids.view(np.uint64), (twins + known).view(np.uint64)), deals)
    row, minimiser = row[some], minimiser[some]
    return pa.Table.from_batches(
        [pack_lists("deal", deal[row], (known, ids, twins), row, np.zeros(len(row), np.int64), minimiser)]
    )


def lists_of_documents(documents: list[int], counts: list[int], payloads: list[bytes]) -> pa.Table:
    """One row per document: its minimisers of all buckets."""
    known, ids, twins, row, _, minimiser = unpack_lists(documents, counts, payloads)
    docs, of = np.unique(np.stack([known, ids, twins]), axis=1, return_inverse=True)
    row = of.reshape(-1)[row]
    ends = np.cumsum(np.bincount(row, minlength=docs.shape[1]))
    lists = pa.ListArray.from_arrays(
        pa.array(np.append(0, ends), pa.int32()), pa.array(minimiser[np.argsort(row, kind="stable")], pa.int64())
    )
    return pa.table({"doc_id": pa.array(docs[1], pa.int64(), mask=docs[0] == 0), "twin": docs[2], "minimisers": lists})


def _shared(keys: DataFrame, buckets: int) -> DataFrame:
    """doc_id, twin, minimisers of the documents that share any. A bucket brings a row per deal of documents, not per
    document, since with more buckets a document is in more of them."""
    deals = DEALS * -(-buckets // MANY_BUCKETS)
    columns = ("documents", "n", "payload")

    def in_bucket(table: pa.Table) -> pa.Table:
        return shared_in_bucket(*(table[c].to_pylist() for c in columns), deals)

    def in_deal(table: pa.Table) -> pa.Table:
        return lists_of_documents(*(table[c].to_pylist() for c in columns))

    return keys.groupBy("bucket").applyInArrow(in_bucket, DEALT).groupBy("deal").applyInArrow(in_deal, SHARED)


def _packed(frames: DataFrame, shared: DataFrame, how: Windows, buckets: int, dictionary: bytes) -> DataFrame:
    """The stretches that may be repeated, packed by bucket. Hot minimisers are in no list of shared ones."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in by_text_size(batch):
            own = stretches(texts_of(part), how)
            # the minimisers that one of these documents shares are shared wherever they occur
            listed = part.column("minimisers").flatten()
            own = own.take(np.flatnonzero(np.isin(own.minimiser.view(np.int64), np.asarray(listed))))
            bucket = _bucket(own.minimiser, buckets)
            yield pack(own, part.column("doc_id"), part.column("twin"), bucket, dictionary)

    return map_batches(with_rows(frames, shared, "minimisers", "inner"), run, PACKED)


def with_rows(frames: DataFrame, some: DataFrame, column: str, kind: str) -> DataFrame:
    """doc_id, twin, frame and a column of ``some`` (doc_id, twin, column). The frames are dealt out once, however often
    they are joined in a query: Spark sees that it is the same exchange."""
    named = some.select(F.col("doc_id").alias("id"), F.col("twin").alias("tw"), column)
    # null-safe twice: a plain condition would add a filter to an inner join, and the exchanges would differ
    same = F.col("doc_id").eqNullSafe(F.col("id")) & F.col("twin").eqNullSafe(F.col("tw"))
    return frames.join(named.hint("merge"), same, kind).select("doc_id", "twin", "frame", column)


def _hot_stretches(docs: DataFrame, how: Windows, hot: np.ndarray, bits: int) -> DataFrame:
    """doc_id, twin, start, n, s (the words) of the stretches with a hot minimiser."""

    def run(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = stretches(part.column("text"), how)
        own = own.take(np.flatnonzero(_is_hot(own, hot, bits)))
        row = pa.array(own.row)
        view = memoryview(own.data)
        text = [bytes(view[x:y]) for x, y in zip(own.begin.tolist(), own.end.tolist())]
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id").take(row),
                part.column("twin").take(row),
                pa.array(own.start),
                pa.array(own.count),
                pa.array(text, pa.binary()),
            ],
            ["doc_id", "twin", "start", "n", "s"],
        )

    return map_batches(docs, run, "doc_id long, twin long, start long, n long, s binary")


def _spread(firsts: DataFrame, how: Windows, buckets: int, dictionary: bytes) -> DataFrame:
    """Every window of these stretches as a stretch of its own, in the bucket of its own hash."""

    def run(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = utf8(part.column("s").cast(pa.large_binary()).cast(pa.large_string()))
        starts, ends, first = token_spans(data, offsets)
        packed, begins = joined_words(data, starts, ends)
        count = np.diff(first) - how.window + 1
        row = np.repeat(np.arange(len(count)), count)
        step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        at = first[row] + step
        hashes = sliding(token_hashes(data, starts, ends), how.window, _pair)[at]
        begin = np.asarray(part.column("start"))[row] + step
        one = np.ones(len(row), np.int64)
        own = Stretches(row, begin, one, hashes, packed, begins[at], begins[at + how.window])
        yield pack(own, part.column("doc_id"), part.column("twin"), _bucket(hashes, buckets), dictionary)

    return map_batches(firsts, run, PACKED)


def _hot_repeats(docs: DataFrame, how: Windows, hot: np.ndarray, bits: int, dictionary: bytes) -> DataFrame:
    all_ = stored(_hot_stretches(docs, how, hot, bits), "hot-stretches")
    place = F.struct("doc_id", "twin", "start")
    firsts = stored(all_.groupBy("s").agg(F.min(place).alias("lead"), F.max("n").alias("n")), "hot-firsts")
    later = all_.join(firsts.select("s", "lead").hint("merge"), "s").filter(~place.eqNullSafe(F.col("lead")))
    whole = later.select(
        "doc_id", "twin", F.col("start").alias("first"), (F.col("start") + F.col("n") + how.window - 1).alias("stop")
    )
    windows = firsts.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-windows // (4 * how.bucket)))
    parts = _spread(firsts.select("lead.doc_id", "lead.twin", "lead.start", "s"), how, buckets, dictionary)
    return whole.union(_repeats(parts, how.window, dictionary))


def repeats(docs: DataFrame, frames: DataFrame, how: Windows = Windows()) -> DataFrame:
    """doc_id, twin, first, stop: the words of ``docs`` (doc_id, twin, text) that repeat an earlier window. ``frames``
    holds the same texts compressed."""
    bits = how.bits
    slots = stored(_counted(docs, how, bits), "stretch-counts")
    total = slots.agg(F.sum("n")).first()[0] or 0
    crowded = max(how.crowd, how.times * total >> bits)
    # over ``times`` the mean: at most one counter in ``times`` is hot
    hot = np.array(sorted(r["slot"] for r in slots.filter(F.col("n") > crowded).select("slot").collect()), np.int64)
    dictionary = text_dictionary(docs, how)
    key_buckets = max(1, -(-total // (8 * how.bucket)))
    shared = _shared(_keys(docs, how, hot, bits, key_buckets), key_buckets)
    buckets = max(1, -(-total // how.bucket))
    out = [_repeats(_packed(frames, shared, how, buckets, dictionary), how.window, dictionary)]
    if len(hot):
        out.append(_hot_repeats(docs, how, hot, bits, dictionary))
    return reduce(DataFrame.union, out)


def _twin(docs: DataFrame) -> Column:
    """Tells rows apart that share their doc_id; nothing to tell in the usual case."""
    shared = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    return F.lit(0).cast("long") if shared.isEmpty() else F.coalesce(F.xxhash64("text"), F.lit(0).cast("long"))


def squeezed(rows: DataFrame) -> DataFrame:
    """doc_id, twin, frame: the texts compressed, since all of them travel to their spans."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        squeeze = zstd(b"")[0]
        frames = [squeeze.compress(x.as_buffer() or b"") for x in batch.column("text").fill_null("")]
        columns = [batch.column("doc_id"), batch.column("twin"), pa.array(frames, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "twin", "frame"])

    return map_batches(rows.select("doc_id", "twin", "text"), run, "doc_id long, twin long, frame binary")


def texts_of(batch: pa.RecordBatch) -> pa.Array:
    expand = zstd(b"")[1]
    return pa.array([expand.decompress(x.as_buffer()).decode() for x in batch.column("frame")], pa.string())


def by_text_size(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices whose frames hold little text, or one row each, however well it is compressed."""
    start = total = 0
    for i, frame in enumerate(batch.column("frame")):
        size = zstandard.frame_content_size(frame.as_buffer())
        if i > start and total + size > SLICE:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if batch.num_rows:
        yield batch.slice(start)


def remove_repeats(docs: DataFrame, how: Windows = Windows()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, text (the kept words, joined by one space).

    Words are runs without white space (space, tab to carriage return), unchanged. A window of ``how.window``
    consecutive words of one document goes, with all words it covers, if the same words also start earlier: in a
    document with a smaller doc_id, or in the same one before. Windows are judged on the input. A null text has no
    words; a text of fewer words than a window stays. A null doc_id counts as the smallest. Rows that share a doc_id
    are ordered by a hash of their texts; rows that repeat both are one document, and come back as often. Other columns
    are ignored.
    """
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = plain.withColumn("twin", _twin(plain))
    frames = squeezed(rows)
    spans = repeats(rows, frames, how).groupBy("doc_id", "twin")
    spans = spans.agg(F.collect_list(F.struct("first", "stop")).alias("spans"))
    joined = with_rows(frames, spans, "spans", "left")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in by_text_size(batch):
            yield cleaned(part)

    def cleaned(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = utf8(texts_of(batch))
        starts, ends, first = token_spans(data, offsets)
        counts = np.diff(first)
        gone = np.zeros(len(starts) + 1, np.int64)
        own = batch.column("spans")
        flat = own.flatten()
        row = np.repeat(np.arange(len(own)), np.asarray(pc.fill_null(pc.list_value_length(own), 0)))
        np.add.at(gone, first[row] + np.asarray(flat.field("first")), 1)
        np.add.at(gone, first[row] + np.asarray(flat.field("stop")), -1)
        stay = np.cumsum(gone[:-1]) == 0
        packed, begins = joined_words(data, starts[stay], ends[stay])
        upto = np.concatenate([[0], np.cumsum(stay)])
        removed, whole = [], []
        for a, b in zip(first[:-1], first[1:]):
            x, y = begins[upto[a]], begins[upto[b]]
            removed.append(int(b - a - (upto[b] - upto[a])))
            whole.append(packed[x : max(x, y - 1)].tobytes().decode())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(whole)],
            ["doc_id", "n_words", "n_removed", "text"],
        )

    return map_batches(joined, run, "doc_id long, n_words long, n_removed long, text string")


KEPT_SQL = """
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM split),
win AS (
  SELECT doc_id, i, md5(string_agg(word, ' ') OVER p) AS h, count(*) OVER p AS n FROM word
  WINDOW p AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
lead AS (SELECT h, min((doc_id, i)) AS lead FROM win WHERE n = 20 GROUP BY h),
late AS (SELECT doc_id, i FROM win JOIN lead USING (h) WHERE n = 20 AND lead <> (doc_id, i)),
marked AS (
  SELECT word.doc_id, word.i, word,
    max(CASE WHEN late.i IS NOT NULL THEN late.i END) OVER (
      PARTITION BY word.doc_id ORDER BY word.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM word LEFT JOIN late ON late.doc_id = word.doc_id AND late.i = word.i),
kept AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed,
         string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS text FROM marked GROUP BY doc_id)
SELECT split.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept ON kept.doc_id = split.doc_id
"""
