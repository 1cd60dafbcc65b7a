"""Fill-in-the-middle transformation over seekable compressed texts.

A text is stored as independent zstandard frames of some 64 KB, with the units (lines), code points and bytes up to the
end of each. Whatever comes later works on frames: a cut is looked up in the cumulative counts, and only the frame it
falls into is decompressed and split in two; all others move to their new place as they are, still compressed. Frames
decode one after the other, so the reordered text is again a valid zstandard stream, and digests stream over its frames
without the text ever being whole in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import map_batches, stored

FRAMES = "payload binary, ends binary"
STORED = f"doc_id long, n long, marked boolean, {FRAMES}"
FILLED = f"doc_id long, n long, form string, prefix_chars long, middle_chars long, {FRAMES}"
DIGESTS = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
    "output_sha256 string, restored_sha256 string"
)


@dataclass(frozen=True)
class FillIn:
    """``seed`` goes before the decimal doc_id. ``rate``: percent of texts that are cut; ``spm``: percent of those with
    the suffix first. The three marks stand before the parts. ``frame_bytes``: text bytes in a frame."""

    seed: str = "7:"
    rate: int = 100
    spm: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    frame_bytes: int = 1 << 16

    def __post_init__(self) -> None:
        if len({self.prefix, self.suffix, self.middle}) < 3 or not all((self.prefix, self.suffix, self.middle)):
            raise ValueError("three different marks are needed")
        if any(_overlap(x, y) for x in self.marks for y in self.marks):
            raise ValueError("no mark may begin as another one ends, or lie in it: they could not be told from text")
        if self.frame_bytes < 1:
            raise ValueError("a frame holds a byte at least")

    @property
    def marks(self) -> tuple[bytes, bytes, bytes]:
        return self.prefix.encode(), self.suffix.encode(), self.middle.encode()


def _overlap(x: bytes, y: bytes) -> bool:
    return (x != y and x in y) or any(x[-k:] == y[:k] for k in range(1, min(len(x), len(y)) + (x != y)) if k < len(x))


@cache
def _zstd() -> tuple[Callable[[bytes], bytes], Callable[[bytes], bytes]]:
    """Compress and decompress, of this Python worker."""
    return zstandard.ZstdCompressor(level=3).compress, zstandard.ZstdDecompressor().decompress


def _points(data: bytes) -> int:
    """Code points that begin in these bytes of UTF-8."""
    return int(np.count_nonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80))


class Frames:
    """A compressed text. ``ends``: one row per frame with the lines that end, the code points that begin and the bytes
    that lie before its end, and where it ends in ``payload``."""

    def __init__(self, payload: bytes, ends: np.ndarray) -> None:
        self.payload, self.ends = payload, ends

    @classmethod
    def of(cls, chunks: Iterable[bytes]) -> Frames:
        out = Builder()
        for chunk in chunks:
            out.add(chunk)
        return out.done()

    @classmethod
    def read(cls, payload: bytes, ends: bytes) -> Frames:
        return cls(payload, np.frombuffer(ends, "<i8").reshape(-1, 4))

    def packed(self) -> tuple[bytes, bytes]:
        return self.payload, self.ends.astype("<i8").tobytes()

    def __len__(self) -> int:
        return len(self.ends)

    def before(self, frame: int) -> np.ndarray:
        return self.ends[frame - 1] if frame else np.zeros(4, np.int64)

    def raw(self, frame: int) -> memoryview:
        return memoryview(self.payload)[self.before(frame)[3] : self.ends[frame][3]]

    def text(self, frame: int) -> bytes:
        return _zstd()[1](self.raw(frame))

    def size(self) -> int:
        return int(self.ends[-1][2]) if len(self) else 0

    def place_of_line(self, line: int, n: int) -> tuple[int, int]:
        """Byte and code point at which a line (from 0) of n begins; one frame is decompressed."""
        if line == 0:
            return 0, 0
        if line >= n:
            return self.size(), int(self.ends[-1][1]) if len(self) else 0
        frame = int(np.searchsorted(self.ends[:, 0], line))
        text = self.text(frame)
        feeds = np.flatnonzero(np.frombuffer(text, np.uint8) == 10)
        at = int(feeds[line - int(self.before(frame)[0]) - 1]) + 1
        return int(self.before(frame)[2]) + at, int(self.before(frame)[1]) + _points(text[:at])

    def span(self, begin: int, end: int) -> Iterator[bytes]:
        """The bytes from ``begin`` to before ``end``, frame by frame."""
        if begin >= end:
            return
        for frame in range(int(np.searchsorted(self.ends[:, 2], begin, side="right")), len(self)):
            start = int(self.before(frame)[2])
            if start >= end:
                return
            text = self.text(frame)
            yield text[max(0, begin - start) : end - start]


class Builder:
    """Frames put together from new text and from frames of other texts."""

    def __init__(self) -> None:
        self.payloads: list[bytes | memoryview] = []
        self.sizes: list[tuple[int, int, int, int]] = []

    def add(self, text: bytes) -> None:
        if text:
            frame = _zstd()[0](text)
            self.payloads.append(frame)
            self.sizes.append((text.count(b"\n"), _points(text), len(text), len(frame)))

    def move(self, source: Frames, begin: int, end: int) -> None:
        """The bytes from ``begin`` to before ``end``: whole frames as they are, cut ones compressed anew."""
        if begin >= end:
            return
        for frame in range(int(np.searchsorted(source.ends[:, 2], begin, side="right")), len(source)):
            start, stop = int(source.before(frame)[2]), int(source.ends[frame][2])
            if start >= end:
                return
            if begin <= start and stop <= end:
                self.payloads.append(source.raw(frame))
                self.sizes.append(tuple((source.ends[frame] - source.before(frame)).tolist()))
            else:
                self.add(source.text(frame)[max(0, begin - start) : end - start])

    def done(self) -> Frames:
        sizes = np.array(self.sizes, np.int64).reshape(-1, 4)
        return Frames(b"".join(self.payloads), np.cumsum(sizes, axis=0))


def chunks(text: bytes, size: int) -> Iterator[bytes]:
    for at in range(0, len(text), size):
        yield text[at : at + size]


def draws(doc_id: int | None, how: FillIn) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of the document; a null id counts as an empty one."""
    digest = hashlib.sha256(f"{how.seed}{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


# ---- the three steps of one document


def line_count(text: bytes) -> int:
    return text.count(b"\n") + (text[-1:] not in (b"", b"\n"))


def fill(
    doc_id: int | None, n: int, marked: bool, frames: Frames, how: FillIn
) -> tuple[str, int | None, int | None, Frames]:
    """Form, code points of prefix and middle, and the transformed text."""
    one, two, cut, order = draws(doc_id, how)
    if not len(frames) or marked or cut % 100 >= how.rate:
        return "plain", None, None, frames
    (a, a_chars), (b, b_chars) = (frames.place_of_line(k, n) for k in sorted((one % (n + 1), two % (n + 1))))
    form = "spm" if order % 100 < how.spm else "psm"
    parts = {how.prefix: (0, a), how.suffix: (b, frames.size()), how.middle: (a, b)}
    marks = (how.suffix, how.prefix, how.middle) if form == "spm" else (how.prefix, how.suffix, how.middle)
    out = Builder()
    for mark in marks:
        out.add(mark.encode())
        out.move(frames, *parts[mark])
    return form, a_chars, b_chars - a_chars, out.done()


def find_marks(output: Frames, marks: tuple[bytes, ...]) -> dict[bytes, int]:
    """Where each mark begins in a transformed text, found while streaming over its frames."""
    longest = max(map(len, marks))
    found: dict[bytes, int] = {}
    tail, at = b"", 0
    for frame in range(len(output)):
        window = tail + output.text(frame)
        for mark in marks:
            if mark not in found and (i := window.find(mark)) >= 0:
                found[mark] = at + i
        tail = window[max(0, len(window) - longest + 1) :]
        at += len(window) - len(tail)
    return found


def restore(form: str, output: Frames, how: FillIn) -> Iterator[bytes]:
    """The bytes of the original text, from the transformed one and its form alone."""
    if form == "plain":
        yield from output.span(0, output.size())
        return
    found = find_marks(output, how.marks)
    begins = sorted(found.values())
    ends = dict(zip(begins, [*begins[1:], output.size()]))
    prefix, suffix, middle = how.marks
    for mark in (prefix, middle, suffix):
        yield from output.span(found[mark] + len(mark), ends[found[mark]])


def _sha256(parts: Iterable[bytes]) -> str:
    digest = hashlib.sha256()
    for part in parts:
        digest.update(part)
    return digest.hexdigest()


# ---- tables


def store_frames(docs: DataFrame, how: FillIn = FillIn()) -> DataFrame:
    """doc_id, n (lines), marked (a mark occurs in the text), payload, ends: the texts as frames.

    ``payload`` is a valid zstandard stream of the text in UTF-8. A null text is empty and has no frame. Rows stay what
    they are: null and repeated ids, and repeated rows, are documents of their own. Other columns are ignored.
    """

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for text in batch.column("text").cast(pa.binary()):
            own = text.as_py() or b""
            marked = any(mark in own for mark in how.marks)
            rows.append((line_count(own), marked, *Frames.of(chunks(own, how.frame_bytes)).packed()))
        yield _batch(batch.column("doc_id"), rows, STORED)

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, STORED)


def _batch(doc_ids: pa.Array, rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    names, types = zip(*(field.split() for field in schema.split(", ")))
    columns = zip(*rows) if rows else [()] * (len(names) - 1)
    arrays = [pa.array(c, kinds[t]) for c, t in zip(columns, types[1:])]
    return pa.RecordBatch.from_arrays([doc_ids, *arrays], list(names))


def _filled(batch: pa.RecordBatch, how: FillIn) -> Iterator[tuple[int, str, int | None, int | None, Frames]]:
    for doc_id, n, marked, payload, ends in zip(*(batch.column(i).to_pylist() for i in range(5))):
        yield n, *fill(doc_id, n, marked, Frames.read(payload, ends), how)


def transform(frames: DataFrame, how: FillIn = FillIn()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, payload, ends: the transformed texts, again as frames.

    Cuts fall between lines. A text that is empty or holds one of the marks stays plain, as does a share of
    100 - ``how.rate`` percent; its ``prefix_chars`` and ``middle_chars`` are null.
    """

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = [(n, form, a, b, *out.packed()) for n, form, a, b, out in _filled(batch, how)]
        yield _batch(batch.column("doc_id"), rows, FILLED)

    return map_batches(frames, run, FILLED)


def texts(filled: DataFrame) -> DataFrame:
    """doc_id, form, output: the transformed texts as strings."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        each = map(Frames.read, *(batch.column(c).to_pylist() for c in ("payload", "ends")))
        out = [b"".join(f.span(0, f.size())).decode() for f in each]
        columns = [batch.column("doc_id"), batch.column("form"), pa.array(out, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "form", "output"])

    own = filled.select("doc_id", "form", "payload", "ends")
    return map_batches(own, run, "doc_id long, form string, output string")


def digests(frames: DataFrame, how: FillIn = FillIn()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, and SHA-256 of the transformed text and of the one restored from
    it, both streamed over the frames of :func:`transform`, which never leave the task."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for n, form, a, b, out in _filled(batch, how):
            rows.append((n, form, a, b, _sha256(out.span(0, out.size())), _sha256(restore(form, out, how))))
        yield _batch(batch.column("doc_id"), rows, DIGESTS)

    return map_batches(frames, run, DIGESTS)


def fill_in_digests(docs: DataFrame, how: FillIn = FillIn()) -> DataFrame:
    """:func:`digests` of the texts of ``docs``, by way of a stored table of frames."""
    return digests(stored(store_frames(docs, how), "text-frames"), how)


DIGESTS_SQL = f"""
WITH lines AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
         sha256('{FillIn().seed}' || doc_id) AS h
  FROM documents),
drawn AS (
  SELECT doc_id, text, u, len(u)::BIGINT AS n,
         ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
         ('0x' || h[17:24])::BIGINT % 100 AS cut, ('0x' || h[25:32])::BIGINT % 100 AS turned
  FROM lines),
formed AS (
  SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
              OR cut >= {FillIn().rate} THEN 'plain' WHEN turned < {FillIn().spm} THEN 'spm' ELSE 'psm' END AS form,
         coalesce(array_to_string(u[1:least(a, b)], ''), '') AS prefix,
         coalesce(array_to_string(u[least(a, b) + 1:greatest(a, b)], ''), '') AS middle,
         coalesce(array_to_string(u[greatest(a, b) + 1:], ''), '') AS suffix
  FROM drawn)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM formed
"""
