"""Benchmark items inside documents, with up to a share of edits, by the pigeonhole principle.

An item of n characters may differ by e = floor(rate * n) edits. It is split into e + 1 pieces: whatever the edits, one
piece is left whole, so it appears in the document exactly. One pass of an Aho-Corasick automaton over a document finds
all pieces of a block of items; around each hit the whole item is verified by Myers' bit-parallel edit distance. Items
are the stated query set: they go to the tasks in blocks of bounded size, however many there are.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import map_batches


@dataclass(frozen=True)
class Matching:
    """``rate``: edits allowed per character of an item. ``shortest``: items with fewer characters tell nothing and are
    left out. ``block_chars``: characters of items that are sent to the tasks at once."""

    rate: float = 0.05
    shortest: int = 20
    block_chars: int = 1 << 20


def normalised(text: str) -> str:
    """Lower-cased, with one space for each run of white space, and none at the ends."""
    return " ".join(text.lower().split())


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """edits + 1 pieces of nearly equal length, each with its place."""
    n, k = len(item), edits + 1
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(item: str, masks: dict[str, int], text: str, most: int) -> tuple[int, int] | None:
    """The fewest edits between the item and any part of the text, and where that part ends; None above ``most``.

    The columns of the distance matrix are kept as differences in the bits of two numbers.
    """
    n = len(item)
    full, last = (1 << n) - 1, 1 << (n - 1)
    up, down, distance = full, 0, n
    best = None
    for at, c in enumerate(text):
        same = masks.get(c, 0)
        x = same | down
        diagonal = (((same & up) + up) ^ up) | same
        rise = down | ~(diagonal | up)
        fall = up & diagonal
        if rise & last:
            distance += 1
        if fall & last:
            distance -= 1
        rise = (rise << 1) & full  # a part may begin anywhere: nothing is carried into the first row
        fall = (fall << 1) & full
        up = (fall | ~(x | rise)) & full
        down = rise & x
        if distance <= most and (best is None or distance < best[0]):
            best = distance, at + 1
    return best


@dataclass
class Items:
    """A block of normalised items, with what is needed to find them; built anew in each Python worker."""

    rows: list[tuple[int | None, str]]
    how: Matching

    def __getstate__(self) -> dict:
        return {"rows": self.rows, "how": self.how}

    @cached_property
    def automaton(self):
        import ahocorasick

        places = defaultdict(list)
        for no, (_, item) in enumerate(self.rows):
            for at, piece in pieces(item, self.edits(item)):
                places[piece].append((no, at))
        out = ahocorasick.Automaton()
        for piece, where in places.items():
            out.add_word(piece, (len(piece), where))
        out.make_automaton()
        return out

    @cached_property
    def masks(self) -> list[dict[str, int]]:
        out = []
        for _, item in self.rows:
            own: dict[str, int] = defaultdict(int)
            for i, c in enumerate(item):
                own[c] |= 1 << i
            out.append(dict(own))
        return out

    def edits(self, item: str) -> int:
        return int(self.how.rate * len(item))

    def leaks(self, text: str) -> list[tuple[int | None, int, int]]:
        """Item, edits and end (in the normalised text) of the best place of each item that the text holds."""
        text = normalised(text)
        tried: set[tuple[int, int]] = set()
        best: dict[int, tuple[int, int]] = {}
        for end, (length, where) in self.automaton.iter(text):
            for no, at in where:
                begin = end + 1 - length - at  # where the item would begin without edits before the piece
                if (no, begin) in tried or (no in best and best[no][0] == 0):
                    continue
                tried.add((no, begin))
                item = self.rows[no][1]
                most = self.edits(item)
                first = max(0, begin - most)
                found = myers(item, self.masks[no], text[first : begin + len(item) + most], most)
                if found and (no not in best or found[0] < best[no][0]):
                    best[no] = found[0], first + found[1]
        return [(self.rows[no][0], *best[no]) for no in sorted(best)]


def blocks(benchmark: DataFrame, how: Matching, item: str = "item_id", text: str = "text") -> Iterator[Items]:
    """The items in blocks of bounded size, read one partition at a time."""
    rows: list[tuple[int | None, str]] = []
    size = 0
    for row in benchmark.select(F.col(item).cast("long"), F.col(text).cast("string")).toLocalIterator():
        own = normalised(row[1] or "")
        if len(own) < how.shortest:
            continue
        if rows and size + len(own) > how.block_chars:
            yield Items(rows, how)
            rows, size = [], 0
        rows.append((row[0], own))
        size += len(own)
    if rows:
        yield Items(rows, how)


LEAKS = "doc_id long, item_id long, edits long, end long"


def find_leaks(docs: DataFrame, benchmark: DataFrame, how: Matching = Matching()) -> DataFrame:
    """doc_id, item_id, edits, end: one row for each document and item it holds, at its best place.

    Both texts are lower-cased and their white space made single spaces; ``end`` counts characters of that. A null or
    empty text, and an item shorter than ``how.shortest``, match nothing. Rows are read one by one: null or repeated
    ids of documents or items, and repeated rows, each give rows of their own. Without items the result is empty.
    """

    def with_block(items: Items) -> DataFrame:
        def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            found = [
                (i, *leak) for i, text in enumerate(batch.column("text").to_pylist()) for leak in items.leaks(text or "")
            ]
            if found:
                row, *columns = (pa.array(c, pa.int64()) for c in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(row), *columns], ["doc_id", "item_id", "edits", "end"]
                )

        return map_batches(rows, run, LEAKS)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    parts = [with_block(items) for items in blocks(benchmark, how)]
    return reduce(DataFrame.union, parts) if parts else docs.sparkSession.createDataFrame([], LEAKS)


def drop_leaking(docs: DataFrame, benchmark: DataFrame, how: Matching = Matching(), text: str = "text") -> DataFrame:
    """The rows that hold no item, with all their columns; each block of items filters what the last one left."""

    def without(df: DataFrame, items: Items) -> DataFrame:
        def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            clean = [not items.leaks(t or "") for t in batch.column(text).cast(pa.string()).to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

        return map_batches(df, run, df.schema)

    return reduce(without, blocks(benchmark, how), docs)
