"""Byte-level BPE by speculation and verification.

Greedy longest match proposes the tokens of all new words of a batch at once. A proposal is the right encoding if and
only if every adjacent pair of its tokens is compatible, that is, if merging the two tokens' bytes alone would give
these two tokens again; vectorised checks walk down both merge trees of all distinct pairs together and look for a merge
that would have crossed the border. Only words with an incompatible pair undergo exact merging, one by one.

Why adjacent pairs suffice: merges are applied by rank, so what happens left and right of a border is independent as
long as no merge crosses it, and whether one does depends on the two tokens at the border only.
"""

from __future__ import annotations

import hashlib
import json
from codecs import getincrementaldecoder
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from itertools import chain, count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import map_batches

#: Fixed value: the byte-level pre-tokenizer's pattern.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_CHARS = 4 << 20
CUT_CHARS = 1 << 18
GROUP_CHARS = 1 << 21
GROUP_IDS = 1 << 18
LONG_WORD = 256
NO_MERGE = 1 << 30
END = 256  # stands behind each word, and continues no token

_WHITE_AFTER = regex.compile(r"(?<=\S)\s")


def byte_letters() -> list[str]:
    """The character that stands for each byte in the vocabulary: itself if printable, else one from 256 on."""
    spare = count(256)
    return [chr(b) if 33 <= b < 127 or 161 <= b < 173 or b >= 174 else chr(next(spare)) for b in range(256)]


class Merges:
    """The vocabulary as arrays: tokens' bytes, the two halves and the rank of each, and the merges by pair."""

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[bytes, bytes]]) -> None:
        n = max(vocabulary.values()) + 1
        self.bytes: list[bytes] = [b""] * n
        for token, i in vocabulary.items():
            self.bytes[i] = token
        self.byte_id = np.array([vocabulary.get(bytes([b]), -1) for b in range(256)])
        if (self.byte_id < 0).any():
            raise ValueError("a byte has no token")
        # a byte was there before any merge: rank -1, no halves
        self.rank, self.left, self.right = (np.full(n, -1, np.int64) for _ in range(3))
        self.pairs: dict[tuple[int, int], int] = {}
        for r, (a, b) in enumerate(merges):
            one, two, whole = vocabulary[a], vocabulary[b], vocabulary[a + b]
            if self.rank[whole] >= 0 or len(a + b) < 2:
                raise ValueError("each token must come from one merge")
            self.rank[whole], self.left[whole], self.right[whole] = r, one, two
            if any(len(half) > 1 and not 0 <= self.rank[vocabulary[half]] < r for half in (a, b)):
                raise ValueError("a merge must come after those that make its halves")
            self.pairs[one, two] = whole
        self.n = n
        keys = np.array([a * n + b for a, b in self.pairs], np.int64)
        wholes = np.array(list(self.pairs.values()), np.int64)
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.pair_rank = np.append(self.rank[wholes[order]], -1)
        self.made = np.zeros(len(merges) + 1, np.int64)
        self.made[self.rank[wholes]] = wholes

    def crossing(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair, NO_MERGE where there is none."""
        keys = a * self.n + b
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_rank[at], NO_MERGE)

    def compatible(self, a: np.ndarray, b: np.ndarray, joined: bool = False) -> np.ndarray:
        """Whether the bytes of a and b together are encoded as a, b. With ``joined``, up to the merge of the two.

        Goes back in time: of the two tokens at the border, the one made later is replaced by its half at the border.
        A crossing merge would have happened if it came before the halves were used up: before the left one was, or
        not after the right one was, as equal merges happen from left to right.
        """
        ok = np.ones(len(a), bool)
        left_until = np.full(len(a), NO_MERGE)
        right_until = np.full(len(a), NO_MERGE)
        open_ = np.arange(len(a))
        a, b = a.copy(), b.copy()
        first = joined
        while len(open_):
            x, y = a[open_], b[open_]
            if not first:
                r = self.crossing(x, y)
                crossed = (r < left_until[open_]) & (r <= right_until[open_])
                ok[open_[crossed]] = False
                open_, x, y = open_[~crossed], x[~crossed], y[~crossed]
            first = False
            by_left = (self.rank[x] >= self.rank[y]) & (self.rank[x] >= 0)
            by_right = ~by_left & (self.rank[y] >= 0)
            i, j = open_[by_left], open_[by_right]
            left_until[i], a[i] = self.rank[x[by_left]], self.right[x[by_left]]
            right_until[j], b[j] = self.rank[y[by_right]], self.left[y[by_right]]
            open_ = open_[by_left | by_right]
        return ok

    def merge_all(self, words: list[bytes]) -> list[np.ndarray]:
        """The exact encoding of each word: the merge of the lowest rank first, one in every word at a time."""
        ids = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        rank = np.full(len(ids), NO_MERGE)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner] = self.crossing(ids[inner], ids[inner + 1])
        done = []
        while len(ids):
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lowest = np.minimum.reduceat((rank << 32) | np.arange(len(ids)), first)
            open_ = lowest < NO_MERGE << 32
            at = lowest[open_] & ((1 << 32) - 1)
            ids[at] = self.made[lowest[open_] >> 32]
            stay = np.repeat(open_, np.diff(np.append(first, len(ids))))
            done.append((word[~stay], ids[~stay]))
            stay[at + 1] = False  # gone into the token before it
            at = np.cumsum(stay)[at] - 1
            ids, word, rank = ids[stay], word[stay], rank[stay]
            rank[at] = NO_MERGE
            near = np.unique(np.concatenate([at, at - 1]))
            near = near[(near >= 0) & (near + 1 < len(ids))]
            near = near[word[near] == word[near + 1]]
            rank[near] = self.crossing(ids[near], ids[near + 1])
        word, ids = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return np.split(ids[order], np.searchsorted(word[order], np.arange(1, len(words))))

    def merge(self, word: bytes) -> list[int]:
        """The same for one long word, with a heap of the merges that wait."""
        ids = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        rank, pairs = self.rank, self.pairs
        waiting = [(int(rank[w]), i, w) for i, p in enumerate(zip(ids, ids[1:])) if (w := pairs.get(p)) is not None]
        heapify(waiting)
        n = len(ids)
        while waiting:
            _, i, whole = heappop(waiting)
            j = after[i]
            if ids[i] < 0 or j >= n or pairs.get((ids[i], ids[j])) != whole:
                continue  # one of the two has gone into another token since
            ids[i], ids[j], after[i] = whole, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for k, m in ((before[i], i), (i, after[i])):
                if k >= 0 and m < n and (w := pairs.get((ids[k], ids[m]))) is not None:
                    heappush(waiting, (int(rank[w]), k, w))
        return [i for i in ids if i >= 0]


class Trie:
    """All given tokens, as sorted edges (node, byte) -> node; walked from every place of a text at once."""

    def __init__(self, tokens: dict[bytes, int]) -> None:
        nodes: dict[tuple[int, int], int] = {}
        ends: dict[int, int] = {}
        for token, i in tokens.items():
            node = 0
            for byte in token:
                node = nodes.setdefault((node, byte), len(nodes) + 1)
            ends[node] = i
        keys = np.array([a * (END + 1) + b for a, b in nodes], np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.to = np.append(np.array(list(nodes.values()), np.int64)[order], 0)
        self.token = np.full(len(nodes) + 1, -1, np.int64)
        self.token[list(ends)] = list(ends.values())

    def longest(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every place, the longest token that begins there, and its length; (-1, 1) at an END."""
        best, length = np.full(len(codes), -1, np.int64), np.ones(len(codes), np.int64)
        padded = np.append(codes, END)
        at, depth = np.flatnonzero(codes != END), 0
        node = np.zeros(len(at), np.int64)
        while len(at):
            keys = node * (END + 1) + padded[at + depth]
            found = np.searchsorted(self.keys, keys)
            hit = self.keys[found] == keys
            at, node = at[hit], self.to[found[hit]]
            depth += 1
            token = self.token[node]
            whole = token >= 0
            best[at[whole]], length[at[whole]] = token[whole], depth
        return best, length


class Speculator:
    """Encodes words: proposals by :class:`Trie`, verdicts by :class:`Merges`."""

    def __init__(self, merges: Merges) -> None:
        self.merges = merges
        made = np.flatnonzero(merges.rank >= 0)
        # a token that its own bytes would not give can stand in no encoding, so it is never proposed
        own = merges.compatible(merges.left[made], merges.right[made], joined=True)
        usable = np.concatenate([merges.byte_id, made[own]]).tolist()
        self.trie = Trie({merges.bytes[i]: i for i in usable})
        self.failed = self.seen = 0

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word."""
        if not words:
            return []
        codes = np.frombuffer(b"\0".join(words) + b"\0", np.uint8).astype(np.int16)
        sizes = np.array([len(w) for w in words])
        ends = np.cumsum(sizes + 1) - 1
        codes[ends] = END
        best, length = self.trie.longest(codes)
        # the places that proposals begin at: all that can be reached from the words' starts, in doubling steps
        begins = np.zeros(len(codes) + 1, bool)
        begins[np.append(0, ends[:-1] + 1)] = True
        step = np.append(np.arange(len(codes)) + length, len(codes))
        step[ends] = ends  # a word's end leads nowhere
        while True:
            more = step[np.flatnonzero(begins)]
            if begins[more].all():
                break
            begins[more] = True
            step = step[step]
        begins[-1] = False
        begins[ends] = False
        place = np.flatnonzero(begins)
        ids = best[place]
        word = np.searchsorted(ends, place)
        inner = np.flatnonzero(word[1:] == word[:-1])
        keys, back = np.unique(ids[inner] * self.merges.n + ids[inner + 1], return_inverse=True)
        ok = self.merges.compatible(*np.divmod(keys, self.merges.n))[back]
        failing = np.unique(word[inner[~ok]])
        out = np.split(ids, np.searchsorted(word, np.arange(1, len(words))))
        long = sizes[failing] > LONG_WORD
        for w in failing[long].tolist():
            out[w] = np.array(self.merges.merge(words[w]), np.int64)
        short = failing[~long].tolist()
        for w, exact in zip(short, self.merges.merge_all([words[w] for w in short]) if short else ()):
            out[w] = exact
        self.seen += len(words)
        self.failed += len(failing)
        return out


class Codec:
    """Encoder and decoder of one tokenizer file, with the ids of the words seen lately."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        model, before = stated["model"], stated["pre_tokenizer"]
        plain = model["type"] == "BPE" and not any(
            model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        )
        split = before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
        added = stated["added_tokens"]
        simple = not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip"))
        if not (plain and split and simple) or stated["normalizer"] or stated["decoder"]["type"] != "ByteLevel":
            raise ValueError(f"not a plain byte-level BPE: {path}")
        byte = {c: b for b, c in enumerate(byte_letters())}
        self.special = {t["content"]: t["id"] for t in added}
        vocabulary = {
            bytes(byte[c] for c in k): v for k, v in model["vocab"].items() if k not in self.special
        }
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        merges = [tuple(bytes(byte[c] for c in half) for half in p) for p in pairs]
        self.speculator = Speculator(Merges(vocabulary, merges))
        by_id = {**dict(enumerate(self.speculator.merges.bytes)), **{i: t.encode() for t, i in self.special.items()}}
        self.token_bytes = [by_id[i] for i in range(max(by_id) + 1)]
        self.words = regex.compile(WORDS).findall
        longest_first = sorted(self.special, key=len, reverse=True)
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if added else None
        self.known: dict[str, bytes] = {}
        self.chars = 0

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit numbers."""
        out: list[list[bytes]] = [[] for _ in texts]
        for some in self.groups(texts):
            self.learn(set(chain.from_iterable(words for _, words in some)))
            for row, words in some:
                out[row].append(b"".join(map(self.known.__getitem__, words)))
        return [b"".join(parts) for parts in out]

    def groups(self, texts: list[str]) -> Iterator[list[tuple[int, list[str]]]]:
        """The words of all texts, in groups of bounded size."""
        some, chars = [], 0
        for row, text in enumerate(texts):
            for words, size in self.units(text):
                some.append((row, words))
                chars += size
                if chars >= GROUP_CHARS:
                    yield some
                    some, chars = [], 0
        yield some

    def learn(self, words: set[str]) -> None:
        if self.chars > CACHE_CHARS:
            self.known, self.chars = {}, 0
        new = words.difference(self.known)
        special = {t: np.array([i]) for t, i in self.special.items() if t in new}
        plain = [w for w in new if w not in special]
        found = chain(special.items(), zip(plain, self.speculator.encode([w.encode() for w in plain])))
        self.known.update((word, ids.astype("<u4").tobytes()) for word, ids in found)
        self.chars += sum(map(len, new))

    def units(self, text: str) -> Iterator[tuple[list[str], int]]:
        """The words of a text, part by part, with the part's size; a special token is a word of its own."""
        pieces = self.at_special.split(text) if self.at_special and self.at_special.search(text) else [text]
        for i, piece in enumerate(pieces):
            if i % 2:
                yield [piece], len(piece)
            else:
                yield from ((self.words(part), len(part)) for part in cut(piece))

    def decode(self, ids: np.ndarray) -> Iterator[str]:
        """The text of some ids, in parts. Bytes that are no UTF-8 become U+FFFD; ids that name no token are passed
        over."""
        text = getincrementaldecoder("utf-8")(errors="replace")
        known = ids[ids < len(self.token_bytes)]
        for at in range(0, len(known), GROUP_IDS):
            yield text.decode(b"".join(map(self.token_bytes.__getitem__, known[at : at + GROUP_IDS].tolist())))
        yield text.decode(b"", final=True)


def cut(text: str) -> Iterator[str]:
    """A long text in parts whose words are those of the whole: cut before white space behind another character, where
    every word ends."""
    begin = 0
    while len(text) - begin > CUT_CHARS:
        found = _WHITE_AFTER.search(text, begin + CUT_CHARS)
        if not found:
            break
        yield text[begin : found.start()]
        begin = found.start()
    yield text[begin:]


@cache
def codec(path: str) -> Codec:
    """The codec of this Python worker, kept between tasks."""
    return Codec(path)


@cache
def decimals(path: str) -> list[str]:
    return [str(i) for i in range(len(codec(path).token_bytes))]


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [text or "" for text in batch.column("text").to_pylist()]


def _own(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids (array of int): the texts' ids, without special ones added.

    They equal those of the ``tokenizers`` library; a special token's string in a text becomes its id. A null text is
    empty and has no ids. Rows stay what they are: null and repeated ids, and repeated rows, are documents of their
    own. Other columns are ignored. Nothing is shuffled.
    """

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        each = codec(tokenizer).encode(_texts(batch))
        sizes = np.array([len(x) // 4 for x in each], np.int64)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        flat = pa.array(np.frombuffer(b"".join(each), "<i4"), pa.int32())
        columns = [batch.column("doc_id"), pa.array(sizes), pa.ListArray.from_arrays(offsets, flat)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids"])

    return map_batches(_own(docs), run, "doc_id long, n_tokens long, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, text of rows of ids; null ids give an empty text."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer).decode
        out = ["".join(own(np.array(x or [], np.uint32))) for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def _listed(ids: np.ndarray, names: list[str]) -> Iterator[str]:
    """Decimal ids joined by commas, in parts."""
    for at in range(0, len(ids), GROUP_IDS):
        yield "," * (at > 0) + ",".join(map(names.__getitem__, ids[at : at + GROUP_IDS].tolist()))


def _sha256(parts: Iterator[str]) -> str:
    digest = hashlib.sha256()
    for part in parts:
        digest.update(part.encode())
    return digest.hexdigest()


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids, joined by commas), decoded_sha256: what :func:`encode` and then
    :func:`decode` give, as digests made in the task that encodes."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own, names = codec(tokenizer), decimals(tokenizer)
        each = [np.frombuffer(packed, "<u4") for packed in own.encode(_texts(batch))]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(ids) for ids in each], pa.int64()),
                pa.array([_sha256(_listed(ids, names)) for ids in each], pa.string()),
                pa.array([_sha256(own.decode(ids)) for ids in each], pa.string()),
            ],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return map_batches(_own(docs), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
