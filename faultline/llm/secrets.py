"""Secrets: fixed patterns, and literals that source or configuration assigns to sensitive names.

The lexer looks at every assignment operator, reads the name before it and the value behind it, and remembers what
each name holds. A value that is itself a known name stands for that name's literal (constants are propagated, through
chains too), so ``k = "..."`` and later ``api_key = k`` reports the literal in the first line. A literal's score is
how sensitive the name is times how much the literal looks like a secret.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import map_batches

KINDS = ("assign", "access", "hex", "named")

# The base patterns.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # longest runs: the same spans as [0-9a-f]+ with 32 characters or more
_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

_OPERATOR = re.compile(r"(:=|=>|==|[!<>+*/|&^%-]=|=|:)[ \t]*")
_NAME = re.compile(r"""([A-Za-z_][A-Za-z0-9_.-]*)["']?\]?[ \t]*\Z""")
_VALUE = re.compile(r""""((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|([^\s"',;(){}\[\]<>]+)""")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_PLAIN = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*\Z")
_SAMPLE = re.compile(r"(?i)x{4,}|\*{3,}|\.{3,}|your|example|change.?me|placeholder|dummy|\$\{|\{\{|<")


@dataclass(frozen=True)
class Names:
    """How sensitive a name is, by the words in it; pairs of words count before single ones."""

    words: dict[str, float] = field(
        default_factory=lambda: {
            "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.7, "secret": 1.0,
            "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "auth": 0.6,
        }
    )
    pairs: dict[tuple[str, str], float] = field(
        default_factory=lambda: {
            ("api", "key"): 1.0, ("access", "key"): 1.0, ("private", "key"): 1.0, ("secret", "key"): 1.0,
            ("encryption", "key"): 1.0, ("signing", "key"): 1.0, ("auth", "key"): 0.9, ("account", "key"): 0.9,
        }
    )
    longest: int = 128

    def score(self, name: str) -> float:
        words = [w.lower() for w in _WORD.findall(name[-self.longest :])]
        pairs = [self.pairs.get(p, 0.0) for p in zip(words, words[1:])]
        return max([0.0, *pairs, *(self.words.get(w, 0.0) for w in words)])


def literal_score(literal: str) -> float:
    """0 to 1: short, repetitive and placeholder literals score low, long ones of several kinds of characters high."""
    if len(literal) < 6 or _SAMPLE.search(literal) or any(c.isspace() for c in literal):
        return 0.0
    counts = Counter(literal)
    entropy = -sum(n / len(literal) * math.log2(n / len(literal)) for n in counts.values())
    kinds = sum(any(map(test, counts)) for test in (str.islower, str.isupper, str.isdigit))
    kinds += any(not c.isalnum() for c in counts)
    return min(1.0, entropy / 3.0) * min(1.0, 0.4 + 0.2 * kinds)


def assignments(text: str, longest: int = 128) -> Iterator[tuple[str, str, int, int, bool]]:
    """Every assignment: name, value, where the value begins and ends, and whether it was quoted."""
    if "=" not in text and ":" not in text:
        return
    for operator in _OPERATOR.finditer(text):
        if operator[1] not in ("=", ":", ":=", "=>"):
            continue
        name = _NAME.search(text[max(0, operator.start() - longest - 3) : operator.start()])
        value = name and _VALUE.match(text, operator.end())
        if value:
            group = value.lastindex
            yield name[1], value[group], value.start(group), value.end(group), group < 3


def named_literals(text: str, names: Names, least: float) -> list[tuple[int, int, float]]:
    """Begin, end and score of the literals that sensitive names hold, directly or through other names."""
    held: dict[str, tuple[str, int, int]] = {}
    out: dict[tuple[int, int], float] = {}
    for name, value, start, end, quoted in assignments(text, names.longest):
        literal = (value, start, end)
        if not quoted and value in held:
            literal = held[value]
        elif not quoted and _PLAIN.match(value) and not any(map(str.isdigit, value)):
            continue  # a bare word that nothing was assigned to is no literal
        held[name] = literal
        score = names.score(name) * literal_score(literal[0])
        if score >= least:
            out[literal[1:]] = max(score, out.get(literal[1:], 0.0))
    return [(*span, score) for span, score in out.items()]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the base patterns: leftmost, not overlapping within a kind."""
    out = []
    lowered = text.lower()
    if any(hint in lowered for hint in _HINTS):
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    return out + [(*m.span(), "hex") for m in HEX.finditer(text)]


def secrets_in(text: str, names: Names = Names(), least: float = 0.5) -> list[tuple[str, int, int, float]]:
    """Kind, begin, end and score of all spans, by begin and then kind as in KINDS."""
    base = base_spans(text)
    out = [(kind, start, end, 1.0) for start, end, kind in base]
    begins = sorted((start, end) for start, end, _ in base)
    reach = list(accumulate((end for _, end in begins), max))
    for start, end, score in named_literals(text, names, least):
        before = bisect_right(begins, start, key=lambda span: span[0])
        if not before or reach[before - 1] < end:  # else it lies within a base span
            out.append(("named", start, end, score))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = "array<struct<kind:string,start:long,end:long,score:double>>"


def find_secrets(docs: DataFrame, names: Names = Names(), least: float = 0.5) -> DataFrame:
    """doc_id and ``secrets``: kind, start, end (code points, end exclusive) and score of each span, in order.

    Base spans (assign, access, hex) have the score 1; ``named`` literals that lie within a base span are not repeated,
    and those that score below ``least`` are left out. A null text is empty and has none. Rows are read one by one, so
    null or repeated ids and repeated rows come back as they are; other columns are ignored.
    """

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [
            [dict(zip(("kind", "start", "end", "score"), s)) for s in secrets_in(text or "", names, least)]
            for text in batch.column("text").to_pylist()
        ]
        kind = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
        )
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "secrets"])

    return map_batches(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, f"doc_id long, secrets {SPANS}"
    )


def span_digests(found: DataFrame) -> DataFrame:
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
    of = lambda kind: F.filter("secrets", lambda s: s["kind"] == kind)
    count = lambda kind: F.size(of(kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *map(count, KINDS),
        F.sha2(listed(F.filter("secrets", lambda s: s["kind"] != "named")), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
    )
