"""Language identification by interpolated Kneser-Ney models of characters.

One model per language is fitted on a bounded sample of labelled texts. Its n-grams live in arrays sorted by hash, one
set for all languages: row i of the table holds the log-probability of the i-th n-gram in each language. A text goes to
the language with the lowest cross-entropy per character. The models' own texts, held back from the counts, calibrate
how high that may be; a text above is rejected: no learned language fits it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import map_batches, stored

if TYPE_CHECKING:
    import pandas as pd

UNKNOWN = "und"
SPACE = 32


@dataclass(frozen=True)
class Fit:
    """``rows``: labelled texts per language that are used, about; ``languages``: at most, the most frequent.
    ``entries``: n-grams of the highest order that are kept over all languages, the most frequent. ``hold``: every so
    many of the texts calibrates instead of counting. ``z``: how many deviations above its language's usual
    cross-entropy a text may lie."""

    order: int = 4
    rows: int = 2000
    languages: int = 1000
    entries: int = 1 << 20
    hold: int = 5
    z: float = 8.0


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def characters(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, with one space for each run of anything else, and at both ends."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    codes = np.where(_letters()[codes], codes, np.uint32(SPACE))
    stay = np.ones(len(codes), bool)
    stay[1:] = (codes[1:] != SPACE) | (codes[:-1] != SPACE)
    return codes[stay]


_STEP = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """The hash of each n-gram: one for each character from the n-th on."""
    out = np.zeros(max(0, len(codes) - n + 1), np.uint64)
    for i in range(n):
        out = (out + codes[i : i + len(out)] + np.uint64(1)) * _STEP
        out ^= out >> np.uint64(29)
    return out


@dataclass
class Level:
    """The n-grams of one order: sorted hashes, log-probabilities per language; sorted hashes of contexts that the next
    order knows, with their log back-off weights per language."""

    grams: np.ndarray
    logs: np.ndarray
    contexts: np.ndarray
    backoffs: np.ndarray


@dataclass
class Model:
    languages: list[str]
    order: int
    levels: list[Level]
    unseen: np.ndarray
    usual: np.ndarray  # per language: mean cross-entropy, deviation between texts, deviation of one character
    z: float


def _find(sorted_: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted hashes, and which are there."""
    if not len(sorted_):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(sorted_, wanted), len(sorted_) - 1)
    return at, sorted_[at] == wanted


def log_probabilities(model: Model, codes: np.ndarray) -> np.ndarray:
    """Log-probability of each character but the first in each language, given up to ``order - 1`` before it."""
    out = np.zeros((max(0, len(codes) - 1), len(model.languages)), np.float32)
    open_ = np.arange(1, len(codes))  # places in the text that no order has settled yet
    for n in range(model.order, 0, -1):
        level = model.levels[n - 1]
        deep = open_ >= n - 1  # characters nearer to the begin have shorter contexts
        at = open_[deep]
        hashes = gram_hashes(codes, n)
        place, found = _find(level.grams, hashes[at - n + 1])
        hit = at[found]
        out[hit - 1] += level.logs[place[found]]
        missed = at[~found]
        if n > 1 and len(missed):
            below = model.levels[n - 2]
            own, known = _find(below.contexts, gram_hashes(codes, n - 1)[missed - n + 1])
            out[missed[known] - 1] += below.backoffs[own[known]]
        open_ = np.concatenate([open_[~deep], missed]) if n > 1 else missed
    out[open_ - 1] += model.unseen
    return out


def compile_model(counts: pd.DataFrame, fit: Fit) -> Model:
    """Models from the counts of the highest n-grams: columns lang, gram (text of ``order`` characters), n.

    The highest order uses the counts; each lower one the number of different characters seen before an n-gram.
    """
    languages = sorted(counts["lang"].unique())
    width = len(languages)
    codes = {g: np.fromiter(map(ord, g), np.uint32) for g in counts["gram"].unique()}
    matrix = np.array([codes[g] for g in counts["gram"]], np.uint32).reshape(-1, fit.order)
    lang = counts["lang"].map({name: i for i, name in enumerate(languages)}).to_numpy()
    weight = counts["n"].to_numpy(np.float64)
    per_order = []
    for n in range(fit.order, 0, -1):
        per_order.append(_summed(matrix, lang, weight, width))
        keep, _ = different_rows(np.column_stack([matrix, lang]).astype(np.uint32))
        matrix, lang, weight = keep[:, 1:n], keep[:, n].astype(np.int64), np.ones(len(keep))
    letters = len(per_order[-1][0]) + 1
    lower: tuple[np.ndarray, np.ndarray] | None = None
    levels: list[Level] = []
    unseen = np.zeros(width)
    for n, (grams, table) in enumerate(reversed(per_order), start=1):
        discount = _discounts(table)
        contexts, of_gram = np.unique(_rows_hash(grams[:, : n - 1]), return_inverse=True)
        totals, kinds = np.zeros((len(contexts), width)), np.zeros((len(contexts), width))
        np.add.at(totals, of_gram, table)
        np.add.at(kinds, of_gram, table > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            left = np.where(totals > 0, discount * kinds / totals, 1.0)
            own = np.where(totals[of_gram] > 0, np.maximum(table - discount, 0) / totals[of_gram], 0.0)
        if lower is None:
            unseen = np.log(left[0] / letters)
            probability = own + left[of_gram] / letters
        else:
            place, _ = _find(lower[0], _rows_hash(grams[:, 1:]))
            probability = own + left[of_gram] * lower[1][place]
            levels[-1].contexts, levels[-1].backoffs = contexts, np.log(left).astype(np.float32)
        hashes = _rows_hash(grams)
        order = np.argsort(hashes)
        lower = hashes[order], probability[order]
        none = np.zeros(0, np.uint64), np.zeros((0, width), np.float32)
        levels.append(Level(lower[0], np.log(lower[1]).astype(np.float32), *none))
    return Model(languages, fit.order, levels, unseen.astype(np.float32), np.zeros((width, 3)), fit.z)


def _summed(matrix: np.ndarray, lang: np.ndarray, weight: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The different rows, and their weights by language."""
    rows, row = np.unique(matrix, axis=0, return_inverse=True)
    table = np.zeros((len(rows), width))
    np.add.at(table, (row.ravel(), lang), weight)
    return rows, table


def _discounts(table: np.ndarray) -> np.ndarray:
    ones, twos = (table == 1).sum(0), (table == 2).sum(0)
    return np.clip(ones / np.maximum(ones + 2 * twos, 1), 0.1, 0.9)


def _rows_hash(grams: np.ndarray) -> np.ndarray:
    out = np.zeros(len(grams), np.uint64)
    for i in range(grams.shape[1]):
        out = (out + grams[:, i] + np.uint64(1)) * _STEP
        out ^= out >> np.uint64(29)
    return out


def cross_entropies(model: Model, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
    """For each text the number of characters scored, and the cross-entropy of each language; 0 without a letter."""
    for text in texts:
        codes = characters(text or "")
        if len(codes) < 2:
            yield 0, np.zeros(len(model.languages))
            continue
        total = np.zeros(len(model.languages))
        for start in range(0, len(codes) - 1, 1 << 20):  # a slice at a time, with the context before it
            begin = max(0, start - model.order + 2)
            logs = log_probabilities(model, codes[begin : start + (1 << 20) + 1])
            total += logs[start - begin :].sum(0, dtype=np.float64)
        yield len(codes) - 1, -total / (len(codes) - 1)


def training_sample(docs: DataFrame, fit: Fit, text: str = "text", lang: str = "lang") -> DataFrame:
    """About ``fit.rows`` labelled texts of each language, picked by their hash: (lang, text, held)."""
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    picked = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) / (1 << 40)
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(fit.languages)
    shares = sizes.select("lang", (F.lit(fit.rows) / F.col("n")).alias("share"))
    chosen = rows.join(F.broadcast(shares), "lang").filter(picked < F.col("share"))  # one row per language
    held = F.pmod(F.xxhash64(F.lit(1), F.col("text")), F.lit(fit.hold)) == 0
    return chosen.select("lang", "text", held.alias("held"))


def fit_model(docs: DataFrame, fit: Fit = Fit(), text: str = "text", lang: str = "lang") -> Model | None:
    """A model from the labelled rows; None if there are none. Counting runs on Spark, over the sample's whole texts."""

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts: dict[str, list[np.ndarray]] = {}
        for name, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            if len(codes := characters(text)) > 1:
                texts.setdefault(name, []).append(_padded(codes, fit.order))
        for name, own in texts.items():
            grams, n = different_rows(
                np.concatenate([np.lib.stride_tricks.sliding_window_view(c, fit.order) for c in own])
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(n)), pa.array([array_text(g) for g in grams.tolist()]), pa.array(n)],
                ["lang", "gram", "n"],
            )

    sample = stored(training_sample(docs, fit, text, lang), "language-sample")
    counted = map_batches(sample.filter("NOT held").select("lang", "text"), count, "lang string, gram string, n long")
    sums = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = sums.orderBy(F.desc("n"), "lang", "gram").limit(fit.entries).toPandas()
    if counts.empty:
        return None
    model = compile_model(counts, fit)
    model.usual = _calibrated(model, sample)
    return model


def _padded(codes: np.ndarray, order: int) -> np.ndarray:
    return np.concatenate([np.full(order - 2, SPACE, np.uint32), codes])


def different_rows(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows of a matrix, and how often each is there."""
    rows = matrix[np.lexsort(matrix.T)]
    new = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(axis=1)))
    return rows[new], np.diff(np.append(new, len(rows)))


def array_text(codes: list[int]) -> str:
    return "".join(map(chr, codes))


def _calibrated(model: Model, sample: DataFrame) -> np.ndarray:
    """Mean and deviation of the held texts' cross-entropies, and a character's, for each language."""

    def measure(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = [
            (name, n, float(h[model.languages.index(name)]))
            for name, (n, h) in zip(
                batch.column("lang").to_pylist(), cross_entropies(model, batch.column("text").to_pylist())
            )
            if n and name in model.languages
        ]
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.float64()))]
        if rows:
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "n", "h"])

    own = map_batches(sample.filter("held").select("lang", "text"), measure, "lang string, n long, h double")
    stats = own.groupBy("lang").agg(
        (F.sum(F.col("h") * F.col("n")) / F.sum("n")).alias("mean"),
        F.expr("percentile_approx(h, 0.9) - percentile_approx(h, 0.5)").alias("spread"),
    )
    by = {r["lang"]: (r["mean"], max(r["spread"], 0.05)) for r in stats.collect()}
    # a language without held texts is never rejected
    return np.array([(*by.get(name, (0.0, np.inf)), 3.0) for name in model.languages])


def judge(model: Model | None, texts: list[str | None]) -> Iterator[tuple[str, float, bool]]:
    """Language, score from 0 to 1 and rejection of each text.

    The score is the language's share when the languages compete by cross-entropy over up to 20 characters. A text
    without a letter is ``und``, with score 0, and rejected.
    """
    if model is None:
        yield from ((UNKNOWN, 0.0, True) for _ in texts)
        return
    for n, entropy in cross_entropies(model, texts):
        if not n:
            yield UNKNOWN, 0.0, True
            continue
        best = int(np.argmin(entropy))
        mean, between, within = model.usual[best]
        share = 1.0 / np.exp((entropy[best] - entropy) * min(n, 20)).sum()
        limit = mean + model.z * (between + within / np.sqrt(n))
        yield model.languages[best], float(share), bool(entropy[best] > limit)


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, rejected of every row. Only the text is looked at, and all of it.

    A null text, or one without a letter, is ``und``, with score 0, and rejected; so is every text if nothing could be
    learned. Ties go to the first language by name. Rows are judged one by one; null or repeated ids stay as they are.
    """

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = list(judge(model, batch.column("text").to_pylist()))
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.float64(), pa.bool_()))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *arrays], ["doc_id", "lang_pred", "score", "rejected"]
        )

    return map_batches(
        docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string").alias("text")),
        run,
        "doc_id long, lang_pred string, score double, rejected boolean",
    )


def keep_known(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows that are not rejected, with all their columns.

    Without a model nothing was learned, so nothing can be rejected, and all rows stay. With one, a null text and one
    without a letter go: no language accepts them. Null and repeated ids, repeated rows and further columns stay as
    they are; rows are judged one by one, and ties between languages do not matter.
    """
    if model is None:
        return docs

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = judge(model, batch.column(text).to_pylist())
        yield batch.filter(pa.array([not rejected for _, _, rejected in rows], pa.bool_()))

    return map_batches(docs, run, docs.schema)


def held_out(doc_id: Column) -> Column:
    """The documents that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
