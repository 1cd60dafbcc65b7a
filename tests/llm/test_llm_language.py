import math
import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from llm_cases import CLASH, odd_texts, table

from faultline.llm import language
from faultline.llm.common import documents
from faultline.llm.language import Fit, characters, compile_model, cross_entropies, judge
from pyspark.sql import functions as F

TEXTS = {
    "xx": ["banana bandana nab a cab", "a banana can", "ban a band and a nab"],
    "yy": ["zuzu zip pizz zoo", "pip zoo zip", "oz zoo zuzu"],
}


def grams(text, order):
    codes = [32] * (order - 2) + characters(text).tolist()
    return ["".join(map(chr, codes[i : i + order])) for i in range(len(codes) - order + 1)]


def model_of(texts, order):
    counts = Counter((lang, g) for lang, own in texts.items() for t in own for g in grams(t, order))
    frame = pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["lang", "gram", "n"])
    return compile_model(frame, Fit(order=order))


class Reference:
    """Interpolated Kneser-Ney by the book, for one language."""

    def __init__(self, texts, order, letters):
        self.order, self.letters = order, letters
        self.tables = {order: Counter(g for t in texts for g in grams(t, order))}
        for n in range(order - 1, 0, -1):
            self.tables[n] = Counter(g[1:] for g in self.tables[n + 1])
        self.discounts = {}
        for n, table_ in self.tables.items():
            ones, twos = (sum(v == k for v in table_.values()) for k in (1, 2))
            self.discounts[n] = min(0.9, max(0.1, ones / max(ones + 2 * twos, 1)))

    def probability(self, gram):
        n = len(gram)
        lower = 1 / self.letters if n == 1 else self.probability(gram[1:])
        own = {g: c for g, c in self.tables[n].items() if g[:-1] == gram[:-1]}
        total = sum(own.values())
        if not total:
            return lower
        d = self.discounts[n]
        return max(own.get(gram, 0) - d, 0) / total + d * len(own) / total * lower


@pytest.mark.parametrize("order", [2, 3, 4])
def test_probabilities_are_kneser_neys(order):
    model = model_of(TEXTS, order)
    letters = len({c for own in TEXTS.values() for t in own for c in characters(t)}) + 1
    references = [Reference(TEXTS[name], order, letters) for name in model.languages]
    for text in ("banana zoo", "ban", "q zip ban", "nab nab"):
        codes = characters(text)
        got = language.log_probabilities(model, codes)
        whole = "".join(map(chr, codes))
        for i in range(1, len(codes)):
            gram = whole[max(0, i - order + 1) : i + 1]
            for k, reference in enumerate(references):
                want = reference.probability(gram) if len(gram) == order else None
                if want is not None:
                    assert got[i - 1, k] == pytest.approx(math.log(want), abs=1e-5)


def test_probabilities_add_up_to_one():
    model = model_of({"xx": TEXTS["xx"]}, 3)
    letters = sorted({c for t in TEXTS["xx"] for c in characters(t).tolist()})
    for context in ("ba", " a", "zz"):
        total = sum(
            math.exp(language.log_probabilities(model, np.array([*map(ord, context), c], np.uint32))[-1, 0])
            for c in [*letters, ord("q")]
        )
        assert total == pytest.approx(1.0, abs=1e-5)


def test_long_texts_are_scored_in_slices(monkeypatch):
    model = model_of(TEXTS, 4)
    text = " ".join(random.Random(1).choices(["banana", "zoo", "cab"], k=400))
    codes = characters(text)
    whole = -language.log_probabilities(model, codes).sum(0, dtype=np.float64) / (len(codes) - 1)
    n, got = next(cross_entropies(model, [text]))
    assert n == len(codes) - 1 and got == pytest.approx(whole, abs=1e-6)


def test_without_letters():
    model = model_of(TEXTS, 3)
    assert [j[0] for j in judge(model, [None, "", " 12 !", "\n", "banana"])] == ["und"] * 4 + ["xx"]
    assert list(judge(None, ["banana"])) == [("und", 0.0, True)]


def test_odd_tables(spark):
    rows = [(i, t, "xx" if i and i % 2 else None) for i, t in odd_texts()]
    df = table(spark, [(i, t, k) for i, t, k in rows])
    model = language.fit_model(df)
    out = language.predict(df, model)
    assert out.count() == len(rows) and {r.lang_pred for r in out.collect()} <= {"xx", "und"}
    kept = language.keep_known(df, model)
    assert kept.columns == df.columns and set(CLASH) <= set(kept.columns)
    assert language.predict(df.limit(0), model).count() == 0
    nothing = language.fit_model(df.withColumn("lang", F.lit(None).cast("string")))
    assert nothing is None and language.keep_known(df, nothing).count() == df.count()


def test_held_out_accuracy_and_rejection(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    held = language.held_out(F.col("doc_id"))
    model = language.fit_model(docs.filter(~held))
    found = language.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    right = defaultdict(list)
    for r in found.withColumn("held", held).collect():
        assert 0 <= r.score <= 1
        right[r.held].append(r.lang == r.lang_pred)
    assert sum(right[True]) / len(right[True]) > 0.97
    assert language.keep_known(docs, model).count() > 0.99 * docs.count()
    strange = spark.createDataFrame([(1, "xq zvk qqj wvx kzq " * 20), (2, "слово за слово " * 20)], "doc_id long, text string")
    assert all(r.rejected for r in language.predict(strange, model).collect())
