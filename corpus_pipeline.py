"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes the rows that the one before kept, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import decontaminate, language, line_dedup, near_dedup, packing
from faultline.llm.common import documents, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that some language's model accepts; the models are fitted on the labelled ones."""
    return language.keep_known(docs, language.fit_model(docs))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that much of their source repeats; ``n_chars`` follows the text.

    Copies are still in: a text must not lose its lines to its own copies, so no line goes from all pages.
    """
    kept = line_dedup.drop_boilerplate(docs, line_dedup.Boilerplate(spare=True)).drop("n_lines", "n_dropped")
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest doc_id."""
    return near_dedup.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaking(docs, documents(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two lengths, with their ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("lines", without_boilerplate),
    ("near_duplicates", one_of_each),
    ("benchmark", without_benchmark),
    ("packing", packed),
]

#: SQL can express neither the language models nor the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is stored before the next reads it."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
