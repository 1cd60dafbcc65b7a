"""Small document tables with every odd case, and brute-force answers."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("n", "key", "cls", "row", "gone", "site", "spans", "twin", "hits", "dropped", "digest", "n_words", "bucket")


def table(spark, rows, clash=True):
    """Rows of (doc_id, text[, lang[, source]]), with further columns named like those the operators make."""
    full = [(r + (None, None, None))[:4] + (len(r[1]) if r[1] is not None else None,) for r in map(tuple, rows)]
    out = spark.createDataFrame(full, SCHEMA)
    return out.withColumns({c: F.lit("other") for c in CLASH}) if clash else out


def prose(seed, words, vocabulary=400):
    dice = random.Random(seed)
    return " ".join(f"w{dice.randrange(vocabulary)}" for _ in range(words))


def odd_texts():
    """Null, empty, blank, tiny, long, repeated and unusual texts."""
    long = prose(1, 30_000)
    return [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "one"),
        (5, "One"),
        (6, "a b 　 c\x1cd"),
        (7, "naïve Straße İK ß"),
        (8, long),
        (9, long.upper()),
        (10, "x" * 300_000),
        (11, "same line\nsame line\n\nsame line"),
        (12, "same line\nsame line\n\nsame line"),
        (12, "same line\nsame line\n\nsame line"),
        (12, "another text under the id"),
        (None, "no id"),
        (None, "no id"),
        (None, None),
        (13, "😀 漢字 <|endoftext|> <|im_end|>"),
        (14, "a " * 5000),
    ]


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def words_of(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
