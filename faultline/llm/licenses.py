"""Licence notices, found by a positional index of the templates' rarest words.

Every template is a run of words, some of which are mandatory key phrases. A file's licence words are kept with their
positions. A template is looked up by its key words from the rarest on (by document frequency over all files): a word
at a position implies where the template would begin, and only begins that all key words agree on stay. All of it is
array functions on single rows; nothing but the few document frequencies is shuffled.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import fresh, lower_ascii, stored

#: Words of a text before A-Z are lower-cased; lower-casing changes no word's borders.
WORDS = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


@dataclass(frozen=True)
class Template:
    """``key``: phrases of ``text`` that must all be there, at their places; none given: the whole text."""

    label: str
    text: str
    key: tuple[str, ...] = ()
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_offsets(self) -> list[int]:
        words, out = self.words, set()
        for phrase in self.key or (self.text,):
            own = phrase.split()
            at = next(i for i in range(len(words)) if words[i : i + len(own)] == own)
            out |= set(range(at, at + len(own)))
        return sorted(out)


# Wording of the notices.
BASE = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
)
NOTICES = (
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        ("permission is hereby granted free of charge", "deal in the software without restriction"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        ("permission to use copy modify", "with or without fee is hereby granted"),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        ("redistribution and use in source and binary forms", "are permitted provided that"),
    ),
    Template("gpl-2", "gnu general public license version 2"),
    Template("gpl-3", "gnu general public license version 3"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl-3", "gnu affero general public license version 3"),
    Template("mpl-2", "mozilla public license version 2"),
    Template("apache-2", "licensed under the apache license version 2 0", ("apache license version 2",)),
    Template("cc-by-sa", "cc by sa"),
    Template("cc0", "creative commons cc0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    Template("proprietary", "all rights reserved"),
)


def vocabulary(templates: tuple[Template, ...]) -> list[str]:
    return sorted({w for t in templates for w in t.words})


def licence_words(files: DataFrame, templates: tuple[Template, ...], text: str, n_words: str, hits: str) -> DataFrame:
    """The files without their texts, with the number of words, and ``hits``: position and word of the licence words."""
    words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORDS), F.lit(0))
    known = vocabulary(templates)
    placed = F.transform(words, lambda w, i: F.struct(i.alias("at"), w.alias("word")))
    # lower() is quick, but also maps letters beyond A-Z; the exact mapping is left to the few hits
    near = F.filter(placed, lambda x: F.lower(x["word"]).isin(known))
    exact = F.transform(near, lambda x: F.struct(x["at"].alias("at"), lower_ascii(x["word"]).alias("word")))
    return files.select(
        *[F.col(f"`{c}`") for c in files.columns if c != text],
        F.size(words).cast("long").alias(n_words),
        F.filter(exact, lambda x: x["word"].isin(known)).alias(hits),
    )


def document_frequencies(found: DataFrame, hits: str) -> dict[str, int]:
    """In how many files each licence word is; at most as many entries as the templates have words."""
    words = found.select(F.explode(F.array_distinct(F.col(f"{hits}.word"))).alias("word"))
    return {r["word"]: r["n"] for r in words.groupBy("word").agg(F.count("*").alias("n")).collect()}


def _index(templates: tuple[Template, ...], frequency: dict[str, int]) -> Column:
    """The templates as one constant: key words from the rarest on, and all words, each with its place."""
    rows = []
    for i, t in enumerate(templates):
        words, key = t.words, t.key_offsets
        order = sorted(key, key=lambda at: (frequency.get(words[at], 0), at))
        rows.append(
            {
                "no": i,
                "key": [{"word": words[at], "at": at} for at in order],
                "all": [{"word": w, "at": at} for at, w in enumerate(words)],
            }
        )
    place = "array<struct<word:string,at:int>>"
    return F.from_json(F.lit(json.dumps(rows)), f"array<struct<no:int,key:{place},all:{place}>>")


def _begins(hits: Column, place: Column) -> Column:
    """Where a template would begin, by the places of one of its words."""
    return F.transform(F.filter(hits, lambda h: h["word"] == place["word"]), lambda h: h["at"] - place["at"])


def scan(files: DataFrame, templates: tuple[Template, ...] = BASE + NOTICES, text: str = "text") -> DataFrame:
    """The rows of ``files`` without the text, with ``n_words`` and ``notices``: array of (label, base, begins, coverage).

    ``begins`` are the word positions at which all key phrases of a template stand; ``coverage`` is the share of the
    template's words that stand in place for one of them. Words are runs of letters, digits and all characters beyond
    ASCII; A-Z is lower-cased. A null text counts as empty: no words, no notices. Rows are looked at one by one, so
    repeated rows, and null or repeated keys, come back as they are. Columns named n_words or notices are replaced.
    """
    own = files.drop("n_words", "notices")
    (hits,) = fresh(own, "hits")
    found = stored(licence_words(own, templates, text, "n_words", hits), "licence-words")
    index = _index(templates, document_frequencies(found, hits))
    h = F.col(hits)

    def notice(t: Column) -> Column:
        agreed = F.aggregate(
            F.slice(t["key"], F.lit(2), F.size(t["key"])),
            _begins(h, F.element_at(t["key"], 1)),
            lambda acc, place: F.when(F.size(acc) == 0, acc).otherwise(F.array_intersect(acc, _begins(h, place))),
        )
        return F.struct(t["no"].alias("no"), agreed.alias("begins"), t["all"].alias("all"))

    def covered(n: Column) -> Column:
        in_place = F.filter(n["all"], lambda p: F.arrays_overlap(n["begins"], _begins(h, p)))
        label = F.element_at(F.lit([t.label for t in templates]), n["no"] + 1)
        base = F.element_at(F.lit([t.base for t in templates]), n["no"] + 1)
        return F.struct(
            label.alias("label"),
            base.alias("base"),
            n["begins"].alias("begins"),
            (F.size(in_place) / F.size(n["all"])).alias("coverage"),
        )

    notices = F.transform(F.filter(F.transform(index, notice), lambda n: F.size(n["begins"]) > 0), covered)
    empty = F.from_json(F.lit("[]"), "array<struct<label:string,base:boolean,begins:array<int>,coverage:double>>")
    return found.withColumn("notices", F.when(F.size(h) == 0, empty).otherwise(notices)).drop(hits)


def summary(scanned: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of scanned documents."""
    base = F.filter("notices", lambda n: n["base"])
    begins = F.flatten(F.transform(base, lambda n: n["begins"]))
    labels = lambda notices: F.array_join(
        F.array_sort(F.array_distinct(F.transform(notices, lambda n: n["label"]))), ","
    )
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(begins).cast("long").alias("n_base"),
        F.array_min(begins).cast("long").alias("first_word"),
        F.array_max(begins).cast("long").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("notices")).alias("labels"),
        F.coalesce(F.array_max(F.transform("notices", lambda n: n["coverage"])), F.lit(0.0)).alias("score"),
    )


def _template_rows(templates: tuple[Template, ...]) -> str:
    return ", ".join(
        f"({i}, '{t.label}', {t.base}, {at}, '{w}', {at in t.key_offsets})"
        for i, t in enumerate(templates)
        for at, w in enumerate(t.words)
    )


SUMMARY_SQL = f"""
WITH template(no, label, base, off, word, is_key) AS (VALUES {_template_rows(BASE + NOTICES)}),
sizes AS (SELECT no, count(*) AS n, count(*) FILTER (WHERE is_key) AS n_key FROM template GROUP BY no),
split AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos FROM split),
hits AS (
  SELECT doc_id, no, label, base, pos - off AS start, off, is_key FROM placed JOIN template USING (word)),
begins AS (
  SELECT doc_id, no, start FROM hits JOIN sizes USING (no)
  GROUP BY doc_id, no, start, n_key HAVING count(*) FILTER (WHERE is_key) = n_key),
notices AS (
  SELECT h.doc_id, h.no, any_value(label) AS label, any_value(base) AS base, count(DISTINCT h.start) AS n_begins,
         min(h.start) AS first_start, max(h.start) AS last_start, count(DISTINCT off) / any_value(n)::DOUBLE AS coverage
  FROM hits h JOIN begins b ON h.doc_id = b.doc_id AND h.no = b.no AND h.start = b.start JOIN sizes s ON s.no = h.no
  GROUP BY h.doc_id, h.no)
SELECT split.doc_id, len(words)::BIGINT AS n_words,
       coalesce(sum(n_begins) FILTER (WHERE base), 0)::BIGINT AS n_base,
       (min(first_start) FILTER (WHERE base))::BIGINT AS first_word,
       (max(last_start) FILTER (WHERE base))::BIGINT AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
       coalesce(max(coverage), 0.0)::DOUBLE AS score
FROM split LEFT JOIN notices ON notices.doc_id = split.doc_id
GROUP BY split.doc_id, words
"""
