"""Canonical names and types as native expressions: no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions import rules
from faultline.functions.text import SPACE, unicode_pattern


def quoted(value: str) -> str:
    """A text as an SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def key_sql(text: str, cfg: rules.NameRules) -> str:
    """The corrected text without separators, noise words and spaces, as SQL over a column.

    One pattern removes all three: separators and spaces are no word characters, so a noise
    word has the same boundaries whether or not they are still there.
    """
    for typo, fix in cfg.typos:
        text = f"replace({text}, {quoted(typo)}, {quoted(fix)})"
    removed = quoted(unicode_pattern(f"{cfg.separators}|{SPACE}|{cfg.noise}"))
    return f"regexp_replace({text}, {removed}, '')"


def name_sql(text: str, key: str, cfg: rules.NameRules) -> str:
    """Canonical name from the upper-case text (guard) and its compact key (all other rules).

    One flat chain of branches: the generated code stays small enough to be compiled together
    with the rest of its stage. A null text is unmapped.
    """
    branches = [(f"{text} IS NULL", cfg.unmapped)]
    if cfg.guard:
        branches.append((f"{text} RLIKE {quoted(unicode_pattern(cfg.guard))}", cfg.unmapped))
    for family in cfg.families:
        marked = f"contains({key}, {quoted(family.marker)})"
        for name, tokens in family.members:
            held = " OR ".join(f"contains({key}, {quoted(token)})" for token in tokens)
            branches.append((marked if tokens == (family.marker,) else f"{marked} AND ({held})", name))
        branches.append((marked, cfg.unmapped))
    for name in cfg.names:
        bare = quoted(name.replace(" ", "").replace("/", ""))
        held = f"contains({bare}, {key})"
        if cfg.min_reverse_len:
            held = f"(length({key}) >= {cfg.min_reverse_len} AND {held})"
        branches.append((f"contains({key}, {bare}) OR {held}", name))
    cases = " ".join(f"WHEN {condition} THEN {quoted(name)}" for condition, name in branches)
    return f"CASE {cases} ELSE {quoted(cfg.unmapped)} END"


def type_sql(
    raw: str, types: dict[str, str] = rules.OUTAGE_TYPES, other: str = rules.OTHER
) -> str:
    """Canonical outage type by the compact spelling; anything unknown becomes `other`."""
    pairs = ", ".join(f"{quoted(k)}, {quoted(v)}" for k, v in types.items())
    removed = quoted(unicode_pattern(f"{rules.OUTAGE_TYPE_PUNCTUATION}|{SPACE}"))
    bare = f"translate(regexp_replace(upper({raw}), {removed}, ''), '0', 'O')"
    return f"coalesce(try_element_at(map({pairs}), {bare}), {quoted(other)})"


def with_canonical_name(
    df: DataFrame,
    raw: str,
    out: str = "feeder_canonical",
    cfg: rules.NameRules = rules.FEEDER_RULES,
) -> DataFrame:
    """Add the canonical name of a raw one.

    The key is a column of its own because several rules read it. It comes out of a
    one-element explode, which Spark does not merge with what follows: otherwise a filter on
    the result would be moved below it, with the corrections copied into each of some forty
    branches. Outer spaces need no trimming: no rule depends on them.
    """
    text, key = f"__{out}_text", f"__{out}_key"
    keys = F.array(F.coalesce(F.expr(key_sql(f"`{text}`", cfg)), F.lit("")))
    return (
        df.withColumn(text, F.upper(F.col(raw)))
        .select("*", F.explode(keys).alias(key))
        .withColumn(out, F.expr(name_sql(f"`{text}`", f"`{key}`", cfg)))
        .drop(text, key)
    )


def with_canonical_name_by_spelling(
    df: DataFrame,
    raw: str,
    out: str = "feeder_canonical",
    cfg: rules.NameRules = rules.FEEDER_RULES,
) -> DataFrame:
    """The same column, with the rules run once per distinct spelling of a stored table.

    Real tables have few spellings (hundreds), and looking a name up is far cheaper than
    cleaning it. Spellings are found by aggregation and joined back; Spark broadcasts them
    while they are few and splits a heavy one otherwise.
    """
    key = f"__{out}_raw"
    named = with_canonical_name(df.select(raw).distinct(), raw, out, cfg)
    lookup = named.withColumnRenamed(raw, key)
    return df.join(lookup, F.col(raw).eqNullSafe(F.col(key)), "left").drop(key)


def canonical_type(
    raw: str, types: dict[str, str] = rules.OUTAGE_TYPES, other: str = rules.OTHER
) -> Column:
    """The rule of :func:`type_sql` for a column given by name."""
    return F.expr(type_sql(f"`{raw}`", types, other))
