"""Names looked up in a table of any size: by containment, and by small edit distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.session import stored

# Spellings that one variant may bring to a join task; more frequent variants are split.
VARIANT_ROWS = 2_000
# Most characters of a text by which its places in other texts are found.
START_LENGTH = 8


def _start(text: str) -> Column:
    """The first characters of a text: a power of two of them, START_LENGTH at most."""
    widths = [1 << i for i in range(1, START_LENGTH.bit_length())]
    width = F.lit(1)
    for w in widths:
        width = F.when(F.length(text) >= w, w).otherwise(width)
    return F.substring(F.col(text), F.lit(1), width)


def _pieces(texts: DataFrame, text: str, sought: DataFrame, what: str) -> DataFrame:
    """`texts` with each `piece` of `text` that may be one of the `sought`: where a sought text's start stands, the
    pieces as long as the texts with that start.

    A text brings one row per place and width of starts, and a piece per length; how many others hold the same part of
    it does not matter.
    """
    starts = sought.select(_start(what).alias("start"), F.length(what).alias("size")).distinct()
    starts = stored(starts, "starts")
    widths = starts.agg(F.collect_set(F.length("start"))).scalar()
    places = texts.withColumn("width", F.explode(widths)).filter(F.length(text) >= F.col("width"))
    places = places.withColumn("at", F.explode(F.sequence(F.lit(1), F.length(text) - F.col("width") + 1)))
    places = places.withColumn("start", F.substring(F.col(text), F.col("at"), F.col("width")))
    found = places.join(starts, "start").filter(F.col("at") + F.col("size") - 1 <= F.length(text))
    return found.withColumn("piece", F.substring(F.col(text), F.col("at"), F.col("size"))).select(*texts.columns, "piece")


def first_containing(
    keys: DataFrame, key: str, names: DataFrame, bare: str, position: str, min_reverse_len: int = 0
) -> DataFrame:
    """key, position: the first name in the list that a key contains, or that contains the key.

    `keys` has distinct keys, `names` one row per name; null keys and names match nothing, and
    keys that match nothing are left out. No key meets all names, nor all that share a part with
    it: the pieces of a key that are as long as names with the same start are joined with the
    names as whole texts, and the pieces of names with the keys.
    Keys shorter than `min_reverse_len` are not looked for in names.
    """
    keys = stored(keys.select(F.col(key).alias("key")).filter("key IS NOT NULL"), "keys")
    first = names.select(F.col(bare).alias("bare"), F.col(position).alias("position")).filter("bare IS NOT NULL")
    names = stored(first.groupBy("bare").agg(F.min("position").alias("position")), "names")
    named = names.filter("bare != ''")
    pieces = _pieces(keys.filter("key != ''"), "key", named, "bare")
    forward = pieces.join(named, F.col("piece") == F.col("bare"))

    longest = named.agg(F.max(F.length("bare"))).scalar()
    sought = keys.filter((F.length("key") >= max(1, min_reverse_len)) & (F.length("key") <= longest))
    # one row per piece before the keys are met: a piece that most names have costs no more than another
    pieces = _pieces(named, "bare", sought, "key").groupBy("piece").agg(F.min("position").alias("position"))
    reverse = pieces.join(sought, F.col("piece") == F.col("key"))

    # an empty name is in every key, an empty key in every name
    empty_name = names.filter("bare = ''").agg(F.min("position").alias("position"))
    always = keys.select("key", empty_name.scalar().alias("position"))
    found = [forward, reverse, always.filter("position IS NOT NULL")]
    if min_reverse_len == 0:
        first = names.agg(F.min("position").alias("position")).scalar()
        found.append(keys.filter("key = ''").select("key", first.alias("position")))
    each = [f.select("key", "position") for f in found]
    every = each[0]
    for more in each[1:]:
        every = every.union(more)
    return every.filter("position IS NOT NULL").groupBy("key").agg(F.min("position").alias("position"))


def with_listed_name(
    df: DataFrame, key: str, names: DataFrame, name: str, bare: str, position: str, out: str, **how: int
) -> DataFrame:
    """`df` with the first name that :func:`first_containing` finds for its key, or null."""
    found = first_containing(df.select(key).distinct(), key, names, bare, position, **how)
    named = names.select(F.col(position).alias("position"), F.col(name).alias(out))
    lookup = found.join(named, "position").select(F.col("key").alias("__key"), out)
    return df.join(lookup, F.col(key) == F.col("__key"), "left").select(*df.columns, out)


def _without(text: Column) -> Column:
    """All texts with one character less."""
    return F.transform(
        F.sequence(F.lit(1), F.length(text)),
        lambda i: F.concat(F.substr(text, F.lit(1), i - 1), F.substr(text, i + 1)),
    )


def _variants(text: Column, most: int) -> Column:
    """Hashes of the text with up to `most` characters left out."""
    level = F.array(text)
    every = level
    for _ in range(most):
        longer = F.filter(level, lambda t: F.length(t) > 0)
        level = F.array_distinct(F.flatten(F.transform(longer, _without)))
        every = F.concat(every, level)
    return F.array_distinct(F.transform(every, lambda t: F.xxhash64(t)))


def proposed_names(
    spellings: DataFrame, spelling: str, names: DataFrame, name: str, most: int = 2
) -> DataFrame:
    """spelling, name, distance: every name within `most` edits of a spelling.

    Two texts within d edits have a common variant with at most d characters left out of each,
    so the variants are joined, and only what meets is compared. Both sides are distinct texts;
    nulls meet nothing. A variant that very many spellings have is split, and each part meets
    all names that have it.
    """
    left = spellings.select(F.col(spelling).alias("spelling")).filter("spelling IS NOT NULL").distinct()
    right = names.select(F.col(name).alias("name")).filter("name IS NOT NULL").distinct()
    left = stored(left.select("spelling", F.explode(_variants(F.col("spelling"), most)).alias("variant")), "variants")
    right = stored(right.select("name", F.explode(_variants(F.col("name"), most)).alias("variant")), "variants")
    # only variants that a name has matter
    left = left.join(right.select("variant").distinct(), "variant", "left_semi")
    counts = left.groupBy("variant").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > VARIANT_ROWS)
    hot = stored(counts.select("variant", F.ceil(F.col("n") / VARIANT_ROWS).cast("int").alias("parts")), "hot-variants")
    parts = F.coalesce("parts", F.lit(1))
    left = left.join(hot, "variant", "left").withColumn("part", F.pmod(F.xxhash64("spelling"), parts).cast("int"))
    right = right.join(hot, "variant", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    met = left.drop("parts").join(right.drop("parts"), ["variant", "part"]).select("spelling", "name").distinct()
    return met.withColumn("distance", F.levenshtein("spelling", "name")).filter(F.col("distance") <= most)


def proposals(
    audit: DataFrame, spelling: str, names: DataFrame, name: str, rows: str = "n_rows", most: int = 2
) -> DataFrame:
    """Proposed corrections of unmapped spellings with the rows that each would map."""
    found = proposed_names(audit, spelling, names, name, most)
    counted = audit.select(F.col(spelling).alias("spelling"), F.col(rows).alias(rows))
    return found.join(counted, "spelling").select("spelling", "name", "distance", rows)
