"""Near-duplicates by MinHash with tensored banding.

A few small hashes, each of two minima, are computed per document; every pair of them forms the key of one table, so
m small hashes give m (m - 1) / 2 tables of four minima each, for the price of 2 m minima instead of four per table.
Documents with the same shingle set are one class; classes meet in the tables and are verified on their full sets.

Groups are never expanded into all pairs. In each table a class is first compared with the smallest of its bucket,
then, if they are not yet connected, with the one that has the fewest shingles of its own. For what is still in
different components, each class of a bucket notes which shingles of the bucket's leader it lacks. Two classes can have
no more in common than what neither lacks, plus what both have beside the leader: in a crowd of near-misses around one
text, that tells nearly every pair apart without looking at their sets, and loses no link.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import fresh, map_batches, mix, stored, token_hashes, token_spans, utf8
from faultline.llm.graph import stars

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEEDS = np.random.default_rng(7).integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


BITS = 1024
SAMPLED = 16  # sets with fewer shingles are not judged by their sample bits, which scatter more there
_SEEDS_32 = np.random.default_rng(8).integers(1, 2**31, 2 * BITS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_LONGS = [f"b{i}" for i in range(BITS // 64)]
_LACKS = [f"m{i}" for i in range(BITS // 64)]
_OWN = ("cls", "n", "lone", "label", "small", *_LONGS)


@dataclass(frozen=True)
class Near:
    """``words`` per shingle, ``percent``: least similarity, ``small``: small hashes of two minima each.

    Two documents with similarity s miss each other with probability (1-p)^m + m p (1-p)^(m-1), p = s^2: 8e-4 at 0.75
    and 8e-5 at 0.8 for twelve.
    """

    words: int = 5
    percent: int = 75
    small: int = 12


def shingles(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, and where each text's begin (with the end of the last)."""
    data, offsets = utf8(texts)
    data = _LOWER[data]
    starts, ends, first = token_spans(data, offsets)
    own = token_hashes(data, starts, ends)
    counts = np.diff(first)
    per_text = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    out_first = np.concatenate([[0], np.cumsum(per_text)])
    begin = np.repeat(first[:-1], per_text) + np.arange(out_first[-1]) - np.repeat(out_first[:-1], per_text)
    length = np.repeat(np.minimum(counts, words), per_text)
    padded = np.concatenate([own, np.zeros(words, np.uint64)])
    out = length.astype(np.uint64)
    for i in range(words):
        out += np.where(i < length, padded[begin + i], np.uint64(0)) * _SEEDS[i]
    return mix(out), out_first


def small_hashes(hashes: np.ndarray, begins: np.ndarray, small: int) -> np.ndarray:
    """One row per text that has shingles, one column per small hash: two minima mixed into one number."""
    out = np.empty((len(begins), small), np.uint64)
    for k in range(small):
        own = np.uint64(k + 1)
        for half in (2 * k, 2 * k + 1):
            seen = (hashes ^ _SEEDS[16 + half]) * _SEEDS[1040 + half]
            seen ^= seen >> np.uint64(32)
            own = mix(own + np.minimum.reduceat(seen * _SEEDS[2064 + half], begins) * _SEEDS[half % 2])
        out[:, k] = own
    return out


def shingle_sets(batch: pa.RecordBatch, how: Near) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The distinct shingles of each text; all shingles, and where each text's begin."""
    hashes, first = shingles(batch.column("text"), how.words)
    return [np.unique(hashes[a:b]) for a, b in zip(first, first[1:])], hashes, first


def set_class(own: np.ndarray) -> bytes | None:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None


def sketches(docs: DataFrame, how: Near) -> DataFrame:
    """doc_id, n_shingles, cls (a digest of the set; null for an empty one) and the small hashes."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sets, hashes, first = shingle_sets(batch, how)
        full = np.flatnonzero(np.diff(first))
        table = np.zeros((len(sets), how.small), np.int64)
        if len(full):
            table[full] = small_hashes(hashes, first[full], how.small).view(np.int64)
        small = pa.FixedSizeListArray.from_arrays(pa.array(table.ravel()), how.small).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([set_class(s) for s in sets], pa.binary()),
                small,
            ],
            ["doc_id", "n_shingles", "cls", "small"],
        )

    return map_batches(docs, run, "doc_id long, n_shingles long, cls binary, small array<long>")


def table_keys(classes: DataFrame) -> DataFrame:
    """cls, n, key, i, j: the tables' keys that at least two classes share, and the small hashes they combine.

    Only small hashes that several classes have can be half of such a key, so the others form none.
    """
    halves = classes.select("cls", "n", F.posexplode("small").alias("i", "h"))
    common = halves.groupBy("i", "h").agg(F.count("*").alias("c")).filter("c > 1")
    met = halves.join(common.hint("merge"), ["i", "h"], "left_semi")
    own = met.groupBy("cls", "n").agg(F.array_sort(F.collect_list(F.struct("i", "h"))).alias("hs"))
    pairs = F.flatten(
        F.transform(
            "hs",
            lambda x, p: F.transform(
                F.slice("hs", p + 2, F.size("hs")),
                lambda y: F.struct(
                    F.xxhash64(x["i"], x["h"], y["i"], y["h"]).alias("key"), x["i"].alias("i"), y["i"].alias("j")
                ),
            ),
        )
    )
    keys = own.filter(F.size("hs") > 1).select("cls", "n", F.inline(pairs))
    shared = keys.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    return keys.join(shared.hint("merge"), "key", "left_semi")


def anew(per_key: DataFrame) -> DataFrame:
    """The rows of an aggregate by key, dealt out anew by a join on key: Spark splits a frequent key only if both sides
    are. Costs one exchange, where a stored table would cost a write and a scan more."""
    return per_key.withColumn("key", F.expr("key ^ 0"))


def _close(how: Near, a: str, b: str) -> str:
    """No sets of such different sizes can be similar enough."""
    return f"100 * least({a}, {b}) >= {how.percent} * greatest({a}, {b})"


def first_pairs(keys: DataFrame, how: Near) -> DataFrame:
    """Each class with the smallest of its bucket, for every key."""
    lead = keys.groupBy("key").agg(F.min(F.struct("cls", "n")).alias("lead"))
    pairs = keys.join(anew(lead).hint("merge"), "key")
    pairs = pairs.filter("cls != lead.cls").filter(_close(how, "n", "lead.n"))
    return pairs.select(F.col("cls").alias("a"), F.col("lead.cls").alias("b")).distinct()


def open_rows(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """``rows`` (key, cls, more) of the buckets that hold several components, with the component of each as ``label``
    and the bucket's most frequent one as ``main``. ``linked``: the stars of the links found so far."""
    labels = linked.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labelled = rows.join(labels.hint("merge"), rows["cls"] == labels["node"], "left").select(
        *rows.columns, F.coalesce("component", "cls").alias("label")
    )
    parts = labelled.groupBy("key", "label").agg(F.count("*").alias("c"))
    mains = parts.groupBy("key").agg(
        F.max_by("label", F.struct("c", "label")).alias("main"), F.count("*").alias("components")
    )
    split = anew(mains.filter("components > 1").drop("components"))
    return stored(labelled.join(split.hint("merge"), "key"), "near-open")


def sample_bits(hashes: np.ndarray) -> np.ndarray:
    """One bit of each of BITS minima of a set: two sets of similarity s differ in (1 - s) / 2 of them on average."""
    x = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)[:, None]
    least = [
        ((x ^ _SEEDS_32[k : k + 64]) * _SEEDS_32[BITS + k : BITS + k + 64]).min(axis=0) for k in range(0, BITS, 64)
    ]
    return np.packbits((np.concatenate(least) >> np.uint32(9)) & np.uint32(1)).view(np.int64)


def bit_samples(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """cls and its sample bits, as longs."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        each = [sample_bits(np.frombuffer(x.as_buffer(), np.uint64)) for x in batch.column("set")]
        longs = [pa.array(column) for column in np.stack(each).T.copy()]
        yield pa.RecordBatch.from_arrays([batch.column("cls"), *longs], ["cls", *_LONGS])

    own = sets.join(rows.select("cls").distinct().hint("merge"), "cls", "left_semi")
    return map_batches(own, run, "cls binary, " + ", ".join(f"{c} long" for c in _LONGS))


def lone_shingles(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """cls, lone: how many shingles of a class no other class in ``rows`` has.

    The sets' hashes travel packed, a batch's share of a bucket in one row, and are counted bucket by bucket. A batch
    names a shingle once, however many of its sets have it, so a very frequent one does not fill its bucket.
    """
    some = rows.select("cls").distinct()
    own = sets.join(some.hint("merge"), "cls", "left_semi")
    total = own.agg(F.sum(F.octet_length("set"))).first()[0] or 0
    buckets = 1 + total // (8 << 20)

    def pack(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        each = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("set")]
        owner = np.repeat(np.arange(len(each), dtype=np.int32), [len(x) for x in each])
        # a shingle that several sets of the batch have travels once, and without an owner
        hashes, first, times = np.unique(np.concatenate(each), return_index=True, return_counts=True)
        owner = np.where(times > 1, np.int32(-1), owner[first])
        bucket = (hashes % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        classes = batch.column("cls").to_pylist()
        rows = []
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            o = order[cuts[b] : cuts[b + 1]]
            own, at = np.unique(owner[o], return_inverse=True)
            named = [classes[k] for k in own.tolist() if k >= 0]
            at = at - (own[0] < 0)  # -1: no owner
            rows.append((b, named, at.astype("<i4").tobytes(), hashes[o].tobytes()))
        columns = zip(*rows) if rows else ((), (), (), ())
        kinds = (pa.int64(), pa.list_(pa.binary()), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["bucket", "classes", "owners", "hashes"]
        )

    def count(table: pa.Table) -> pa.Table:
        classes, owners, hashes = [], [], []
        for row in table.to_pylist():
            own = np.frombuffer(row["owners"], "<i4")
            owners.append(np.where(own < 0, -1, own + len(classes)))
            hashes.append(np.frombuffer(row["hashes"], np.uint64))
            classes += row["classes"]
        own = np.concatenate(owners)
        _, first, times = np.unique(np.concatenate(hashes), return_index=True, return_counts=True)
        lone = own[first[times == 1]]
        alone = np.bincount(lone[lone >= 0], minlength=len(classes))
        return pa.table({"cls": pa.array(classes, pa.binary()), "lone": pa.array(alone, pa.int64())})

    packed = map_batches(own, pack, "bucket long, classes array<binary>, owners binary, hashes binary")
    counted = packed.groupBy("bucket").applyInArrow(count, "cls binary, lone long")
    return counted.groupBy("cls").agg(F.sum("lone").alias("lone"))


def _possible(how: Near, a: str, b: str) -> str:
    """What only one of two sets has is outside their intersection: 100 * both >= percent * (both + lone + lone).

    And unless a set has fewer than SAMPLED shingles, their sample bits differ by no more than is usual at the least
    similarity, plus five deviations; at the least similarity that should pass over 1e-6 of the similar sets.
    """
    both = f"least({a}n - {a}lone, {b}n - {b}lone)"
    differ = (1 - how.percent / 100) / 2
    most = int(BITS * differ + 5 * (BITS * differ * (1 - differ)) ** 0.5)
    bits = " + ".join(f"bit_count({a}{c} ^ {b}{c})" for c in _LONGS)
    bound = f"{100 - how.percent} * {both} >= {how.percent} * ({a}lone + {b}lone)"
    return f"{_close(how, f'{a}n', f'{b}n')} AND {bound} AND (least({a}n, {b}n) < {SAMPLED} OR {bits} <= {most})"


def lead_pairs(rows: DataFrame, how: Near) -> DataFrame:
    """In each bucket, the class with the fewest lone shingles and those of other components that it may be like.

    What is like any member of the bucket is mostly like this one.
    """
    lead = rows.groupBy("key").agg(F.min(F.struct("lone", "cls", "n", "label", "small", *_LONGS)).alias("o"))
    lead = lead.select("key", *[F.col(f"o.{c}").alias(f"o_{c}") for c in _OWN])
    return _pairs(rows, anew(lead), how)


def lacking(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """``rows`` with what each class has to do with its bucket's leader (the class with the fewest lone shingles).

    ``n_lead``: the leader's shingles. ``beside``: own shingles that the leader does not have, without the lone ones.
    ``m0``...: one bit for each group of the leader's shingles, set if the class lacks any of the group; up to BITS
    shingles are groups of one.
    """
    leads = rows.groupBy("key").agg(F.min(F.struct("lone", "cls")).alias("o"))
    leads = leads.select("key", F.col("o.cls").alias("lead"))
    led = rows.join(anew(leads).hint("merge"), "key")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bits, sizes, beside = [], [], []
        for x, y in zip(batch.column("set_a"), batch.column("set_b")):
            own, lead = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
            lacks = np.flatnonzero(~np.isin(lead, own, assume_unique=True))
            group = np.zeros(BITS, bool)
            group[lacks if len(lead) <= BITS else lacks * BITS // len(lead)] = True
            bits.append(np.packbits(group).view(np.int64))
            sizes.append(len(lead))
            beside.append(len(own) - len(lead) + len(lacks))
        longs = [pa.array(column) for column in np.stack(bits).T.copy()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(sizes, pa.int64()), pa.array(beside, pa.int64()), *longs],
            ["of", "by", "n_lead", "beside", *_LACKS],
        )

    pairs = led.select(F.col("cls").alias("a"), F.col("lead").alias("b")).distinct()
    longs = ", ".join(f"{c} long" for c in _LACKS)
    found = map_batches(with_sets(pairs, sets), run, f"of binary, by binary, n_lead long, beside long, {longs}")
    same = (F.col("cls") == F.col("of")) & (F.col("lead") == F.col("by"))
    joined = led.join(found.hint("merge"), same).withColumn("beside", F.expr("beside - lone"))
    return joined.drop("of", "by", "lead")


def _in_common(how: Near) -> str:
    """No more than this can be in both sets: what the leader has and neither lacks, and what both have beside it."""
    lacked = " + ".join(f"bit_count({c} | o_{c})" for c in _LACKS)
    both = f"(n_lead - ({lacked}) + least(beside, o_beside))"
    return f"{100 + how.percent} * {both} >= {how.percent} * (n + o_n)"


def rest_pairs(rows: DataFrame, sets: DataFrame, how: Near) -> DataFrame:
    """All pairs of a bucket's classes in different components that may be similar enough.

    Each has a class outside the bucket's main component. Rows that cannot be like any other, by the fewest lone
    shingles of those they would be paired with, are left out before anything is paired. What passes the bound by the
    leader is mostly similar indeed.
    """
    outside = F.col("label") != F.col("main")
    least = rows.groupBy("key").agg(
        F.min("lone").alias("low"), F.min(F.when(outside, F.col("lone"))).alias("low_outside")
    )
    near = rows.join(anew(least).hint("merge"), "key")
    low = F.when(outside, F.col("low")).otherwise(F.col("low_outside"))
    near = near.filter((100 - how.percent) * (F.col("n") - F.col("lone")) >= how.percent * (F.col("lone") + low))
    near = stored(lacking(stored(near, "near-possible"), sets), "near-lacking")
    own = (*_OWN, "beside", *_LACKS)
    others = near.filter("label != main").select("key", *[F.col(c).alias(f"o_{c}") for c in own])
    # each pair speaks once: in the table of its first two common small hashes, and in one order
    # written out for each small hash, this made the join's condition so long that a pair took 5.7 us
    earlier = "exists(sequence(0, j), k -> k < j AND k != i AND small[k] = o_small[k])"
    once = f"{_in_common(how)} AND (label = main OR cls < o_cls) AND NOT {earlier}"
    return _pairs(near, others, how, once)


def _pairs(rows: DataFrame, others: DataFrame, how: Near, once: str = "true") -> DataFrame:
    # the bound by the leader before the sample bits: it lets far fewer pairs pass
    meet = f"label != o_label AND {_close(how, 'n', 'o_n')} AND {once} AND {_possible(how, '', 'o_')}"
    pairs = rows.join(others.hint("merge"), "key").filter(meet)
    return pairs.select(F.least("cls", "o_cls").alias("a"), F.greatest("cls", "o_cls").alias("b")).distinct()


def with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, set_a, set_b. Few b may have many a, as leaders do: they meet their sets first, and the pairs are dealt out
    by a for what follows."""
    one = pairs.join(sets.select(F.col("cls").alias("b"), F.col("set").alias("set_b")).hint("merge"), "b")
    two = one.join(sets.select(F.col("cls").alias("a"), F.col("set").alias("set_a")).hint("merge"), "a")
    return two.select("a", "b", "set_a", "set_b")


def verified(pairs: DataFrame, sets: DataFrame, how: Near) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keep = []
        for x, y in zip(batch.column("set_a"), batch.column("set_b")):
            a, b = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * both >= how.percent * (len(a) + len(b) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_batches(with_sets(pairs, sets), run, "a binary, b binary")


def candidate_sets(docs: DataFrame, keys: DataFrame, classes: DataFrame, how: Near) -> DataFrame:
    """cls, set (sorted hashes) of the classes that share a key, from the text of one document of each."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sets, _, _ = shingle_sets(batch, how)
        rows = [(set_class(s), s.tobytes()) for s in sets if len(s)]
        arrays = [pa.array(c, pa.binary()) for c in zip(*rows)] if rows else [pa.array([], pa.binary())] * 2
        yield pa.RecordBatch.from_arrays(arrays, ["cls", "set"])

    some = classes.join(keys.select("cls").distinct().hint("merge"), "cls", "left_semi").select("rep").distinct()
    texts = docs.join(some.hint("merge"), F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")
    return map_batches(texts, run, "cls binary, set binary").dropDuplicates(["cls"])


def near_groups(docs: DataFrame, how: Near = Near()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    A document's set holds its distinct shingles of ``how.words`` words (runs without white space, A-Z lower-cased);
    one with fewer words has its whole sequence as the only one; a null text, or one without words, has none, and is
    linked with nothing. ``component_id`` is the smallest doc_id that linked documents reach; null ids are passed over,
    and a component of null ids only has a null one. ``kept`` says whether it is the document's own. Repeated rows come
    back as often. Rows that share a doc_id but not the text are documents of their own. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sketch = stored(sketches(docs, how), "near-sketches")
    full = sketch.filter("n_shingles > 0")
    classes = stored(
        full.groupBy("cls").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("small").alias("small")
        ),
        "near-classes",
    )
    keys = stored(table_keys(classes.select("cls", "n", "small")), "near-keys")
    sets = stored(candidate_sets(docs, keys, classes, how), "near-sets")
    linked = stars(verified(first_pairs(keys, how), sets, how))
    rows = open_rows(keys, linked)
    facts = lone_shingles(rows, sets).join(bit_samples(rows, sets), "cls").join(classes.select("cls", "small"), "cls")
    rows = stored(rows.join(facts.hint("merge"), "cls"), "near-rows")
    linked = stars(linked.union(verified(lead_pairs(rows, how), sets, how)))
    rows = open_rows(rows.drop("label", "main"), linked)
    linked = stars(linked.union(verified(rest_pairs(rows, sets, how), sets, how)))
    of_class = classes.select("cls", "rep").join(linked.hint("merge"), F.col("cls") == F.col("a"), "left")
    of_class = of_class.select("cls", "rep", F.coalesce("b", "cls").alias("component"))
    lowest = of_class.groupBy("component").agg(F.min("rep").alias("low"))
    # under a name of its own, dealt out anew like the keys of :func:`anew`
    lowest = lowest.select(F.expr("substring(component, 1)").alias("of"), "low")
    lows = of_class.join(lowest.hint("merge"), F.col("component") == F.col("of")).select("cls", "low")
    low = F.when(F.col("n_shingles") > 0, F.col("low")).otherwise(F.col("doc_id"))
    return (
        sketch.join(lows.hint("merge"), "cls", "left")
        .withColumn("component_id", low)
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )


def keep_one(docs: DataFrame, how: Near = Near()) -> DataFrame:
    """The rows of ``docs``, with all columns, but those that :func:`near_groups` does not keep. Null ids stay."""
    (own,) = fresh(docs, "dropped")
    gone = near_groups(docs, how).filter("NOT kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias(own)).distinct()
    return docs.join(stored(gone, "near-gone").hint("merge"), F.col("doc_id") == F.col(own), "left_anti")


GROUPS_SQL = """
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM split),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingle a JOIN shingle b USING (s)
  WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (
  SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM split UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT split.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(reach.b) AS component_id,
       split.doc_id = min(reach.b) AS kept
FROM split JOIN reach ON reach.a = split.doc_id LEFT JOIN size ON size.doc_id = split.doc_id
GROUP BY split.doc_id
"""
