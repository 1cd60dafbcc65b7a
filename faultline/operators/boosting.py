"""Multi-class boosting by softmax, on histograms of gradients.

All classes are boosted together: a round grows one tree per class, and one pass over the rows gives the histograms of
every class, open node, feature and bin of a level. Bins are fitted once, by quantiles; a categorical feature splits one
value from the rest, as its one-hot columns would. Rows travel as blocks of packed bins and margins in a stored table,
which is written anew every few rounds, so that a pass applies few trees and no lineage grows.

A round mostly grows the trees of the round before. A pass therefore looks at all nodes that these trees have, on every
level; what the round then splits otherwise takes further passes, a level each. The trees are the same as without.

Gradients are rounded to multiples of 2^-24 before they are added up. The sums are then whole numbers that do not depend
on the order of rows, blocks and tasks: the same rows give the same model, on any cluster and after any lost executor.
Values of leaves are multiples of 2^-40, so that margins are exact too: trees with the same splits are walked once, for
the sum of their values. A row is counted in its last node only; what a node holds is the sum of what lies below it.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from faultline.session import stored

UNIT = float(1 << 24)
VALUE_UNIT = float(1 << 40)
FEW_TASKS = 16
STATE = "bins binary, labels binary, margins binary"


@dataclass(frozen=True)
class Boosting:
    """``l2`` and ``least_weight`` (Hessian sum of a child) hold trees back. ``block_rows``: rows per block. ``renew``:
    rounds after which the stored margins are brought up to date."""

    rounds: int = 200
    depth: int = 6
    rate: float = 0.1
    bins: int = 256
    l2: float = 1.0
    least_weight: float = 1.0
    least_gain: float = 1e-6
    block_rows: int = 1 << 15
    renew: int = 10


@dataclass(frozen=True)
class Feature:
    """``cuts``: the upper ends of the bins of a number, or the values of a category. Other values of a category are a
    bin that no split names; a missing number counts as the least."""

    name: str
    categorical: bool
    cuts: tuple

    def bins(self) -> int:
        return len(self.cuts) + 1

    def encode(self, column: pa.Array) -> np.ndarray:
        if self.categorical:
            found = pc.index_in(column.cast(pa.string()), pa.array(self.cuts, pa.string()))
            return np.asarray(pc.fill_null(found, len(self.cuts)))
        # the last bin also holds what is above all cuts
        values = np.asarray(pc.fill_null(column.cast(pa.float64()), -np.inf))
        return np.searchsorted(np.array(self.cuts), np.where(np.isnan(values), -np.inf, values))


@dataclass
class Trees:
    """The trees of one round, one per class, as complete binary trees: the children of node i are 2 i + 1 and 2 i + 2.
    ``feature`` is -1 at a leaf; a row goes right above ``cut``, or at it if the feature is a category."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, classes: int, depth: int) -> Trees:
        shape = (classes, (2 << depth) - 1)
        return cls(np.full(shape, -1), np.zeros(shape, np.int64), np.zeros(shape))

    def splits(self, k: int) -> bytes:
        """Equal for trees with the same splits."""
        return self.feature[k].tobytes() + self.cut[k].tobytes()


@dataclass
class Walk:
    """The splits of one tree, laid out for a walk of all rows at once: a leaf is its own child. A row goes right above
    ``low`` and, at a category, not above ``high``."""

    feature: np.ndarray
    child: np.ndarray
    low: np.ndarray
    high: np.ndarray | None
    depth: int

    @classmethod
    def of(cls, feature: np.ndarray, cut: np.ndarray, categorical: np.ndarray) -> Walk:
        node, inner = np.arange(len(feature)), feature >= 0
        by_value = inner & categorical[feature]
        most = np.iinfo(np.int64).max
        low = np.where(inner, cut - by_value, most)
        high = np.where(by_value, cut, most) if by_value.any() else None
        depth = int(node[inner].max() + 1).bit_length() if inner.any() else 0
        return cls(np.where(inner, feature, 0), np.where(inner, 2 * node + 1, node), low, high, depth)

    def last(self, bins: np.ndarray) -> np.ndarray:
        """The last node of every row (columns of ``bins``)."""
        rows = bins.shape[1]
        at = np.zeros(rows, np.int64)
        for level in range(self.depth):
            if level == 0:
                x, low = bins[self.feature[0]], self.low[0]
                high = None if self.high is None else self.high[0]
                at += self.child[0]
            else:
                place = self.feature.take(at)
                place *= rows
                place += np.arange(rows)
                x, low = bins.reshape(-1).take(place), self.low.take(at)
                high = None if self.high is None else self.high.take(at)
                at = self.child.take(at)
            right = x > low
            if high is not None:
                right &= x <= high
            at += right
        return at


def merged(rounds: list[Trees], categorical: np.ndarray, classes: int) -> list[dict[bytes, tuple[Walk, np.ndarray]]]:
    """For each class, by their splits, the different trees of these rounds with the sum of their values."""
    out: list[dict[bytes, tuple[Walk, np.ndarray]]] = [{} for _ in range(classes)]
    for trees in rounds:
        for k, own in enumerate(out):
            splits = trees.splits(k)
            if splits in own:
                own[splits] = (own[splits][0], own[splits][1] + trees.value[k])
            else:
                own[splits] = (Walk.of(trees.feature[k], trees.cut[k], categorical), trees.value[k])
    return out


def add_to(
    margins: np.ndarray, bins: np.ndarray, trees: list[dict[bytes, tuple[Walk, np.ndarray]]]
) -> list[dict[bytes, np.ndarray]]:
    """Adds to the margins (classes, rows). Returns the last nodes of the rows, by class and splits."""
    walked: list[dict[bytes, np.ndarray]] = [{} for _ in trees]
    for k, own in enumerate(trees):
        for splits, (walk, value) in own.items():
            at = walked[k][splits] = walk.last(bins)
            margins[k] += value.take(at)
    return walked


# ---- blocks


def encoded(features: list[Feature], batch: pa.RecordBatch) -> np.ndarray:
    """(features, rows): the bin of each value."""
    if not features:
        return np.zeros((0, batch.num_rows), np.int64)
    return np.stack([f.encode(batch.column(f.name)) for f in features])


def _opened(
    batch: pa.RecordBatch, features: int, classes: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each block: bins (features, rows), labels, and margins (classes, rows)."""
    for row in zip(*(batch.column(c) for c in ("bins", "labels", "margins"))):
        bins, labels, margins = (x.as_buffer() for x in row)
        labels = np.frombuffer(labels, np.int32)
        narrow = f"u{bins.size // max(features * len(labels), 1)}"
        margins = np.frombuffer(margins, np.float64).reshape(classes, len(labels)).copy()
        yield np.frombuffer(bins, narrow).reshape(features, len(labels)), labels, margins


def _narrow(features: list[Feature]) -> np.dtype:
    """The least type that holds every bin."""
    return np.min_scalar_type(max(f.bins() for f in features) - 1)


def _filled(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of this many; only the last may have fewer."""
    held, n = [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            held.append(batch.slice(at, rows - n))
            at, n = at + held[-1].num_rows, n + held[-1].num_rows
            if n == rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def first_state(rows: DataFrame, features: list[Feature], label: str, labels: list[str], how: Boosting) -> DataFrame:
    narrow = _narrow(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _filled(batches, how.block_rows):
            bins = encoded(features, part).astype(narrow)
            of = np.asarray(pc.index_in(part.column(label), pa.array(labels, pa.string()))).astype(np.int32)
            each = (bins.tobytes(), of.tobytes(), np.zeros((len(labels), len(of))).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in each], ["bins", "labels", "margins"])

    names = list(dict.fromkeys([*(f.name for f in features), label]))
    # dealt out evenly, once: every later pass keeps all cores busy to its end
    rows = rows.select(*names)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = -(-max(rows.rdd.getNumPartitions(), 1) // cores) * cores
    return stored(rows.repartition(tasks).mapInArrow(run, STATE), "boosting-state")


def renewed(state: DataFrame, rounds: list[Trees], categorical: np.ndarray, classes: int) -> DataFrame:
    """The blocks with the margins after these rounds."""
    trees = merged(rounds, categorical, classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = []
            for bins, _, own in _opened(batch, len(categorical), classes):
                add_to(own, bins, trees)
                margins.append(own.tobytes())
            yield batch.set_column(2, "margins", pa.array(margins, pa.binary()))

    return stored(state.mapInArrow(run, STATE), "boosting-state")


# ---- one pass


@dataclass
class Pass:
    """What a pass needs to know: the trees since the state was written, the trees that rows walk down with the splits
    they are known by, and for each class the histogram that the rows in a last node belong to (-1: none)."""

    since: list[dict[bytes, tuple[Walk, np.ndarray]]]
    walked: list[tuple[bytes, Walk]]
    slots: np.ndarray
    sizes: list[int]

    def shape(self) -> tuple[int, int, int]:
        """Wanted nodes of all classes, bins of all features; gradients and Hessians."""
        return int(self.slots.max()) + 1, sum(self.sizes), 2

    def histograms(self, batches: Iterable[pa.RecordBatch]) -> np.ndarray:
        """The sums of gradients and Hessians, in units."""
        classes = len(self.slots)
        out = np.zeros(self.shape(), np.int64)
        for bins, labels, margins in (x for b in batches for x in _opened(b, len(self.sizes), classes)):
            known = add_to(margins, bins, self.since)
            g, h = gradients(margins, labels)
            for k, (splits, walk) in enumerate(self.walked):
                own = self.slots[k]
                if own.max() < 0:
                    continue
                at = known[k][splits] if splits in known[k] else walk.last(bins)
                slot = own.take(at)
                if slot.min() < 0:
                    rows = np.nonzero(slot >= 0)[0]
                    if len(rows):
                        self.add(out, slot[rows], bins[:, rows], (g[k][rows], h[k][rows]))
                else:
                    self.add(out, slot, bins, (g[k], h[k]))
        return out

    def add(self, out: np.ndarray, slot: np.ndarray, bins: np.ndarray, weights: tuple) -> None:
        low, n, begin = slot.min(), slot.max() - slot.min() + 1, 0
        slot = slot - low
        for f, size in enumerate(self.sizes):
            at = slot * size
            at += bins[f]
            for i, own in enumerate(weights):
                sums = np.bincount(at, own, n * size).astype(np.int64).reshape(n, size)
                out[low : low + n, begin : begin + size, i] += sums
            begin += size


def gradients(margins: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(classes, rows): gradients and Hessians in whole units. The margins are used up."""
    p = margins
    p -= p.max(axis=0)
    np.exp(p, out=p)
    p /= p.sum(axis=0)
    h = 1 - p
    h *= p
    h *= 2
    np.maximum(h, 1 / UNIT, out=h)
    h *= UNIT
    p[labels, np.arange(len(labels))] -= 1
    p *= UNIT
    return np.rint(p, out=p), np.rint(h, out=h)


def best_splits(
    sums: np.ndarray, sizes: list[int], categorical: np.ndarray, how: Boosting
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each open node: gain, feature, cut, and sums (left, right) of gradients and Hessians. Of equal gains, the
    first feature and the lowest cut."""
    n = len(sums)
    gain, feature, cut = np.full(n, -np.inf), np.full(n, -1), np.zeros(n, np.int64)
    sides = np.zeros((n, 2, 2))
    at = 0
    for f, size in enumerate(sizes):
        own = sums[:, at : at + size]
        at += size
        total = own.sum(axis=1)
        # what goes right: one value of a category, everything above a cut of a number; the last bin is no cut
        right = own if categorical[f] else total[:, None] - own.cumsum(axis=1)
        right = right[:, :-1] / UNIT
        whole = total[:, None] / UNIT
        left = whole - right
        if right.shape[1] == 0:
            continue
        score = [x[..., 0] ** 2 / (x[..., 1] + how.l2) for x in (left, right, whole)]
        own_gain = np.where(
            (left[..., 1] >= how.least_weight) & (right[..., 1] >= how.least_weight),
            score[0] + score[1] - score[2],
            -np.inf,
        )
        best = own_gain.argmax(axis=1)
        node = np.arange(n)
        better = own_gain[node, best] > gain
        gain = np.where(better, own_gain[node, best], gain)
        feature, cut = np.where(better, f, feature), np.where(better, best, cut)
        sides[better] = np.stack([left[node, best], right[node, best]], axis=1)[better]
    return gain, feature, cut, sides


def added_up(each: DataFrame, tasks: int, shape: tuple[int, ...]) -> np.ndarray:
    """The sum of all tasks' histograms: those of a few tasks as they come, else by a tree of tasks. What reaches the
    driver does not grow with the rows."""
    if tasks <= FEW_TASKS:
        sums = np.zeros(shape, np.int64)
        for row in each.collect():
            sums += np.frombuffer(row["sums"], np.int64).reshape(shape)
        return sums
    return each.rdd.map(lambda row: np.frombuffer(row["sums"], np.int64).reshape(shape)).treeReduce(np.add).copy()


def grow(
    blocks: DataFrame,
    since: list[Trees],
    before: Trees | None,
    sizes: list[int],
    categorical: np.ndarray,
    classes: int,
    how: Boosting,
) -> Trees:
    """One round: the trees of all classes. The first pass takes the nodes of the round before, each further one those
    that are still open; there are at most as many as levels."""
    trees = Trees.empty(classes, how.depth)
    guess = before or trees
    open_ = [(k, 0) for k in range(classes)]
    known: dict[tuple[int, int], np.ndarray] = {}
    for level in range(how.depth):
        if any(place not in known for place in open_):
            known |= passed(blocks, since, guess if level == 0 else trees, open_, sizes, categorical)
        sums = np.stack([known[place] for place in open_])
        gain, feature, cut, sides = best_splits(sums, sizes, categorical, how)
        values = _value(sides[..., 0], sides[..., 1], how)
        if level == 0:
            total = sums[:, : sizes[0]].sum(axis=1) / UNIT
            trees.value[:, 0] = _value(total[:, 0], total[:, 1], how)
        below = []
        for slot, (k, node) in enumerate(open_):
            split = gain[slot] > how.least_gain
            if (guess.feature[k, node], guess.cut[k, node]) != ((feature[slot], cut[slot]) if split else (-1, 0)):
                # what was seen below this node is of other rows
                known = {place: x for place, x in known.items() if not _is_below(place, (k, node))}
            if not split:
                continue
            trees.feature[k, node], trees.cut[k, node] = feature[slot], cut[slot]
            for child in (0, 1):
                place = 2 * node + 1 + child
                trees.value[k, place] = values[slot, child]
                if sides[slot, child, 1] >= 2 * how.least_weight:  # else no split of it can be heavy enough
                    below.append((k, place))
        open_ = below
        if not open_:
            break
    return trees


def _value(gradient: np.ndarray, hessian: np.ndarray, how: Boosting) -> np.ndarray:
    return np.rint(-how.rate * gradient / (hessian + how.l2) * VALUE_UNIT) / VALUE_UNIT


def _is_below(place: tuple[int, int], top: tuple[int, int]) -> bool:
    (k, node), (of, root) = place, top
    while k == of and node > root:
        node = (node - 1) // 2
        if node == root:
            return True
    return False


def passed(
    blocks: DataFrame,
    since: list[Trees],
    walked: Trees,
    open_: list[tuple[int, int]],
    sizes: list[int],
    categorical: np.ndarray,
) -> dict[tuple[int, int], np.ndarray]:
    """The histograms of the open nodes, and of all nodes of ``walked`` below them."""
    last = walked.feature.shape[1]
    wanted, front = [], list(open_)
    while front:
        wanted += [(k, node) for k, node in front if 2 * node + 2 < last]
        front = [
            (k, 2 * node + 1 + child) for k, node in front if walked.feature[k, node] >= 0 for child in (0, 1)
        ]
    slots = np.full(walked.feature.shape, -1)
    for slot, (k, node) in enumerate(wanted):
        slots[k, node] = slot
    above = slots.copy()
    for node in range(1, last):
        # rows are counted in the deepest node that is wanted
        above[:, node] = np.where(slots[:, node] >= 0, slots[:, node], above[:, (node - 1) // 2])
    walks = [
        (walked.splits(k), Walk.of(walked.feature[k], walked.cut[k], categorical)) for k in range(len(slots))
    ]
    own = Pass(merged(since, categorical, len(slots)), walks, above, sizes)
    shape = own.shape()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([own.histograms(batches).tobytes()], pa.binary())], ["sums"])

    sums = added_up(blocks.mapInArrow(run, "sums binary"), blocks.rdd.getNumPartitions(), shape)
    for slot, (k, node) in reversed(list(enumerate(wanted))):
        if node and slots[k, (node - 1) // 2] >= 0:
            sums[slots[k, (node - 1) // 2]] += sums[slot]
    return dict(zip(wanted, sums))


# ---- the model


@dataclass
class Model:
    features: list[Feature]
    labels: list[str]
    rounds: list[Trees]

    def predict(self, rows: DataFrame, keep: Iterable[str], out: str) -> DataFrame:
        """The columns ``keep`` and the predicted label. A table of any size, nothing is shuffled."""
        keep = list(dict.fromkeys(keep))
        needed = list(dict.fromkeys([*keep, *(f.name for f in self.features)]))
        model, trees = self, merged(self.rounds, _categorical(self.features), len(self.labels))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = pa.array(model.labels, pa.string())
            for batch in batches:
                best = model.margins(batch, trees).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([*map(batch.column, keep), names.take(pa.array(best))], [*keep, out])

        fields = [rows.schema[c] for c in keep]
        return rows.select(*needed).mapInArrow(run, StructType([*fields, StructField(out, StringType())]))

    def margins(self, batch: pa.RecordBatch, trees: list | None = None) -> np.ndarray:
        """(rows, classes). `trees`: the merged rounds, for callers with many batches."""
        out = np.zeros((len(self.labels), batch.num_rows))
        trees = trees or merged(self.rounds, _categorical(self.features), len(self.labels))
        add_to(out, encoded(self.features, batch), trees)
        return out.T

    def save(self, spark: SparkSession, path: str) -> None:
        """Two tables: one row for the shape, one row per node of all trees."""
        shape = {"labels": self.labels, "features": [asdict(f) for f in self.features]}
        spark.createDataFrame([(json.dumps(shape), len(self.rounds))], "shape string, rounds int").coalesce(
            1
        ).write.mode("overwrite").parquet(f"{path}/shape")
        nodes = [
            (r, k, i, int(t.feature[k, i]), int(t.cut[k, i]), float(t.value[k, i]))
            for r, t in enumerate(self.rounds)
            for k, i in zip(*map(np.ndarray.tolist, np.nonzero((t.feature >= 0) | (t.value != 0))))
        ]
        schema = "round int, class int, node int, feature int, cut int, value double"
        spark.createDataFrame(nodes, schema).write.mode("overwrite").parquet(f"{path}/nodes")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Model:
        row = spark.read.parquet(f"{path}/shape").first()
        shape = json.loads(row["shape"])
        features = [Feature(f["name"], f["categorical"], tuple(f["cuts"])) for f in shape["features"]]
        nodes = spark.read.parquet(f"{path}/nodes").collect()  # as many as the model has
        depth = max((n["node"] + 1 for n in nodes), default=1).bit_length() - 1
        rounds = [Trees.empty(len(shape["labels"]), depth) for _ in range(row["rounds"])]
        for r, k, i, feature, cut, value in nodes:
            rounds[r].feature[k, i], rounds[r].cut[k, i], rounds[r].value[k, i] = feature, cut, value
        return cls(features, shape["labels"], rounds)


def _categorical(features: list[Feature]) -> np.ndarray:
    return np.array([f.categorical for f in features], bool)


def fit_features(
    rows: DataFrame, numeric: Iterable[str], categorical: Iterable[str], label: str, bins: int
) -> tuple[list[Feature], list[str]]:
    """Bins and labels, in one aggregation: quantiles of the numbers, values of the categories."""
    numeric, categorical = list(numeric), list(categorical)
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(
        *[
            F.percentile_approx(F.col(c).cast("double"), shares, 20 * bins).alias(f"n{i}")
            for i, c in enumerate(numeric)
        ],
        *[F.collect_set(c).alias(f"c{i}") for i, c in enumerate([*categorical, label])],
    ).first()
    features = [Feature(c, False, tuple(sorted(set(found[f"n{i}"] or ())))) for i, c in enumerate(numeric)]
    features += [Feature(c, True, tuple(sorted(found[f"c{i}"]))) for i, c in enumerate(categorical)]
    return features, sorted(found[f"c{len(categorical)}"])


def fit(
    rows: DataFrame, numeric: Iterable[str], categorical: Iterable[str], label: str, how: Boosting = Boosting()
) -> Model:
    """Boosts on ``rows``; rows without a label are left out. At most rounds x depth passes, fewer where trees end
    early. Without features, all rounds are roots."""
    rows = rows.filter(F.col(label).isNotNull())
    features, labels = fit_features(rows, numeric, categorical, label, how.bins)
    if not labels:
        raise ValueError("no row has a label")
    if not features:
        features = [Feature(label, True, ())]  # a constant: one bin, which nothing splits
    categorical_ = _categorical(features)
    sizes = [f.bins() for f in features]
    state = first_state(rows, features, label, labels, how).persist()
    rounds: list[Trees] = []
    since: list[Trees] = []
    for _ in range(how.rounds):
        trees = grow(state, since, rounds[-1] if rounds else None, sizes, categorical_, len(labels), how)
        rounds.append(trees)
        since.append(trees)
        if len(since) == how.renew:
            old, state, since = state, renewed(state, since, categorical_, len(labels)).persist(), []
            old.unpersist()
    state.unpersist()
    return Model(features, labels, rounds)
