"""Outage-type classifier: split, features, training, prediction and scores."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import (
    IndexToString,
    OneHotEncoder,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.functions import rules
from faultline.operators import boosting
from faultline.operators.ranking import counted_before
from faultline.session import stored
from faultline.sources.tables import union_frames

NUMERIC_FEATURES = (
    "duration_hours_num",
    "load_loss_mw_num",
    "no_of_customers_restored_num",
    "customer_hours_interruption_num",
    "event_no_num",
)
LABEL = "outage_type_canonical"
ENTITY = "feeder_canonical"
# The split looks at the hex digits of a row's hash, so many at a time.
HASH_PREFIX = 4


@dataclass(frozen=True)
class ClassifierConfig:
    """`boosted`: softmax boosting of all classes at once; `forest`: a random forest."""

    kind: str = "boosted"
    numeric: tuple[str, ...] = NUMERIC_FEATURES
    categorical: tuple[str, ...] = (ENTITY,)
    label: str = LABEL
    depth: int = 6
    trees: int = 200
    learning_rate: float = 0.1
    seed: int = 42
    test_fraction: float = 0.2
    pass_through: tuple[str, ...] = field(default=(ENTITY, LABEL, "source_month"))


def labeled_rows(features: DataFrame, cfg: ClassifierConfig = ClassifierConfig()) -> DataFrame:
    """Rows to learn from: a named asset, a known type and no missing value."""
    named = features.filter(~F.col("is_transformer_event") & (F.col(cfg.label) != rules.OTHER))
    return named.dropna(subset=list(dict.fromkeys((*cfg.numeric, cfg.label, *cfg.categorical))))


def with_row_ids(df: DataFrame, out: str = "row_id") -> DataFrame:
    """The rows with a unique number each, read from a table in the shared folder.

    The numbers depend on how the input was partitioned, so they are written once: a lost
    executor then re-reads them and cannot move a row from training to test.
    """
    return stored(df.withColumn(out, F.monotonically_increasing_id()), "row-ids")


def _row_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))


def split_sizes(class_counts: DataFrame, label: str, test_fraction: float) -> DataFrame:
    """Training and test rows per class, from one row (label, n) per class.

    The test set has the given share of all rows, rounded up. Training rows are dealt in
    proportion to class size; rows left over by rounding go to the largest remainders, then
    in label order.
    """
    n, total = F.col("n"), F.col("__all.total")
    whole = class_counts.agg(
        F.struct(
            F.sum("n").alias("total"), F.count(F.lit(1)).alias("classes"), F.min("n").alias("least")
        )
    ).scalar()
    n_test = F.ceil(F.lit(test_fraction) * total).cast("bigint")
    problem = (
        F.when(F.col("__all.least") < 2, F.lit("a class has fewer than 2 rows"))
        .when(n_test < F.col("__all.classes"), F.lit("fewer test rows than classes"))
        .when(total - n_test < F.col("__all.classes"), F.lit("fewer training rows than classes"))
    )
    checked = F.when(problem.isNotNull(), F.raise_error(problem).cast("bigint")).otherwise(
        total - n_test
    )
    # The product of two row counts outgrows 64 bits.
    share = n.cast("decimal(19,0)") * F.col("__train").cast("decimal(19,0)")
    dealt = stored(
        class_counts.select(label, "n", whole.alias("__all"))
        .withColumn("__train", checked)
        .withColumn("__rest", (share % total).cast("bigint"))
        .withColumn("__floor", ((share - F.col("__rest")) / total).cast("bigint"))
        .withColumn("__one", F.lit(1))
        .select(label, "n", "__train", "__rest", "__floor", "__one"),
        "split-sizes",
    )
    left = dealt.agg(F.max("__train") - F.sum("__floor")).scalar()
    turns = counted_before(dealt, [F.col("__rest").desc(), F.col(label)], "__one", "__turn")
    train = F.col("__floor") + (F.col("__turn") < left).cast("bigint")
    return turns.select(label, "n", train.alias("n_train")).select(
        label, "n", "n_train", (n - F.col("n_train")).alias("n_test")
    )


def _cut(hashed: DataFrame, label: str, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of each class with the next digits of the hash at which its count is reached,
    and how many of these rows are still wanted. `wanted`: label, need."""
    rows = hashed.withColumn("__p", F.substring("__rest_of", 1, HASH_PREFIX))
    histogram = rows.groupBy(label, "__p").agg(F.count(F.lit(1)).alias("__m"))
    upto = F.sum("__m").over(Window.partitionBy(label).orderBy("__p"))
    before = F.col("__upto") - F.col("__m")
    cuts = (
        histogram.withColumn("__upto", upto)
        .join(wanted, label)
        .filter((before < F.col("need")) & (F.col("__upto") >= F.col("need")))
        .select(label, F.col("__p").alias("__cut"), (F.col("need") - before).alias("need"))
    )
    cuts = stored(cuts, "split-cuts")
    inside = rows.join(cuts.select(label, "__cut"), label).filter(F.col("__p") == F.col("__cut"))
    rest = F.substring("__rest_of", HASH_PREFIX + 1, 32)
    return (
        inside.select(label, "__h", rest.alias("__rest_of")),
        cuts.select(label, "need"),
    )


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    test_fraction: float = 0.2,
    seed: int = 42,
    out: str = "is_test",
) -> DataFrame:
    """Flag the test rows: per class, exactly the rows with the smallest hash of `key`.

    `key` is unique; rows without a label are never in the test. The classes may be of any
    size, and any number: no class is ever sorted. A histogram over 65,536 hash prefixes shows
    in which a class is cut; a second one over the next digits, of that prefix only, leaves
    the few rows that are ordered to find the last test hash. One hash per class returns to
    the rows by a join; Spark broadcasts it while there are few classes.
    """
    # The filter stands in every branch below, so that the histogram is computed once.
    labeled = df.filter(F.col(label).isNotNull())
    hashed = labeled.select(label, _row_hash(key, seed).alias("__h")).withColumn("__rest_of", F.col("__h"))
    counts = stored(hashed.groupBy(label).agg(F.count(F.lit(1)).alias("n")), "split-classes")
    sizes = split_sizes(counts, label, test_fraction)
    need = sizes.select(label, F.col("n_test").alias("need"))
    for _ in range(2):
        hashed, need = _cut(hashed, label, need)
    by_hash = Window.partitionBy(label).orderBy("__h")
    last = (
        hashed.join(need, label)
        .withColumn("__turn", F.row_number().over(by_hash))
        .filter(F.col("__turn") == F.col("need"))
        .select(label, F.col("__h").alias("__last"))
    )
    in_test = F.coalesce(_row_hash(key, seed) <= F.col("__last"), F.lit(False))
    return df.join(stored(last, "split-last"), label, "left").select(*df.columns, in_test.alias(out))


def split_summary(split: DataFrame, label: str, flag: str = "is_test") -> DataFrame:
    """Training rows, test rows and the sorted class list."""
    per_class = split.groupBy(label).agg(
        F.count_if(~F.col(flag)).alias("train"), F.count_if(F.col(flag)).alias("test")
    )
    return per_class.agg(
        F.sum("train").alias("train_rows"),
        F.sum("test").alias("test_rows"),
        F.array_sort(F.collect_list(label)).alias("classes"),
    )


def one_hot(df: DataFrame, column: str, values: list[str], prefix: str) -> DataFrame:
    """One 0/1 column per value, all values kept."""
    flags = {
        f"{prefix}_{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in values
    }
    return df.select("*", *[flag.alias(name) for name, flag in flags.items()])


def _indexer(df: DataFrame, column: str, out: str, unknown: str = "error") -> StringIndexerModel:
    """Numbers the sorted values of a column. They become part of the model."""
    indexer = StringIndexer(
        inputCol=column, outputCol=out, handleInvalid=unknown, stringOrderType="alphabetAsc"
    )
    return indexer.fit(df)


def label_encode(df: DataFrame, label: str, out: str) -> DataFrame:
    """Class numbers from 0 in sorted order of the labels; null for rows without one."""
    labels = df.select(label).distinct().filter(F.col(label).isNotNull())
    numbers = counted_before(labels.withColumn("__one", F.lit(1)), [F.col(label)], "__one", out)
    return df.join(numbers.select(label, out), label, "left").select(*df.columns, out)


def _train_forest(training: DataFrame, cfg: ClassifierConfig) -> PipelineModel:
    """Encode, assemble and fit; the model turns raw feature rows into named predictions."""
    labels = _indexer(training, cfg.label, "label_index")
    encoded = [f"{c}_onehot" for c in cfg.categorical]
    stages = []
    for c, hot in zip(cfg.categorical, encoded):
        stages.append(_indexer(training, c, f"{c}_index", unknown="keep"))
        stages.append(OneHotEncoder(inputCol=f"{c}_index", outputCol=hot, dropLast=False))
    stages += [
        VectorAssembler(inputCols=[*cfg.numeric, *encoded], outputCol="features"),
        labels,
        RandomForestClassifier(
            maxDepth=cfg.depth,
            numTrees=cfg.trees,
            seed=cfg.seed,
            featuresCol="features",
            labelCol="label_index",
        ),
        IndexToString(
            inputCol="prediction", outputCol="predicted_outage_type", labels=labels.labels
        ),
    ]
    return Pipeline(stages=stages).fit(training)


def train(
    training: DataFrame, cfg: ClassifierConfig = ClassifierConfig()
) -> boosting.Model | PipelineModel:
    if cfg.kind == "forest":
        return _train_forest(training, cfg)
    if cfg.kind != "boosted":
        raise ValueError(f"unknown classifier {cfg.kind!r}")
    how = boosting.Boosting(rounds=cfg.trees, depth=cfg.depth, rate=cfg.learning_rate)
    return boosting.fit(training, cfg.numeric, cfg.categorical, cfg.label, how)


def save_model(spark: SparkSession, model: boosting.Model | PipelineModel, path: str) -> None:
    if isinstance(model, boosting.Model):
        model.save(spark, path)
    else:
        model.write().overwrite().save(path)


def load_model(
    spark: SparkSession, path: str, cfg: ClassifierConfig = ClassifierConfig()
) -> boosting.Model | PipelineModel:
    """The stored model; `cfg.kind` says which one it is."""
    return PipelineModel.load(path) if cfg.kind == "forest" else boosting.Model.load(spark, path)


def predict(
    model: boosting.Model | PipelineModel,
    rows: DataFrame,
    cfg: ClassifierConfig = ClassifierConfig(),
) -> DataFrame:
    """Predicted class and whether it is right, with the columns that identify the row."""
    if isinstance(model, boosting.Model):
        scored = model.predict(rows, [*cfg.pass_through, cfg.label], "predicted_outage_type")
    else:
        scored = model.transform(rows)
    correct = F.col(cfg.label) == F.col("predicted_outage_type")
    return scored.select(*cfg.pass_through, "predicted_outage_type", correct.alias("correct"))


def overall_accuracy(predictions: DataFrame, correct: str = "correct") -> DataFrame:
    return predictions.agg(
        F.avg(F.col(correct).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("test_rows"),
    )


def class_report(
    predictions: DataFrame, actual: str = LABEL, predicted: str = "predicted_outage_type"
) -> DataFrame:
    """Precision, recall and F1 per class; 0 where a ratio has no cases.

    Every cell of the confusion table counts once for its actual and once for its predicted
    class, so one pass over the counts gives both sums.
    """
    cells = predictions.groupBy(actual, predicted).agg(F.count(F.lit(1)).alias("n"))
    n, none = F.col("n"), F.lit(0).cast("bigint")
    hit = F.when(F.col(actual) == F.col(predicted), n).otherwise(none)

    def entry(cls: str, hits: Column, support: Column, claimed: Column) -> Column:
        return F.struct(
            F.col(cls).alias("class"),
            hits.alias("hits"),
            support.alias("support"),
            claimed.alias("claimed"),
        )

    sides = F.array(entry(actual, hit, n, none), entry(predicted, none, none, n))
    sums = (
        cells.select(F.inline(sides))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("hits", "support", "claimed")])
    )
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide("hits", "claimed"), zero)
    recall = F.coalesce(F.try_divide("hits", "support"), zero)
    both = F.col("precision") + F.col("recall")
    return (
        sums.withColumns({"precision": precision, "recall": recall})
        .withColumn(
            "f1",
            F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), both), zero),
        )
        .select("class", "precision", "recall", "f1", "support")
    )


def metrics_document(split: DataFrame, predictions: DataFrame, cfg: ClassifierConfig) -> DataFrame:
    """One row: accuracy, row counts, classes and the scores of every class."""
    report = class_report(predictions, cfg.label)
    scores = F.struct("precision", "recall", "f1")
    per_class = report.agg(
        F.map_from_entries(F.collect_list(F.struct("class", scores))).alias("per_class")
    )
    rows = split_summary(split, cfg.label).select(F.struct("*")).scalar()
    return (
        overall_accuracy(predictions)
        .withColumns({"rows": rows, "per_class": per_class.scalar()})
        .select("accuracy", "rows.train_rows", "rows.test_rows", "rows.classes", "per_class")
    )


def stored_split(labeled: DataFrame, key: str, cfg: ClassifierConfig) -> DataFrame:
    """The split table, read from the shared folder: training passes over it many times, and
    no pass should hash and split the rows again. It is cut into pieces of Spark's advisory
    size, however few or uneven the input files were."""
    split = stratified_split(labeled, cfg.label, key, cfg.test_fraction, cfg.seed)
    return stored(split.hint("rebalance"), "split")


def leak_probe(
    labeled: DataFrame,
    label: str,
    numeric: tuple[str, ...] = (),
    categorical: tuple[str, ...] = (),
    bins: int = 16,
) -> DataFrame:
    """What each feature alone tells about the label, before anything is trained.

    One row per feature: its distinct values, the entropy of the label, what is left of it
    once the feature is known (both in bits), and the share that the feature explains. A share
    near 1 is the mark of a column that was filled in when the label was. Numbers are counted
    in `bins` of equal width, nulls as a value of their own; rows without a label are left out.

    The rows are read once after the ranges of the numbers are known, and shrink to one row
    per feature, value and class before they are shuffled.
    """
    rows = labeled.filter(F.col(label).isNotNull())
    ends = {c: F.struct(F.min(c).cast("double").alias("low"), F.max(c).cast("double").alias("high")) for c in numeric}
    if numeric:
        rows = rows.withColumn("__ends", rows.agg(F.struct(*[e.alias(c) for c, e in ends.items()])).scalar())

    def binned(c: str) -> Column:
        low, high = F.col(f"__ends.`{c}`.low"), F.col(f"__ends.`{c}`.high")
        at = F.try_divide((F.col(c).cast("double") - low) * bins, high - low)
        return F.when(F.col(c).isNotNull(), F.least(F.coalesce(F.floor(at), F.lit(0)), F.lit(bins - 1)))

    values = {**{c: binned(c) for c in numeric}, **{c: F.col(c) for c in categorical}}
    each = F.array(
        *[F.struct(F.lit(c).alias("feature"), v.cast("string").alias("value")) for c, v in values.items()]
    )
    cells = (
        rows.select(F.col(label).alias("__label"), F.inline(each))
        .groupBy("feature", "value", "__label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    cells = stored(cells, "leak-cells")
    known = cells.groupBy("feature", "value").agg(F.sum("n").alias("of_value"))
    same = (F.col("feature") == F.col("f")) & F.col("value").eqNullSafe(F.col("v"))
    known = known.select(F.col("feature").alias("f"), F.col("value").alias("v"), "of_value")
    left = cells.join(known, same).groupBy("feature").agg(
        F.sum(-F.col("n") * F.log2(F.col("n") / F.col("of_value"))).alias("bits"),
        F.sum("n").alias("rows"),
        F.count_distinct(F.coalesce(F.concat(F.lit("="), "value"), F.lit(""))).alias("n_values"),
    )
    classes = cells.groupBy("feature", "__label").agg(F.sum("n").alias("n"))
    totals = classes.groupBy("feature").agg(F.sum("n").alias("rows"))
    whole = classes.join(totals, "feature").groupBy("feature").agg(
        F.sum(-F.col("n") * F.log2(F.col("n") / F.col("rows")) / F.col("rows")).alias("label_bits")
    )
    rest = F.col("bits") / F.col("rows")
    told = F.coalesce(1 - F.try_divide(rest, F.col("label_bits")), F.lit(0.0))
    return left.join(whole, "feature").select(
        "feature",
        "n_values",
        F.round("label_bits", 9).alias("label_bits"),
        F.round(rest, 9).alias("bits_left"),
        F.round(told, 9).alias("explained"),
    )


def train_and_predict(
    labeled: DataFrame, key: str, cfg: ClassifierConfig = ClassifierConfig()
) -> tuple[boosting.Model | PipelineModel, DataFrame, DataFrame]:
    """(model, predictions on the held-out rows, the split table)."""
    split = stored_split(labeled, key, cfg)
    model = train(split.filter(~F.col("is_test")), cfg)
    return model, predict(model, split.filter("is_test"), cfg), split


def ablation(labeled: DataFrame, key: str, variants: dict[str, ClassifierConfig]) -> DataFrame:
    """Accuracy per feature list, on one split: what a suspect column adds."""
    split = stored_split(labeled, key, next(iter(variants.values())))
    scores = []
    for name, cfg in variants.items():
        model = train(split.filter(~F.col("is_test")), cfg)
        scored = overall_accuracy(predict(model, split.filter("is_test"), cfg))
        scores.append(scored.select(F.lit(name).alias("features"), "accuracy", "test_rows"))
    return union_frames(scores)
