"""Features, split, training and scores of the classifier."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline import schemas
from faultline.operators import classify, summaries
from faultline.operators.classify import ClassifierConfig
from faultline.plans.cleaning_queries import NAMED_SQL, canon_name
from faultline.plans.inputs import table
from faultline.plans.registry import query
from faultline.session import shared_dir, stored
from faultline.sources.tables import read_table, write_checked, write_json


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as feature rows: some of transformers, some of type OTHER, some incomplete."""
    i, value = F.col("event_id"), F.col("value")
    k = (i % 77).cast("double")
    return table(spark, sf_dir, "events").select(
        i,
        F.concat(F.lit("F"), (F.col("user_id") % 18).cast("string")).alias("feeder_canonical"),
        F.when(i % 31 == 4, "OTHER").otherwise(F.col("event_type")).alias("outage_type_canonical"),
        F.when(i % 23 != 6, value).alias("duration_hours_num"),
        k.alias("load_loss_mw_num"),
        (i % 100).cast("double").alias("no_of_customers_restored_num"),
        (value * k).alias("customer_hours_interruption_num"),
        F.hour("ts").alias("event_no_num"),
        (i % 19 == 2).alias("is_transformer_event"),
        F.date_format("ts", "yyyy-MM").alias("source_month"),
    )


_FEATURES_SQL = """
features AS (
  SELECT event_id, 'F' || (user_id % 18) AS feeder_canonical,
         CASE WHEN event_id % 31 = 4 THEN 'OTHER' ELSE event_type END AS outage_type_canonical,
         CASE WHEN event_id % 23 <> 6 THEN value END AS duration_hours_num,
         CAST(event_id % 77 AS DOUBLE) AS load_loss_mw_num,
         CAST(event_id % 100 AS DOUBLE) AS no_of_customers_restored_num,
         value * CAST(event_id % 77 AS DOUBLE) AS customer_hours_interruption_num,
         CAST(hour(ts) AS INTEGER) AS event_no_num, event_id % 19 = 2 AS is_transformer_event,
         strftime(ts, '%Y-%m') AS source_month
  FROM events)
"""


@query(
    f"""WITH {_FEATURES_SQL}
    SELECT * FROM features
    WHERE NOT is_transformer_event AND outage_type_canonical <> 'OTHER'
      AND duration_hours_num IS NOT NULL"""
)
def feature_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.labeled_rows(_features(spark, sf_dir))


@query(
    """SELECT event_id, event_type, dense_rank() OVER (ORDER BY event_type) - 1 AS label_index
    FROM events"""
)
def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return classify.label_encode(events, "event_type", "label_index")


_FEEDERS = ("AGODI 1", "AGODI 2", "APATA", "APETE", "ELEYELE", "ERUWA TOWN", "ERUWA/LANLATE",
            "EXPRESS", "FAN MILK", "INDUSTRIAL", "INTERCHANGE", "IYAGANKU", "LIBERTY", "MINISTER",
            "OLUYOLE", "OMI ADIO", "ROM", "SAMONDA", "UNMAPPED")


@query(
    f"""WITH {NAMED_SQL}
    SELECT event_id, feeder_canonical, """
    + ", ".join(
        f"CAST(feeder_canonical = '{f}' AS INTEGER) AS \"feeder_{f}\"" for f in _FEEDERS
    )
    + " FROM named"
)
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = canon_name(spark, sf_dir).select("event_id", "feeder_canonical")
    return classify.one_hot(named, "feeder_canonical", list(_FEEDERS), "feeder")


_SPLIT_SQL = """
sizes AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1),
totals AS (SELECT sum(n) AS total, sum(n) - ceil(0.2 * sum(n)) AS n_train FROM sizes),
shares AS (
  SELECT event_type, n, floor(n * n_train / total) AS base,
         row_number() OVER (ORDER BY (n * n_train) % total DESC, event_type) AS turn,
         n_train - sum(floor(n * n_train / total)) OVER () AS spare
  FROM sizes, totals),
quota AS (
  SELECT event_type, n - base - CASE WHEN turn <= spare THEN 1 ELSE 0 END AS n_test FROM shares),
split AS (
  SELECT event_id, event_type, value,
         row_number() OVER (PARTITION BY event_type ORDER BY md5('42:' || event_id)) <= n_test
           AS is_test
  FROM events JOIN quota USING (event_type))
"""


@query(f"WITH {_SPLIT_SQL} SELECT event_id, event_type, value, is_test FROM split")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return classify.stratified_split(events, "event_type", "event_id")


@query(
    f"""WITH {_SPLIT_SQL}
    SELECT count(*) FILTER (NOT is_test) AS train_rows, count(*) FILTER (is_test) AS test_rows,
           list_aggregate(list_sort(list(DISTINCT event_type)), 'string_agg', ',') AS classes
    FROM split"""
)
def split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = classify.split_summary(stratified_split(spark, sf_dir), "event_type")
    return summary.withColumn("classes", F.array_join("classes", ","))


_CFG = ClassifierConfig(pass_through=("event_id", *ClassifierConfig().pass_through))
_PLAIN = ("duration_hours_num", "customer_hours_interruption_num")


def _learnable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature rows in which every number but two follows from the type, so that a sound
    encoder, model and label mapping must get every held-out row right."""
    code = F.col("outage_type_canonical")
    number = F.pmod(F.crc32(F.encode(code, "utf-8")), F.lit(1000))
    names = [c for c in classify.NUMERIC_FEATURES if c not in _PLAIN]
    shaped = {c: (number * (i + 1)).cast("int" if c == "event_no_num" else "double")
              for i, c in enumerate(names)}
    return classify.labeled_rows(_features(spark, sf_dir), _CFG).withColumns(shaped)


_LEARNED_SQL = f"""
{_FEATURES_SQL},
labeled AS (
  SELECT event_id, feeder_canonical, source_month, outage_type_canonical AS label FROM features
  WHERE NOT is_transformer_event AND outage_type_canonical <> 'OTHER'
    AND duration_hours_num IS NOT NULL),
sizes AS (SELECT label, count(*) AS n FROM labeled GROUP BY 1),
totals AS (SELECT sum(n) AS total, sum(n) - ceil(0.2 * sum(n)) AS n_train FROM sizes),
shares AS (
  SELECT label, n, floor(n * n_train / total) AS base,
         row_number() OVER (ORDER BY (n * n_train) % total DESC, label) AS turn,
         n_train - sum(floor(n * n_train / total)) OVER () AS spare
  FROM sizes, totals),
quota AS (
  SELECT label, n - base - CASE WHEN turn <= spare THEN 1 ELSE 0 END AS n_test FROM shares),
split AS (
  SELECT labeled.*,
         row_number() OVER (PARTITION BY label ORDER BY md5('42:' || event_id)) <= n_test AS is_test
  FROM labeled JOIN quota USING (label))
"""


@query(
    f"""WITH {_LEARNED_SQL}
    SELECT event_id, feeder_canonical, label AS outage_type_canonical, source_month,
           label AS predicted_outage_type, true AS correct
    FROM split WHERE is_test"""
)
def train_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions for the held-out rows, written, checked and read again."""
    predictions = classify.train_and_predict(_learnable(spark, sf_dir), "event_id", _CFG)[1]
    path = shared_dir(spark, "predictions")
    write_checked(spark, predictions, path)
    return read_table(spark, path, predictions.schema)


@query(
    f"""WITH {_LEARNED_SQL}
    SELECT CAST(1 AS DOUBLE) AS accuracy, count(*) FILTER (NOT is_test) AS train_rows,
           count(*) FILTER (is_test) AS test_rows,
           list_aggregate(list_sort(list(DISTINCT label)), 'string_agg', ',') AS classes,
           count(DISTINCT label) AS perfect_classes
    FROM split"""
)
def classifier_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics document of the model that was stored and read again, itself stored and read."""
    split = classify.stored_split(_learnable(spark, sf_dir), "event_id", _CFG)
    model = classify.train(split.filter(~F.col("is_test")), _CFG)
    path = shared_dir(spark, "classifier-model")
    classify.save_model(spark, model, path)
    loaded = classify.load_model(spark, path, _CFG)
    predictions = stored(classify.predict(loaded, split.filter("is_test"), _CFG), "predictions")
    path = shared_dir(spark, "classifier-metrics")
    write_json(classify.metrics_document(split, predictions, _CFG), path)
    scores = F.map_values("per_class")
    perfect = F.filter(scores, lambda x: (x["precision"] == 1) & (x["recall"] == 1) & (x["f1"] == 1))
    return spark.read.schema(schemas.METRICS).json(path).select(
        "accuracy",
        "train_rows",
        "test_rows",
        F.array_join("classes", ",").alias("classes"),
        F.size(perfect).cast("bigint").alias("perfect_classes"),
    )


@query(
    f"""WITH {_LEARNED_SQL.replace(
        "outage_type_canonical AS label FROM features",
        "CASE WHEN event_id % 5 < 3 THEN 'view' ELSE outage_type_canonical END AS label FROM features")}
    SELECT 'without_cause' AS features,
           count(*) FILTER (label = 'view') / CAST(count(*) AS DOUBLE) AS accuracy,
           count(*) AS test_rows
    FROM split WHERE is_test
    UNION ALL SELECT 'with_cause', 1.0, count(*) FROM split WHERE is_test"""
)
def ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy with and without a cause that fixes the type. The other features are constant,
    so without it the best a model can do is to name the most frequent type."""
    label = F.when(F.col("event_id") % 5 < 3, "view").otherwise(F.col("outage_type_canonical"))
    rows = classify.labeled_rows(_features(spark, sf_dir), _CFG).withColumns(
        {
            "outage_type_canonical": label,
            "feeder_canonical": F.lit("F"),
            **{c: F.lit(1).cast("int" if c == "event_no_num" else "double")
               for c in classify.NUMERIC_FEATURES},
        }
    )
    rows = rows.withColumn("cause", F.concat(F.lit("because of "), "outage_type_canonical"))
    variants = {
        "without_cause": replace(_CFG, categorical=()),
        "with_cause": replace(_CFG, categorical=("cause",)),
    }
    return classify.ablation(rows, "event_id", variants)


_PROBED = ("duration_hours_num", "load_loss_mw_num", "event_no_num")


@query(
    f"""WITH {_FEATURES_SQL},
    labeled AS (
      SELECT *, outage_type_canonical AS label,
             CASE WHEN event_id % 50 <> 0 THEN 'because of ' || outage_type_canonical END AS cause
      FROM features
      WHERE NOT is_transformer_event AND outage_type_canonical <> 'OTHER'
        AND duration_hours_num IS NOT NULL),
    ends AS (SELECT {", ".join(f"min({c})::DOUBLE AS low_{c}, max({c})::DOUBLE AS high_{c}" for c in _PROBED)}
             FROM labeled),
    cells AS (
      {" UNION ALL ".join(
          f"SELECT '{c}' AS feature, least(floor(({c}::DOUBLE - low_{c}) * 16 / (high_{c} - low_{c})), 15)"
          f"::BIGINT::VARCHAR AS value, label FROM labeled, ends" for c in _PROBED)}
      UNION ALL SELECT 'feeder_canonical', feeder_canonical, label FROM labeled
      UNION ALL SELECT 'cause', cause, label FROM labeled),
    counted AS (SELECT feature, value, label, count(*) AS n FROM cells GROUP BY ALL),
    shares AS (
      SELECT *, sum(n) OVER (PARTITION BY feature, value) AS of_value,
             sum(n) OVER (PARTITION BY feature) AS total,
             sum(n) OVER (PARTITION BY feature, label) AS of_label
      FROM counted),
    sums AS (
      SELECT feature, count(DISTINCT coalesce('=' || value, '')) AS n_values,
             sum(-n * log2(of_label / total::DOUBLE) / total) AS label_bits,
             sum(-n * log2(n / of_value::DOUBLE)) / any_value(total) AS bits_left
      FROM shares GROUP BY feature)
    SELECT feature, n_values, round(label_bits, 9) AS label_bits, round(bits_left, 9) AS bits_left,
           round(1 - bits_left / label_bits, 9) AS explained
    FROM sums"""
)
def leak_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each feature tells about the type; a cause that was filled in with it tells nearly all."""
    cause = F.concat(F.lit("because of "), "outage_type_canonical")
    rows = classify.labeled_rows(_features(spark, sf_dir), _CFG).withColumn(
        "cause", F.when(F.col("event_id") % 50 != 0, cause)
    )
    return classify.leak_probe(rows, classify.LABEL, _PROBED, ("feeder_canonical", "cause"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made-up predictions: some wrong, one class never actual, one never predicted."""
    i, actual = F.col("event_id"), F.col("event_type")
    predicted = (
        F.when(i % 50 == 1, "never seen")
        .when((i % 3 == 0) | (actual == "view"), "click")
        .otherwise(actual)
    )
    scored = table(spark, sf_dir, "events").select(
        "event_id",
        actual.alias("outage_type_canonical"),
        predicted.alias("predicted_outage_type"),
    )
    same = F.col("outage_type_canonical") == F.col("predicted_outage_type")
    return scored.withColumn("correct", same)


_SCORED_SQL = """
scored AS (
  SELECT *, actual = predicted AS correct
  FROM (SELECT event_id, event_type AS actual,
               CASE WHEN event_id % 50 = 1 THEN 'never seen'
                    WHEN event_id % 3 = 0 OR event_type = 'view' THEN 'click'
                    ELSE event_type END AS predicted
        FROM events))
"""


@query(
    f"""WITH {_SCORED_SQL}
    SELECT actual AS actual_outage_type, count(*) AS test_set_events,
           CAST(sum(CASE WHEN correct THEN 1 ELSE 0 END) AS BIGINT) AS correct_predictions,
           round(100.0 * sum(CASE WHEN correct THEN 1 ELSE 0 END) / count(*), 1) AS accuracy_pct
    FROM scored GROUP BY actual"""
)
def accuracy_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.accuracy_by_class(_scored(spark, sf_dir))


@query(
    f"""WITH {_SCORED_SQL}
    SELECT avg(CAST(correct AS INTEGER)) AS accuracy, count(*) AS test_rows FROM scored"""
)
def overall_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.overall_accuracy(_scored(spark, sf_dir))


@query(
    f"""WITH {_SCORED_SQL},
    classes AS (SELECT actual AS class FROM scored UNION SELECT predicted FROM scored),
    counts AS (
      SELECT class,
             (SELECT count(*) FROM scored WHERE actual = class AND correct) AS hits,
             (SELECT count(*) FROM scored WHERE actual = class) AS support,
             (SELECT count(*) FROM scored WHERE predicted = class) AS claimed
      FROM classes),
    scores AS (
      SELECT class, support,
             CASE WHEN claimed = 0 THEN 0 ELSE hits / CAST(claimed AS DOUBLE) END AS precision,
             CASE WHEN support = 0 THEN 0 ELSE hits / CAST(support AS DOUBLE) END AS recall
      FROM counts)
    SELECT class, precision, recall,
           CASE WHEN precision + recall = 0 THEN 0
                ELSE 2 * precision * recall / (precision + recall) END AS f1, support
    FROM scores"""
)
def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.class_report(_scored(spark, sf_dir))
