"""Splits, folds, weights, metrics and training."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from hindsight.config import MODEL_FEATURES
from hindsight.operators import metrics, splits
from hindsight.plans import training
from hindsight.session import stage
from hindsight.sources.extract import chronological
from querybook.base import Book, table
from querybook.layers import GOLD_SQL, features

book = Book()


def labelled(spark, sf_dir):
    """events with a class and a made-up predictor of it: fixed shares per event."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "ts",
        "user_id",
        "case when event_type in ('purchase', 'signup') then 0 when event_type = 'view' then 1 else 2 end label",
        "array((1 + event_id % 5) / 10.0D, (1 + event_id % 3) / 10.0D, "
        "1 - (1 + event_id % 5) / 10.0D - (1 + event_id % 3) / 10.0D) prob",
    )


LABELLED_SQL = """
l AS (SELECT event_id, ts, user_id, CASE WHEN event_type IN ('purchase', 'signup') THEN 0 WHEN event_type = 'view' THEN 1
             ELSE 2 END AS label, (1 + event_id % 5) / 10.0::DOUBLE AS p0, (1 + event_id % 3) / 10.0::DOUBLE AS p1
      FROM events),
c AS (SELECT *, 1 - p0 - p1 AS p2 FROM l),
d AS (SELECT *, CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS predicted FROM c)
"""


def predicted(spark, sf_dir):
    return labelled(spark, sf_dir).withColumn("predicted", metrics.arg_max("prob"))


@book.add(
    "SELECT event_id, CASE WHEN row_number() OVER (ORDER BY ts, event_id) <= "
    "floor((SELECT count(*) FROM events) * 0.9) THEN 'train' ELSE 'test' END AS split FROM events"
)
def chronological_split(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return splits.chronological_split(events, "ts", "event_id", 0.1, small=5_000).select("event_id", "split")


@book.add("""
WITH r AS (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) - 1 AS place, (SELECT count(*) FROM events) AS n FROM events),
f AS (SELECT unnest([1, 2, 3, 4]) AS fold), c AS (SELECT fold, n * fold // 5 AS first, n * (fold + 1) // 5 AS past, ts AS begun FROM f JOIN r ON place = n * fold // 5)
SELECT event_id, fold, 'test' AS side FROM r JOIN c ON place >= first AND place < past
UNION ALL SELECT event_id, fold, 'train' FROM r JOIN c ON place < first AND epoch_us(begun) - epoch_us(ts) >= 3600000000
""")
def forward_folds(spark, sf_dir):
    """Four expanding folds with an hour between training and test rows."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return splits.forward_folds(events, "ts", "event_id", 4, purge=3600, small=2_000).select("event_id", "fold", "side")


@book.add("SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS place FROM events", name="chronological_order")
def in_order(spark, sf_dir):
    """All events with their place in time, ties by id: places as the sorted extract has them."""
    ordered = chronological(table(spark, sf_dir, "events").select("event_id", "ts"), "ts", "event_id")
    # The sort's partitions follow each other; places are counted within each, on top of those before.
    placed = stage(ordered.withColumn("part", F.spark_partition_id()), "ordered")
    sizes = placed.groupBy("part").agg(F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    nth = F.row_number().over(Window.partitionBy("part").orderBy("ts", "event_id"))
    return placed.withColumn("nth", nth).join(starts, "part").select("event_id", (F.col("start") + F.col("nth")).alias("place"))


@book.add(f"WITH {LABELLED_SQL} SELECT label, count(*) AS rows FROM d GROUP BY label")
def label_counts(spark, sf_dir):
    return splits.label_counts(labelled(spark, sf_dir), "label")


@book.add(
    f"WITH {LABELLED_SQL}, n AS (SELECT label, count(*) AS rows FROM d GROUP BY label) SELECT label, rows, "
    "round((CASE WHEN label = 1 THEN 1 ELSE 100 END) * (SELECT sum(rows) FROM n)::DOUBLE / rows, 6) AS weight FROM n"
)
def class_weights(spark, sf_dir):
    weights = splits.class_weights(labelled(spark, sf_dir), "label", {0: 100, 1: 1, 2: 100})
    return weights.withColumn("weight", F.round("weight", 6))


@book.add(
    f"WITH {LABELLED_SQL}, n AS (SELECT label, count(*) AS rows FROM d GROUP BY label), w AS (SELECT label, "
    "(CASE WHEN label = 1 THEN 1 ELSE 100 END) * (SELECT sum(rows) FROM n)::DOUBLE / rows AS weight FROM n) "
    "SELECT event_id, label, round(weight, 6) AS weight FROM d JOIN w USING (label)"
)
def weighted_rows(spark, sf_dir):
    rows = labelled(spark, sf_dir).select("event_id", "label")
    weights = splits.class_weights(rows, "label", {0: 100, 1: 1, 2: 100})
    return splits.with_class_weights(rows, weights, "label").withColumn("weight", F.round("weight", 6))


@book.add(
    f"WITH {LABELLED_SQL}, h AS (SELECT event_id, label, ('0x' || substr(md5('999:' || event_id), 1, 15))::BIGINT AS h, "
    "(SELECT ceil(count(*) / 1000.0)::BIGINT FROM events) AS buckets FROM d) SELECT event_id, label, "
    "((row_number() OVER (PARTITION BY label ORDER BY h % buckets, h, event_id) - 1) % 10)::INT AS fold FROM h"
)
def strat_folds(spark, sf_dir):
    """The fold of every row: classes even to within one row, drawn by hash of the id."""
    rows = labelled(spark, sf_dir).select("event_id", "label")
    return splits.stratified_folds(rows, "label", "event_id", 10, seed=999, bucket_rows=1_000)


@book.add(f"WITH {LABELLED_SQL} SELECT label, predicted, count(*) AS rows FROM d GROUP BY ALL")
def confusion(spark, sf_dir):
    return metrics.confusion(predicted(spark, sf_dir), "label", "predicted")


@book.add(
    f"WITH {LABELLED_SQL} SELECT label, "
    + ", ".join(f"count(*) FILTER (predicted = {c}) AS predicted_{c}" for c in (0, 1, 2))
    + " FROM d GROUP BY label"
)
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(predicted(spark, sf_dir), "label", "predicted", [0, 1, 2])


@book.add(f"""
WITH {LABELLED_SQL}, k AS (SELECT unnest([0, 1, 2]) AS class),
s AS (SELECT class, count(*) FILTER (label = class) AS support, count(*) FILTER (predicted = class) AS named,
             count(*) FILTER (label = class AND predicted = class) AS hit FROM k, d GROUP BY class),
r AS (SELECT class::VARCHAR AS class, coalesce(hit / nullif(named, 0), 0.0) AS precision,
             coalesce(hit / nullif(support, 0), 0.0) AS recall, coalesce(2 * hit / nullif(named + support, 0), 0.0) AS f1,
             support FROM s),
u AS (SELECT * FROM r UNION ALL
  SELECT 'macro', avg(precision), avg(recall), avg(f1), sum(support) FROM r UNION ALL
  SELECT 'weighted', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
         sum(f1 * support) / sum(support), sum(support) FROM r)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       support::BIGINT AS support FROM u
""")
def class_report(spark, sf_dir):
    report = metrics.class_report(predicted(spark, sf_dir), "label", "predicted")
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@book.add(
    f"WITH {LABELLED_SQL} SELECT (event_id % 10)::INT AS fold, round(-avg(ln(greatest(2.220446049250313e-16, "
    "CASE label WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END))), 6) AS log_loss, count(*) AS rows FROM d GROUP BY fold"
)
def log_loss(spark, sf_dir):
    rows = labelled(spark, sf_dir).withColumn("fold", (F.col("event_id") % 10).cast("int"))
    return metrics.log_loss(rows, "label", "prob", ["fold"]).withColumn("log_loss", F.round("log_loss", 6))


@book.add(
    f"WITH {LABELLED_SQL} SELECT round(avg((label = predicted)::INT), 6) AS accuracy, count(*) AS rows, "
    "round((SELECT max(n) / sum(n) FROM (SELECT count(*) AS n FROM d GROUP BY label)), 6) AS majority_share FROM d"
)
def accuracy(spark, sf_dir):
    rows = predicted(spark, sf_dir)
    share = metrics.majority_baseline(rows, "label").scalar()
    found = metrics.accuracy(rows, "label", "predicted")
    return found.select(F.round("accuracy", 6).alias("accuracy"), "rows", F.round(share, 6).alias("majority_share"))


@book.add(
    f"WITH {GOLD_SQL} SELECT game_uuid, coalesce(round(log10(TimeSinceLast + 1), 6), 0.0::DOUBLE) AS since, "
    "(TimeSinceLast IS NULL)::INT::DOUBLE AS since_missing, coalesce(TimeOfDay, 0)::DOUBLE AS TimeOfDay, "
    "(TimeOfDay IS NULL)::INT::DOUBLE AS TimeOfDay_missing, account_id, Result::DOUBLE AS label, "
    + ", ".join(f"coalesce({c}, 0)::DOUBLE AS {c}" for c in MODEL_FEATURES if c not in ("TimeSinceLast", "TimeOfDay"))
    + " FROM gold"
)
def model_frame(spark, sf_dir):
    """Chosen features as doubles: logs taken, gaps filled and flagged."""
    frame = training.model_frame(stage(features(spark, sf_dir), "gold"))
    return frame.select(
        "game_uuid", "account_id", F.round("TimeSinceLast", 6).alias("since"), F.col("TimeSinceLast_missing").alias("since_missing"),
        "TimeOfDay_missing", *[c for c in MODEL_FEATURES if c != "TimeSinceLast"], "label",
    )


def _trained(spark, sf_dir):
    gold = stage(features(spark, sf_dir), "gold")
    return training.train(gold, training.forest(), trials=2, folds=2)


@book.add()
def train_eval(spark, sf_dir):
    """Search, weighted final fit and holdout scores over gold; an iterative fit has no SQL."""
    return training.evaluation(_trained(spark, sf_dir))


@book.add()
def feature_importances(spark, sf_dir):
    """Features of gold ranked by a fitted model; an iterative fit has no SQL."""
    return training.importances(_trained(spark, sf_dir))


@book.add()
def boosted_eval(spark, sf_dir):
    """Boosted trees over gold with early stopping, and their holdout scores; an iterative fit has no SQL."""
    gold = stage(features(spark, sf_dir), "gold")
    return training.evaluation(training.train_boosted(gold, trials=0))
