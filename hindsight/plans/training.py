"""Model work on Spark ML: frame, search, final fit, evaluation, artefacts."""

from __future__ import annotations

import argparse
import math
import random
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hindsight.config import MODEL_FEATURES
from hindsight.operators import metrics
from hindsight.operators.splits import chronological_split, class_weights, stratified_folds, with_class_weights
from hindsight.plans.boosting import Boosted, Boosting, fit
from hindsight.plans.boosting import importances as gain_table
from hindsight.plans.search import Range, Search
from hindsight.session import stage
from hindsight.sources.extract import read_features, require_columns

# Weight multipliers of won, draw, lost.
MULTIPLIERS = {0: 100, 1: 1, 2: 100}


def log_scale(column: str):
    return F.log10(F.col(column) + 1)


def model_frame(
    table: DataFrame,
    features: Sequence[str] = MODEL_FEATURES,
    label: str = "Result",
    keep: Sequence[str] = ("game_uuid", "account_id", "start_ts"),
    log_of: Sequence[str] = ("TimeSinceLast",),
) -> DataFrame:
    """Named features as doubles with gaps filled and flagged, logs taken, and ``label``.

    MLlib takes no nulls: a feature that may be null, as its schema says,
    becomes 0 with a ``<name>_missing`` column beside it.
    """
    require_columns(table, [*features, label, *keep])
    nullable = {f.name for f in table.schema if f.nullable}
    columns = []
    for name in features:
        value = (log_scale(name) if name in log_of else F.col(name)).cast("double")
        columns.append(F.coalesce(value, F.lit(0.0)).alias(name))
        if name in nullable:
            columns.append(value.isNull().cast("double").alias(f"{name}_missing"))
    return table.select(*keep, *columns, F.col(label).cast("double").alias("label"))


def input_columns(frame: DataFrame, keep: Sequence[str]) -> list[str]:
    return [c for c in frame.columns if c not in {*keep, "label", "split", "fold", "weight"}]


def forest(seed: int = 999, **params) -> RandomForestClassifier:
    return RandomForestClassifier(seed=seed, featuresCol="features", labelCol="label", **params)


def logistic(**params) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol="label", family="multinomial", **params)


def _between(rng: random.Random, low: float, high: float, log: bool = False) -> float:
    return math.exp(rng.uniform(math.log(low), math.log(high))) if log else rng.uniform(low, high)


def random_points(estimator, n: int, seed: int = 999) -> list[dict]:
    """``n`` seeded random parameter maps over the ranges searched.

    Forest: depth, row and column sampling, least gain, least leaf size.
    Logistic: strength and mix of L1 and L2.
    """
    rng = random.Random(seed)
    points = []
    for _ in range(n):
        if isinstance(estimator, RandomForestClassifier):
            point = {
                estimator.maxDepth: rng.randint(3, 10),
                estimator.subsamplingRate: _between(rng, 0.5, 1.0),
                estimator.featureSubsetStrategy: str(round(_between(rng, 0.5, 1.0), 3)),
                estimator.minInfoGain: _between(rng, 1e-8, 1.0, log=True),
                estimator.minInstancesPerNode: rng.randint(1, 7),
            }
        else:
            l1, l2 = (_between(rng, 1e-8, 1.0, log=True) for _ in range(2))
            point = {estimator.regParam: l1 + l2, estimator.elasticNetParam: l1 / (l1 + l2)}
        points.append(point)
    return points


def random_search(
    train: DataFrame, estimator, trials: int = 25, folds: int = 10, seed: int = 999, parallelism: int = 4
) -> tuple[dict, list[float]]:
    """Parameters of the least mean validation log loss over stratified folds, and all means.

    ``train`` holds ``features``, ``label`` and a ``group``; rows of a group are in one fold, which
    is drawn by the least label among them.
    """
    groups = train.groupBy("group").agg(F.min("label").alias("label"))
    drawn = stratified_folds(groups, "label", "group", folds, seed).select("group", "fold")
    folded = stage(train.join(drawn, "group"), "folds")
    points = random_points(estimator, trials, seed)
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=points,
        evaluator=MulticlassClassificationEvaluator(metricName="logLoss"),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    ).fit(folded)
    means = list(search.avgMetrics)
    return points[means.index(min(means))], means


@dataclass
class Trained:
    model: PipelineModel | Boosted
    features: list[str]
    predictions: DataFrame
    search_losses: list[float]


def train(
    table: DataFrame,
    estimator=None,
    features: Sequence[str] = MODEL_FEATURES,
    label: str = "Result",
    time: str = "start_ts",
    group: str = "game_uuid",
    view: str | None = "account_id",
    test_share: float = 0.1,
    trials: int = 25,
    folds: int = 10,
    multipliers: dict | None = None,
    seed: int = 999,
) -> Trained:
    """Holdout by time, search on the training rows, weighted final fit, predictions on the holdout.

    A row is named by ``group`` and ``view``: a game that two tracked people
    played is two rows, which are always on the same side of the cut and in the
    same fold. Class weights enter the final fit only, not the search.
    """
    estimator = estimator or forest(seed)
    views = [view] if view else []
    keep = (group, *views, time)
    split = chronological_split(model_frame(table, features, label, keep), time, group, test_share)
    inputs = input_columns(split, keep)
    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    ready = assembler.transform(split).select(
        F.concat_ws("/", group, *views).alias("id"), F.col(group).alias("group"), "features", "label", "split"
    )
    # Written once: the search goes over it for every fold and every parameter set.
    ready = stage(ready, "model-frame")
    past, future = ready.where("split = 'train'"), ready.where("split = 'test'")
    losses: list[float] = []
    point: dict = {}
    if trials:
        point, losses = random_search(past, estimator, trials, folds, seed)
    weights = class_weights(past, "label", {float(k): v for k, v in (multipliers or MULTIPLIERS).items()})
    weighted = with_class_weights(past, weights, "label")
    fitted = estimator.copy(point).setWeightCol("weight").fit(weighted)
    model = PipelineModel(stages=[assembler, fitted])
    probability = vector_to_array("probability")
    predictions = fitted.transform(future).select("id", "label", probability.alias("prob"))
    predictions = predictions.withColumn("predicted", metrics.arg_max("prob"))
    return Trained(model, inputs, predictions.withColumn("label", F.col("label").cast("int")), losses)


#: What is searched for boosted trees.
BOOSTED_RANGES = {
    "depth": Range(2, 7, whole=True), "rate": Range(0.02, 0.5, log=True), "shrinkage": Range(0.1, 20.0, log=True),
    "least_cover": Range(1.0, 50.0, log=True), "least_gain": Range(1e-6, 1.0, log=True),
}


def train_boosted(
    table: DataFrame,
    features: Sequence[str] = MODEL_FEATURES,
    label: str = "Result",
    time: str = "start_ts",
    group: str = "game_uuid",
    view: str | None = "account_id",
    test_share: float = 0.1,
    trials: int = 25,
    multipliers: dict | None = None,
    seed: int = 999,
    settings: Boosting = Boosting(),
    log_of: Sequence[str] = ("TimeSinceLast",),
) -> Trained:
    """The same with boosted trees, which take gaps as they are and stop early.

    Rows are held out by time twice: the newest for evaluation, and of the others
    the newest to stop by. Trials differ in ``BOOSTED_RANGES``, each chosen by the
    losses before it. Class weights enter the final fit only, which runs as
    many rounds as the best trial found right.
    """
    views = [view] if view else []
    require_columns(table, [*features, label, group, *views, time])
    values = [(log_scale(f) if f in log_of else F.col(f)).cast("double").alias(f) for f in features]
    frame = table.select(F.concat_ws("/", group, *views).alias("id"), F.col(group).alias("group"), time, *values, F.col(label).cast("int").alias("label"))
    split = stage(chronological_split(frame, time, "group", test_share), "model-frame")
    past, future = split.where("split = 'train'").drop("split"), split.where("split = 'test'")
    past = stage(chronological_split(past, time, "group", test_share).withColumn("valid", F.col("split") == "test"), "past")

    def loss(point: dict) -> float:
        return min(fit(past, features, valid="valid", s=replace(settings, **point)).losses, default=math.inf)

    point, losses = Search(BOOSTED_RANGES, seed).run(loss, trials)
    chosen = replace(settings, **point)
    stopped = fit(past, features, valid="valid", s=chosen)
    rounds = len(stopped.trees)
    weights = class_weights(past, "label", {k: float(v) for k, v in (multipliers or {}).items()})
    model = replace(fit(with_class_weights(past, weights, "label"), features, weight="weight", s=replace(chosen, rounds=rounds)), losses=stopped.losses) if multipliers else stopped
    predictions = model.predict(future).select("id", "label", "prob").withColumn("predicted", metrics.arg_max("prob"))
    return Trained(model, list(features), predictions, losses)


def importances(trained: Trained) -> DataFrame:
    """Features ranked by importance; one row per feature, as many as the model has.

    For boosted trees that is total gain; ``boosting.importances`` has the other measures.
    """
    if isinstance(trained.model, Boosted):
        spark = trained.predictions.sparkSession
        gains = {r["feature"]: r["total_gain"] for r in gain_table(trained.model.nodes(spark)).collect()}
        rows = sorted(((n, gains.get(n, 0.0)) for n in trained.features), key=lambda pair: (-pair[1], pair[0]))
        return spark.createDataFrame([(i + 1, n, float(v)) for i, (n, v) in enumerate(rows)], "rank int, feature string, importance double")
    fitted = trained.model.stages[-1]
    if hasattr(fitted, "featureImportances"):
        values = fitted.featureImportances.toArray().tolist()
    else:
        values = abs(fitted.coefficientMatrix.toArray()).sum(axis=0).tolist()
    rows = sorted(zip(trained.features, values), key=lambda pair: (-pair[1], pair[0]))
    spark = trained.predictions.sparkSession
    return spark.createDataFrame([(i + 1, n, float(v)) for i, (n, v) in enumerate(rows)], "rank int, feature string, importance double")


def evaluation(trained: Trained) -> DataFrame:
    """Holdout log loss, accuracy and majority share in one row."""
    loss = metrics.log_loss(trained.predictions, "label", "prob")
    right = metrics.accuracy(trained.predictions, "label", "predicted").select("accuracy")
    base = metrics.majority_baseline(trained.predictions, "label")
    return loss.select("log_loss", right.scalar().alias("accuracy"), base.scalar().alias("majority_share"), "rows")


def save_artefacts(trained: Trained, path: str) -> None:
    """Model, its exact feature list, importances and confusion counts below ``path``."""
    spark = trained.predictions.sparkSession
    if isinstance(trained.model, Boosted):
        trained.model.save(spark, f"{path}/model")
    else:
        trained.model.write().overwrite().save(f"{path}/model")
    names = spark.createDataFrame(list(enumerate(trained.features)), "position int, feature string")
    names.coalesce(1).write.mode("overwrite").json(f"{path}/features")
    importances(trained).coalesce(1).write.mode("overwrite").json(f"{path}/importances")
    confusion = metrics.confusion(trained.predictions, "label", "predicted")
    confusion.write.mode("overwrite").parquet(f"{path}/confusion")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--features", required=True, help="gold feature table, Parquet")
    parser.add_argument("--out", required=True, help="folder for model, feature list, importances, confusion counts")
    parser.add_argument("--model", choices=["forest", "logistic", "boosted"], default="boosted")
    parser.add_argument("--trials", type=int, default=25)
    parser.add_argument("--folds", type=int, default=10)
    parser.add_argument("--test-share", type=float, default=0.1)
    parser.add_argument("--seed", type=int, default=999)
    args = parser.parse_args()
    spark = SparkSession.builder.appName("hindsight-train").getOrCreate()
    table = read_features(spark, args.features, [*MODEL_FEATURES, "Result", "game_uuid", "account_id", "start_ts"])
    if args.model == "boosted":
        trained = train_boosted(table, test_share=args.test_share, trials=args.trials, multipliers=MULTIPLIERS, seed=args.seed)
    else:
        estimator = forest(args.seed) if args.model == "forest" else logistic()
        trained = train(table, estimator, test_share=args.test_share, trials=args.trials, folds=args.folds, seed=args.seed)
    save_artefacts(trained, args.out)
    print(evaluation(trained).first().asDict())


if __name__ == "__main__":
    main()
