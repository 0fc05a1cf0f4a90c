import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from hindsight.plans import training
from hindsight.sources.extract import MissingColumns, chronological, read_features

NAMES = ["a", "b", "TimeSinceLast"]
SCHEMA = "game_uuid string, start_ts timestamp, a double, b int, TimeSinceLast double, Result int"


@pytest.fixture(scope="module")
def features(spark):
    return spark.range(400).select(
        F.concat(F.lit("g"), "id").alias("game_uuid"),
        F.timestamp_seconds(F.col("id") * 60).alias("start_ts"),
        F.coalesce(F.col("id") % 3 + F.rand(1) / 4, F.lit(0.0)).alias("a"),
        F.coalesce((F.col("id") % 5).cast("int"), F.lit(0)).alias("b"),
        F.when(F.col("id") > 0, (F.col("id") % 90).cast("double")).alias("TimeSinceLast"),
        (F.col("id") % 3).cast("int").alias("Result"),
    )


@pytest.mark.parametrize("make", [lambda: training.forest(numTrees=5), lambda: training.logistic(maxIter=20)])
def test_training_learns_and_saves(spark, features, make, tmp_path):
    trained = training.train(features, make(), NAMES, view=None, trials=2, folds=2, multipliers={0: 1, 1: 1, 2: 1})
    row = training.evaluation(trained).first()
    assert row.rows == 40 and row.accuracy > 0.9 > row.majority_share
    assert len(trained.search_losses) == 2
    ranked = training.importances(trained).collect()
    assert {r.feature for r in ranked} == {*NAMES, "TimeSinceLast_missing"}
    assert [r["rank"] for r in ranked] == [1, 2, 3, 4]
    path = str(tmp_path / "model")
    training.save_artefacts(trained, path)
    assert spark.read.json(f"{path}/features").count() == 4
    assert PipelineModel.load(f"{path}/model").stages[0].getInputCols() == trained.features


def test_points_are_seeded_and_in_range():
    estimator = training.forest()
    points = training.random_points(estimator, 25)
    assert points == training.random_points(estimator, 25)
    assert all(3 <= p[estimator.maxDepth] <= 10 and 0.5 <= p[estimator.subsamplingRate] <= 1 for p in points)
    logistic = training.logistic()
    assert all(0 <= p[logistic.elasticNetParam] <= 1 for p in training.random_points(logistic, 25))


def test_gaps_are_filled_and_flagged(features):
    frame = training.model_frame(features, NAMES, keep=("game_uuid", "start_ts"))
    assert "a_missing" not in frame.columns  # its schema says that it is never null
    first = frame.orderBy("start_ts").first()
    assert (first.TimeSinceLast, first.TimeSinceLast_missing) == (0.0, 1.0)
    assert frame.where("game_uuid = 'g9'").first().TimeSinceLast == 1.0


def test_feature_sources_agree(spark, features, tmp_path):
    fixed = features.orderBy(F.rand(3))
    fixed.write.parquet(str(tmp_path / "t"))
    fixed.write.option("header", True).csv(str(tmp_path / "t.csv"))
    a = read_features(spark, str(tmp_path / "t"), NAMES)
    b = read_features(spark, str(tmp_path / "t.csv"), NAMES, SCHEMA)
    assert a.count() == b.count() == 400 and a.exceptAll(b).count() == 0
    assert [r.game_uuid for r in chronological(b, "start_ts", "game_uuid").take(3)] == ["g0", "g1", "g2"]
    with pytest.raises(MissingColumns, match="nope"):
        read_features(spark, str(tmp_path / "t"), ["nope"])


def test_any_nullable_feature_is_flagged(spark):
    table = spark.createDataFrame([("g", "a", None, 0), ("h", "a", 5.0, 1)], "game_uuid string, account_id string, TimeOfDay double, Result int")
    got = {r.game_uuid: (r.TimeOfDay, r.TimeOfDay_missing) for r in training.model_frame(table, ["TimeOfDay"], keep=("game_uuid",)).collect()}
    assert got == {"g": (0.0, 1.0), "h": (5.0, 0.0)}


def test_two_views_of_a_game_stay_together(spark):
    views = spark.range(300).selectExpr("concat('g', id div 2) group", "cast(id % 3 as double) label", "id")
    groups = views.groupBy("group").agg(F.min("label").alias("label"))
    drawn = training.stratified_folds(groups, "label", "group", 5).select("group", "fold")
    joined = views.join(drawn, "group").groupBy("group").agg(F.count_distinct("fold").alias("n"), F.count("*").alias("rows"))
    assert {(r.n, r.rows) for r in joined.collect()} == {(1, 2)}
