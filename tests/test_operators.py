import math
import random

import pytest
from pyspark.sql import functions as F

from hindsight.functions.encode import one_hot
from hindsight.functions.text import attribute, header, names, path_value
from hindsight.operators import checks as q
from hindsight.operators import metrics, profile, splits
from hindsight.operators.latest import latest_per_key
from hindsight.operators.sequence import sequence_aggregates


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_latest_keeps_one_of_a_key_held_by_most_rows(spark):
    hot = spark.range(5000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    rest = spark.range(100).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v"))
    out = latest_per_key(hot.union(rest), ["k"], ["v"])
    assert out.count() == 101
    assert out.where("k = 'hot'").first().v == 4999


def test_text_helpers(spark):
    row = (
        spark.createDataFrame([(' A ,, b,"', '[ECO "B10"]', "/x/username=me/f", '<a lang="fr">')], "a string, b string, c string, d string")
        .select(
            names("a").alias("names"),
            header("b", "ECO").alias("eco"),
            header("b", "UTCDate").alias("none"),
            path_value("c", "username").alias("user"),
            path_value("c", "year").alias("year"),
            attribute("d", "lang").alias("lang"),
        )
        .first()
    )
    assert tuple(row) == (["a", "b", '"'], "B10", None, "me", "", "fr")


def test_one_hot_null_goes_to_other(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    out = df.select(*one_hot("c", ["a", "b"], "is_", other="other")).collect()
    assert [tuple(r) for r in out] == [(1, 0, 0), (0, 0, 1), (0, 0, 1)]


def test_sequence_aggregates_keep_a_null_last_value(spark):
    rows = [("s", 1, True, 5.0), ("s", 2, False, 7.0), ("s", 3, True, None), ("t", 1, None, 1.0)]
    df = spark.createDataFrame(rows, "k string, ply int, mine boolean, clock double")
    out = {r.k: r for r in sequence_aggregates(df, ["k"], F.col("mine"), "ply", {"clock": "clock"}).collect()}
    assert (out["s"].my_moves, out["s"].my_last_clock, out["s"].opp_last_clock) == (2, None, 7.0)
    assert (out["t"].my_moves, out["t"].opp_moves) == (0, 0)


# --- checks ---------------------------------------------------------------------


def test_report_is_whole_and_then_raises(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "k string, v int")
    parts = [
        q.check_unique(df, "unique", ["k"]),
        q.check_rows(df, [q.Floor("many", 2), q.in_domain("known", "k", ["a"]), q.in_domain("lax", "k", ["a"], null_ok=True)]),
        q.check_columns(df, "columns", {"k": "string", "v": "string", "w": "int"}),
        q.check_width(df, "width", 2),
        q.check_same_count(df, df, "same"),
        q.check_orphans(df, df.where("v = 1"), "orphans", ["k"]),
        q.check_reconciled(df, df.where("v = 1"), "reconciled", ["k"]),
    ]
    report = q.combine(parts)
    got = {r["name"]: (r["ok"], r["detail"]) for r in report.collect()}
    assert {n for n, (ok, _) in got.items() if not ok} == {"unique", "known", "columns", "orphans", "reconciled"}
    assert got["columns"][1] == "missing: ['w'], mistyped: ['v is int']"
    assert got["orphans"][1] == "1 orphan rows"
    assert got["reconciled"][1] == "1 keys missing, 0 keys extra"
    with pytest.raises(q.ChecksFailed) as failed:
        q.enforce(report)
    assert len(failed.value.failed) == 5
    assert len(q.enforce(report.where("ok"))) == 4


def test_null_bound_per_person(spark):
    df = spark.createDataFrame([("p", None), ("p", 1), ("q", None), ("q", None)], "person string, v int")
    rule = q.null_bound("first", "v", per="person")
    assert values(q.check_rows(df, [rule])) == [("first", False, "1 values of person with more than 1 bad rows")]
    assert q.check_rows(df.limit(3), [rule]).first().ok
    # Two nulls of one person are too many, although another has none.
    uneven = spark.createDataFrame([("p", None), ("p", None), ("q", 1)], "person string, v int")
    assert not q.check_rows(uneven, [rule]).first().ok
    both = q.check_rows(uneven, [rule, q.Floor("rows", 3)])
    assert {r["name"]: r["ok"] for r in both.collect()} == {"first": False, "rows": True}


# --- profile --------------------------------------------------------------------


def test_missing_dimension_counts_as_question_mark(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), ("a", "x")], "acct string, d string")
    counts = profile.value_counts(df, ["acct"], ["d"])
    assert values(counts) == [("a", "d", "?", 1), ("a", "d", "x", 2)]
    assert values(profile.top_values(counts, ["acct", "dimension"], 1)) == [("a", "d", "x", 2, 1)]


def test_compare_rates_of_an_empty_group(spark):
    df = spark.createDataFrame([(False, True), (False, False)], "g boolean, h boolean")
    row = profile.compare_rates(df, F.col("g"), F.col("h")).first()
    assert (row.n_in, row.rate_in, row.rate_out, row.z_score) == (0, None, 0.5, None)


# --- splits ---------------------------------------------------------------------


@pytest.mark.parametrize("case", ["spread", "one instant", "few instants", "with nulls"])
def test_nth_key_equals_a_sort(spark, case):
    rng = random.Random(case)
    times = {"spread": range(5000), "one instant": [7], "few instants": [1, 2, 3], "with nulls": [None, 4, 9]}[case]
    rows = [(rng.choice(list(times)), i) for i in range(900)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "t long, id int").repartition(4)
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    for n in (0, 450, 899):
        key = splits.nth_key(df, ["t", "id"], n, small=40)
        assert (key["v0"], key["v1"]) == ordered[n]
    assert splits.nth_key(df, ["t", "id"], 900) is None


def test_nth_key_of_equal_rows_ends(spark):
    df = spark.range(600).select(F.lit(1).alias("t"), F.lit(1).alias("id")).union(spark.createDataFrame([(2, 2)], "t int, id int"))
    assert splits.nth_key(df, ["t", "id"], 300, small=10)["v1"] == 1
    assert splits.nth_key(df, ["t", "id"], 600, small=10)["v1"] == 2


def test_split_is_chronological_and_exact(spark):
    df = spark.createDataFrame([(i * 7 % 1000, i) for i in range(1000)], "t long, id long")
    out = splits.chronological_split(df, "t", "id", 0.1, small=50)
    assert values(out.groupBy("split").agg(F.count("*"), F.min("t"), F.max("t"))) == [("test", 100, 900, 999), ("train", 900, 0, 899)]
    assert splits.chronological_split(df, "t", "id", 0.0).where("split = 'test'").count() == 0


@pytest.mark.parametrize("bucket_rows", [50, 100_000])
def test_folds_are_even_per_class_and_repeatable(spark, bucket_rows):
    df = spark.range(1003).select("id", F.when(F.col("id") < 800, 0).when(F.col("id") < 1000, 1).alias("label"))
    folds = splits.stratified_folds(df, "label", "id", 10, bucket_rows=bucket_rows)
    sizes = folds.groupBy("label", "fold").count().collect()
    by_label = {}
    for r in sizes:
        by_label.setdefault(r["label"], []).append(r["count"])
    assert sorted(by_label[0]) == [80] * 10 and sorted(by_label[1]) == [20] * 10 and sorted(by_label[None]) == [1, 1, 1]
    again = splits.stratified_folds(df.repartition(7), "label", "id", 10, bucket_rows=bucket_rows)
    assert values(folds) == values(again)


def test_absent_class_has_no_weight(spark):
    df = spark.createDataFrame([(0,), (0,), (2,)], "label int")
    out = splits.class_weights(df, "label", {0: 100, 1: 1, 2: 100})
    assert values(out) == [(0, 2, 150.0), (2, 1, 300.0)]


# --- metrics --------------------------------------------------------------------


def test_metrics_by_hand(spark):
    rows = [(0, [0.7, 0.2, 0.1]), (1, [0.5, 0.3, 0.2]), (2, [0.0, 0.0, 1.0]), (0, [0.0, 1.0, 0.0])]
    df = spark.createDataFrame(rows, "label int, prob array<double>").withColumn("predicted", metrics.arg_max("prob"))
    eps = metrics.EPSILON
    loss = metrics.log_loss(df, "label", "prob").first().log_loss
    assert loss == pytest.approx(-(math.log(0.7) + math.log(0.3) + math.log(1 - eps) + math.log(eps)) / 4)
    assert metrics.accuracy(df, "label", "predicted").first().accuracy == 0.5
    report = {r["class"]: tuple(r)[1:] for r in metrics.class_report(df, "label", "predicted").collect()}
    assert report["0"] == (0.5, 0.5, 0.5, 2)
    assert report["1"] == (0.0, 0.0, 0.0, 1)
    assert report["2"] == (1.0, 1.0, 1.0, 1)
    assert report["macro"] == (0.5, 0.5, 0.5, 4) and report["weighted"] == (0.5, 0.5, 0.5, 4)
    matrix = metrics.confusion_matrix(df, "label", "predicted", [0, 1, 2])
    assert values(matrix) == [(0, 1, 1, 0), (1, 1, 0, 0), (2, 0, 0, 1)]


def test_watched_rules_equal_counted_ones(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "if(id % 7 = 0, null, cast(id % 3 as string)) k").repartition(5)
    rules = [q.Floor("many", 50), q.Floor("few", 90, F.col("id") > 20), q.in_domain("known", "k", ["0", "1"]), q.in_domain("lax", "k", ["0", "1", "2"], null_ok=True)]
    watch = q.Watch(df, rules)
    watch.rows.write.parquet(str(tmp_path / "out"))
    assert watch.report().collect() == q.check_rows(df, rules).collect()
    assert watch.count() == 100 and watch.count("few") == 79
    with pytest.raises(ValueError):
        q.Watch(df, [q.null_bound("first", "k", per="id")])
    broken = {(r["rule"], r["id"]) for r in q.offending_rows(df, rules[2:], ["id"]).collect()}
    assert broken == {("known", i) for i in range(100) if i % 7 == 0 or i % 3 == 2}


def test_lineage_names_each_offender(spark):
    source = spark.createDataFrame([("a",), ("a",), ("b",), ("lost",), (None,)], "k string")
    parents = spark.createDataFrame([("a",), ("b",), ("b",), ("new",), (None,)], "k string")
    far = q.POSITIONS + 5
    moves = [("a", i) for i in (0, 1, 63, 64, 64, 64, 1023)] + [("a", far), ("a", far), ("a", None), ("orphan", 1), ("orphan", 2), (None, 7), (None, 7)]
    lineage = q.Lineage(source, parents, spark.createDataFrame(moves, "k string, at int"), ["k"], "at")
    got = sorted(((r["problem"], r["k"], r["rows"]) for r in lineage.offenders().collect()), key=str)
    want = [("missing", "lost", 1), ("extra", "new", 1), ("repeated", "b", 2), ("orphan", "orphan", 2), ("repeated child", "a", 2), ("repeated child", "a", 1), ("repeated child", None, 1)]
    assert got == sorted(want, key=str)
    report = {r["name"]: (r["ok"], r["detail"]) for r in lineage.check("u", "r", "c", "o").collect()}
    assert report == {"u": (False, "1 repeated keys"), "r": (False, "1 keys missing, 1 keys extra"), "c": (False, "4 rows repeat a key"), "o": (False, "2 orphan rows")}
    clean = q.Lineage(source.limit(0), parents.limit(0), lineage.children.limit(0), ["k"], "at").check("u", "r", "c", "o")
    assert all(r["ok"] for r in clean.collect())


def test_report_counts_repeated_keys_of_moves(spark):
    from hindsight.plans.checks import layer_report
    from hindsight.schemas import BRONZE, MOVES_CONTRACT
    from querybook import layers

    assert layers.LEAST_POPULATION == 5_769 and "0 repeated keys" in layers.book.sql["check_report"] and "pop >= 5769" in layers.book.sql["check_report"]
    games = spark.createDataFrame([("g", "a", "chess", "won")], "game_uuid string, account string, rules string, result string").selectExpr(
        "*", "true rated", "'rapid' time_class", "false is_friend", "false is_self_play", "current_timestamp() start_ts")
    moves = spark.createDataFrame([("g", "a", p) for p in (1, 1, 1, 2, 2, 3)], "game_uuid string, account string, ply int")
    moves = moves.selectExpr("*", *[f"cast(null as {t}) {c}" for c, t in MOVES_CONTRACT.items() if c not in moves.columns])
    openings = [f"0 {c}" for c in ("ECO_A00", "ECO_B01", "ECO_C00", "ECO_D00", "ECO_Other")]
    gold = games.selectExpr("game_uuid", "account account_id", "'p' person_id", "start_ts", "1.0D TimeSinceLast", *openings)
    from hindsight.config import Settings

    report = layer_report(spark.createDataFrame([], BRONZE), games, moves, gold, Settings(openings=("A00", "B01", "C00", "D00")))
    assert {r["name"]: r["detail"] for r in report.collect()}["moves key uniqueness"] == "2 repeated keys"


def test_games_are_made_once_for_rates_after_losses(spark, monkeypatch):
    from querybook import quality

    staged, made = [], spark.range(1)
    monkeypatch.setattr(quality, "games", lambda *_: made)
    monkeypatch.setattr(quality, "stage", lambda df, name: staged.append(df) or "written")
    monkeypatch.setattr(quality.reports, "win_rate_after_losses", lambda games: games)
    assert quality.rate_after_losses(spark, "") == "written" and staged == [made]
