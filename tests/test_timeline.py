import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hindsight.operators.timeline import Timeline, Trailing, time_since, timeline_features

DAY = 86_400
SCHEMA = "person string, sec long, id string, result string, end long"


def expected(rows, depth=2, frames=(("day", DAY), ("week", 7 * DAY))):
    """Brute force over lists."""
    out = {}
    for r in rows:
        person, sec, rid, _, _ = r
        if sec is None:
            out[rid] = None
            continue
        mine = sorted((x for x in rows if x[0] == person and x[1] is not None), key=lambda x: (x[1], x[2]))
        at = mine.index(r)
        values = []
        for _, seconds in frames:
            window = [x for x in mine if sec - (seconds - 1) <= x[1] <= sec - 1]
            n = len(window)
            wins = sum(x[3] == "won" for x in window)
            values += [n, round(100.0 * wins / n + 1e-9, 2) if n else 0.0]
        values += [mine[at - i][3] if at >= i else None for i in range(1, depth + 1)]
        values.append(mine[at - 1][4] if at else None)
        out[rid] = values
    return out


@pytest.fixture(autouse=True)
def many_slices(spark):
    """Slices of a few rows: AQE would put so little data into one."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def run(spark, rows, slices=4, entity=("person",)):
    spark.conf.set("spark.sql.shuffle.partitions", slices)
    try:
        return features(spark, rows, entity)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def features(spark, rows, entity):
    df = spark.createDataFrame(rows, SCHEMA)
    won = {"win": F.col("result") == "won"}
    out = timeline_features(
        df,
        Timeline(entity, "sec", ("id",)),
        [Trailing("day", DAY, won), Trailing("week", 7 * DAY, won)],
        {"result": 2, "end": 1},
    )
    assert set(out.columns) == set(df.columns) | {
        "day_n", "day_win", "week_n", "week_win", "prev1_result", "prev2_result", "prev1_end",
    }
    return out


def as_dict(out):
    got = {}
    for r in out.collect():
        assert r["id"] not in got
        values = [r["day_n"], r["day_win"], r["week_n"], r["week_win"]]
        values += [r["prev1_result"], r["prev2_result"], r["prev1_end"]]
        got[r["id"]] = None if r["sec"] is None else values
        if r["sec"] is None:
            assert values == [None] * 7
    return got


def some_rows(n, seed, hot_share=0.4, span=20 * DAY, burst=0.2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        person = "hot" if rng.random() < hot_share else rng.choice(["a", "b", None])
        sec = 5 * DAY if rng.random() < burst else rng.randrange(span)
        if rng.random() < 0.02:
            sec = None
        rows.append((person, sec, f"r{i:05d}", rng.choice(["won", "draw", "lost"]), (sec or 0) + rng.randrange(900)))
    return rows


@pytest.mark.parametrize("slices", [1, 7, 40])
def test_equals_brute_force_at_any_cut(spark, slices):
    rows = some_rows(300, seed=slices)
    assert as_dict(run(spark, rows, slices)) == expected(rows)


def test_one_second_holding_a_third_of_all_rows_is_cut(spark):
    rows = some_rows(400, seed=5, hot_share=0.9, burst=0.4)
    assert as_dict(run(spark, rows, 8)) == expected(rows)


def test_global_timeline(spark):
    rows = [("x", *r[1:]) for r in some_rows(200, seed=9)]
    assert as_dict(run(spark, rows, 16, entity=())) == expected(rows)


def test_frame_edges(spark):
    rows = [("p", s, f"e{i}", "won", s) for i, s in enumerate([0, 0, 1, 86399, 86400])]
    for slices in (1, 5):
        got = as_dict(run(spark, rows, slices))
        assert [got[f"e{i}"][0] for i in range(5)] == [0, 0, 2, 3, 2]


def test_empty_frame_rate_is_zero_and_first_row_has_no_previous(spark):
    row = run(spark, [("p", 10, "a", "won", 20)]).first()
    assert (row["day_n"], row["day_win"], row["prev1_result"], row["prev1_end"]) == (0, 0.0, None, None)


def test_time_since_is_clamped_and_null_for_the_first(spark):
    df = spark.createDataFrame([(100, 50), (100, 150), (100, None)], "start long, prev long")
    assert [r[0] for r in df.select(time_since("start", "prev")).collect()] == [50.0, 0.0, None]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=st.lists(
        st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 3 * DAY), st.sampled_from(["won", "draw", "lost"])),
        min_size=1,
        max_size=30,
    ),
    slices=st.sampled_from([2, 8]),
)
def test_sliced_equals_brute_force(spark, data, slices):
    rows = [(p, s, f"r{i:03d}", r, s + 5) for i, (p, s, r) in enumerate(data)]
    assert as_dict(run(spark, rows, slices)) == expected(rows)


@pytest.mark.parametrize("slices", [1, 16])
def test_later_rows_never_change_earlier_ones(spark, slices):
    rows = [r for r in some_rows(160, seed=3) if r[1] is not None]
    cut = 8 * DAY
    before = as_dict(run(spark, [r for r in rows if r[1] < cut], slices))
    after = as_dict(run(spark, rows, slices))
    assert before == {k: after[k] for k in before}


def test_plans(spark):
    import contextlib
    import io

    def plan(df):
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            df.explain("simple")
        return text.getvalue()

    for entity in (("person",), ()):
        text = plan(run(spark, some_rows(200, seed=1), entity=entity))
        assert "NestedLoop" not in text and "Cartesian" not in text
        # The written slices are read for rows, edges and cells; what was given is not read again.
        assert text.count("LocalTableScan") + text.count("Scan ExistingRDD") == 0
        assert "array<" not in text


def test_a_busy_second_is_dealt_over_slices(spark):
    rows = [("x", 7 if i % 3 == 0 else i, f"r{i:04d}", "won", i) for i in range(900)]
    out = run(spark, rows, 9)
    assert as_dict(out) == expected(rows)
    spark.conf.set("spark.sql.shuffle.partitions", 9)
    busy = spark.createDataFrame(rows, SCHEMA).repartitionByRange("person", "sec", "id").where("sec = 7").select(F.spark_partition_id().alias("p"))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert busy.distinct().count() > 1
