import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hindsight.operators import sketches as s
from hindsight.sources.tables import VersionedTable

SCHEMA = "month string, value string, extra long"


@pytest.fixture(scope="module")
def rows():
    """Zipf-like values over three months, some null, one month of nulls only."""
    draw = random.Random(3)
    made = [(f"m{i % 3}", f"v{int(1 / (draw.random() + 1e-4))}" if draw.random() > 0.1 else None, i) for i in range(30_000)]
    made += [("m0", f"only{i}", i) for i in range(20_000)]  # many values that are there once
    return made + [("nulls", None, 0), (None, "v1", 1)]


def test_merged_equals_one_over_everything(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    by_month = s.sketched(df, ["month"], ["value", "extra"])
    whole = s.distinct_values(s.merged(s.sketched(df, [], ["value", "extra"]), [], ["value", "extra"]), [], ["value", "extra"])
    parts = s.distinct_values(s.merged(by_month, [], ["value", "extra"]), [], ["value", "extra"])
    twice = s.merged(s.merged(by_month.unionByName(by_month), ["month"], ["value", "extra"]), [], ["value", "extra"])
    single = s.distinct_values(s.sketched(df.coalesce(1), [], ["value", "extra"]), [], ["value", "extra"])  # never merged
    as_set = lambda d: {(r.column, r.estimate, r.low, r.high) for r in d.collect()}
    assert as_set(whole) == as_set(single) == as_set(parts) == as_set(s.distinct_values(twice, [], ["value", "extra"]))
    exact = {"value": len({v for _, v, _ in rows if v is not None}), "extra": len({e for _, _, e in rows})}
    for r in parts.collect():
        assert r.low <= exact[r.column] <= r.high
        assert r.high - r.low < 0.08 * exact[r.column]


def test_nulls_and_empty(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.month: (r.known, r.estimate) for r in s.distinct_values(s.sketched(df, ["month"], ["value"]), ["month"], ["value"]).collect()}
    assert got["nulls"] == (0, 0)
    assert got[None] == (1, 1)
    none = df.limit(0)
    assert s.distinct_values(s.merged(s.sketched(none, ["month"], ["value"]), ["month"], ["value"]), ["month"], ["value"]).count() == 0


@pytest.mark.parametrize("tracked", [96, 6_000])
def test_counts_lie_in_their_range(spark, rows, tracked):
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    merged = s.merged(s.sketched(df, ["month"], ["value"], tracked=tracked), [], ["value"], tracked)
    exact = Counter(v for _, v, _ in rows if v is not None)
    found = s.frequent_values(merged, [], "value", tracked).collect()
    assert found
    for r in found:
        assert r.at_least <= exact[r.value] <= r.at_most
    error = 3.5 * sum(exact.values()) / s.counters(tracked)
    assert {v for v, n in exact.items() if n > 2 * error} <= {r.value for r in found}


def test_heavy_values_are_exact(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    stored = s.sketched(df, ["month"], ["value"], tracked=200)
    got = {(r.month, r.value): r.rows for r in s.heavy_values(df, stored, ["month"], "value", 50, tracked=200).collect()}
    exact = Counter((m, v) for m, v, _ in rows if v is not None)
    known = Counter(m for m, v, _ in rows if v is not None)
    assert got == {k: n for k, n in exact.items() if n * 50 >= known[k[0]]}
    assert (None, "v1") in got
    with pytest.raises(ValueError):
        s.heavy_values(df, stored, ["month"], "value", 100, tracked=200)


def test_refresh_replaces_touched_months_alone(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, SCHEMA)
    store = VersionedTable(spark, str(tmp_path / "sketches"))
    s.refreshed(store, df.where("month <> 'm2' or month is null"), ["month"], ["value"])
    before = {r.month: r.value for r in store.read().collect()}
    late = spark.createDataFrame([("m1", f"late{i}", i) for i in range(500)], SCHEMA)
    now = df.unionByName(late)
    s.refreshed(store, now.where("month in ('m1', 'm2')"), ["month"], ["value"])
    s.refreshed(store, now.where("month in ('m1', 'm2')"), ["month"], ["value"])  # again: no change
    after = {r.month: r.value for r in store.read().collect()}
    assert {m for m in before if before[m] != after[m]} == {"m1"}
    estimates = lambda d: {(r.month, r.known, r.estimate) for r in s.distinct_values(d, ["month"], ["value"]).collect()}
    assert estimates(s.merged(store.read(), ["month"], ["value"])) == estimates(s.merged(s.sketched(now, ["month"], ["value"]), ["month"], ["value"]))


def test_values_fill_sketches_before_the_exchange(spark, rows):
    plan = s.sketched(spark.createDataFrame(rows, SCHEMA), ["month"], ["value"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "partial_hll_sketch_agg" in plan[plan.index("Exchange") :]
