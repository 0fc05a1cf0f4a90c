"""Boosted trees against a plain re-computation, importances against SQL, early stopping."""

import math
import random

import numpy as np
import pytest

from hindsight.plans.boosting import Boosted, Boosting, fit, importances


def plain_fit(rows, cuts, n_classes, s):
    """Exact greedy boosting over the same cuts, row by row: returns each row's margins after all rounds."""
    n = len(rows)
    mass = [sum(w for _, y, w in rows if y == k) for k in range(n_classes)]
    margins = [[math.log(m / sum(mass)) for m in mass] for _ in rows]

    def goes_left(x, f, c, missing_left):
        return missing_left if x[f] is None else x[f] <= c

    def leaf(ids, g, h):
        return -s.rate * sum(g[i] for i in ids) / (sum(h[i] for i in ids) + s.shrinkage)

    def grow(ids, g, h, depth, out):
        score = lambda a: sum(g[i] for i in a) ** 2 / (sum(h[i] for i in a) + s.shrinkage)
        best = None
        if depth < s.depth:
            for missing_left in (False, True):
                for f, own in enumerate(cuts):
                    for c in [*own, math.inf]:
                        left = [i for i in ids if goes_left(rows[i][0], f, c, missing_left)]
                        right = [i for i in ids if not goes_left(rows[i][0], f, c, missing_left)]
                        if sum(h[i] for i in left) < s.least_cover or sum(h[i] for i in right) < s.least_cover:
                            continue
                        gain = score(left) + score(right) - score(ids)
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, left, right)
        if best is None:
            for i in ids:
                out[i] = leaf(ids, g, h)
            return
        grow(best[1], g, h, depth + 1, out)
        grow(best[2], g, h, depth + 1, out)

    for _ in range(s.rounds):
        steps = []
        for k in range(n_classes):
            g, h = [0.0] * n, [0.0] * n
            for i, (_, y, w) in enumerate(rows):
                e = [math.exp(m) for m in margins[i]]
                p = e[k] / sum(e)
                g[i], h[i] = w * (p - (y == k)), w * p * (1 - p)
            out = [0.0] * n
            grow(list(range(n)), g, h, 0, out)
            steps.append(out)
        for i in range(n):
            for k in range(n_classes):
                margins[i][k] += steps[k][i]
    return margins


def table(seed, n):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        x = [rng.choice([None, *range(6)]), rng.random(), rng.choice([0.0, 1.0])]
        y = 0 if x[0] is None or x[0] > 3 else 1 if x[1] > 0.6 else 2
        rows.append((x, rng.randrange(3) if rng.random() < 0.1 else y, rng.choice([1.0, 2.5])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, *[None if v is None else float(v) for v in x], y, w) for i, (x, y, w) in enumerate(rows)], "id int, a double, b double, c double, label int, weight double")


def test_equals_a_plain_recomputation(spark):
    rows = table(1, 200)
    s = Boosting(rounds=3, depth=2, rate=0.3, bins=8, least_cover=2.0)
    df = frame(spark, rows).repartition(3)
    model = fit(df, ["a", "b", "c"], weight="weight", s=s)
    assert len(model.trees) == 3
    want = plain_fit(rows, model.cuts, 3, s)
    prob = {r["id"]: r["prob"] for r in model.predict(df).collect()}
    for i, margins in enumerate(want):
        e = np.exp(margins)
        assert np.allclose(prob[i], e / e.sum(), atol=1e-6)


def test_margins_written_between_rounds_change_nothing(spark, monkeypatch):
    from hindsight.plans import boosting

    df, s = frame(spark, table(2, 150)), Boosting(rounds=4, depth=2, bins=8)
    whole = fit(df, ["a", "b", "c"], s=s)
    monkeypatch.setattr(boosting, "KEPT", 1)
    assert np.allclose([t.value for r in fit(df, ["a", "b", "c"], s=s).trees for t in r], [t.value for r in whole.trees for t in r])


def test_stops_early_and_beats_the_shares(spark, tmp_path):
    rows = table(3, 600)
    df = frame(spark, rows).selectExpr("*", "id % 4 = 0 valid", "cast(null as double) nothing")
    model = fit(df, ["a", "b", "c", "nothing"], valid="valid", s=Boosting(rounds=60, depth=3, rate=0.5, bins=16, patience=3))
    assert 0 < len(model.trees) < 60 and len(model.losses) <= len(model.trees) + 4
    assert model.losses[len(model.trees)] == min(model.losses) < 0.7 * model.losses[0]
    held = [r for r in model.predict(df.where("valid")).collect()]
    loss = -sum(math.log(max(r["prob"][r["label"]], 1e-15)) for r in held) / len(held)
    assert abs(loss - min(model.losses)) < 1e-9
    # three measures from the written node table, equal to SQL over it; the model comes back from it
    model.save(spark, str(tmp_path / "m"))
    nodes = spark.read.parquet(str(tmp_path / "m" / "nodes"))
    nodes.createOrReplaceTempView("nodes")
    want = spark.sql("SELECT feature, count(*) weight, avg(gain) gain, avg(cover) cover, sum(gain) total_gain, sum(cover) total_cover FROM nodes WHERE feature IS NOT NULL GROUP BY feature")
    assert sorted(map(tuple, importances(nodes).collect())) == sorted(map(tuple, want.collect()))
    found = {r["feature"]: r["total_gain"] for r in importances(nodes).collect()}
    assert set(found) <= {"a", "b", "c"} and found["a"] > found.get("c", 0)
    again = Boosted.load(spark, str(tmp_path / "m"))
    assert [r["prob"] for r in again.predict(df.orderBy("id")).collect()] == [r["prob"] for r in model.predict(df.orderBy("id")).collect()]


def test_odd_tables(spark):
    with pytest.raises(ValueError):
        fit(frame(spark, []), ["a"])
    same = spark.createDataFrame([(1.0, 0)] * 5 + [(float("nan"), 1)] + [(None, None)], "a double, label int")
    model = fit(same, ["a"], s=Boosting(rounds=2, depth=1, least_cover=0.0))
    prob = [r["prob"] for r in model.predict(same).collect()]
    assert prob[0][0] > 5 / 6 > prob[5][0] and len(prob) == 7


def test_search_learns_from_its_trials():
    """A known minimum in fewer trials than drawing at random, over many seeds."""
    from hindsight.plans.search import Range, Search

    ranges = {"x": Range(0.001, 10, log=True), "y": Range(0, 20, whole=True), "z": Range(-1, 1)}

    def loss(p):
        return (math.log10(p["x"]) + 1) ** 2 + ((p["y"] - 13) / 10) ** 2 + (p["z"] - 0.3) ** 2

    def trials(search, most=120):
        _, losses = search.run(loss, most)
        return next((i + 1 for i, v in enumerate(losses) if v < 0.05), most)

    learned = [trials(Search(ranges, seed)) for seed in range(20)]
    drawn = [trials(Search(ranges, seed, first=10**9)) for seed in range(20)]
    assert sum(learned) < 0.6 * sum(drawn)
    best, losses = Search(ranges, 1).run(loss, 60)
    assert losses == Search(ranges, 1).run(loss, 60)[1] and loss(best) == min(losses) and isinstance(best["y"], int)
    assert Search(ranges).run(loss, 0) == ({}, [])


def test_forward_folds(spark):
    from hindsight.operators.splits import forward_folds, nth_key, nth_keys

    rng = random.Random(4)
    rows = [(i // 2, v, rng.choice([None, *range(40)]) if i > 30 else rng.randrange(1000)) for i, v in enumerate("ab" * 150)]
    at = {g: t for g, _, t in rows}  # both views of a game at one time
    rows = [(g, v, at[g]) for g, v, _ in rows]
    df = spark.createDataFrame(rows, "game int, view string, at long").repartition(5)
    ordered = sorted(rows, key=lambda r: (r[2] is None, r[2] or 0, r[0]))
    for small in (10, 10_000):
        ns = [0, 50, 50, 149, 299, 300, -1]
        got = nth_keys(df, ["at", "game"], ns, small)
        assert got == [nth_key(df, ["at", "game"], n, small) for n in (0, 50, 149, 299)]
        folds = [(r["game"], r["view"], r["fold"], r["side"]) for r in forward_folds(df, "at", "game", 3, 5, small).collect()]
        want = []
        cuts = [ordered[300 * f // 4] for f in (1, 2, 3)]
        key = lambda r: (r[2] is None, r[2] or 0, r[0])
        for r in rows:
            block = sum(key(r) >= key(c) for c in cuts)
            for f, c in enumerate(cuts, 1):
                if block == f:
                    want.append((r[0], r[1], f, "test"))
                elif block < f and not (c[2] is not None and r[2] is not None and c[2] - r[2] < 5):
                    want.append((r[0], r[1], f, "train"))
        assert sorted(folds) == sorted(want)
    assert forward_folds(df.limit(0), "at", "game", 3).count() == 0
