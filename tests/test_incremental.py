"""Gold redone where silver has changed, against gold of everything."""

import random

import pytest
from games import bronze, dimensions, game, pgn
from pyspark.sql import functions as F

from hindsight.config import Settings
from hindsight.plans import incremental
from hindsight.plans.gold import feature_table
from hindsight.plans.incremental import refresh_gold
from hindsight.plans.run import Layout, apply_snapshots
from hindsight.sources.tables import PartitionedTable

DAY = 86_400
T0 = 1_704_067_200  # 2024-01-01


def at(uuid, second, result="win", dated=True, **other):
    import datetime

    when = datetime.datetime.fromtimestamp(T0 + second, datetime.UTC)
    text = pgn(["e4", "c5"], ["0:09:50", "0:09:40"], when.strftime("%Y.%m.%d"), when.strftime("%H:%M:%S")) if dated else ""
    return game(uuid, pgn=text, end_time=T0 + second + 600, white=("acct_a", 1500, result), **other)


def same(layout, settings=Settings()):
    columns = layout.features().columns
    rows = lambda df: sorted(df.select(*columns).collect(), key=lambda r: (r.game_uuid, r.account_id))
    got, want = rows(layout.features()), rows(feature_table(layout.games.read(), settings))
    assert got == want and len(got) > 0
    edges = lambda df: sorted(map(str, df.select("person_id", "game_uuid", "account", "activity_month", "is_head", "is_tail").collect()))
    assert edges(layout.edges.read()) == edges(incremental.edges_of(layout.games.read()))


def refreshed(layout):
    return refresh_gold(layout.games, layout.edges, layout.gold)


def test_late_changed_and_moved_games(spark, tmp_path):
    rng = random.Random(3)
    layout = Layout(spark, str(tmp_path / "lake"))
    codes = ["win", "resigned", "agreed"]
    games = [at(f"g{i:03}", rng.randrange(250 * DAY) if i % 3 else 40 * DAY + rng.randrange(3 * DAY), rng.choice(codes)) for i in range(60)]
    rng.shuffle(games)
    apply_snapshots(bronze(spark, [("acct_a", games[:45], 1)]), layout, *dimensions(spark))
    assert not refreshed(layout)
    same(layout)
    late = games[45:50] + [at("tie", 40 * DAY), at("undated", 90 * DAY, dated=False, rules="bughouse")]
    apply_snapshots(bronze(spark, [("acct_a", late, 2)]), layout, *dimensions(spark))
    assert refreshed(layout)
    same(layout)
    # one is told otherwise, one has moved to another month, one is out of the population now
    again = [at("tie", 40 * DAY, "resigned"), at(games[0]["uuid"], 200 * DAY), at(games[1]["uuid"], 45 * DAY, rated=False)]
    apply_snapshots(bronze(spark, [("acct_a", again, 3), ("acct_b", games[50:], 3)]), layout, *dimensions(spark))
    assert refreshed(layout)
    same(layout)


def test_months_out_of_reach_are_neither_read_nor_written(spark, tmp_path, monkeypatch):
    layout = Layout(spark, str(tmp_path / "lake"))
    games = [at(f"g{m}-{i}", (30 * m + 3 * i) * DAY + 5) for m in range(12) for i in range(5)]
    apply_snapshots(bronze(spark, [("acct_a", games, 1)]), layout, *dimensions(spark))
    refreshed(layout)
    before = layout.gold.manifest()
    apply_snapshots(bronze(spark, [("acct_a", [at("late", 185 * DAY)], 2)]), layout, *dimensions(spark))
    opened = set()
    load = PartitionedTable._load

    def watched(self, entries, schema):
        if self.path.endswith("/games"):
            opened.update(entries)
        return load(self, entries, schema)

    monkeypatch.setattr(PartitionedTable, "_load", watched)
    assert refreshed(layout)
    assert opened <= {f"activity_month=2024-{m:02}" for m in (6, 7, 8)}
    monkeypatch.undo()
    same(layout)
    after = layout.gold.manifest()
    assert {n for n in before if after[n] == before[n]} >= {f"activity_month=2024-{m:02}" for m in (1, 2, 3, 4, 5, 9, 10, 11, 12)}


def test_rows_after_a_long_gap_are_found(spark, tmp_path):
    layout = Layout(spark, str(tmp_path / "lake"))
    apply_snapshots(bronze(spark, [("acct_a", [at("a", 0), at("b", 200 * DAY), at("c", 300 * DAY), at("d", 301 * DAY)], 1)]), layout, *dimensions(spark))
    refreshed(layout)
    apply_snapshots(bronze(spark, [("acct_a", [at("late", 10 * DAY, "resigned")], 2)]), layout, *dimensions(spark))
    refreshed(layout)
    same(layout)
    rows = {r.game_uuid: r for r in layout.features().collect()}
    assert (rows["b"].LastResultIsLoss, rows["c"]["2ndLastResultIsLoss"], rows["d"]["2ndLastResultIsLoss"]) == (1, 1, 0)


def test_nothing_new_and_other_settings(spark, tmp_path):
    layout = Layout(spark, str(tmp_path / "lake"))
    apply_snapshots(bronze(spark, [("acct_a", [at("a", 0), at("b", DAY)], 1)]), layout, *dimensions(spark))
    refreshed(layout)
    commits = layout.gold.manifests()
    assert refreshed(layout) and layout.gold.manifests() == commits
    other = Settings(zone="UTC")
    assert not refresh_gold(layout.games, layout.edges, layout.gold, other)
    same(layout, other)
    # the commit that gold was made from is gone
    apply_snapshots(bronze(spark, [("acct_a", [at("c", 2 * DAY)], 2)]), layout, *dimensions(spark))
    layout.games.vacuum()
    assert not refresh_gold(layout.games, layout.edges, layout.gold, other)
    same(layout, other)


@pytest.mark.parametrize("first, last, want", [(0, 0, ["2024-01"]), (30 * DAY, 61 * DAY, ["2024-01", "2024-02", "2024-03"])])
def test_months_between(spark, first, last, want):
    got = spark.range(1).select(incremental.months_between(F.lit(T0 + first), F.lit(T0 + last)).alias("m")).first()["m"]
    assert got == want
