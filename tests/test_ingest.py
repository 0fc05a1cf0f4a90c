import json

import pytest
from games import dimensions, game, write_snapshot
from pyspark.sql import functions as F

from hindsight.config import Settings
from hindsight.operators.checks import ChecksFailed
from hindsight.plans.run import Layout, apply_snapshots, refresh
from hindsight.plans.silver import explode_games
from hindsight.sources import landing
from hindsight.sources.bronze import bronze_counts, infer_schema, read_bronze, reopened
from hindsight.sources.landing import SyncFailed
from hindsight.sources.tables import PartitionedTable
from hindsight.streaming.ingest import document_stream, ingest_batch, ingest_stream, payload_stream

LISTING = "account string, ordinal int, url string"


def listing(spark):
    rows = [("a", i, f"https://s/a/games/2024/{i:02}" + "/" * (i % 2)) for i in range(1, 5)] + [("b", 1, "x/2024/01")]
    return landing.with_year_month(spark.createDataFrame(rows, LISTING))


def landed(spark, months):
    return spark.createDataFrame([("a", "2024", m) for m in months], "account string, year string, month string")


@pytest.mark.parametrize("trailing, due", [(2, {"02", "03", "04"}), (0, {"02"}), (9, {"01", "02", "03", "04"})])
def test_sync_plan(spark, trailing, due):
    plan = landing.sync_plan(listing(spark), landed(spark, ["01", "03", "04"]), trailing)
    assert {r.month for r in plan.where("account = 'a' and due").collect()} == due
    assert [r.reason for r in plan.where("account = 'b'").collect()] == ["missing"]


def test_summary_and_failure(spark):
    plan = landing.sync_plan(listing(spark), landed(spark, ["01", "02"]), 1)
    outcomes = spark.createDataFrame(
        [("a", "2024", "03", 7, None), ("a", "2024", "04", None, "timeout"), ("b", "2024", "01", 2, None)],
        "account string, year string, month string, games int, error string",
    )
    summary = landing.sync_summary(plan, outcomes)
    rows = {r.account: r for r in summary.collect()}
    a = rows["a"]
    assert (a.archives_at_source, a.fetched, a.skipped, a.games_fetched) == (4, ["2024/03"], 2, 7)
    assert a.errors == ["2024/04: timeout"] and rows["b"].errors == []
    with pytest.raises(SyncFailed, match="timeout"):
        landing.fail_on_errors(summary)
    landing.fail_on_errors(summary.where("account = 'b'"))


def payloads(spark, stamps):
    rows = [("acct_a", "2024", "03", json.dumps({"games": [game()]}), f"u/{s}", s) for s in stamps]
    made = spark.createDataFrame(rows, "account string, year string, month string, payload string, source_url string, s long")
    return made.withColumn("fetched_at", F.timestamp_seconds("s")).drop("s")


def test_landing_as_files_is_append_only_and_verbatim(spark, tmp_path):
    path = str(tmp_path / "landing")
    for stamp in (1, 2):
        landing.land_snapshots(payloads(spark, [stamp]), path, as_files=True)
    assert [tuple(r) for r in landing.landed_partitions(spark, path).collect()] == [("acct_a", "2024", "03")]
    texts = [r[0] for r in spark.read.option("recursiveFileLookup", True).text(path).collect()]
    assert texts == [json.dumps({"games": [game()]})] * 2
    log = spark.read.parquet(f"{path}_log")
    assert sorted((r.source_url, r.game_count) for r in log.collect()) == [("u/1", 1), ("u/2", 1)]
    bronze = str(tmp_path / "bronze")
    assert ingest_batch(spark, path, bronze) == 2
    assert ingest_batch(spark, path, bronze) == 0


def test_landing_as_rows_and_stream(spark, tmp_path):
    path, bronze, seen = (str(tmp_path / n) for n in ("landing", "bronze", "seen"))
    for stamp in (1, 2):
        landing.land_snapshots(payloads(spark, [stamp]), path)
    assert [tuple(r) for r in landing.landed_rows(spark, path).collect()] == [("acct_a", "2024", "03")]
    for _ in range(2):
        ingest_stream(payload_stream(spark, path), bronze, seen)
    rows = spark.read.parquet(bronze)
    assert rows.count() == 2
    assert all(r._source_file.endswith("&username=acct_a") for r in rows.collect())
    # two snapshots in one file are still told apart by when they were fetched
    assert sorted(r._file_modified_at.second for r in rows.collect()) == [1, 2]


def test_newest_of_two_payloads_in_one_file(spark, tmp_path):
    path, layout = str(tmp_path / "landing"), Layout(spark, str(tmp_path / "lake"))
    made = payloads(spark, [1, 2]).withColumn(
        "payload", F.when(F.col("source_url") == "u/1", F.replace("payload", F.lit('"win"'), F.lit('"agreed"'))).otherwise(F.col("payload"))
    )
    landing.land_snapshots(made.coalesce(1), path)
    refresh(path, layout, *dimensions(spark), landed_as="rows")
    assert [r.result for r in layout.games.read().collect()] == ["won"]


def test_files_are_ingested_once(spark, tmp_path):
    root, bronze, seen = (str(tmp_path / n) for n in ("raw", "bronze", "seen"))
    write_snapshot(root, "acct_a", "2024", "03", "1", [game()])
    write_snapshot(root, "acct_b", "2024", "03", "1", [])
    for expected in (2, 2, 3):
        if expected == 3:
            write_snapshot(root, "acct_a", "2024", "03", "2", [game(), game("g2")])
        ingest_stream(document_stream(spark, root), bronze, seen)
        assert spark.read.parquet(bronze).count() == expected
    counts = bronze_counts(spark.read.parquet(bronze)).first()
    assert (counts.snapshot_files, counts.game_rows_incl_duplicates) == (3, 3)
    assert "uuid:string" in infer_schema(spark, root)


def test_new_fields_stay_in_bronze_and_can_be_read_later(spark, tmp_path):
    root, bronze = str(tmp_path / "raw"), str(tmp_path / "bronze")
    write_snapshot(root, "a", "2024", "01", "1", [{"uuid": "x"}])
    ingest_batch(spark, root, bronze)
    write_snapshot(root, "a", "2024", "02", "1", [{"uuid": "y", "fresh": {"deep": 7}}])
    ingest_batch(spark, root, bronze)
    wider = reopened(read_bronze(spark, bronze), "games array<struct<uuid: string, fresh: struct<deep: int>>>")
    rows = wider.select(F.explode("games").alias("g")).select("g.uuid", "g.fresh.deep").collect()
    assert sorted(tuple(r) for r in rows) == [("x", None), ("y", 7)]


def test_odd_names_are_ingested_once_and_read_as_given(spark, tmp_path):
    root, bronze = str(tmp_path / "raw"), str(tmp_path / "bronze")
    names = ["acct a", "100%", "a+b", "größe", "a%20b"]
    for name in names:
        write_snapshot(root, name, "2024", "01", "1", [game()])
    assert ingest_batch(spark, root, bronze) == len(names)
    assert ingest_batch(spark, root, bronze) == 0
    got = {r[0] for r in explode_games(read_bronze(spark, bronze)).select("account").collect()}
    assert got == set(names)


def test_a_crash_between_two_writes_is_replayed(spark, tmp_path, monkeypatch):
    from games import bronze, pgn

    long, short = pgn(["e4", "c5", "Nf3"], ["0:09:00"] * 3), pgn(["e4"], ["0:09:00"], date="2024.04.01")
    layout = Layout(spark, str(tmp_path / "lake"))
    apply_snapshots(bronze(spark, [("acct_a", [game("g1", pgn=long), game("g2")], 1)]), layout, *dimensions(spark))
    late = bronze(spark, [("acct_a", [game("g1", pgn=short)], 2)])
    commit, done = PartitionedTable._commit, []
    for dies_at in (0, 1):  # before the first and between the two writes

        def sometimes(table, *args, dies_at=dies_at):
            if len(done) == dies_at:
                raise OSError("lost")
            done.append(table.path)
            return commit(table, *args)

        done.clear()
        with monkeypatch.context() as broken:
            broken.setattr(PartitionedTable, "_commit", sometimes)
            with pytest.raises(OSError):
                apply_snapshots(late, layout, *dimensions(spark))
    apply_snapshots(late, layout, *dimensions(spark))
    moves = layout.moves.read().where("game_uuid = 'g1'").collect()
    assert [(r.ply, r.activity_month) for r in moves] == [(1, "2024-04")]
    assert layout.games.read().where("game_uuid = 'g1'").count() == 1


def test_older_snapshot_of_a_game_without_a_key(spark, tmp_path):
    from games import bronze

    layout = Layout(spark, str(tmp_path / "lake"))
    for modified, code in ((5, "win"), (3, "resigned")):
        nameless = game(white=("acct_a", 1, code)) | {"uuid": None, "url": None}
        apply_snapshots(bronze(spark, [("acct_a", [nameless], modified)]), layout, *dimensions(spark))
    assert [r.result for r in layout.games.read().collect()] == ["won"]


def test_layers_by_name(spark, tmp_path):
    root, layout = str(tmp_path / "raw"), Layout(spark, str(tmp_path / "lake"))
    write_snapshot(root, "acct_a", "2024", "03", "1", [game("g1"), game("g2")])
    try:
        refresh(root, layout, *dimensions(spark), catalog="r_")
        for name, rows in (("r_silver.games", 2), ("r_gold.game_features", 2), ("r_gold.dashboard_games", 2), ("r_bronze.snapshots", 1)):
            assert spark.table(name).count() == rows
    finally:
        for name in ("bronze", "silver", "gold"):
            spark.sql(f"DROP SCHEMA IF EXISTS r_{name} CASCADE")


def test_refresh_end_to_end(spark, tmp_path):
    root, layout = str(tmp_path / "raw"), Layout(spark, str(tmp_path / "lake"))
    accounts, friends = dimensions(spark)
    from games import pgn

    long = pgn(["e4", "c5", "Nf3"], ["0:09:00"] * 3)
    write_snapshot(root, "acct_a", "2024", "03", "1", [game("g1", pgn=long), game("g2")])
    report = refresh(root, layout, accounts, friends)
    assert len(report) == 14 and all(ok for _, ok, _ in report)
    assert (layout.games.read().count(), layout.moves.read().count(), layout.gold.read().count()) == (2, 5, 2)
    # nothing new: the same tables
    refresh(root, layout, accounts, friends)
    assert (layout.games.read().count(), layout.moves.read().count()) == (2, 5)
    # a re-pull: one game with fewer moves and another date, one new game
    short = pgn(["e4"], ["0:09:00"], date="2024.04.01")
    write_snapshot(root, "acct_a", "2024", "03", "2", [game("g1", pgn=short), game("g2"), game("g3")])
    refresh(root, layout, accounts, friends)
    assert (layout.games.read().count(), layout.moves.read().count(), layout.gold.read().count()) == (3, 5, 3)
    assert {r[0] for r in layout.games.read().select("activity_month").collect()} == {"2024-03", "2024-04"}
    # an unmet floor: everything is written and reported, then the run fails
    with pytest.raises(ChecksFailed, match="games row-count floor") as failed:
        refresh(root, layout, accounts, friends, Settings(min_games=10))
    assert [name for name, _ in failed.value.failed] == ["games row-count floor"]


def test_older_snapshot_arriving_late_changes_nothing(spark, tmp_path):
    from games import bronze

    from hindsight.plans.run import apply_snapshots

    layout = Layout(spark, str(tmp_path / "lake"))
    for modified, code in ((5, "win"), (3, "resigned"), (5, "win")):
        snapshot = bronze(spark, [("acct_a", [game(white=("acct_a", 1, code))], modified)])
        apply_snapshots(snapshot, layout, *dimensions(spark))
        assert [r.result for r in layout.games.read().collect()] == ["won"]


def test_evolving_documents_are_bounded(spark, tmp_path, monkeypatch):
    from oracle import plain, rows_of

    import duckdb
    from querybook import ingestion

    monkeypatch.setattr(ingestion, "shared_dir", lambda _, name: str(tmp_path / name))
    rows = [(i, 1) for i in range(8000)] + [(8000 + 2 * i, 2) for i in range(9)]
    spark.createDataFrame(rows, "event_id long, user_id long").write.parquet(str(tmp_path / "events.parquet"))
    got = ingestion.evolving_bronze(spark, str(tmp_path))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    wanted = db.execute(ingestion.book.sql["evolving_bronze"])
    assert rows_of(got.columns, [tuple(map(plain, r)) for r in got.collect()]) == rows_of([d[0] for d in wanted.description], wanted.fetchall())
    held = [len(json.loads(p.read_text())["games"]) for p in (tmp_path / "documents").rglob("*.txt")]
    assert sum(held) == len(rows) and max(held) <= 1200


def test_documents_kept_as_variants(spark, tmp_path):
    from hindsight.sources.bronze import drift

    root, bronze = str(tmp_path / "raw"), str(tmp_path / "bronze")
    texts = {
        "a": '{"games": [{"uuid": "g1", "fresh": {"deep": 5}, "rated": "yes"}, {"uuid": 7}], "page": 1}',
        "twice": '{"games": [{"uuid": "g2"}], "games": [{"uuid": "g3"}]}',
        "broken": '{"games": [{"uuid": "g4"',
    }
    for name, text in texts.items():
        folder = tmp_path / "raw" / f"username={name}" / "year=2024" / "month=01"
        folder.mkdir(parents=True)
        (folder / "games_1.json").write_text(text)
    assert ingest_batch(spark, root, bronze) == 3 and ingest_batch(spark, root, bronze) == 0
    rows = read_bronze(spark, bronze)
    # only what is no variant is kept as text
    assert sorted(r["_raw"] for r in rows.where("_raw IS NOT NULL").collect()) == sorted([texts["twice"], texts["broken"]])
    plan = reopened(rows.drop("_raw").selectExpr("*", "cast(null as string) _raw"), "games array<struct<uuid: string>>")
    assert plan.count() == 3
    found = reopened(rows, "games array<struct<uuid: string, fresh: struct<deep: int>, rated: boolean>>")
    games = [tuple(g) for r in found.where("_raw IS NULL").collect() for g in r["games"]]
    assert [(g[0], g[1] and g[1]["deep"], g[2]) for g in games] == [("g1", 5, None), ("7", None, None)] or games[0][2] is True
    # rows written before there were variants are read from their text
    old = rows.where("_raw IS NULL").selectExpr("* except (_variant, _raw)", "to_json(_variant) _raw")
    again = [g["uuid"] for r in reopened(old, "games array<struct<uuid: string>>").collect() for g in r["games"]]
    assert again == ["g1", "7"]
    seen = {(r["path"], r["seen"], r["declared"] is not None, r["rows"]) for r in drift(rows).collect()}
    assert seen == {
        ("games", "ARRAY", True, 1), ("page", "BIGINT", False, 1), ("games[].uuid", "STRING", True, 1), ("games[].uuid", "BIGINT", True, 1),
        ("games[].fresh", "OBJECT<deep: BIGINT>", False, 1), ("games[].rated", "STRING", True, 1),
    }
    assert drift(rows.limit(0)).count() == 0


def test_documents_are_written_one_a_file_in_tasks(spark, tmp_path):
    rows = [("p 1+é%/x", "a"), ("p 1+é%/x", "a"), ("p 1+é%/x", "b\nc"), (None, "d"), ("", None)]
    texts = spark.createDataFrame(rows, "username string, d string").repartition(3, "username")
    path = str(tmp_path / "documents")
    for _ in range(2):
        landing.write_documents(texts, "d", ["username"], path)
    read = spark.read.text(path, wholetext=True)
    wanted = [("p 1+é%/x", "a\n")] * 4 + [("p 1+é%/x", "b\nc\n")] * 2 + [(None, "d\n")] * 2 + [(None, "\n")] * 2
    assert sorted(map(str, [(r.username, r.value) for r in read.collect()])) == sorted(map(str, wanted))
    assert not [p for p in (tmp_path / "documents").rglob("*") if p.is_file() and (p.name[0] in "._" or p.suffix != ".txt")]


def test_listing_takes_few_tasks_per_core(spark):
    from hindsight.session import configure

    spark.conf.unset("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    configure(spark)
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) == 4 * spark.sparkContext.defaultParallelism


def test_document_folders_are_named_as_spark_names_them(spark, tmp_path):
    odd = "".join(map(chr, range(1, 128))).replace("/", "").replace(".", "") + "é\u2028"
    texts = spark.createDataFrame([(c, "x") for c in odd] + [("a/b=c", "x")], "k string, d string")
    landing.write_documents(texts, "d", ["k"], str(tmp_path / "ours"))
    texts.write.partitionBy("k").text(str(tmp_path / "sparks"))
    ours, sparks = (sorted(p.name for p in (tmp_path / n).iterdir() if p.is_dir()) for n in ("ours", "sparks"))
    assert ours == sparks
