"""Several writers of a table, key filters, and tables that are merged when read."""

import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from hindsight.sources import tables
from hindsight.sources.commits import Commits, Contended
from hindsight.sources.merging import MergeTable
from hindsight.sources.tables import PartitionedTable
from hindsight.streaming.upsert import stream_upsert


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, part string, v int")


def rows_of(df):
    return sorted(((r.k or "", r.part, r.v) for r in df.select("k", "part", "v").collect()), key=str)


def test_a_number_goes_to_one_writer(spark, tmp_path):
    commits = Commits(spark, str(tmp_path / "c"))
    for number in (1, 2):
        with ThreadPoolExecutor(8) as pool:
            won = list(pool.map(lambda i, n=number: commits.put(n, {"by": i}), range(8)))
        assert won.count(True) == 1 and commits.read(number) == {"by": won.index(True)}
    assert commits.numbers() == [1, 2] and not list((tmp_path / "c" / "_drafts").glob("[!.]*"))


def between(monkeypatch, table, write):
    """Let ``write`` happen just before the table's next commit."""
    commit, done = PartitionedTable._commit, []

    def late(self, *args):
        if not done:
            done.append(1)
            write()
        return commit(self, *args)

    monkeypatch.setattr(PartitionedTable, "_commit", late)


def test_writes_of_other_partitions_go_on_top_of_each_other(spark, tmp_path, monkeypatch):
    table = PartitionedTable(spark, str(tmp_path / "t"), "part")
    table.upsert(frame(spark, [("a", "1", 1), ("b", "2", 2), ("c", "3", 3)]), ["k"])
    first = table.manifest()
    between(monkeypatch, table, lambda: table.upsert(frame(spark, [("b", "2", 20), ("new", "4", 4)]), ["k"]))
    table.upsert(frame(spark, [("a", "1", 10)]), ["k"])
    assert rows_of(table.read()) == [("a", "1", 10), ("b", "2", 20), ("c", "3", 3), ("new", "4", 4)]
    assert len(table.manifests()) == 3 and table.manifest()["part=3"] == first["part=3"]
    # the later write was not done twice: its folder is the one of its first attempt
    assert table.manifest()["part=1"]["write"].startswith("table_write=0000000002-")


def test_writes_of_the_same_partition_are_merged(spark, tmp_path, monkeypatch):
    table = PartitionedTable(spark, str(tmp_path / "t"), "part")
    table.upsert(frame(spark, [("a", "1", 1), ("b", "1", 2)]), ["k"])
    between(monkeypatch, table, lambda: table.upsert(frame(spark, [("b", "1", 20)]), ["k"]))
    table.upsert(frame(spark, [("a", "1", 10)]), ["k"])
    assert rows_of(table.read()) == [("a", "1", 10), ("b", "1", 20)]


def test_a_key_that_two_writers_insert_elsewhere_is_there_once(spark, tmp_path, monkeypatch):
    table = PartitionedTable(spark, str(tmp_path / "t"), "part")
    table.upsert(frame(spark, [("a", "1", 1)]), ["k"])
    between(monkeypatch, table, lambda: table.upsert(frame(spark, [("new", "2", 2), (None, "2", 0)]), ["k"]))
    table.upsert(frame(spark, [("new", "3", 3), (None, "3", 9)]), ["k"])
    assert rows_of(table.read()) == [("", "3", 9), ("a", "1", 1), ("new", "3", 3)]


def test_a_write_made_from_an_older_state_is_refused(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), "part")
    table.upsert(frame(spark, [("a", "1", 1), ("b", "2", 2)]), ["k"])
    at = table.commits.newest()
    table.upsert(frame(spark, [("a", "1", 5)]), ["k"])
    with pytest.raises(Contended):
        table.upsert(frame(spark, [("a", "1", 9)]), ["k"], held=["1"], at=at)
    table.upsert(frame(spark, [("b", "2", 9)]), ["k"], held=["2"], at=at)
    assert rows_of(table.read()) == [("a", "1", 5), ("b", "2", 9)]


def test_raced_writers_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    batches = [[(f"k{w}-{i}", str((w + i + n) % 4), n) for i in range(12)] + [("shared", str(w), w)] for n in range(2) for w in range(3)]

    def write(w):
        for batch in batches[w::3]:
            PartitionedTable(spark, path, "part").upsert(frame(spark, batch), ["k"])

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(write, range(3)))
    got = {r.k: (r.part, r.v) for r in PartitionedTable(spark, path, "part").read().collect()}
    shared = got.pop("shared")
    assert shared in {("0", 0), ("1", 1), ("2", 2)}
    assert got == {k: (part, v) for batch in batches[3:] for k, part, v in batch if k != "shared"}
    assert PartitionedTable(spark, path, "part").read().count() == 37


def test_vacuum_spares_a_write_under_way(spark, tmp_path, monkeypatch):
    table = PartitionedTable(spark, str(tmp_path / "t"), "part")
    table.upsert(frame(spark, [("a", "1", 1), ("b", "2", 2)]), ["k"])
    between(monkeypatch, table, lambda: table.vacuum())
    table.upsert(frame(spark, [("a", "1", 10)]), ["k"])
    assert rows_of(table.read()) == [("a", "1", 10), ("b", "2", 2)]
    table.vacuum(grace_hours=0)
    assert rows_of(table.read()) == [("a", "1", 10), ("b", "2", 2)]
    table.upsert(frame(spark, [("b", "2", 20)]), ["k"])
    assert rows_of(table.read()) == [("a", "1", 10), ("b", "2", 20)]


def slices_of(table, folder):
    entry = table.manifest()[folder]
    return [part["write"] for part in (entry, *entry.get("more", []))]


def test_writers_of_other_keys_of_a_partition_write_their_rows_once(spark, tmp_path, monkeypatch):
    table = PartitionedTable(spark, str(tmp_path / "t"), "part")
    table.upsert(frame(spark, [("a", "1", 1), ("b", "1", 2)]), ["k"])
    first = slices_of(table, "part=1")
    between(monkeypatch, table, lambda: table.upsert(frame(spark, [("c", "1", 3)]), ["k"]))
    table.upsert(frame(spark, [("d", "1", 4), ("e", None, 5)]), ["k"])
    assert rows_of(table.read()) == [("a", "1", 1), ("b", "1", 2), ("c", "1", 3), ("d", "1", 4), ("e", None, 5)]
    # nothing was merged: both writes lie beside the first, and no folder is left over
    assert slices_of(table, "part=1")[:1] == first and len(slices_of(table, "part=1")) == 3
    assert len(list((tmp_path / "t").glob("table_write=*"))) == 3
    # of the slices, only the one that holds the key is written anew
    table.upsert(frame(spark, [("c", "2", 30)]), ["k"])
    assert slices_of(table, "part=1")[:1] == first and len(slices_of(table, "part=1")) == 2
    want = [("a", "1", 1), ("b", "1", 2), ("c", "2", 30), ("d", "1", 4), ("e", None, 5)]
    assert rows_of(table.read()) == want and rows_of(table.at(table.commits.newest(), {"part=1"})) == [w for w in want if w[1] == "1"]
    table.vacuum(grace_hours=0)
    tables.publish(spark, "sliced", table)
    try:
        assert rows_of(table.read()) == want and rows_of(spark.table("sliced")) == want
    finally:
        spark.sql("DROP VIEW IF EXISTS sliced")


def test_a_replay_under_named_partitions_leaves_keys_once(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), "part")
    table.upsert(frame(spark, [("a", "1", 1), ("b", "2", 2)]), ["k"])
    for _ in range(2):
        table.upsert(frame(spark, [("a", "2", 10)]), ["k"], held=["1"])
    assert rows_of(table.read()) == [("a", "2", 10), ("b", "2", 2)]


def test_a_partition_of_many_slices_is_merged(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), "part")
    for n in range(tables.SLICES + 2):
        table.upsert(frame(spark, [(f"k{n}", "1", n), (f"l{n}", "2" if n < 2 else "1", n)]), ["k"])
    assert len(slices_of(table, "part=1")) == 3 and len(slices_of(table, "part=2")) == 2
    assert rows_of(table.read()) == sorted([(f"{c}{n}", "2" if c == "l" and n < 2 else "1", n) for n in range(tables.SLICES + 2) for c in "kl"], key=str)


# Key filters


def test_filters_are_not_asked_about_more_keys_than_they_can_tell(spark, tmp_path, monkeypatch):
    table = PartitionedTable(spark, str(tmp_path / "t"), "part")
    table.upsert(spark.range(400).selectExpr("concat('k', id) k", "cast(id % 4 as string) part", "cast(id as int) v"), ["k"])
    entries, keys = table.manifest(), spark.range(50).selectExpr("concat('absent', id) k").unionByName(frame(spark, [("k5", "", 0)]).select("k"))
    assert "part=1" in table.possibly_holding(entries, keys, ["k"])
    monkeypatch.setattr(tables, "FILTERED", 50)
    assert table.possibly_holding(entries, keys, ["k"]) == entries and table.holding(keys, ["k"]) == ["1"]


def test_only_partitions_that_may_hold_a_key_are_opened(spark, tmp_path, monkeypatch):
    table = PartitionedTable(spark, str(tmp_path / "t"), "part")
    rows = spark.range(40_000).selectExpr("concat('k', id) k", "cast(id % 40 as string) part", "cast(id as int) v")
    table.upsert(rows, ["k"])
    opened = []
    load = PartitionedTable._load
    monkeypatch.setattr(PartitionedTable, "_load", lambda self, entries, schema: opened.append(set(entries)) or load(self, entries, schema))
    keys = spark.createDataFrame([("k7",), ("k47",), ("k13",), ("unknown",)], "k string")
    assert sorted(table.holding(keys, ["k"])) == ["13", "7"]
    assert {"part=7", "part=13"} <= opened[0] and len(opened[0]) <= 8
    opened.clear()
    table.upsert(frame(spark, [("k5", "5", -1), ("fresh", "5", -2)]), ["k"])
    assert all(len(entries) <= 6 for entries in opened)
    assert table.read().where("v < 0").count() == 2 and table.read().count() == 40_001


def test_false_positives_are_few_and_misses_none(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), "part")
    table.upsert(spark.range(20_000).selectExpr("concat('k', id) k", "cast(id % 3 as string) part", "cast(id as int) v"), ["k"])
    entries = table.manifest()
    absent = spark.range(3000).selectExpr("concat('absent', id) k").collect()
    hits = 0
    for row in absent[:40]:
        hits += len(table.possibly_holding(entries, spark.createDataFrame([row]), ["k"]))
    assert hits <= 12  # of 120; one in a hundred to one in twenty-five by chance
    for i in (0, 1, 2, 19_999):
        assert f"part={i % 3}" in table.possibly_holding(entries, spark.createDataFrame([(f"k{i}",)], "k string"), ["k"])


def test_partitions_written_under_other_keys_are_opened(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), "part")
    table.upsert(frame(spark, [("a", "1", 1), ("b", "2", 2)]), ["k", "v"])
    assert table.holding(frame(spark, [("a", "9", 5)]), ["k"]) == ["1"]
    # a null key is a key here too
    table.upsert(frame(spark, [(None, "3", 3)]), ["k"])
    assert table.holding(frame(spark, [(None, "9", 5)]), ["k"]) == ["3"]


def test_hashes_of_a_filter_word(spark):
    """A key's four bits lie in the word that its low bits choose."""
    rows = spark.range(200).select(tables.key_hash(["id"]).alias("h"), F.lit(16).cast("long").alias("words"))
    for r in rows.select("h", tables._word("h", "words").alias("w"), tables._mask("h").alias("m")).collect():
        assert r.w == r.h % 16 and r.m % 2**64 == sum({1 << ((r.h % 2**64) >> s & 63) for s in (40, 46, 52, 58)})


# Merge on read


def merge_table(spark, tmp_path, name="m"):
    return MergeTable(spark, str(tmp_path / name), ("k",), ("at",))


def versions(spark, rows):
    return spark.createDataFrame(rows, "k string, at int, v string")


def contents(table):
    return {r.k: (r.at, r.v) for r in table.read().collect()}


def test_merged_reads_equal_whole_recomputation(spark, tmp_path):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", "c", None, f"k{i}"]), rng.randint(0, 9), rng.choice(["x", "y", None])) for i in range(120)]
    batches = [rows[i::6] for i in range(6)]
    want = {}
    for k, at, v in rows:
        want[k] = max(want.get(k, (at, v)), (at, v), key=lambda x: (x[0], x[1] is not None, x[1] or ""))
    for order in (range(6), reversed(range(6))):
        table = merge_table(spark, tmp_path, f"m{rng.random()}")
        for n, i in enumerate(order):
            table.append(versions(spark, batches[i]))
            if n == 2:
                assert table.compact(whole=True) and not table.state()["deltas"]
        table.append(versions(spark, batches[0]))  # again
        assert contents(table) == want and table.read().count() == len(want)
        table.compact(whole=True)
        assert contents(table) == want and table.read().count() == len(want)


def test_an_upsert_writes_its_rows_only(spark, tmp_path):
    table = merge_table(spark, tmp_path)
    table.append(spark.range(20_000).selectExpr("concat('k', id) k", "1 at", "sha2(string(id), 256) v"))
    table.compact(whole=True)
    table.append(versions(spark, [("k5", 2, "new"), ("fresh", 1, "new")]))
    (base,), (delta,) = table.state()["base"], table.state()["deltas"]
    assert delta[1] < base[1] / 100 and not table.compact()
    assert table.read().count() == 20_001 and contents(table)["k5"] == (2, "new")
    # rows that no delta renews reach the reader without an exchange
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan


def test_many_deltas_become_one(spark, tmp_path):
    table = merge_table(spark, tmp_path)
    table.append(spark.range(5000).selectExpr("concat('k', id) k", "1 at", "sha2(string(id), 256) v"))
    table.compact(whole=True)
    for i in range(9):
        table.append(versions(spark, [("k1", i + 2, str(i))]))
        table.compact()
    assert len(table.state()["deltas"]) <= 2 and contents(table)["k1"] == (10, "8")
    before = contents(table)
    table.vacuum(grace_hours=0)
    assert contents(table) == before and len(list((tmp_path / "m").glob("rows-*"))) == len(table.state()["deltas"]) + 1


def test_a_replayed_batch_is_left_out(spark, tmp_path):
    table = merge_table(spark, tmp_path)
    assert table.append(versions(spark, [("a", 1, "x")]), ("s", 0))
    assert not table.append(versions(spark, [("a", 1, "x")]), ("s", 0))
    assert table.append(versions(spark, [("a", 0, "late")]), ("other", 0))
    assert len(table.state()["deltas"]) == 2 and contents(table) == {"a": (1, "x")}


def test_appends_and_compaction_at_once(spark, tmp_path):
    table = merge_table(spark, tmp_path)
    table.append(versions(spark, [("a", 0, "x")]))

    def work(w):
        for i in range(4):
            table.append(versions(spark, [(f"k{w}", i, str(w)), ("a", 10 * i + w, "y")]))
            table.compact(whole=w == 0)

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(work, range(3)))
    assert contents(table) == {"a": (32, "y"), "k0": (3, "0"), "k1": (3, "1"), "k2": (3, "2")}


def test_a_merged_table_gains_columns(spark, tmp_path):
    table = merge_table(spark, tmp_path)
    with pytest.raises(FileNotFoundError):
        table.read()
    table.append(versions(spark, [("a", 1, "x"), ("b", 1, "y")]))
    table.append(versions(spark, [("b", 2, "z")]).withColumn("extra", F.lit(7)))
    assert {r.k: (r.v, r.extra) for r in table.read().collect()} == {"a": ("x", None), "b": ("z", 7)}


def test_streamed_upsert_compacts_by_itself(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(900).selectExpr("concat('k', id % 50) k", "cast(id as int) at", "string(id) v").repartition(12).write.parquet(source)
    stream = spark.readStream.schema("k string, at int, v string").option("maxFilesPerTrigger", 1).parquet(source)
    table = merge_table(spark, tmp_path)
    stream_upsert(stream, table, str(tmp_path / "seen"))
    assert contents(table) == {f"k{i}": (850 + i, str(850 + i)) for i in range(50)}
    assert len(table.state()["deltas"]) < 12
    stream_upsert(stream, table, str(tmp_path / "seen"))
    assert table.read().count() == 50
