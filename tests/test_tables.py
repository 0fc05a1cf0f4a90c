import pytest
from pyspark.sql import functions as F

from hindsight.operators.upsert import DuplicateKeys, upsert, upsert_groups
from hindsight.sources.tables import (
    PartitionedTable,
    VersionedTable,
    create_namespaces,
    create_once,
    create_view,
    merge_statement,
    publish,
)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, part string, v int")


def rows_of(df):
    return sorted(((r.k or "", r.part, r.v) for r in df.select("k", "part", "v").collect()), key=str)


def test_upsert_and_null_keys(spark):
    old = frame(spark, [("a", "x", 1), ("b", "x", 2), (None, "x", 3)])
    new = frame(spark, [("b", "y", 20), (None, "y", 30), ("c", "y", 40)])
    want = [("", "y", 30), ("a", "x", 1), ("b", "y", 20), ("c", "y", 40)]
    once = upsert(old, new, ["k"])
    assert rows_of(once) == want
    assert rows_of(upsert(once, new, ["k"])) == want


def test_upsert_needs_unique_source(spark):
    with pytest.raises(DuplicateKeys):
        upsert(frame(spark, []), frame(spark, [("a", "x", 1), ("a", "x", 2)]), ["k"])


def test_group_upsert_drops_stale_rows(spark):
    old = frame(spark, [("a", "1", 1), ("a", "2", 2), ("b", "1", 3)])
    assert rows_of(upsert_groups(old, frame(spark, [("a", "1", 9)]), ["k"])) == [("a", "1", 9), ("b", "1", 3)]


def test_versions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    table.upsert(frame(spark, [("a", "x", 1)]), ["k"])
    table.upsert(frame(spark, [("a", "x", 2), ("b", "x", 3)]), ["k"])
    assert table.versions() == [1, 2]
    assert rows_of(table.read()) == [("a", "x", 2), ("b", "x", 3)]
    # a replay of version 2 starts from version 1 again
    table.upsert(frame(spark, [("c", "x", 4)]), ["k"], version=2)
    assert rows_of(table.read()) == [("a", "x", 1), ("c", "x", 4)]
    # an unfinished version does not count
    (tmp_path / "t" / "v=0000000003").mkdir()
    assert table.current() == 2
    # a rebuild may change the schema
    table.write(spark.range(3).select(F.col("id").alias("n")), 4)
    assert table.read().columns == ["n"]


def test_partitioned_upsert_touches_only_its_partitions(spark, tmp_path):
    path = tmp_path / "t"
    table = PartitionedTable(spark, str(path), "part")
    table.upsert(frame(spark, [("a", "01", 1), ("b", "02", 2), ("c", "03", 3), ("d", "04", 4)]), ["k"])
    before = table.manifest()
    # b moves to another partition, which empties its own; c changes in place; e is new
    table.upsert(frame(spark, [("b", "03", 20), ("c", "03", 30), ("e", "05", 5)]), ["k"])
    want = [("a", "01", 1), ("b", "03", 20), ("c", "03", 30), ("d", "04", 4), ("e", "05", 5)]
    assert rows_of(table.read()) == want
    after = table.manifest()
    assert after["part=01"] == before["part=01"] and after["part=03"] != before["part=03"] and "part=02" not in after
    # twice changes nothing
    table.upsert(frame(spark, [("e", "05", 5)]), ["k"])
    assert rows_of(table.read()) == want
    table.vacuum()
    assert rows_of(table.read()) == want and len(table.manifests()) == 1
    assert not list(path.glob("table_write=0000000001-*/part=02")) and list(path.glob("table_write=0000000001-*/part=01"))


def test_a_write_that_dies_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    table = PartitionedTable(spark, str(tmp_path / "t"), "part")
    table.upsert(frame(spark, [("a", "01", 1), ("b", "01", 2)]), ["k"])

    def die(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(PartitionedTable, "_commit", die)
        with pytest.raises(OSError):
            table.upsert(frame(spark, [("b", "02", 20)]), ["k"])
    assert rows_of(table.read()) == [("a", "01", 1), ("b", "01", 2)]
    table.upsert(frame(spark, [("b", "03", 30)]), ["k"])
    assert rows_of(table.read()) == [("a", "01", 1), ("b", "03", 30)]


def test_partition_names_are_escaped(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), "part")
    table.upsert(frame(spark, [("a", "x/y=1 %", 1), ("b", None, 2)]), ["k"])
    table.upsert(frame(spark, [("a", "x/y=1 %", 3)]), ["k"])
    assert sorted((r.k, r.part, r.v) for r in table.read().collect()) == [("a", "x/y=1 %", 3), ("b", None, 2)]
    create_namespaces(spark, "p_")
    try:
        publish(spark, "p_silver.things", table)
        assert sorted((r.k, r.part, r.v) for r in spark.table("p_silver.things").collect()) == [("a", "x/y=1 %", 3), ("b", None, 2)]
    finally:
        for name in ("bronze", "silver", "gold"):
            spark.sql(f"DROP SCHEMA IF EXISTS p_{name} CASCADE")


def test_partitioned_groups_and_null_partition(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), "part")
    table.upsert(frame(spark, [("a", None, 1), ("b", "02", 2)]), ["k"])
    table.replace_groups(frame(spark, []), frame(spark, [("a", "x", 0)]), ["k"])
    assert rows_of(table.read()) == [("b", "02", 2)]


def test_partitioned_gains_columns(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), "part")
    table.upsert(frame(spark, [("a", "01", 1), ("b", "02", 2)]), ["k"])
    wider = frame(spark, [("b", "02", 3)]).withColumn("extra", F.lit("new"))
    table.upsert(wider, ["k"])
    got = {(r.k, r.v, r.extra) for r in table.read(like=wider).collect()}
    assert got == {("a", 1, None), ("b", 3, "new")}


def test_catalog(spark, tmp_path):
    create_namespaces(spark, "t_")
    assert {"t_bronze", "t_silver", "t_gold"} <= {d.name for d in spark.catalog.listDatabases()}
    table = VersionedTable(spark, str(tmp_path / "t"))
    for n in (1, 2):
        table.upsert(frame(spark, [("a", "x", n)]), ["k"])
        publish(spark, "t_silver.things", table)
        assert rows_of(spark.table("t_silver.things")) == [("a", "x", n)]
    create_view(spark, "t_gold.seen", "SELECT k FROM t_silver.things")
    assert spark.table("t_gold.seen").collect()[0][0] == "a"
    try:
        assert create_once(frame(spark, [("a", "x", 1)]), "t_silver.once")
        assert not create_once(frame(spark, []), "t_silver.once")
        assert spark.table("t_silver.once").count() == 1
    finally:
        for name in ("bronze", "silver", "gold"):
            spark.sql(f"DROP SCHEMA IF EXISTS t_{name} CASCADE")


def test_merge_statement_parses(spark):
    sql = merge_statement("lake.silver.games", "incoming", ["a", "b"])
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    assert "MergeIntoTable" in plan.toString()
