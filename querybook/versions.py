"""Newest version per key, upsert and nested snapshots."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from hindsight.operators.latest import duplicate_counts, latest_per_key
from hindsight.operators.upsert import duplicate_keys, upsert, upsert_groups
from hindsight.session import shared_dir
from hindsight.sources.bronze import bronze_counts, dedup_preview as preview, sample_games, widen
from hindsight.sources.tables import create_namespaces, create_once, PartitionedTable, VersionedTable, create_view
from querybook.base import Book, table
from querybook.standins import snapshots

book = Book()

LINE_KEY = ["l_orderkey", "l_linenumber"]
NEWEST = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
LINE_COLUMNS = [*LINE_KEY, "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
NEWEST_SQL = "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC"
LINES_SQL = ", ".join(LINE_COLUMNS)


def _latest_sql(source: str) -> str:
    return (
        f"SELECT {LINES_SQL}, l_shipdate FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {NEWEST_SQL}) = 1"
    )


SPLIT_SQL = (
    f"o AS ({_latest_sql('lineitem WHERE l_shipdate < TIMESTAMP ' + chr(39) + '1998-01-01' + chr(39))}), "
    f"n AS ({_latest_sql('lineitem WHERE l_shipdate >= TIMESTAMP ' + chr(39) + '1998-01-01' + chr(39))})"
)


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS, "l_shipdate")


def _old_and_new(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    cut = F.lit("1998-01-01").cast("timestamp")
    old, new = (lines.where(c) for c in (F.col("l_shipdate") < cut, F.col("l_shipdate") >= cut))
    return latest_per_key(old, LINE_KEY, NEWEST), latest_per_key(new, LINE_KEY, NEWEST)


@book.add(f"SELECT {LINES_SQL} FROM ({_latest_sql('lineitem')})")
def latest_snapshot(spark, sf_dir):
    return latest_per_key(_lines(spark, sf_dir), LINE_KEY, NEWEST).select(*LINE_COLUMNS)


@book.add(
    "SELECT count(*) AS rows, count(*) AS keyed_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys "
    "FROM lineitem"
)
def duplicate_key_counts(spark, sf_dir):
    return duplicate_counts(_lines(spark, sf_dir), LINE_KEY)


@book.add("SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def key_uniqueness(spark, sf_dir):
    return duplicate_keys(_lines(spark, sf_dir), LINE_KEY)


UPSERT_SQL = (
    f"WITH {SPLIT_SQL} SELECT {LINES_SQL} FROM n UNION ALL SELECT {LINES_SQL} FROM o "
    "WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.l_orderkey = o.l_orderkey AND n.l_linenumber = o.l_linenumber)"
)


@book.add(UPSERT_SQL)
def upsert_lines(spark, sf_dir):
    old, new = _old_and_new(spark, sf_dir)
    return upsert(old, new, LINE_KEY).select(*LINE_COLUMNS)


@book.add(
    f"WITH {SPLIT_SQL} SELECT {LINES_SQL} FROM n UNION ALL SELECT {LINES_SQL} FROM o "
    "WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.l_orderkey = o.l_orderkey)",
    name="upsert_groups",
)
def upsert_order_groups(spark, sf_dir):
    old, new = _old_and_new(spark, sf_dir)
    return upsert_groups(old, new, ["l_orderkey"]).select(*LINE_COLUMNS)


@book.add(UPSERT_SQL)
def versioned_table_upsert(spark, sf_dir):
    """Create on the first run, upsert on the second, and read what is current."""
    lines = VersionedTable(spark, shared_dir(spark, "lines"))
    for part in _old_and_new(spark, sf_dir):
        lines.upsert(part, LINE_KEY)
    return lines.read().select(*LINE_COLUMNS)


@book.add(UPSERT_SQL)
def view_of_current_version(spark, sf_dir):
    """A view over the table's current version, as readers see it."""
    lines = VersionedTable(spark, shared_dir(spark, "lines"))
    for part in _old_and_new(spark, sf_dir):
        lines.upsert(part, LINE_KEY)
    location = lines.location(lines.current())
    create_view(spark, "current_lines", f"SELECT * FROM parquet.`{location}`", temporary=True)
    return spark.table("current_lines").select(*LINE_COLUMNS)


@book.add(UPSERT_SQL)
def partitioned_table_upsert(spark, sf_dir):
    """The same into a table by ship month; keys change month, so old copies must go."""
    lines = PartitionedTable(spark, shared_dir(spark, "lines-by-month"), "ship_month")
    for part in _old_and_new(spark, sf_dir):
        lines.upsert(part.withColumn("ship_month", F.date_format("l_shipdate", "yyyy-MM")), LINE_KEY)
    return lines.read().select(*LINE_COLUMNS)


@book.add(UPSERT_SQL)
def concurrent_upserts(spark, sf_dir):
    """Two writers at once, whose orders share all months: each finds the other's commits and writes on top."""
    path = shared_dir(spark, "lines-of-two")
    parts = [p.withColumn("ship_month", F.date_format("l_shipdate", "yyyy-MM")) for p in _old_and_new(spark, sf_dir)]

    def write(odd: int) -> None:
        lines = PartitionedTable(spark, path, "ship_month")
        for part in parts:
            lines.upsert(part.where(F.col("l_orderkey") % 2 == odd), LINE_KEY)

    with ThreadPoolExecutor(2) as writers:
        list(writers.map(write, (0, 1)))
    lines = PartitionedTable(spark, path, "ship_month")
    if len(lines.manifests()) != 4:
        raise AssertionError("a write is missing")
    return lines.read().select(*LINE_COLUMNS)


@book.add(
    "SELECT count(*) + count(*) FILTER (event_id % 4 = 0) AS snapshot_files, "
    "CAST(sum((CASE WHEN event_id % 4 = 0 THEN 2 ELSE 1 END) * (CASE WHEN event_id % 6 = 0 THEN 2 ELSE 1 END)) "
    "AS BIGINT) AS game_rows_incl_duplicates FROM events"
)
def nested_explode_counts(spark, sf_dir):
    return bronze_counts(snapshots(spark, sf_dir))


@book.add(
    "SELECT CAST(sum((CASE WHEN event_id % 4 = 0 THEN 2 ELSE 1 END) * (CASE WHEN event_id % 6 = 0 THEN 2 ELSE 1 END)) "
    "AS BIGINT) AS game_rows_incl_duplicates, count(*) AS distinct_games FROM events WHERE event_id % 97 <> 0"
)
def dedup_preview(spark, sf_dir):
    return preview(snapshots(spark, sf_dir))


@book.add(
    "SELECT 'g' || event_id AS uuid, 'u/' || event_id AS url, floor(epoch(ts))::BIGINT + floor(value)::BIGINT AS end_time, "
    "list_extract(['600', '600+5', '900+10', '180', '1/259200'], (event_id % 5 + 1)::INT) AS time_control "
    "FROM events WHERE event_id % 97 <> 0 ORDER BY uuid LIMIT 1"
)
def game_sample(spark, sf_dir):
    """One raw game to look at, the one of the least key."""
    return sample_games(snapshots(spark, sf_dir)).select("uuid", "url", "end_time", "time_control")


@book.add("SELECT n_nationkey, n_name FROM nation")
def named_table(spark, sf_dir):
    """A catalog table created on the first run and left alone by the second."""
    create_namespaces(spark, "querybook_")
    name = f"querybook_silver.nations_{uuid.uuid4().hex}"
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    if not create_once(nations, name) or create_once(nations.limit(0), name):
        raise AssertionError("created other than once")
    return spark.table(name)


@book.add(
    "SELECT o_orderkey, o_totalprice, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END "
    "AS o_orderpriority FROM orders"
)
def schema_evolution(spark, sf_dir):
    """Rows written before a field existed read as null beside later ones."""
    orders = table(spark, sf_dir, "orders")
    cut = F.lit("1998-01-01").cast("timestamp")
    old = orders.where(F.col("o_orderdate") < cut).select("o_orderkey", "o_totalprice")
    new = orders.where(F.col("o_orderdate") >= cut).select("o_orderkey", "o_totalprice", "o_orderpriority")
    return widen(old, new)
