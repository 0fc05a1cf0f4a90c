"""Sync plans, landing, incremental ingestion."""

from __future__ import annotations

from pyspark.sql import functions as F

from hindsight.functions.text import names, path_value, year_month
from hindsight.session import shared_dir
from hindsight.sources import landing
from hindsight.sources.bronze import as_variant, drift, read_bronze, reopened
from hindsight.sources.merging import MergeTable
from hindsight.streaming.ingest import ingest_batch, ingest_stream, payload_stream
from hindsight.streaming.upsert import stream_upsert
from querybook.base import Book, table
from querybook.standins import snapshots

book = Book()


def _months(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.selectExpr(
        "concat('acct', o_custkey) account", "date_format(o_orderdate, 'yyyy') year", "date_format(o_orderdate, 'MM') month"
    ).distinct()


def archives(spark, sf_dir):
    """One archive per account and month of order, listed in calendar order."""
    listed = _months(spark, sf_dir).selectExpr(
        "account",
        "cast(year as int) * 12 + cast(month as int) ordinal",
        "concat('https://source.example/', account, '/games/', year, '/', month, if(month % 2 = 0, '/', '')) url",
    )
    return landing.with_year_month(listed)


def landed(spark, sf_dir):
    """Two of three months have landed, as file paths say."""
    paths = _months(spark, sf_dir).where("(cast(year as int) * 12 + cast(month as int)) % 3 <> 0").selectExpr(
        "concat('s/username=', account, '/year=', year, '/month=', month, '/games_20240101T000000Z.json') path"
    )
    return landing.landed_from_paths(paths, "path")


MONTHS_SQL = """
m AS (SELECT DISTINCT 'acct' || o_custkey AS account, strftime(o_orderdate, '%Y') AS year,
             strftime(o_orderdate, '%m') AS month, year(o_orderdate) * 12 + month(o_orderdate) AS ordinal FROM orders)
"""
PLAN_SQL = f"""
{MONTHS_SQL}, p AS (
  SELECT *, row_number() OVER (PARTITION BY account ORDER BY ordinal DESC) <= 2 AS tail, ordinal % 3 <> 0 AS landed
  FROM m), plan AS (
  SELECT account, year, month, ordinal, NOT landed OR tail AS due,
         CASE WHEN NOT landed THEN 'missing' WHEN tail THEN 'trailing' ELSE 'landed' END AS reason FROM p)
"""


@book.add(
    "SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month FROM orders"
)
def archive_year_month(spark, sf_dir):
    urls = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "concat('x/games/', date_format(o_orderdate, 'yyyy/MM'), if(o_orderkey % 2 = 0, '/', '')) url"
    )
    year, month = year_month("url")
    return urls.select("o_orderkey", year.alias("year"), month.alias("month"))


@book.add(f"WITH {MONTHS_SQL} SELECT account, year, month FROM m WHERE ordinal % 3 <> 0")
def landed_partitions(spark, sf_dir):
    return landed(spark, sf_dir)


@book.add(f"WITH {PLAN_SQL} SELECT account, year, month, due, reason FROM plan")
def sync_plan(spark, sf_dir):
    plan = landing.sync_plan(archives(spark, sf_dir), landed(spark, sf_dir), trailing_n=2)
    return plan.select("account", "year", "month", "due", "reason")


@book.add(f"WITH {PLAN_SQL} SELECT account, year, month, reason FROM plan WHERE reason = 'missing'")
def missing_archives(spark, sf_dir):
    plan = landing.sync_plan(archives(spark, sf_dir), landed(spark, sf_dir), trailing_n=0)
    return plan.where("due").select("account", "year", "month", "reason")


@book.add(f"""
WITH {PLAN_SQL}, o AS (
  SELECT *, CASE WHEN due AND ordinal % 7 <> 0 THEN ordinal % 50 END AS games, due AND ordinal % 7 = 0 AS failed,
         year || '/' || month AS ym FROM plan)
SELECT account, count(*) AS archives_at_source,
  coalesce(string_agg(ym, ',' ORDER BY ym) FILTER (games IS NOT NULL), '') AS fetched,
  count(*) FILTER (NOT due) AS skipped, CAST(coalesce(sum(games), 0) AS BIGINT) AS games_fetched,
  coalesce(string_agg(ym || ': timeout', ',' ORDER BY ym) FILTER (failed), '') AS errors
FROM o GROUP BY account
""")
def sync_summary(spark, sf_dir):
    plan = landing.sync_plan(archives(spark, sf_dir), landed(spark, sf_dir), trailing_n=2)
    outcomes = plan.where("due").selectExpr(
        "account", "year", "month", "if(ordinal % 7 <> 0, ordinal % 50, null) games",
        "if(ordinal % 7 = 0, 'timeout', null) error",
    )
    summary = landing.sync_summary(plan, outcomes)
    joined = {c: F.array_join(c, ",") for c in ("fetched", "errors")}
    return summary.withColumns(joined)


@book.add(f"""
WITH {MONTHS_SQL} SELECT account, min(year || '/' || month) AS first_month, max(year || '/' || month) AS last_month,
  count(*) AS archives FROM m GROUP BY account
""")
def archive_ranges(spark, sf_dir):
    return landing.archive_ranges(archives(spark, sf_dir))


@book.add("SELECT c_custkey, lower(c_mktsegment) || ',' || lower(c_name) AS names, 2 AS n FROM customer")
def name_list(spark, sf_dir):
    """A comma list with blanks and capitals as clean names."""
    customers = table(spark, sf_dir, "customer")
    listed = names(F.concat_ws(",", F.concat(F.lit(" "), "c_mktsegment"), F.lit(" "), F.concat("c_name", F.lit("  "))))
    return customers.select("c_custkey", F.array_join(listed, ",").alias("names"), F.size(listed).alias("n"))


# --- landing and ingestion over files made from events --------------------------

LANDED_SQL = """
s AS (SELECT 'p' || user_id || '_' || (event_id % 2) AS account, event_id,
      CASE WHEN event_id % 4 = 0 THEN 2 ELSE 1 END AS snapshots, CASE WHEN event_id % 6 = 0 THEN 2 ELSE 1 END AS copies
      FROM events)
"""
BY_ACCOUNT_SQL = f"""
WITH {LANDED_SQL} SELECT account, CAST(sum(snapshots) AS BIGINT) AS snapshots,
  CAST(sum(snapshots * copies) AS BIGINT) AS game_rows FROM s GROUP BY account
"""


def payloads(spark, sf_dir):
    """The snapshots as JSON documents waiting to be landed."""
    rows = snapshots(spark, sf_dir)
    path = "_source_file"
    return rows.select(
        *[path_value(path, k).alias(c) for k, c in zip(("username", "year", "month"), landing.MONTH_KEY)],
        F.to_json(F.struct("games")).alias("payload"),
        F.concat(F.lit("https://source.example/"), path).alias("source_url"),
        F.col("_file_modified_at").alias("fetched_at"),
    )


def _by_account(bronze):
    games = F.coalesce(F.size("games"), F.lit(0))
    return bronze.groupBy(path_value("_source_file", "username").alias("account")).agg(
        F.count("*").alias("snapshots"), F.sum(games).cast("bigint").alias("game_rows")
    )


def _land(spark, sf_dir, name):
    path = shared_dir(spark, name)
    landing.land_snapshots(payloads(spark, sf_dir), path)
    return path


@book.add(BY_ACCOUNT_SQL)
def land_snapshots(spark, sf_dir):
    """Landed payloads with the count of games each holds."""
    rows = spark.read.parquet(_land(spark, sf_dir, "landing"))
    return rows.groupBy(F.col("username").alias("account")).agg(
        F.count("*").alias("snapshots"), F.sum("game_count").cast("bigint").alias("game_rows")
    )


@book.add(f"WITH {LANDED_SQL} SELECT DISTINCT account, '2024' AS year, '01' AS month FROM s")
def landed_payload_months(spark, sf_dir):
    """Months present after landing, from the landed rows' own columns."""
    return landing.landed_rows(spark, _land(spark, sf_dir, "landing"))


@book.add(BY_ACCOUNT_SQL)
def stream_ingest(spark, sf_dir):
    """Landed rows into bronze; the second run finds nothing new."""
    path, bronze, checkpoint = (_land(spark, sf_dir, "landing"), shared_dir(spark, "bronze"), shared_dir(spark, "seen"))
    for _ in range(2):
        ingest_stream(payload_stream(spark, path), bronze, checkpoint)
    return _by_account(spark.read.parquet(bronze))


def _documents(spark, sf_dir, path):
    """JSON documents below username=/, one per account and thousand games or so."""
    # For ``explode`` Spark looks at each array's size first, which builds all games of a row twice.
    rows = snapshots(spark, sf_dir).select(
        path_value("_source_file", "username").alias("username"), F.posexplode_outer("games").alias("at", "g")
    ).where("at is not null").drop("at")
    sizes = rows.groupBy("username").agg(F.ceil(F.count("*") / 1000).alias("parts"))
    split = rows.join(sizes, "username").withColumn("part", F.pmod(F.xxhash64("g.uuid", "g.url"), F.col("parts")))
    documents = split.groupBy("username", "part").agg(F.to_json(F.struct(F.collect_list("g").alias("games"))).alias("d"))
    landing.write_documents(documents, "d", ["username"], path)


#: Events of a user in one document of ``evolving_bronze``, about.
EVENTS_A_DOCUMENT = 1000
GAME_ROWS_SQL = f"""
WITH {LANDED_SQL} SELECT account, CAST(sum(snapshots * copies) AS BIGINT) AS game_rows FROM s GROUP BY account
"""


@book.add(GAME_ROWS_SQL)
def batch_ingest(spark, sf_dir):
    """JSON files into bronze; the second run finds nothing new."""
    path, bronze = shared_dir(spark, "documents"), shared_dir(spark, "bronze")
    _documents(spark, sf_dir, path)
    for _ in range(2):
        ingest_batch(spark, path, bronze)
    return _by_account(read_bronze(spark, bronze)).select("account", "game_rows")


@book.add("""
SELECT 'p ' || user_id || '+é' AS account, count(*) AS games, count(DISTINCT event_id % 2) AS files,
  CAST(coalesce(sum(event_id) FILTER (event_id % 2 = 1), 0) AS BIGINT) AS deep FROM events GROUP BY user_id
""")
def evolving_bronze(spark, sf_dir):
    """Documents below odd names; later ones have a nested field that the schema doesn't name, and it is not lost.

    A user's half of the events may be many documents; ``files`` counts the halves that have any.
    """
    path, bronze = shared_dir(spark, "documents"), shared_dir(spark, "bronze")
    events = table(spark, sf_dir, "events").selectExpr("concat('p ', user_id, '+é') username", "event_id", "event_id % 2 later")
    plain = F.struct(F.concat(F.lit("g"), "event_id").alias("uuid"))
    wider = F.struct(F.concat(F.lit("g"), "event_id").alias("uuid"), F.struct(F.col("event_id").alias("deep")).alias("fresh"))
    sizes = events.groupBy("username", "later").agg(F.ceil(F.count("*") / EVENTS_A_DOCUMENT).alias("parts"))
    same = F.col("e.username").eqNullSafe(F.col("s.username")) & (F.col("e.later") == F.col("s.later"))
    split = events.alias("e").join(sizes.alias("s"), same).selectExpr("e.username", "e.later", "event_id", "pmod(xxhash64(event_id), parts) part")
    for later, fields in ((0, plain), (1, wider)):
        documents = split.where(F.col("later") == later).groupBy("username", "later", "part").agg(
            F.to_json(F.struct(F.collect_list(fields).alias("games"))).alias("d")
        )
        landing.write_documents(documents, "d", ["username", "later"], path)
        for _ in range(2):
            ingest_batch(spark, path, bronze)
    opened = reopened(read_bronze(spark, bronze), "games array<struct<uuid: string, fresh: struct<deep: bigint>>>")
    named = [path_value("_source_file", k).alias(c) for k, c in (("username", "account"), ("later", "later"))]
    rows = opened.select(*named, F.explode("games").alias("g"))
    return rows.groupBy("account").agg(
        F.count("*").alias("games"), F.count_distinct("later").alias("files"), F.coalesce(F.sum("g.fresh.deep"), F.lit(0)).alias("deep")
    )


@book.add("""
WITH e AS (SELECT event_id AS id FROM events), t AS (
  SELECT 'games' AS path, 'ARRAY' AS seen FROM e UNION ALL SELECT 'page', 'BIGINT' FROM e WHERE id % 3 = 0 UNION ALL
  SELECT 'games[].uuid', 'STRING' FROM e UNION ALL
  SELECT 'games[].rated', CASE WHEN id % 10 = 0 THEN 'STRING' ELSE 'BOOLEAN' END FROM e UNION ALL
  SELECT 'games[].fresh', 'OBJECT<deep: BIGINT>' FROM e WHERE id % 2 = 1)
SELECT path, seen, CASE path WHEN 'games[].uuid' THEN 'string' WHEN 'games[].rated' THEN 'boolean' WHEN 'games' THEN 'array' END AS declared,
  count(*) AS rows FROM t GROUP BY ALL
""")
def schema_drift(spark, sf_dir):
    """Fields that came new or as another type than declared, told from documents kept as variants."""
    texts = table(spark, sf_dir, "events").selectExpr("""
        concat('{"games":[{"uuid":"g', event_id, '","rated":', if(event_id % 10 = 0, '"yes"', 'true'),
               if(event_id % 2 = 1, concat(',"fresh":{"deep":', event_id, '}'), ''), '}]', if(event_id % 3 = 0, ',"page":1', ''), '}') value""")
    found = drift(texts.select(*as_variant("value")))
    return found.withColumn("declared", F.regexp_extract("declared", r"^\w+", 0))


@book.add(f"WITH {LANDED_SQL} SELECT DISTINCT account, '2024' AS year, '01' AS month FROM s")
def landed_files(spark, sf_dir):
    """Months present after documents landed as files, from a listing of those files."""
    path = shared_dir(spark, "files")
    rows = payloads(spark, sf_dir).groupBy(F.col("account").alias("username"), "year", "month").agg(F.min("payload").alias("d"))
    landing.write_documents(rows, "d", ["username", "year", "month"], path)
    return landing.landed_partitions(spark, path)


USERS_SQL = (
    "SELECT user_id, event_type, event_id FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"
)


def _streamed_users(spark, sf_dir):
    source, out, seen = (shared_dir(spark, n) for n in ("events", "users", "seen"))
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    events.repartition(4, "event_id").write.parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(source)
    users = MergeTable(spark, out, ("user_id",), ("ts", "event_id"))
    stream_upsert(stream, users, seen, compact=False)
    return users


@book.add(USERS_SQL)
def stream_upsert_users(spark, sf_dir):
    """The newest event of each user kept current while files of events stream in; merged when read."""
    return _streamed_users(spark, sf_dir).read().select("user_id", "event_type", "event_id")


@book.add(USERS_SQL)
def stream_upsert_compacted(spark, sf_dir):
    """The same once its deltas have become the base."""
    users = _streamed_users(spark, sf_dir)
    if len(users.state()["deltas"]) < 2 or not users.compact(whole=True) or users.state()["deltas"]:
        raise AssertionError("deltas left")
    return users.read().select("user_id", "event_type", "event_id")
