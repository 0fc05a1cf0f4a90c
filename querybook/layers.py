"""Silver and gold from snapshots to features, their reports and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from hindsight.config import DAY, ECO_CODES, FEATURES_48, WEEK, WEEKDAYS, Settings
from hindsight.operators import checks as q
from hindsight.plans import gold, silver
from hindsight.plans.checks import game_rules, gold_rules, layer_report
from hindsight.plans.incremental import refresh_gold
from hindsight.plans.run import Layout, refresh_silver, with_month
from hindsight.schemas import GAME_KEY
from hindsight.session import shared_dir, stage
from hindsight.sources.landing import land_snapshots
from hindsight.streaming.ingest import ingest_stream, payload_stream
from querybook import standins
from querybook.base import Book
from querybook.ingestion import payloads
from querybook.standins import GAMES_SQL, MOVES_SQL, POPULATION_SQL

book = Book()
ZONE = Settings().zone
#: The games of the reference: a floor that the population of the smaller given tables is below and that of the largest above.
LEAST_POPULATION = 5_769


def games(spark, sf_dir):
    return silver.build_games(
        standins.snapshots(spark, sf_dir), standins.accounts(spark, sf_dir), standins.friends(spark, sf_dir)
    )


GAME_COLUMNS = [
    "game_uuid", "account", "person_id", "account_code", "rated", "time_class", "rules", "time_control", "color",
    "my_rating", "opp_rating", "opp_username", "result", "termination", "eco_code", "is_friend", "is_self_play",
]
SILVER_SQL = (
    f"WITH {GAMES_SQL} SELECT {', '.join(GAME_COLUMNS)}, base_seconds::DOUBLE AS base_seconds, "
    "increment_seconds::DOUBLE AS increment_seconds, end_sec, epoch(start_ts)::DOUBLE AS start_sec FROM games"
)


def _comparable(all_games):
    return all_games.select(
        *GAME_COLUMNS,
        *[F.col(c).cast("double").alias(c) for c in ("base_seconds", "increment_seconds")],
        F.unix_timestamp("end_ts").alias("end_sec"),
        F.unix_timestamp("start_ts").cast("double").alias("start_sec"),
    )


@book.add(SILVER_SQL)
def silver_games(spark, sf_dir):
    return _comparable(games(spark, sf_dir))


@book.add(SILVER_SQL)
def incremental_games(spark, sf_dir):
    """The same games from payloads landed in two goes, each taken in by a streaming run."""
    landing, layout = shared_dir(spark, "landing"), Layout(spark, shared_dir(spark, "lake"))
    dimensions = standins.accounts(spark, sf_dir), standins.friends(spark, sf_dir)
    waiting = payloads(spark, sf_dir)
    first = F.pmod(F.xxhash64("payload"), F.lit(2)) == 0
    for part in (first, ~first):
        land_snapshots(waiting.where(part), landing)
        ingest_stream(payload_stream(spark, landing), layout.path("bronze"), layout.path("seen"))
        refresh_silver(layout, *dimensions)
    return _comparable(layout.games.read())


@book.add(
    f"WITH {GAMES_SQL}, {MOVES_SQL} SELECT game_uuid, account, ply, move_number, side, san, clock_seconds, is_my_move "
    "FROM moves"
)
def silver_moves(spark, sf_dir):
    return silver.build_moves(games(spark, sf_dir)).drop("clock_str")


@book.add(
    f"WITH {GAMES_SQL} SELECT (SELECT CAST(sum((CASE WHEN event_id % 4 = 0 THEN 2 ELSE 1 END) * "
    "(CASE WHEN event_id % 6 = 0 THEN 2 ELSE 1 END)) AS BIGINT) FROM events) AS rows_read, "
    "count(*) AS games_kept, count(DISTINCT (game_uuid, account)) AS keys, "
    "count(*) FILTER (is_self_play) AS self_played, count(*) FILTER (is_friend) AS with_friends FROM games"
)
def dedup_proof(spark, sf_dir):
    return silver.dedup_proof(standins.snapshots(spark, sf_dir), games(spark, sf_dir))


@book.add(
    f"WITH {GAMES_SQL} SELECT account, time_class, base_seconds::DOUBLE AS base_seconds, count(*) AS games FROM games "
    "WHERE rules = 'chess' GROUP BY ALL"
)
def class_crosstab(spark, sf_dir):
    counted = silver.class_crosstab(games(spark, sf_dir))
    return counted.withColumn("base_seconds", F.col("base_seconds").cast("double"))


@book.add(f"WITH {GAMES_SQL} SELECT count(*) AS model_population FROM games WHERE {POPULATION_SQL}")
def population_size(spark, sf_dir):
    return silver.population_size(games(spark, sf_dir))


@book.add(
    f"WITH {GAMES_SQL}, {MOVES_SQL} SELECT count(*) AS rows, count(*) FILTER (san LIKE '%=%') AS promotions, "
    "count(DISTINCT game_uuid) AS games FROM moves"
)
def move_volume(spark, sf_dir):
    return silver.move_volume(silver.build_moves(games(spark, sf_dir)))


@book.add(
    f"WITH {GAMES_SQL}, {MOVES_SQL} SELECT count(*) AS orphan_move_rows FROM moves m WHERE NOT EXISTS "
    "(SELECT 1 FROM games g WHERE g.game_uuid = m.game_uuid AND g.account = m.account AND g.rated)"
)
def orphan_moves(spark, sf_dir):
    """Moves against rated games only, so that some are orphans."""
    all_games = stage(games(spark, sf_dir), "games")
    return silver.orphan_moves(silver.build_moves(all_games), all_games.where("rated"))


# --- gold ---------------------------------------------------------------------


def _frame(name: str, outcome: str) -> str:
    return (
        f"CASE WHEN count(*) OVER {name} > 0 THEN round(100.0::DOUBLE * "
        f"sum(CASE WHEN result = '{outcome}' THEN 1 ELSE 0 END) OVER {name} / count(*) OVER {name}, 2) "
        "ELSE 0.0::DOUBLE END"
    )


CONTEXT_SQL = f"""
context AS (
  SELECT *, count(*) OVER daily + 1 AS nth_day, count(*) OVER weekly + 1 AS nth_week,
    {_frame('daily', 'won')} AS d_won, {_frame('daily', 'lost')} AS d_lost, {_frame('daily', 'draw')} AS d_draw,
    {_frame('weekly', 'won')} AS w_won, {_frame('weekly', 'lost')} AS w_lost, {_frame('weekly', 'draw')} AS w_draw,
    lag(result, 1) OVER line AS last1, lag(result, 2) OVER line AS last2, lag(end_sec, 1) OVER line AS prev_end
  FROM games
  WINDOW daily AS (PARTITION BY person_id ORDER BY activity_sec RANGE BETWEEN {DAY - 1} PRECEDING AND 1 PRECEDING),
         weekly AS (PARTITION BY person_id ORDER BY activity_sec RANGE BETWEEN {WEEK - 1} PRECEDING AND 1 PRECEDING),
         line AS (PARTITION BY person_id ORDER BY activity_sec, game_uuid, account))
"""

AGGREGATES_SQL = """
ranked AS (SELECT *, row_number() OVER (PARTITION BY game_uuid, account, is_my_move ORDER BY ply DESC) AS back FROM moves),
aggs AS (
  SELECT game_uuid, account,
    count(*) FILTER (is_my_move) AS my_n, count(*) FILTER (NOT is_my_move) AS opp_n,
    max(clock_seconds) FILTER (is_my_move AND back = 1) AS my_clock,
    max(clock_seconds) FILTER (NOT is_my_move AND back = 1) AS opp_clock,
    count(*) FILTER (is_my_move AND san IN ('O-O', 'O-O+', 'O-O#')) AS my_short,
    count(*) FILTER (is_my_move AND san IN ('O-O-O', 'O-O-O+', 'O-O-O#')) AS my_long,
    count(*) FILTER (NOT is_my_move AND san IN ('O-O', 'O-O+', 'O-O#')) AS opp_short,
    count(*) FILTER (NOT is_my_move AND san IN ('O-O-O', 'O-O-O+', 'O-O-O#')) AS opp_long,
    min(ply) FILTER (is_my_move AND san LIKE 'O-O%') AS my_castle,
    min(ply) FILTER (NOT is_my_move AND san LIKE 'O-O%') AS opp_castle
  FROM ranked GROUP BY game_uuid, account)
"""


def _used(side: str) -> str:
    return f"round(base_seconds + increment_seconds * {side}_n - {side}_clock, 2)"


FEATURES_SQL = f"""
gold AS (
  SELECT t.game_uuid, t.account AS account_id, person_id, epoch(start_ts)::DOUBLE AS start_sec, account_code AS "Account",
    {', '.join(f"CASE WHEN dayname(local) = '{d}' THEN 1 ELSE 0 END AS Is{d}" for d in WEEKDAYS)},
    (hour(local) * 3600 + minute(local) * 60 + floor(second(local)))::DOUBLE AS TimeOfDay,
    nth_day::INT AS GameOfDay, nth_week::INT AS GameOfWeek, base_seconds::DOUBLE AS TimeControl,
    my_rating - opp_rating AS EloDifference, CASE WHEN color = 'white' THEN 0 ELSE 1 END AS Color,
    CASE WHEN my_castle IS NOT NULL AND (opp_castle IS NULL OR my_castle < opp_castle) THEN 1 ELSE 0 END
      AS ICastledFirst,
    CASE WHEN my_short > 0 THEN 1 ELSE 0 END AS ICastledShort, CASE WHEN my_long > 0 THEN 1 ELSE 0 END AS ICastledLong,
    CASE WHEN opp_short > 0 THEN 1 ELSE 0 END AS OppCastledShort,
    CASE WHEN opp_long > 0 THEN 1 ELSE 0 END AS OppCastledLong,
    {', '.join(
        f'CASE WHEN {c} = {v!r} THEN 1 ELSE 0 END AS "{p}LastResultIs{n}"'
        for p, c in (("", "last1"), ("2nd", "last2")) for n, v in (("Win", "won"), ("Draw", "draw"), ("Loss", "lost"))
    )},
    coalesce(my_n, 0)::INT AS MyNumMoves, coalesce(opp_n, 0)::INT AS OppNumMoves,
    CASE WHEN coalesce(my_n, 0) > 0 THEN {_used('my')} ELSE 0.0::DOUBLE END AS MyTotalTime,
    CASE WHEN coalesce(opp_n, 0) > 0 THEN {_used('opp')} ELSE 0.0::DOUBLE END AS OppTotalTime,
    CASE WHEN coalesce(my_n, 0) > 0 THEN round({_used('my')} / my_n, 2) ELSE 0.0::DOUBLE END AS MyAvgTPM,
    CASE WHEN coalesce(opp_n, 0) > 0 THEN round({_used('opp')} / opp_n, 2) ELSE 0.0::DOUBLE END AS OppAvgTPM,
    CASE WHEN prev_end IS NOT NULL THEN greatest(0.0::DOUBLE, (activity_sec - prev_end)::DOUBLE) END AS TimeSinceLast,
    d_won AS DailyWinPerc, d_lost AS DailyLossPerc, d_draw AS DailyDrawPerc,
    w_won AS WeeklyWinPerc, w_lost AS WeeklyLossPerc, w_draw AS WeeklyDrawPerc,
    {', '.join(f"CASE WHEN eco_code = '{c}' THEN 1 ELSE 0 END AS ECO_{c}" for c in ECO_CODES)},
    CASE WHEN eco_code IN ({', '.join(repr(c) for c in ECO_CODES)}) THEN 0 ELSE 1 END AS ECO_Other,
    CASE result WHEN 'won' THEN 0 WHEN 'draw' THEN 1 ELSE 2 END AS Result
  FROM (SELECT *, (start_ts AT TIME ZONE 'UTC') AT TIME ZONE '{ZONE}' AS local FROM context WHERE {POPULATION_SQL}) t
  LEFT JOIN aggs a ON a.game_uuid = t.game_uuid AND a.account = t.account)
"""
GOLD_SQL = f"{GAMES_SQL}, {MOVES_SQL}, {CONTEXT_SQL}, {AGGREGATES_SQL}, {FEATURES_SQL}"


def features(spark, sf_dir):
    """Gold over written games, as a run of the layers has it."""
    all_games = stage(games(spark, sf_dir), "games")
    return gold.feature_table(all_games)


def _in_doubles(table):
    doubles = {c: F.col(c).cast("double") for c in ("TimeOfDay", "TimeControl")}
    return table.withColumns({**doubles, "start_sec": F.unix_timestamp("start_ts").cast("double")}).drop("start_ts")


@book.add(f"WITH {GOLD_SQL} SELECT * FROM gold")
def feature_table(spark, sf_dir):
    return _in_doubles(features(spark, sf_dir))


@book.add(f"WITH {GOLD_SQL} SELECT * FROM gold")
def incremental_gold(spark, sf_dir):
    """Gold kept up with games that come in three runs, those of the later runs all along the timelines."""
    layout = Layout(spark, shared_dir(spark, "lake"))
    waiting = stage(with_month(games(spark, sf_dir)), "games")
    run = F.pmod(F.xxhash64("game_uuid", "account"), F.lit(20))
    for part in (run > 1, run == 1, run == 0):
        layout.games.upsert(waiting.where(part), GAME_KEY, check=False)
        refresh_gold(layout.games, layout.edges, layout.gold)
    return _in_doubles(layout.features())


@book.add(
    f"WITH {GAMES_SQL}, l AS (SELECT *, ((coalesce(start_ts, make_timestamp(end_sec * 1000000)) AT TIME ZONE 'UTC') "
    f"AT TIME ZONE '{ZONE}') AS local FROM games) SELECT game_uuid, account, result, epoch(local)::BIGINT AS local_sec, "
    f"hour(local)::INT AS local_hour, dayname(local) AS local_day, {POPULATION_SQL} AS is_model_population FROM l"
)
def dashboard_rows(spark, sf_dir):
    rows = gold.dashboard_games(games(spark, sf_dir))
    return rows.select(
        "game_uuid", "account", "result", F.unix_timestamp("local_ts").alias("local_sec"), "local_hour", "local_day",
        "is_model_population",
    )


OPENINGS_SQL = " + ".join(f"ECO_{c}" for c in [*ECO_CODES, "Other"])


@book.add(
    f"WITH {GOLD_SQL} SELECT 'games of the population' AS measure, count(*) AS rows FROM games WHERE {POPULATION_SQL} "
    "UNION ALL SELECT 'rows of gold', count(*) FROM gold "
    f"UNION ALL SELECT 'rows of gold with one opening', count(*) FROM gold WHERE {OPENINGS_SQL} = 1 "
    "UNION ALL SELECT 'rows of gold without a game before', count(*) FROM gold WHERE TimeSinceLast IS NULL"
)
def gold_invariants(spark, sf_dir):
    all_games = stage(games(spark, sf_dir), "games")
    return gold.gold_invariants(all_games, gold.feature_table(all_games))


def _feature_row(name: str) -> str:
    return f"SELECT '{name}' AS feature, round(avg(\"{name}\"), {gold.DECIMALS}) AS average, max(\"{name}\")::DOUBLE AS largest FROM gold"


@book.add(f"WITH {GOLD_SQL} " + " UNION ALL ".join(_feature_row(name) for name in FEATURES_48))
def feature_sanity(spark, sf_dir):
    return gold.summary(features(spark, sf_dir))


@book.add(
    f"WITH {GOLD_SQL} SELECT Result, count(*) AS rows, round(100 * count(*)::DOUBLE / (SELECT count(*) FROM gold), 2) AS percent "
    "FROM gold GROUP BY Result"
)
def result_shares(spark, sf_dir):
    return gold.class_shares(stage(features(spark, sf_dir), "gold"))


@book.add(f"""
WITH {GOLD_SQL}, n AS (SELECT
  (SELECT count(*) FROM games) AS games, (SELECT count(*) FROM games WHERE {POPULATION_SQL}) AS pop,
  (SELECT count(*) FROM games WHERE rules = 'chess' AND start_ts IS NULL) AS nostart,
  (SELECT count(*) FROM gold) AS gold_rows, (SELECT count(*) FROM (SELECT person_id FROM gold GROUP BY 1 HAVING count(*) FILTER (TimeSinceLast IS NULL) > 1)) AS firsts)
SELECT unnest([
  {{'name': 'games schema contract', 'ok': true, 'detail': 'missing: [], mistyped: []'}},
  {{'name': 'moves schema contract', 'ok': true, 'detail': 'missing: [], mistyped: []'}},
  {{'name': 'games key uniqueness', 'ok': true, 'detail': '0 repeated keys'}},
  {{'name': 'moves key uniqueness', 'ok': true, 'detail': '0 repeated keys'}},
  {{'name': 'games row-count floor', 'ok': games >= 500, 'detail': games || ' rows, at least 500'}},
  {{'name': 'model population floor', 'ok': pop >= {LEAST_POPULATION}, 'detail': pop || ' rows, at least {LEAST_POPULATION}'}},
  {{'name': 'standard games have start_ts', 'ok': nostart <= 0, 'detail': nostart || ' bad rows, at most 0'}},
  {{'name': 'result domain', 'ok': true, 'detail': '0 bad rows, at most 0'}},
  {{'name': 'bronze to silver reconciliation', 'ok': true, 'detail': '0 keys missing, 0 keys extra'}},
  {{'name': 'no orphan move rows', 'ok': true, 'detail': '0 orphan rows'}},
  {{'name': 'gold rows equal model population', 'ok': gold_rows = pop, 'detail': gold_rows || ' rows, expected ' || pop}},
  {{'name': 'gold feature count', 'ok': true, 'detail': '48 columns, expected 48'}},
  {{'name': 'TimeSinceLast null only for a first game', 'ok': firsts = 0,
    'detail': firsts || ' values of person_id with more than 1 bad rows'}},
  {{'name': 'every game in exactly one opening', 'ok': true, 'detail': '0 bad rows, at most 0'}}
], recursive := true) FROM n
""")
def check_report(spark, sf_dir):
    """All rules at once; the rule on start times fails on these data, and is reported so."""
    settings = Settings(min_games=500, min_population=LEAST_POPULATION)
    bronze = standins.snapshots(spark, sf_dir)
    games_watch = q.Watch(games(spark, sf_dir), game_rules(settings))
    all_games = stage(games_watch.rows, "games")
    moves = stage(silver.build_moves(all_games), "moves")
    gold_watch = q.Watch(gold.feature_table(all_games), gold_rules(settings))
    table = stage(gold_watch.rows, "gold")
    return layer_report(bronze, all_games, moves, table, settings, games_watch, gold_watch)


@book.add(
    f"WITH {GAMES_SQL} SELECT 'standard games have start_ts' AS rule, game_uuid, account FROM games WHERE rules = 'chess' AND start_ts IS NULL "
    "UNION ALL SELECT 'rated', game_uuid, account FROM games WHERE NOT rated"
)
def offending_rows(spark, sf_dir):
    """Which games break which rule."""
    rules = [*[r for r in game_rules() if isinstance(r, q.RowRule)], q.RowRule("rated", F.col("rated"))]
    return q.offending_rows(games(spark, sf_dir), rules, GAME_KEY)


@book.add(
    f"WITH {GAMES_SQL}, {MOVES_SQL}, kept AS (SELECT * FROM games WHERE id % 10 <> 3), twice AS (SELECT * FROM kept WHERE id % 10 = 7), "
    "read AS (SELECT * FROM games WHERE id % 10 <> 4), n AS (SELECT game_uuid, account, count(*) AS moves FROM moves GROUP BY ALL) "
    "SELECT 'missing' AS problem, game_uuid, account, CAST((CASE WHEN id % 4 = 0 THEN 2 ELSE 1 END) * (CASE WHEN id % 6 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS rows "
    "FROM games WHERE id % 10 = 3 UNION ALL SELECT 'extra', game_uuid, account, 1 FROM games WHERE id % 10 = 4 "
    "UNION ALL SELECT 'repeated', game_uuid, account, 2 FROM twice "
    "UNION ALL SELECT 'orphan', game_uuid, account, moves FROM n JOIN games USING (game_uuid, account) WHERE id % 10 = 3 "
    "UNION ALL SELECT 'repeated child', game_uuid, account, 1 FROM moves WHERE id % 10 = 5 AND ply = 2"
)
def offending_keys(spark, sf_dir):
    """Keys that are missing, extra, repeated or orphaned, of layers that were made so."""
    last = F.substring("game_uuid", -1, 1)
    bronze = silver.explode_games(standins.snapshots(spark, sf_dir)).where(last != "4")
    all_games = stage(games(spark, sf_dir), "games")
    moves = silver.build_moves(all_games)
    kept = all_games.where(last != "3")
    again = moves.where((last == "5") & (F.col("ply") == 2))
    return q.Lineage(bronze, kept.unionByName(kept.where(last == "7")), moves.unionByName(again), GAME_KEY, "ply").offenders()
