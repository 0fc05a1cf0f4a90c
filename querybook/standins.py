"""Game-shaped data derived row by row from the given tables, in Spark and in SQL.

``events`` become games: the user is the person, the time the start, the type
the outcome. Every derivation is local to its row, so it scales with the table
and collects no group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from querybook.base import dealt, table

# --- Spark side: raw snapshots, as a source would deliver them -----------------

MOVES_TEXT = """
concat_ws(' ', transform(filter(sequence(0, 6), i -> i < event_id % 7), i -> concat(
  cast(div(i, 2) + 1 as string), if(i % 2 = 0, '. ', '... '),
  case when i = 2 and event_id % 3 = 0 then 'O-O' when i = 2 and event_id % 3 = 1 then 'O-O-O+'
       when i = 3 and event_id % 2 = 0 then 'O-O#' when i = 3 then 'e8=Q+'
       else concat('e', cast(i + 1 as string)) end,
  if(event_id % 17 = 0 and i = event_id % 7 - 1, ' {}',
     concat(' {[%clk 0:0', cast(9 - i as string), ':', lpad(cast(59 - event_id % 50 as string), 2, '0'),
            '.', cast(event_id % 10 as string), ']}')))))
""".replace("div(i, 2)", "(i div 2)")

PGN = f"""
case when rules = 'bughouse' then null else concat(
  if(event_id % 101 = 0, '', concat(
     '[UTCDate "', date_format(ts, 'yyyy.MM.dd'), '"]\\n[UTCTime "', date_format(ts, 'HH:mm:ss'), '"]\\n')),
  if(eco_code is null, '', concat('[ECO "', eco_code, '"]\\n')), '\\n', {MOVES_TEXT}) end
"""

GAME = """
named_struct(
  'uuid', if(event_id % 97 = 0, null, concat('g', event_id)), 'url', concat('u/', event_id),
  'end_time', sec + cast(floor(value) as bigint), 'rated', event_id % 11 <> 0,
  'time_class', time_class, 'time_control', time_control, 'rules', rules,
  'eco', concat('openings/', coalesce(eco_code, '')), 'pgn', pgn,
  'white', if(event_id % 4 < 2, me, them), 'black', if(event_id % 4 < 2, them, me))
"""


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows: one snapshot per event, and a second, corrected one for every fourth."""
    rows = dealt(table(spark, sf_dir, "events"), "event_id").selectExpr(
        "event_id",
        "ts",
        "user_id",
        "value",
        "cast(floor(unix_micros(ts) / 1000000) as bigint) sec",
        "element_at(array('rapid', 'rapid', 'rapid', 'blitz', 'daily'), cast(event_id % 5 as int) + 1) time_class",
        "element_at(array('600', '600+5', '900+10', '180', '1/259200'), cast(event_id % 5 as int) + 1) time_control",
        "if(event_id % 13 = 0, 'bughouse', 'chess') rules",
        "element_at(array('A00', 'B10', 'D02', 'C99', 'D10', null), cast(event_id div 5 % 6 as int) + 1) eco_code",
        "case event_type when 'purchase' then array('win', 'checkmated') when 'signup' then array('win', 'timeout') "
        "when 'view' then array('agreed', 'agreed') when 'click' then array('resigned', 'win') "
        "else array(null, 'win') end codes",
        "inline(if(event_id % 4 = 0, array(named_struct('version', 1), named_struct('version', 2)), "
        "array(named_struct('version', 2))))",
    )
    rows = rows.selectExpr("*", f"{PGN} pgn")
    rows = rows.selectExpr(
        "*",
        "concat('P', user_id, '_', event_id % 2) account",
        "case when event_id % 29 = 0 then concat('P', user_id, '_', 1 - event_id % 2) "
        "when event_id % 31 = 0 then null else concat('Opp', event_id % 50) end opponent",
    )
    rows = rows.selectExpr(
        "*",
        "named_struct('username', account, 'rating', 1000 + event_id % 700 + if(event_id % 4 = 0, 7 * version, 14), "
        "'result', if(version = 1, 'agreed', codes[0])) me",
        "named_struct('username', opponent, 'rating', 1000 + event_id * 7 % 700, "
        "'result', if(version = 1, 'agreed', codes[1])) them",
    )
    return rows.selectExpr(
        f"if(event_id % 6 = 0, array({GAME}, {GAME}), array({GAME})) games",
        "concat('/landing/username=', lower(account), '/year=', date_format(ts, 'yyyy'), '/month=', "
        "date_format(ts, 'MM'), '/games_', version, '.json') _source_file",
        "ts + make_interval(0, 0, 0, version) _file_modified_at",
        "ts + make_interval(0, 0, 0, 3) _ingested_at",
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    return users.selectExpr(
        "concat('p', user_id) person_id",
        "inline(array(named_struct('account', concat('p', user_id, '_0'), 'account_code', 0), "
        "named_struct('account', concat('p', user_id, '_1'), 'account_code', 1)))",
    )


def friends(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").select("user_id").distinct().where("user_id % 3 = 0")
    return users.select(
        F.expr("concat('p', user_id)").alias("person_id"),
        F.explode(F.array(*[F.lit(f"opp{k}") for k in (3, 13, 23, 33, 43)])).alias("opponent"),
    )


# --- SQL side: what must come out, straight from the same columns -----------------

GAMES_SQL = """
raw AS (
  SELECT event_id AS id, user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS sec,
         date_trunc('second', ts) AS start_at,
         CAST(floor(epoch(ts)) AS BIGINT) + CAST(floor(value) AS BIGINT) AS end_sec
  FROM events),
games AS (
  SELECT id,
    CASE WHEN id % 97 = 0 THEN 'u/' || id ELSE 'g' || id END AS game_uuid,
    'p' || user_id || '_' || (id % 2) AS account,
    'p' || user_id AS person_id,
    CAST(id % 2 AS INT) AS account_code,
    id % 11 <> 0 AS rated,
    CASE WHEN id % 5 < 3 THEN 'rapid' WHEN id % 5 = 3 THEN 'blitz' ELSE 'daily' END AS time_class,
    CASE WHEN id % 13 = 0 THEN 'bughouse' ELSE 'chess' END AS rules,
    CASE id % 5 WHEN 0 THEN '600' WHEN 1 THEN '600+5' WHEN 2 THEN '900+10' WHEN 3 THEN '180' ELSE '1/259200' END
      AS time_control,
    CAST(CASE id % 5 WHEN 0 THEN 600 WHEN 1 THEN 600 WHEN 2 THEN 900 WHEN 3 THEN 180 END AS INT) AS base_seconds,
    CAST(CASE id % 5 WHEN 0 THEN 0 WHEN 1 THEN 5 WHEN 2 THEN 10 WHEN 3 THEN 0 END AS INT) AS increment_seconds,
    CASE WHEN id % 13 = 0 OR id % 101 = 0 THEN NULL ELSE start_at END AS start_ts,
    CASE WHEN id % 13 = 0 OR id % 101 = 0 THEN end_sec ELSE sec END AS activity_sec,
    end_sec,
    CASE WHEN id % 4 < 2 THEN 'white' ELSE 'black' END AS color,
    CAST(1000 + id % 700 + 14 AS INT) AS my_rating,
    CAST(1000 + id * 7 % 700 AS INT) AS opp_rating,
    CASE WHEN id % 29 = 0 THEN 'p' || user_id || '_' || (1 - id % 2) WHEN id % 31 = 0 THEN NULL
         ELSE 'opp' || (id % 50) END AS opp_username,
    CASE event_type WHEN 'purchase' THEN 'won' WHEN 'signup' THEN 'won' WHEN 'view' THEN 'draw' ELSE 'lost' END
      AS result,
    CASE event_type WHEN 'purchase' THEN 'checkmated' WHEN 'signup' THEN 'timeout' WHEN 'view' THEN 'agreed'
         WHEN 'click' THEN 'resigned' END AS termination,
    CASE WHEN id % 13 = 0 THEN NULL ELSE
      CASE (id // 5) % 6 WHEN 0 THEN 'A00' WHEN 1 THEN 'B10' WHEN 2 THEN 'D02' WHEN 3 THEN 'C99' WHEN 4 THEN 'D10' END
    END AS eco_code,
    CASE WHEN id % 29 = 0 THEN FALSE WHEN id % 31 = 0 THEN NULL ELSE user_id % 3 = 0 AND (id % 50) % 10 = 3 END
      AS is_friend,
    CASE WHEN id % 29 = 0 THEN TRUE WHEN id % 31 = 0 THEN NULL ELSE FALSE END AS is_self_play
  FROM raw)
"""

MOVES_SQL = """
moves AS (
  SELECT g.id, game_uuid, account, CAST(i + 1 AS INT) AS ply, CAST(i // 2 + 1 AS INT) AS move_number,
    CASE WHEN i % 2 = 0 THEN 'white' ELSE 'black' END AS side,
    CASE WHEN i = 2 AND id % 3 = 0 THEN 'O-O' WHEN i = 2 AND id % 3 = 1 THEN 'O-O-O+'
         WHEN i = 3 AND id % 2 = 0 THEN 'O-O#' WHEN i = 3 THEN 'e8=Q+' ELSE 'e' || (i + 1) END AS san,
    CASE WHEN id % 17 = 0 AND i = id % 7 - 1 THEN NULL
         ELSE (9 - i) * 60 + CAST((59 - id % 50) || '.' || (id % 10) AS DOUBLE) END AS clock_seconds,
    (i % 2 = 0) = (color = 'white') AS is_my_move
  FROM games g, range(7) AS plies(i)
  WHERE i < id % 7 AND rules = 'chess')
"""

POPULATION_SQL = "rated AND rules = 'chess' AND time_class = 'rapid' AND NOT is_friend AND NOT is_self_play"
