"""Text into events, and aggregates over event sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from hindsight.functions.text import attribute, clock_seconds, header, header_timestamp
from hindsight.operators.sequence import (
    CLOCK_PATTERN,
    TOKEN_PATTERN,
    extract_sequence,
    is_long_castle,
    is_promotion,
    is_short_castle,
    number_moves,
    sequence_aggregates,
)
from querybook.base import Book, dealt, table

book = Book()

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]

# A text of two moves per line: the quantity as a promotion, then a castling move.
TEXT = """
concat('[UTCDate "', date_format(l_shipdate, 'yyyy.MM.dd'), '"]\\n[UTCTime "00:', lpad(l_partkey % 60, 2, '0'),
       ':07"]\\n\\n1. ', l_returnflag, cast(l_quantity as int), '=Q+ {[%clk 1:0', l_partkey % 10, ':',
       lpad(l_suppkey % 60, 2, '0'), '.5]} 1... ', if(l_partkey % 2 = 0, 'O-O#', 'O-O-O'), ' {[%clk 0:00:',
       lpad(l_partkey % 60, 2, '0'), ']}', if(l_suppkey % 3 = 0, ' 2. Nf3 {}', ''))
"""


def texts(spark, sf_dir):
    lines = dealt(table(spark, sf_dir, "lineitem").select(*LINE, "l_returnflag", "l_shipdate"), "l_orderkey")
    return lines.selectExpr(*LINE, f"{TEXT} text", "if(l_suppkey % 2 = 0, 'white', 'black') color")


def events(spark, sf_dir):
    found = extract_sequence(texts(spark, sf_dir), "text", {"san": TOKEN_PATTERN, "clock_str": CLOCK_PATTERN}, [*LINE, "color"])
    return number_moves(found, LINE)


PLIES_SQL = """
plies AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, 1 AS ply,
         l_returnflag || CAST(l_quantity AS INT) || '=Q+' AS san,
         3600 + (l_partkey % 10) * 60 + l_suppkey % 60 + 0.5::DOUBLE AS clock_seconds, l_suppkey % 2 = 0 AS is_my_move
  FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, 2,
         CASE WHEN l_partkey % 2 = 0 THEN 'O-O#' ELSE 'O-O-O' END, (l_partkey % 60)::DOUBLE, l_suppkey % 2 <> 0
  FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, 3, 'Nf3', NULL, l_suppkey % 2 = 0
  FROM lineitem WHERE l_suppkey % 3 = 0)
"""


@book.add(
    f"WITH {PLIES_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, ply, "
    "CAST((ply - 1) // 2 + 1 AS INT) AS move_number, CASE WHEN ply % 2 = 1 THEN 'white' ELSE 'black' END AS side, san, "
    "clock_seconds, is_my_move FROM plies"
)
def parse_sequence(spark, sf_dir):
    return events(spark, sf_dir).drop("clock_str")


@book.add(
    "SELECT event_id, (event_id % 3) * 3600 + (event_id % 60) * 60 + (event_id % 59) + (event_id % 10) / 10.0::DOUBLE "
    "AS clock_seconds FROM events"
)
def parse_clock(spark, sf_dir):
    clocks = table(spark, sf_dir, "events").selectExpr(
        "event_id", "concat(event_id % 3, ':', event_id % 60, ':', event_id % 59, '.', event_id % 10) clock"
    )
    return clocks.select("event_id", clock_seconds("clock").alias("clock_seconds"))


@book.add(
    "SELECT page_id, nullif(regexp_extract(html, 'lang=\"([^\"]*)\"', 1), '') AS lang, "
    "nullif(regexp_extract(html, 'href=\"([^\"]*)\"', 1), '') AS link FROM pages"
)
def attribute_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", attribute("html", "lang").alias("lang"), attribute("html", "href").alias("link"))


@book.add(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, NULL::VARCHAR AS eco, "
    "CAST(epoch(date_trunc('day', l_shipdate)) AS BIGINT) + (l_partkey % 60) * 60 + 7 AS start_sec FROM lineitem"
)
def header_extraction(spark, sf_dir):
    rows = texts(spark, sf_dir)
    start = F.unix_timestamp(header_timestamp("text"))
    return rows.select(*LINE, header("text", "ECO").alias("eco"), start.alias("start_sec"))


@book.add(
    f"WITH {PLIES_SQL} SELECT l_orderkey, count(*) AS moves, "
    "count(*) FILTER (contains(san, '=')) AS promotions, count(*) FILTER (san IN ('O-O', 'O-O#')) AS short_castles, "
    "count(*) FILTER (san IN ('O-O-O', 'O-O-O#')) AS long_castles FROM plies GROUP BY l_orderkey"
)
def move_kinds(spark, sf_dir):
    return events(spark, sf_dir).groupBy("l_orderkey").agg(
        F.count("*").alias("moves"),
        F.count_if(is_promotion("san")).alias("promotions"),
        F.count_if(is_short_castle("san")).alias("short_castles"),
        F.count_if(is_long_castle("san")).alias("long_castles"),
    )


@book.add("""
WITH t AS (
  SELECT conv_id, turn, role = 'user' AS mine, CASE WHEN turn % 3 = 1 THEN NULL ELSE length(text) END AS size,
         contains(text, 'e') AS hit FROM conversations),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, mine ORDER BY turn DESC) AS back FROM t)
SELECT conv_id, CAST(count(*) FILTER (mine) AS INT) AS my_moves, max(size) FILTER (mine AND back = 1) AS my_last_size,
  CAST(coalesce(max(CASE WHEN mine AND hit THEN 1 END), 0) AS INT) AS my_has_e, min(turn) FILTER (mine AND hit) AS my_first_e,
  CAST(count(*) FILTER (NOT mine) AS INT) AS opp_moves, max(size) FILTER (NOT mine AND back = 1) AS opp_last_size,
  CAST(coalesce(max(CASE WHEN NOT mine AND hit THEN 1 END), 0) AS INT) AS opp_has_e,
  min(turn) FILTER (NOT mine AND hit) AS opp_first_e
FROM r GROUP BY conv_id
""", name="sequence_aggregates")  # fmt: skip
def turns(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "turn", "role", "if(turn % 3 = 1, null, length(text)) size", "contains(text, 'e') hit"
    )
    hit = F.col("hit")
    mine = F.col("role") == "user"
    return sequence_aggregates(rows, ["conv_id"], mine, "turn", {"size": "size"}, {"has_e": hit}, {"e": hit})
