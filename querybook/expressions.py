"""Column expressions: calendar, one-hot, perspective, outcomes, time controls."""

from __future__ import annotations

from pyspark.sql import functions as F

from hindsight.config import WEEKDAYS
from hindsight.functions.calendar import day_name, local_time, seconds_of_day, weekday_flags
from hindsight.functions.encode import code, one_hot
from hindsight.functions.outcome import classify, perspective, population, termination
from hindsight.functions.text import time_control
from querybook.base import Book, table

book = Book()
ZONE = "America/New_York"
BRANDS = [f"Brand#{i}" for i in range(1, 10)]


def _local(column: str) -> str:
    return f"(({column} AT TIME ZONE 'UTC') AT TIME ZONE '{ZONE}')"


@book.add(
    f"SELECT o_orderkey, {_local('o_orderdate')} AS local_ts, CAST(hour({_local('o_orderdate')}) AS INT) AS local_hour, "
    f"dayname({_local('o_orderdate')}) AS local_day, CAST(hour({_local('o_orderdate')}) * 3600 + "
    f"minute({_local('o_orderdate')}) * 60 AS INT) AS second_of_day FROM orders"
)
def local_calendar(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", local_time("o_orderdate", ZONE).alias("local_ts"))
    return orders.select(
        "o_orderkey",
        "local_ts",
        F.hour("local_ts").alias("local_hour"),
        day_name("local_ts").alias("local_day"),
        seconds_of_day("local_ts").alias("second_of_day"),
    )


@book.add(
    "SELECT event_id, "
    + ", ".join(f"CAST(dayname({_local('ts')}) = '{d}' AS INT) AS Is{d}" for d in WEEKDAYS)
    + f", CAST(floor(epoch({_local('ts')})) % 86400 AS INT) AS second_of_day FROM events"
)
def weekday_one_hot(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", local_time("ts", ZONE).alias("l"))
    return rows.select("event_id", *weekday_flags("l"), seconds_of_day("l").alias("second_of_day"))


@book.add(
    "SELECT p_partkey, "
    + ", ".join(f"CASE WHEN p_brand = '{b}' THEN 1 ELSE 0 END AS \"is_{b}\"" for b in BRANDS)
    + f", CASE WHEN p_brand IN ({', '.join(repr(b) for b in BRANDS)}) THEN 0 ELSE 1 END AS is_other FROM part"
)
def one_hot_with_other(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", *one_hot("p_brand", BRANDS, "is_", other="other"))


@book.add(
    "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'c' || o_custkey WHEN o_orderkey % 3 = 1 "
    "THEN 's' || (o_orderkey % 7) END AS mine, CASE WHEN o_orderkey % 3 = 0 THEN 's' || (o_orderkey % 7) "
    "ELSE 'c' || o_custkey END AS theirs FROM orders",
    name="perspective",
)
def both_sides(spark, sf_dir):
    """Unmatched and null first names put me second."""
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "named_struct('name', concat('c', o_custkey)) first",
        "named_struct('name', if(o_orderkey % 3 = 2, null, concat('s', o_orderkey % 7))) second",
        "case o_orderkey % 3 when 0 then concat('c', o_custkey) when 1 then 'nobody' end me",
    )
    mine, theirs = perspective(F.col("first.name") == F.col("me"), "first", "second")
    return rows.select("o_orderkey", mine["name"].alias("mine"), theirs["name"].alias("theirs"))


CODE_SQL = (
    "CASE o_orderkey % 6 WHEN 0 THEN 'win' WHEN 1 THEN 'agreed' WHEN 2 THEN 'stalemate' WHEN 3 THEN 'resigned' "
    "WHEN 4 THEN '50move' END"
)


@book.add(
    f"WITH c AS (SELECT o_orderkey, {CODE_SQL} AS mine, CASE WHEN o_orderkey % 2 = 0 THEN 'timeout' ELSE 'win' END AS "
    "theirs FROM orders), r AS (SELECT *, CASE WHEN mine = 'win' THEN 'won' WHEN mine IN ('agreed', 'stalemate', "
    "'50move') THEN 'draw' ELSE 'lost' END AS result FROM c) SELECT o_orderkey, result, "
    "CASE WHEN mine IS NULL THEN 'unknown' ELSE result END AS strict_result, "
    "CASE WHEN result = 'won' THEN theirs ELSE mine END AS termination, "
    "CASE result WHEN 'won' THEN 0 WHEN 'draw' THEN 1 ELSE 2 END AS code FROM r"
)
def classify_result(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "element_at(array('win', 'agreed', 'stalemate', 'resigned', '50move', null), cast(o_orderkey % 6 as int) + 1) mine",
        "if(o_orderkey % 2 = 0, 'timeout', 'win') theirs",
    )
    rows = rows.withColumns({"result": classify("mine"), "strict_result": classify("mine", unknown="unknown")})
    return rows.select(
        "o_orderkey",
        "result",
        "strict_result",
        termination("result", "mine", "theirs").alias("termination"),
        code("result", {"won": 0, "draw": 1, "lost": 2}, 2).alias("code"),
    )


@book.add(
    "SELECT p_partkey, CAST(CASE p_partkey % 4 WHEN 0 THEN p_size WHEN 1 THEN p_size END AS DOUBLE) AS base_seconds, "
    "CAST(CASE p_partkey % 4 WHEN 0 THEN 0 WHEN 1 THEN p_partkey % 30 END AS DOUBLE) AS increment_seconds FROM part"
)
def parse_control(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "case p_partkey % 4 when 0 then cast(p_size as string) when 1 then concat(p_size, '+', p_partkey % 30) "
        "when 2 then concat('1/', p_size) end control",
    )
    base, increment = time_control("control")
    return rows.select(
        "p_partkey", base.cast("double").alias("base_seconds"), increment.cast("double").alias("increment_seconds")
    )


@book.add(
    "WITH f AS (SELECT event_id, event_id % 2 = 0 AS a, CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 5 = 0 END "
    "AS b, CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS t FROM events) SELECT event_id, "
    "a AND t = 'click' AND event_id % 3 <> 0 AND NOT b AND event_id % 11 <> 0 AS in_population FROM f"
)
def population_flag(spark, sf_dir):
    """Three-valued: unknown parts leave the flag unknown unless another part is false."""
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "event_id % 2 = 0 rated",
        "if(event_type = 'view', null, event_type) time_class",
        "if(event_id % 3 <> 0, 'chess', 'other') rules",
        "if(event_id % 7 = 0, null, event_id % 5 = 0) is_friend",
        "event_id % 11 = 0 is_self_play",
    )
    return rows.select("event_id", population(time_class="click").alias("in_population"))
