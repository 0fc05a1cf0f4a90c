"""Trailing windows, previous values and time since, over ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hindsight.config import DAY, WEEK
from hindsight.operators.timeline import Timeline, Trailing, time_since, timeline_features
from querybook.base import Book, table

book = Book()

PER_USER = Timeline(("user_id",), "sec", ("event_id",))
# One timeline for everybody.
GLOBAL = Timeline((), "sec", ("event_id",))


def activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with whole seconds, an end and an outcome."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "cast(floor(unix_micros(ts) / 1000000) as bigint) sec",
        "cast(floor(unix_micros(ts) / 1000000) + floor(value) as bigint) end_sec",
        "case event_type when 'purchase' then 'won' when 'signup' then 'won' when 'view' then 'draw' "
        "else 'lost' end result",
    )


def outcome_rates() -> dict:
    return {name: F.col("result") == name for name in ("won", "draw", "lost")}


ACTIVITY_SQL = """
a AS (
  SELECT event_id, user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS sec,
         CAST(floor(epoch(ts)) AS BIGINT) + CAST(floor(value) AS BIGINT) AS end_sec,
         CASE event_type WHEN 'purchase' THEN 'won' WHEN 'signup' THEN 'won' WHEN 'view' THEN 'draw' ELSE 'lost' END
           AS result
  FROM events)
"""


def frames_sql(partition: str) -> str:
    def rate(frame: str, name: str) -> str:
        return (
            f"CASE WHEN count(*) OVER {frame} > 0 THEN round(100.0::DOUBLE * "
            f"coalesce(sum(CASE WHEN result = '{name}' THEN 1 ELSE 0 END) OVER {frame}, 0) / "
            f"count(*) OVER {frame}, 2) ELSE 0.0::DOUBLE END AS {frame}_{name}"
        )

    columns = [f"count(*) OVER {f} AS {f}_n" for f in ("day", "week")]
    columns += [rate(f, n) for f in ("day", "week") for n in ("won", "draw", "lost")]
    return (
        f"WITH {ACTIVITY_SQL} SELECT event_id, {', '.join(columns)} FROM a WINDOW "
        f"day AS ({partition} ORDER BY sec RANGE BETWEEN 86399 PRECEDING AND 1 PRECEDING), "
        f"week AS ({partition} ORDER BY sec RANGE BETWEEN 604799 PRECEDING AND 1 PRECEDING)"
    )


def _frames(rates: dict) -> list[Trailing]:
    return [Trailing("day", DAY, rates), Trailing("week", WEEK, rates)]


@book.add(
    f"WITH {ACTIVITY_SQL} SELECT event_id, "
    "count(*) OVER (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 86399 PRECEDING AND 1 PRECEDING) + 1 AS nth_of_day, "
    "count(*) OVER (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 604799 PRECEDING AND 1 PRECEDING) + 1 AS nth_of_week "
    "FROM a"
)
def trailing_counts(spark, sf_dir):
    out = timeline_features(activities(spark, sf_dir), PER_USER, _frames({}))
    return out.select("event_id", (F.col("day_n") + 1).alias("nth_of_day"), (F.col("week_n") + 1).alias("nth_of_week"))


RATE_COLUMNS = ["event_id"] + [f"{f}_{c}" for f in ("day", "week") for c in ("n", "won", "draw", "lost")]


@book.add(frames_sql("PARTITION BY user_id"))
def trailing_rates(spark, sf_dir):
    out = timeline_features(activities(spark, sf_dir), PER_USER, _frames(outcome_rates()))
    return out.select(*RATE_COLUMNS)


@book.add(frames_sql(""))
def trailing_rates_global_bucketed(spark, sf_dir):
    out = timeline_features(activities(spark, sf_dir), GLOBAL, _frames(outcome_rates()))
    return out.select(*RATE_COLUMNS)


@book.add(
    f"WITH {ACTIVITY_SQL} SELECT event_id, lag(result, 1) OVER w AS last_result, lag(result, 2) OVER w AS second_last "
    "FROM a WINDOW w AS (PARTITION BY user_id ORDER BY sec, event_id)"
)
def previous_results(spark, sf_dir):
    out = timeline_features(activities(spark, sf_dir), PER_USER, previous={"result": 2})
    return out.select("event_id", F.col("prev1_result").alias("last_result"), F.col("prev2_result").alias("second_last"))


@book.add(
    f"WITH {ACTIVITY_SQL} SELECT event_id, lag(result, 1) OVER w AS last_result, lag(result, 2) OVER w AS second_last "
    "FROM a WINDOW w AS (ORDER BY sec, event_id)"
)
def previous_results_global_sliced(spark, sf_dir):
    out = timeline_features(activities(spark, sf_dir), GLOBAL, previous={"result": 2})
    return out.select("event_id", F.col("prev1_result").alias("last_result"), F.col("prev2_result").alias("second_last"))


@book.add(
    f"WITH {ACTIVITY_SQL}, p AS (SELECT event_id, sec, lag(end_sec) OVER (PARTITION BY user_id ORDER BY sec, event_id) "
    "AS prev FROM a) SELECT event_id, CASE WHEN prev IS NOT NULL THEN greatest(0.0::DOUBLE, (sec - prev)::DOUBLE) END "
    "AS time_since_last FROM p"
)
def time_since_last(spark, sf_dir):
    out = timeline_features(activities(spark, sf_dir), PER_USER, previous={"end_sec": 1})
    return out.select("event_id", time_since("sec", "prev1_end_sec").alias("time_since_last"))
