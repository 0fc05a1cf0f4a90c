"""The quality gate over silver and gold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindsight.config import FEATURES_48, OUTCOMES, Settings
from hindsight.functions.outcome import population
from hindsight.operators import checks as q
from hindsight.plans.gold import feature_names
from hindsight.plans.silver import explode_games
from hindsight.schemas import GAME_KEY, GAMES_CONTRACT, MOVE_KEY, MOVES_CONTRACT


def game_rules(settings: Settings = Settings()) -> list:
    """Rules on single games; the first two are floors."""
    return [
        q.Floor("games row-count floor", settings.min_games),
        q.Floor("model population floor", settings.min_population, population(settings.rules, settings.time_class)),
        q.not_null_where("standard games have start_ts", "start_ts", F.col("rules") == settings.rules),
        q.in_domain("result domain", "result", list(OUTCOMES)),
    ]


def gold_rules(settings: Settings = Settings()) -> list:
    openings = [f"ECO_{c}" for c in settings.openings] + ["ECO_Other"]
    return [q.one_hot_sum("every game in exactly one opening", openings)]


def layer_report(
    bronze: DataFrame,
    games: DataFrame,
    moves: DataFrame,
    gold: DataFrame,
    settings: Settings = Settings(),
    games_watch: q.Watch | None = None,
    gold_watch: q.Watch | None = None,
) -> DataFrame:
    """One row per check.

    Keys of bronze, games and moves are settled by one aggregation over all
    three, and repeated keys of moves by one over these. Rules on single rows were counted while games and gold were written
    where there is a watch for them (``game_rules``, ``gold_rules``), and take
    one pass over the table otherwise.
    """
    spark = games.sparkSession
    besides = len(gold.columns) - len(feature_names(gold))
    expected = len(FEATURES_48) - 9 + len(settings.openings)
    per_person = q.null_bound("TimeSinceLast null only for a first game", "TimeSinceLast", per="person_id")
    lineage = q.Lineage(explode_games(bronze), games, moves, GAME_KEY, "ply")
    if games_watch and gold_watch:
        same = q.check_equal_counts(spark, gold_watch.count(), games_watch.count("model population floor"), SAME_COUNT)
    else:
        same = q.check_same_count(gold, games.where(population(settings.rules, settings.time_class)), SAME_COUNT)
    return q.combine(
        [
            q.check_columns(games, "games schema contract", GAMES_CONTRACT),
            q.check_columns(moves, "moves schema contract", MOVES_CONTRACT),
            lineage.check("games key uniqueness", "bronze to silver reconciliation", None, "no orphan move rows"),
            q.check_unique(moves, "moves key uniqueness", MOVE_KEY),
            games_watch.report() if games_watch else q.check_rows(games, game_rules(settings)),
            same,
            q.check_width(gold, "gold feature count", expected, besides),
            q.check_rows(gold, [per_person]),
            gold_watch.report() if gold_watch else q.check_rows(gold, gold_rules(settings)),
        ]
    )


SAME_COUNT = "gold rows equal model population"
