"""Descriptive findings: source profile, rates by hour, after losses, between groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindsight.config import Settings
from hindsight.operators.profile import compare_rates, rates, tally, top_values, value_counts
from hindsight.plans.gold import dashboard_games, with_context

DIMENSIONS = ["time_class", "rules", "time_control"]


def profile_games(games: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Counters per account and, with a null account, over all."""
    rated = F.coalesce("rated", F.lit(False))
    friend = F.coalesce("is_friend", F.lit(False))
    counters = {
        "rated": rated,
        "unrated": ~rated,
        "rated_rapid": rated & (F.col("time_class") == "rapid"),
        "rated_blitz": rated & (F.col("time_class") == "blitz"),
        "friend": friend,
        "friend_rated": friend & rated,
        "friend_unrated": friend & ~rated,
        "variants": ~F.coalesce(F.col("rules") == settings.rules, F.lit(False)),
    }
    return tally(games, ["account"], counters, total=True)


def top_dimensions(games: DataFrame, k: int = 6) -> DataFrame:
    """The k most frequent time classes, rules and time controls of each account."""
    by = ["account", "dimension"]
    return top_values(value_counts(games, ["account"], DIMENSIONS), by, k)


def claim_verdict(games: DataFrame, claim: int) -> DataFrame:
    """Total against a claimed number of rows."""
    total = F.count("*")
    return games.agg(total.alias("total"), (total - claim).alias("margin"), (total >= claim).alias("ok"))


def win_rate_by_local_hour(games: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return rates(dashboard_games(games, settings), ["local_hour"], F.col("result") == "won")


def win_rate_after_losses(games: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Win rate by how many of the two games before were lost in a row: 0, 1 or 2."""
    lost, lost_before = (F.coalesce(F.col(f"prev{i}_result") == "lost", F.lit(False)) for i in (1, 2))
    run = F.when(lost & lost_before, 2).when(lost, 1).otherwise(0).alias("losses_before")
    return rates(with_context(games, settings), [run], F.col("result") == "won")


def friends_against_others(games: DataFrame) -> DataFrame:
    return compare_rates(games, F.col("is_friend"), F.col("result") == "won")


def accounts_compared(games: DataFrame) -> DataFrame:
    """Win rates of first and other accounts."""
    return compare_rates(games, F.col("account_code") == 0, F.col("result") == "won")
