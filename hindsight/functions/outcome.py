"""Whose side a row is told from, how it ended, and which rows form the population."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from hindsight.config import DRAW_CODES
from hindsight.functions.text import ColumnOrName, _col


def perspective(is_first: Column, first: ColumnOrName, second: ColumnOrName) -> tuple[Column, Column]:
    """(mine, theirs) of two like structs. Where the test is null I am the second."""
    first, second = _col(first), _col(second)
    return F.when(is_first, first).otherwise(second), F.when(is_first, second).otherwise(first)


def classify(
    result: ColumnOrName, win: str = "win", draws: Iterable[str] = DRAW_CODES, unknown: str | None = None
) -> Column:
    """won / draw / lost of a result code. A null code is lost unless ``unknown`` is given."""
    result = _col(result)
    out = F.when(result == win, F.lit("won")).when(result.isin(list(draws)), F.lit("draw"))
    if unknown is not None:
        out = out.when(result.isNull(), F.lit(unknown))
    return out.otherwise(F.lit("lost"))


def termination(outcome: ColumnOrName, mine: ColumnOrName, theirs: ColumnOrName) -> Column:
    """How it ended: the loser's code explains a win, my own code the rest."""
    return F.when(_col(outcome) == "won", _col(theirs)).otherwise(_col(mine))


def population(rules: str = "chess", time_class: str = "rapid") -> Column:
    """Three-valued test for the rows a model is built on; null is not in as a filter."""
    return (
        F.col("rated")
        & (F.col("rules") == rules)
        & (F.col("time_class") == time_class)
        & ~F.col("is_friend")
        & ~F.col("is_self_play")
    )
