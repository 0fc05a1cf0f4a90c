"""One-hot columns and 0/1 flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hindsight.functions.text import ColumnOrName, _col


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def one_hot(value: ColumnOrName, vocabulary: Sequence[str], prefix: str = "", other: str | None = None) -> list[Column]:
    """One 0/1 column per word; with ``other`` a last column for the rest and null."""
    value = _col(value)
    columns = [flag(value == word).alias(f"{prefix}{word}") for word in vocabulary]
    if other is not None:
        columns.append((1 - flag(value.isin(list(vocabulary)))).alias(f"{prefix}{other}"))
    return columns


def code(value: ColumnOrName, codes: dict[str, int], default: int) -> Column:
    """Integer code of a word, ``default`` for unknown words and null."""
    lookup = F.create_map(*[F.lit(part) for pair in codes.items() for part in pair])
    return F.coalesce(F.try_element_at(lookup, _col(value)), F.lit(default))
