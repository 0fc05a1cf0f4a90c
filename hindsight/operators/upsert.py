"""Upsert without a lakehouse format: what the target becomes, as a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindsight.session import null_safe


class DuplicateKeys(ValueError):
    """The source of an upsert holds a key more than once."""


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held more than once, with their row counts. Nulls are a key like any other."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def require_unique(df: DataFrame, keys: list[str]) -> None:
    """Raise when a key repeats, naming a few of the offenders."""
    offenders = duplicate_keys(df, keys).take(3)
    if offenders:
        shown = "; ".join(str(row.asDict()) for row in offenders)
        raise DuplicateKeys(f"source rows are not unique on {keys}, for example {shown}")


def _rows_not_in(target: DataFrame, source_keys: DataFrame, keys: list[str]) -> DataFrame:
    # Spark broadcasts the keys if their size in bytes is known to be small. Otherwise
    # it is a sorted merge of both, where AQE splits hot partitions of the target.
    return target.join(source_keys, null_safe(target, source_keys, keys), "left_anti")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], check: bool = True) -> DataFrame:
    """Source rows replace target rows of the same key; new keys are added; nothing is deleted.

    Columns only one side has become null on the other.
    """
    if check:
        require_unique(source, keys)
    kept = _rows_not_in(target, source.select(*keys), keys)
    return kept.unionByName(source, allowMissingColumns=True)


def upsert_groups(target: DataFrame, source: DataFrame, group: list[str]) -> DataFrame:
    """All target rows of a group the source touches give way to the source's rows of it.

    With this a group that shrinks leaves no stale rows behind.
    """
    kept = _rows_not_in(target, source.select(*group).distinct(), group)
    return kept.unionByName(source, allowMissingColumns=True)
