"""Feature tables as model input: from a table or from a CSV extract."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class MissingColumns(ValueError):
    pass


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(f"feature table lacks {missing}")
    return df


def read_features(
    spark: SparkSession, source: str, columns: Iterable[str], schema: str | None = None
) -> DataFrame:
    """A catalog table, a Parquet folder or a CSV extract (``*.csv``, read with ``schema``).

    Row order does not matter: every consumer orders by time itself.
    """
    if source.endswith(".csv"):
        reader = spark.read.option("header", True).option("enforceSchema", False)
        df = reader.schema(schema).csv(source) if schema else reader.csv(source)
    elif "/" in source:
        df = spark.read.parquet(source)
    else:
        df = spark.table(source)
    return require_columns(df, columns)


def chronological(df: DataFrame, time: str, tie: str) -> DataFrame:
    """Range-partitioned global order by time, ties by id, undated rows last."""
    return df.orderBy(F.col(time).asc_nulls_last(), tie)
