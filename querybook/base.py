"""Loading tables and collecting queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hindsight.session import configure

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table; its zone-less timestamps are UTC instants."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    zoneless = [f.name for f in df.schema if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt by key over the session's shuffle partitions: for queries that make much text of few input bytes."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


class Book:
    """Queries by name, with the SQL that must give the same rows."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            key = name or query.__name__

            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                return query(configure(spark), sf_dir)

            self.queries[key] = run
            if sql is not None:
                self.sql[key] = sql
            return query

        return register
