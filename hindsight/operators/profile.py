"""Tallies of a source and comparisons of rates between groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tally(df: DataFrame, by: Sequence[str], counters: dict[str, Column], total: bool = False) -> DataFrame:
    """Several conditional counts per group; with ``total`` a last row, null in ``by``, over all."""
    grouped = df.rollup(*by) if total and by else df.groupBy(*by)
    out = grouped.agg(F.count("*").alias("total"), *[F.count_if(c).alias(n) for n, c in counters.items()])
    return out


def value_counts(df: DataFrame, by: Sequence[str], dimensions: Sequence[str], missing: str = "?") -> DataFrame:
    """Rows per value of each dimension as (by…, dimension, value, rows), ``missing`` for null.

    Each row is unfolded next to the partial aggregation, so what is exchanged
    are counts.
    """
    cells = F.array(
        *[
            F.struct(
                F.lit(name).alias("dimension"), F.coalesce(F.col(name).cast("string"), F.lit(missing)).alias("value")
            )
            for name in dimensions
        ]
    )
    return df.select(*by, F.inline(cells)).groupBy(*by, "dimension", "value").agg(F.count("*").alias("rows"))


def top_values(counts: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    """The k most frequent values per group, ties by value; the rank limit runs before the exchange."""
    order = [F.desc("rows"), F.asc("value")]
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def top_overall(counts: DataFrame, k: int) -> DataFrame:
    return counts.orderBy(F.desc("rows"), F.asc("value")).limit(k)


def rates(df: DataFrame, by: Sequence[str | Column], hit: Column, digits: int = 6) -> DataFrame:
    """Rows, hits, hit rate and its standard error per group."""
    out = df.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(hit).alias("hits"))
    p = F.col("hits") / F.col("n")
    return out.withColumns(
        {"rate": F.round(p, digits), "std_error": F.round(F.sqrt(p * (1 - p) / F.col("n")), digits)}
    )


def compare_rates(df: DataFrame, in_group: Column, hit: Column, digits: int = 6, z: float = 1.96) -> DataFrame:
    """Two groups in one pass: rates, pooled two-proportion z, and whether the first lies in the other's range."""
    a, b = F.coalesce(in_group, F.lit(False)), F.coalesce(~in_group, F.lit(False))
    sums = df.agg(
        F.count_if(a).alias("n_in"),
        F.count_if(a & hit).alias("hits_in"),
        F.count_if(b).alias("n_out"),
        F.count_if(b & hit).alias("hits_out"),
    )
    p, q = F.try_divide("hits_in", "n_in"), F.try_divide("hits_out", "n_out")
    pooled = F.try_divide(F.col("hits_in") + F.col("hits_out"), F.col("n_in") + F.col("n_out"))
    spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), "n_in") + F.try_divide(F.lit(1.0), "n_out")))
    error = F.sqrt(q * (1 - q) / F.nullif("n_out", F.lit(0)))
    return sums.withColumns(
        {
            "rate_in": F.round(p, digits),
            "rate_out": F.round(q, digits),
            "z_score": F.round(F.try_divide(p - q, spread), digits),
            "low": F.round(q - z * error, digits),
            "high": F.round(q + z * error, digits),
            "within_range": (p >= q - z * error) & (p <= q + z * error),
        }
    )
