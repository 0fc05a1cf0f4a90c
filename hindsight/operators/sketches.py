"""Sketches of wide columns, kept by period and merged: distinct values and heavy hitters.

A sketch row stands for all rows of its group and has a bounded size however
many values there are, so a new month is sketched alone and the year is a merge
of twelve small rows. Values are compared as text; nulls are in no sketch.

Distinct values: HyperLogLog registers, merged by their maximum, so merging
loses nothing. Relative standard error 1.04 / sqrt(2 ** log_registers).

Heavy hitters: a map of at least 4 / 3 of ``tracked`` counters. A count is too
high by 3.5 / counters of the rows at most, merged or not, and any value of more
than twice that is in the map.

An empty input gives no groups. A group of nulls alone counts 0 values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindsight.session import null_safe, stage
from hindsight.sources.tables import VersionedTable

LOG_REGISTERS = 14
TRACKED = 6_000


def counters(tracked: int) -> int:
    """Counters of a map for ``tracked`` values: a power of two, three quarters of it in use."""
    return 1 << math.ceil(math.log2(tracked / 0.75))


def sketched(df: DataFrame, by: Sequence[str], columns: Sequence[str], log_registers: int = LOG_REGISTERS, tracked: int = TRACKED) -> DataFrame:
    """A row per group: its ``rows``, and for each column a struct (known, registers, top).

    Both sketches fill in the tasks that read; what is exchanged are sketches, not values.
    """
    texts = df.select(*by, *[F.col(c).cast("string").alias(f"value_{i}") for i, c in enumerate(columns)])
    parts = []
    for i, c in enumerate(columns):
        value = f"value_{i}"
        top = F.expr(f"approx_top_k_accumulate({value}, {int(tracked)}) FILTER (WHERE {value} IS NOT NULL)")
        parts.append(F.struct(F.count(value).alias("known"), F.hll_sketch_agg(value, F.lit(log_registers)).alias("registers"), top.alias("top")).alias(c))
    return texts.groupBy(*by).agg(F.count("*").alias("rows"), *parts)


def merged(sketches: DataFrame, by: Sequence[str], columns: Sequence[str], tracked: int = TRACKED) -> DataFrame:
    """The sketches of coarser groups, in the same form; sketches must be of one ``log_registers``."""
    parts = [
        F.struct(
            F.sum(F.col(c)["known"]).alias("known"),
            F.hll_union_agg(F.col(c)["registers"]).alias("registers"),
            F.expr(f"approx_top_k_combine(`{c}`.top, {int(tracked)})").alias("top"),
        ).alias(c)
        for c in columns
    ]
    return sketches.groupBy(*by).agg(F.sum("rows").alias("rows"), *parts)


def refreshed(store: VersionedTable, df: DataFrame, by: Sequence[str], columns: Sequence[str], **sizes: int) -> int:
    """Sketches of the groups that ``df`` has all rows of, in place of the stored ones; others stay as they are."""
    return store.upsert_groups(sketched(df, by, columns, **sizes), list(by))


def distinct_values(sketches: DataFrame, by: Sequence[str], columns: Sequence[str], log_registers: int = LOG_REGISTERS, sigmas: float = 4.0) -> DataFrame:
    """(by…, column, known, estimate, low, high): distinct values and the range they are in but for ``sigmas`` errors.

    A sketch that was never merged is estimated with what it noted while it filled, others from the
    registers alone. A union with itself makes that the same for all.
    """
    error = sigmas * 1.04 / math.sqrt(1 << log_registers)
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.col(c)["known"].alias("known"), F.hll_sketch_estimate(F.hll_union(F.col(c)["registers"], F.col(c)["registers"])).alias("estimate")
            )
            for c in columns
        ]
    )
    return sketches.select(*by, F.inline(cells)).withColumns(
        {"low": F.floor(F.col("estimate") / (1 + error)), "high": F.ceil(F.col("estimate") / (1 - error))}
    )


def frequent_values(sketches: DataFrame, by: Sequence[str], column: str, tracked: int = TRACKED) -> DataFrame:
    """(by…, value, at_least, at_most, known): the values in the maps and the range of their counts."""
    error = F.floor(F.col("known") * 3.5 / counters(tracked)).cast("long")
    found = sketches.select(
        *by, F.col(column)["known"].alias("known"), F.inline(F.expr(f"approx_top_k_estimate(`{column}`.top, {int(tracked)})")).alias("value", "at_most")
    )
    return found.select(*by, "value", F.greatest(F.col("at_most") - error, F.lit(1)).alias("at_least"), "at_most", "known")


def heavy_values(df: DataFrame, sketches: DataFrame, by: Sequence[str], column: str, one_in: int, tracked: int = TRACKED) -> DataFrame:
    """(by…, value, rows, known): exactly the values that at least one in ``one_in`` known rows of a group have.

    The merged sketches of ``df`` name all that may be so, 2 * ``one_in`` values a group or so; only these are
    counted. They are written first, so that Spark knows their size when it picks the join.
    """
    if counters(tracked) < 7 * one_in:
        raise ValueError(f"one in {one_in} takes {7 * one_in} counters, {tracked} tracked values have {counters(tracked)}")
    may = frequent_values(sketches, by, column, tracked).where(F.col("at_most") * one_in >= F.col("known"))
    may = may.select(*[F.col(c).alias(f"{c}_may") for c in by], F.col("value").alias("value_may"), "known")
    may = stage(may, "may")
    rows = df.select(*by, F.col(column).cast("string").alias("value")).where("value IS NOT NULL")
    names = [f"{c}_may" for c in by]
    same = null_safe(rows, may, list(by), names) & (F.col("value") == F.col("value_may"))
    counts = rows.join(may, same).groupBy(*by, "value", "known").agg(F.count("*").alias("rows"))
    return counts.where(F.col("rows") * one_in >= F.col("known")).select(*by, "value", "rows", "known")
