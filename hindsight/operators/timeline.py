"""Backward-looking windows over a timeline, whatever share of the rows one timeline holds.

There is one plan for all timelines, long or short:

* Range frames run over cells, the counts of each second of a timeline. Cells
  are made by partial aggregation, so a busy second is one row per map task. A
  window partition is a time bucket as wide as the longest frame, with the
  bucket before it as context: two frames' worth of seconds at most. Rows get
  their second's result by a join in which AQE may split busy seconds.
* Preceding values come from *slices*: rows are range-partitioned by timeline
  and order, written once, and numbered within each slice. Only the first and
  last few rows of a slice look across its edges.

So no task ever holds a whole timeline, a busy bucket, or even a busy second.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindsight.session import null_safe, stage


@dataclass(frozen=True)
class Timeline:
    """Whose activity (``entity``; empty for one timeline), at which second, in which order.

    ``order`` breaks ties within a second and should make rows unique there.
    """

    entity: tuple[str, ...]
    at: str
    order: tuple[str, ...]

    @property
    def sequence(self) -> list[str]:
        return [self.at, *self.order]


@dataclass(frozen=True)
class Trailing:
    """Counts over the last ``seconds``; ``rates`` are percentages of rows meeting a condition.

    A frame of 86,400 s ends one second before the row and begins 86,399 s
    before it: rows of the same second and rows a full frame old are outside.
    """

    name: str
    seconds: int
    rates: dict[str, Column]


def timeline_features(
    df: DataFrame,
    line: Timeline,
    trailing: Sequence[Trailing] = (),
    previous: dict[str, int] | None = None,
) -> DataFrame:
    """``df`` with trailing counts and rates and the values of preceding rows.

    Adds ``<frame>_n`` and ``<frame>_<rate>`` per frame, and ``prev<i>_<col>``
    for i = 1..n per entry of ``previous``. Rows without a time stay in the
    result with null in all of them; they are context for nobody.
    """
    if previous:
        slices = df.repartitionByRange(*line.entity, *line.sequence).withColumn("_slice", F.spark_partition_id())
        # Written, since the slice of a row must be the same wherever it is used.
        df = stage(slices, "slices")
    out = _with_previous(df, line, previous) if previous else df
    if trailing:
        cells = _framed_cells(df, line, trailing)
        keys = [*line.entity, line.at]
        names = [f"_k{i}" for i in range(len(keys))]
        cells = cells.withColumnsRenamed(dict(zip(keys, names)))
        out = out.join(cells, null_safe(out, cells, keys, names), "left").drop(*names)
    return out.drop("_slice")


def time_since(start: str, previous_end: str) -> Column:
    """Seconds from the previous end to this start, 0 where they overlap, null for the first."""
    gap = (F.col(start) - F.col(previous_end)).cast("double")
    return F.when(gap.isNotNull(), F.greatest(F.lit(0.0), gap))


def _within(total: Column, window, seconds: int) -> Column:
    """``total`` over the last ``seconds``, this second excluded.

    Taken as the difference of two frames that only grow along the order, so
    that a partition costs one pass: Spark adds up a sliding frame anew for
    every row, which is quadratic in a busy partition. Counts subtract exactly.
    """
    start = Window.unboundedPreceding
    upto, before = (F.coalesce(total.over(window.rangeBetween(start, end)), F.lit(0)) for end in (-1, -seconds))
    return upto - before


def _rate(hits: Column, n: Column) -> Column:
    return F.when(n > 0, F.round(100.0 * hits / n, 2)).otherwise(F.lit(0.0))


def _lags(window, previous: dict[str, int]) -> dict[str, Column]:
    return {
        f"prev{i}_{column}": F.lag(column, i).over(window)
        for column, depth in previous.items()
        for i in range(1, depth + 1)
    }


def _with_previous(df: DataFrame, line: Timeline, previous: dict[str, int]) -> DataFrame:
    """``lag`` with windows over slices and, for the first rows of each, over slice edges.

    The edge rows of a slice are its first and last ``depth`` rows. Put in
    order, the ``depth`` rows ahead of a slice's first ones are exactly those
    ahead of it in the whole timeline.
    """
    depth = max(previous.values())
    columns = df.columns
    dated = F.col(line.at).isNotNull()
    inside = Window.partitionBy(*line.entity, dated, "_slice").orderBy(*line.sequence)
    numbered = df.withColumns(
        {
            "_nth": F.row_number().over(inside),
            "_is_tail": F.lead(F.lit(1), depth).over(inside).isNull(),
            **_lags(inside, previous),
        }
    )
    names = list(_lags(inside, previous))
    inner = numbered.where((F.col("_nth") > depth) | ~dated)
    inner = inner.withColumns({n: F.when(dated, F.col(n)) for n in names}).drop("_nth", "_is_tail")
    edges = numbered.where(dated & ((F.col("_nth") <= depth) | F.col("_is_tail"))).select(*columns, "_nth")
    across = Window.partitionBy(*line.entity).orderBy(*line.sequence)
    heads = edges.withColumns(_lags(across, previous)).where(F.col("_nth") <= depth).drop("_nth")
    return inner.unionByName(heads)


def _framed_cells(df: DataFrame, line: Timeline, trailing: Sequence[Trailing]) -> DataFrame:
    """Range frames over counts of a second: one row per (entity, second)."""
    entity, at = list(line.entity), line.at
    width = max(frame.seconds for frame in trailing)
    rates = {(f.name, r): c for f in trailing for r, c in f.rates.items()}
    # A condition that several frames count is counted once.
    hits = {str(c): f"_hits_{i}" for i, c in enumerate(rates.values())}
    counted = {hits[str(c)]: c for c in rates.values()}
    cells = df.where(F.col(at).isNotNull()).groupBy(*entity, at).agg(
        F.count("*").alias("_n"), *[F.count_if(c).alias(name) for name, c in counted.items()]
    )
    bucket = F.floor(F.col(at) / width)
    copies = F.array(
        F.struct(bucket.alias("_bucket"), F.lit(True).alias("_own")),
        F.struct((bucket + 1).alias("_bucket"), F.lit(False).alias("_own")),
    )
    spread = cells.select("*", F.inline(copies))
    by_time = Window.partitionBy(*entity, "_bucket").orderBy(at)
    columns: dict[str, Column] = {}
    for frame in trailing:
        n = _within(F.sum("_n"), by_time, frame.seconds)
        columns[f"{frame.name}_n"] = n
        for name, condition in frame.rates.items():
            columns[f"{frame.name}_{name}"] = _rate(_within(F.sum(hits[str(condition)]), by_time, frame.seconds), n)
    return spread.withColumns(columns).where("_own").select(*entity, at, *columns)
