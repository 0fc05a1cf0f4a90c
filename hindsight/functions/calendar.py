"""Local calendar values of UTC instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hindsight.config import WEEKDAYS
from hindsight.functions.text import ColumnOrName, _col


def local_time(instant: ColumnOrName, zone: str) -> Column:
    """Wall-clock time in ``zone``, daylight saving included."""
    return F.from_utc_timestamp(_col(instant), zone)


def day_name(local: ColumnOrName) -> Column:
    return F.element_at(F.array(*map(F.lit, WEEKDAYS)), F.weekday(_col(local)) + 1)


def weekday_flags(local: ColumnOrName, prefix: str = "Is") -> list[Column]:
    """Seven 0/1 columns; all 0 where the time is null."""
    number = F.weekday(_col(local))
    return [
        F.coalesce((number == i).cast("int"), F.lit(0)).alias(f"{prefix}{day}") for i, day in enumerate(WEEKDAYS)
    ]


def seconds_of_day(local: ColumnOrName) -> Column:
    local = _col(local)
    return (F.hour(local) * 3600 + F.minute(local) * 60 + F.second(local)).cast("int")
