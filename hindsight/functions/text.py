"""Reading values out of text, URLs and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def empty_to_null(value: ColumnOrName) -> Column:
    return F.nullif(_col(value), F.lit(""))


def header(text: ColumnOrName, key: str) -> Column:
    """Value of a ``[key "value"]`` header line; null where there is none."""
    return empty_to_null(F.regexp_extract(_col(text), rf'\[{key} "([^"]+)"\]', 1))


def header_timestamp(text: ColumnOrName, date_key: str = "UTCDate", time_key: str = "UTCTime") -> Column:
    """Two header values as one timestamp; null where either is absent or unreadable."""
    stamp = F.concat(header(text, date_key), F.lit(" "), header(text, time_key))
    return F.try_to_timestamp(stamp, F.lit("yyyy.MM.dd HH:mm:ss"))


def attribute(markup: ColumnOrName, key: str) -> Column:
    """Value of a ``key="value"`` attribute; null where there is none."""
    return empty_to_null(F.regexp_extract(_col(markup), rf'{key}="([^"]*)"', 1))


def path_value(path: ColumnOrName, key: str) -> Column:
    """Value of a ``key=value`` path segment; ``''`` where there is none."""
    return F.regexp_extract(_col(path), rf"{key}=([^/]+)", 1)


def year_month(url: ColumnOrName) -> tuple[Column, Column]:
    """Last two segments of a URL, a trailing slash aside."""
    parts = F.split(F.rtrim(_col(url), F.lit("/")), "/")
    return F.try_element_at(parts, F.lit(-2)), F.try_element_at(parts, F.lit(-1))


def names(listing: ColumnOrName) -> Column:
    """A comma list as an array of trimmed lower-case names without blanks."""
    parts = F.transform(F.split(_col(listing), ","), lambda part: F.lower(F.trim(part)))
    return F.filter(parts, lambda part: part != "")


def time_control(control: ColumnOrName) -> tuple[Column, Column]:
    """``N`` or ``N+M`` as (base, increment) seconds; null for any other form."""
    control = _col(control)
    live = control.rlike(r"^[0-9]+(\+[0-9]+)?$")
    base = F.regexp_extract(control, r"^([0-9]+)", 1).try_cast("int")
    increment = F.coalesce(empty_to_null(F.regexp_extract(control, r"\+([0-9]+)$", 1)), F.lit("0"))
    return F.when(live, base), F.when(live, increment.try_cast("int"))


def clock_seconds(clock: ColumnOrName) -> Column:
    """``h:mm:ss[.f]`` as seconds."""
    h, m, s = (F.try_element_at(F.split(_col(clock), ":"), F.lit(i)).try_cast("double") for i in (1, 2, 3))
    return h * 3600 + m * 60 + s
