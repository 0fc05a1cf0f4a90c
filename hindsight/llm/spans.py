"""Spans of regular expression matches as array columns, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPANS = "array<struct<start:bigint,end:bigint,value:string>>"
#: Matches that are put together at once, so that very many in one text don't copy a growing array each.
CHUNK = 128


def with_spans(df: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """Adds, for each (column, pattern), the leftmost non-overlapping matches in code points, end exclusive.

    A text is cut at its matches; lengths of pieces and matches add up to the offsets. Patterns must not
    match the empty string.
    """
    hits = {f"{name}_hits": F.regexp_extract_all(F.col(text), F.lit(p), F.lit(0)) for name, p in patterns.items()}
    cuts = {f"{name}_cuts": F.when(F.size(f"{name}_hits") > 0, F.split(F.col(text), p, -1)) for name, p in patterns.items()}
    spans = {name: _placed(F.col(f"{name}_hits"), F.col(f"{name}_cuts")) for name in patterns}
    return df.withColumns(hits).withColumns(cuts).withColumns(spans).drop(*hits, *cuts)


def _placed(hits: Column, cuts: Column) -> Column:
    none = F.array().cast(SPANS)
    n = F.size(hits)

    def one(state: Column, i: Column) -> Column:
        start = state["at"] + F.length(F.get(cuts, i))
        end = start + F.length(F.get(hits, i))
        span = F.struct(start.alias("start"), end.alias("end"), F.get(hits, i).alias("value"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    def chunk(state: Column, c: Column) -> Column:
        own = F.aggregate(
            F.sequence(c * CHUNK, F.least(n, c * CHUNK + CHUNK) - 1), F.struct(state["at"].alias("at"), none.alias("out")), one
        )
        # One evaluation of ``own`` for both fields.
        return F.get(F.transform(F.array(own), lambda o: F.struct(o["at"].alias("at"), F.concat(state["out"], o["out"]).alias("out"))), F.lit(0))

    begin = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))
    chunks = F.sequence(F.lit(0), F.floor((n - 1) / CHUNK).cast("int"))
    return F.when(n > 0, F.aggregate(chunks, begin, chunk, lambda s: s["out"])).otherwise(none)


def digest(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
