"""Chronological holdout, stratified folds and class weights, without a global window."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from hindsight.session import stage

#: So many rows or fewer are sorted to find a cut; more are narrowed first. It decides the way, not the cut.
SMALL = 100_000
PROBES = 32


def order_key(df: DataFrame, order: list[str]) -> Column:
    """Order columns as one comparable struct, nulls last; instants as microseconds."""
    fields = []
    for i, name in enumerate(order):
        column = F.col(name)
        if df.schema[name].dataType.typeName().startswith("timestamp"):
            column = F.unix_micros(column.cast("timestamp"))
        fields += [column.isNull().alias(f"n{i}"), column.alias(f"v{i}")]
    return F.struct(*fields)


def _literal(key: Row) -> Column:
    return F.struct(*[F.lit(value).alias(name) for name, value in key.asDict().items()])


def _gap_of(key: Column, probes: list[Column], low: int, high: int) -> Column:
    """Even numbers lie between probes, odd ones are rows equal to a probe.

    A search tree over literals: a handful of generated comparisons per row.
    """
    if low == high:
        return F.lit(2 * low)
    middle = (low + high) // 2
    left, right = _gap_of(key, probes, low, middle), _gap_of(key, probes, middle + 1, high)
    return F.when(key < probes[middle], left).when(key == probes[middle], 2 * middle + 1).otherwise(right)


def nth_key(df: DataFrame, order: list[str], n: int, small: int = SMALL, rows: int | None = None) -> Row | None:
    """Order key of the ``n``-th row (from 0); None past the end.

    Selection by narrowing: count the rows at and between a few dozen sampled
    keys, keep the gap the n-th row lies in, repeat, and sort only what is
    left once that is at most ``small`` rows. Every round is one pass over the
    order columns that brings one row per gap to the driver. Which keys are
    sampled decides how fast it narrows, never where it ends.
    """
    keys = df.select(order_key(df, order).alias("k"))
    rows = keys.count() if rows is None else rows
    return _nth(keys, n, rows, small) if 0 <= n < rows else None


def _nth(keys: DataFrame, n: int, rows: int, small: int) -> Row:
    seed = 0
    while rows > small:
        seed += 1
        gaps = _gaps(keys, rows, seed)
        for found in gaps:
            if n < found["rows"]:
                break
            n -= found["rows"]
        if not gaps:
            continue
        if found["low"] == found["high"]:
            return found["low"]
        keys = keys.where(F.col("k").between(_literal(found["low"]), _literal(found["high"])))
        rows = found["rows"]
    return keys.orderBy("k").offset(n).limit(1).first()["k"]


def _gaps(keys: DataFrame, rows: int, seed: int) -> list[Row]:
    """Rows, least and greatest key of each gap between sampled keys, in order; empty if none were sampled."""
    sample = keys.sample(fraction=min(1.0, PROBES / rows), seed=seed).distinct().limit(4 * PROBES)
    probes = [_literal(row["k"]) for row in sample.orderBy("k").collect()]
    if not probes:
        return []
    gap = _gap_of(F.col("k"), probes, 0, len(probes))
    gaps = keys.groupBy(gap.alias("gap")).agg(F.count("*").alias("rows"), F.min("k").alias("low"), F.max("k").alias("high"))
    return gaps.orderBy("gap").collect()


def nth_keys(df: DataFrame, order: list[str], ns: list[int], small: int = SMALL, rows: int | None = None) -> list[Row]:
    """Order keys of several rows, those past the end left out.

    One narrowing pass serves all: only the gaps that hold one of the rows are
    kept, written once, and narrowed further on their own.
    """
    keys = df.select(order_key(df, order).alias("k"))
    rows = keys.count() if rows is None else rows
    wanted = sorted({n for n in ns if 0 <= n < rows})
    gaps, seed = [], 0
    while rows > small and wanted and not gaps:
        seed += 1
        gaps = _gaps(keys, rows, seed)
    if not gaps:
        return [_nth(keys, n, rows, small) for n in wanted]
    held: list[tuple[Row, int]] = []  # the gap of each row, and its place there
    before = 0
    for found in gaps:
        held += [(found, n - before) for n in wanted if before <= n < before + found["rows"]]
        before += found["rows"]
    open_ = {tuple(g["low"]): g for g, _ in held if g["low"] != g["high"]}
    inside = lambda g: F.col("k").between(_literal(g["low"]), _literal(g["high"]))
    kept = stage(keys.where(reduce(lambda a, b: a | b, [inside(g) for g in open_.values()])), "gaps") if open_ else keys
    return [g["low"] if g["low"] == g["high"] else _nth(kept.where(inside(g)), n, g["rows"], small) for g, n in held]


def chronological_split(
    df: DataFrame, time: str, tie: str, test_share: float = 0.1, small: int = SMALL
) -> DataFrame:
    """Adds ``split``: the first ``int(n * (1 - test_share))`` rows by (time, tie) train, the rest test.

    The result is a comparison with one key: no exchange, no sort.
    """
    rows = df.count()
    cut = nth_key(df, [time, tie], int(rows * (1 - test_share)), small, rows)
    if cut is None:
        return df.withColumn("split", F.lit("train"))
    return df.withColumn(
        "split", F.when(order_key(df, [time, tie]) < _literal(cut), F.lit("train")).otherwise(F.lit("test"))
    )


def forward_folds(df: DataFrame, time: str, tie: str, k: int = 5, purge: int = 0, small: int = SMALL) -> DataFrame:
    """(*columns, fold, side): k folds that never look ahead; a row is there for each fold that it serves.

    Rows in order of (time, tie) are k + 1 blocks, even to within one row. Fold f
    tests on block f and trains on all before it, but for rows less than
    ``purge`` seconds before block f begins. Rows equal in ``time`` and ``tie``,
    such as the two views of a game, are on one side. The cuts come from one
    narrowing pass; rows are compared with them, not sorted. Rows without a
    time come last. With fewer rows than blocks some folds have no rows.
    """
    rows = df.count()
    cuts = nth_keys(df, [time, tie], [rows * f // (k + 1) for f in range(1, k + 1)], small, rows)
    key = order_key(df, [time, tie])
    block = reduce(lambda a, b: a + b, [(key >= _literal(c)).cast("int") for c in cuts], F.lit(0))
    unit = 1_000_000 if df.schema[time].dataType.typeName().startswith("timestamp") else 1
    begins = [F.lit(c["v0"]) for c in cuts]
    serves = []
    for f, begin in enumerate(begins, 1):
        purged = F.coalesce(begin - key["v0"] < F.lit(purge * unit), F.lit(False))
        side = F.when(F.col("_block") == f, "test").when((F.col("_block") < f) & ~purged, "train")
        serves.append(F.struct(F.lit(f).alias("fold"), side.alias("side")))
    if not serves:
        return df.limit(0).withColumns({"fold": F.lit(0), "side": F.lit("")})
    held = F.filter(F.array(*serves), lambda s: s["side"].isNotNull())
    return df.withColumn("_block", block).select(*df.columns, F.explode(held).alias("_s")).select(*df.columns, "_s.fold", "_s.side")


def stratified_folds(
    df: DataFrame, label: str, identity: str, k: int = 10, seed: int = 999, bucket_rows: int = 250_000
) -> DataFrame:
    """Adds ``fold`` 0..k-1: every class is spread over the folds evenly, to within one row.

    Rows are ranked per class in hash order. The rank is taken in hash buckets
    that grow in number with the data, on top of the counts of the buckets
    before, so a class holding most rows is still many small windows.
    """
    rows = df.count()
    buckets = max(1, -(-rows // bucket_rows))
    # A hash that any engine has, so that folds can be told elsewhere too.
    digest = F.md5(F.concat_ws(":", F.lit(seed).cast("string"), F.col(identity).cast("string")))
    hashed = df.withColumn("_hash", F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"))
    hashed = hashed.withColumn("_bucket", F.pmod(F.col("_hash"), F.lit(buckets)))
    sizes = hashed.groupBy(label, "_bucket").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(label).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(label).alias("_label"),
        F.col("_bucket").alias("_of"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
    )
    nth = F.row_number().over(Window.partitionBy(label, "_bucket").orderBy("_hash", identity)) - 1
    ranked = hashed.withColumn("_nth", nth)
    on = ranked[label].eqNullSafe(offsets["_label"]) & (ranked["_bucket"] == offsets["_of"])
    placed = ranked.join(offsets, on, "left")
    return placed.withColumn("fold", F.pmod(F.col("_before") + F.col("_nth"), F.lit(k)).cast("int")).select(
        *df.columns, "fold"
    )


def label_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("rows"))


def class_weights(df: DataFrame, label: str, multipliers: dict | None = None) -> DataFrame:
    """Inverse-frequency weight per class present, times its multiplier (1 by default)."""
    counts = label_counts(df, label)
    total = counts.agg(F.sum("rows")).scalar()
    factor: Column = F.lit(1.0)
    if multipliers:
        table = F.create_map(*[F.lit(x) for pair in multipliers.items() for x in (pair[0], float(pair[1]))])
        factor = F.coalesce(F.try_element_at(table, F.col(label)), F.lit(1.0))
    return counts.select(label, "rows", (factor * total / F.col("rows")).alias("weight"))


def with_class_weights(df: DataFrame, weights: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Adds each row's class weight."""
    side = weights.select(label, F.col("weight").alias(name))
    return df.join(side, label, "left")
