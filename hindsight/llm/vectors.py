"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with cosine ``c`` lie ``sqrt(2 - 2c)`` apart, so a cosine threshold
is a distance. Vectors are rotated to their leading principal axes and sorted by
the cells of a grid of that width on them (the epsilon grid order). The sorted
sequence is cut into blocks. A join of the sequence with itself starts from
whole labels and is refined level by level: a pair of sequence intervals is
given up when the boxes around them are further apart than the threshold, and
otherwise replaced by the pairs of its parts, down to blocks. Block pairs that
remain are compared in one matrix product each, in double precision.

Equal vectors are one class and compared once. A block pair reports, for each
class, how many vectors it is linked with and one edge into its local
component; pairs of vectors are never rows.

Edge cases: vectors that are null, empty, zero or hold null or non-finite
components, and those with a null label, link with nothing and are components
of their own; vectors of different lengths never link; repeated ids are counted
row by row; a null id is in no component's name (a component of null ids only
has a null id), and its row isn't kept.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hindsight.llm.components import components
from hindsight.llm.work import batches_of, stage

#: Vectors in a block, principal axes of the grid, parts of an interval at each level.
BLOCK, AXES, PARTS_LOG2 = 512, 6, 3
KEY = 16


def readable(vectors: DataFrame) -> DataFrame:
    """(vec_id, key, label, dim, vector): equal vectors of a label have one ``key``; unusable rows have nulls."""

    def rows(batches):
        for batch in batches:
            out = []
            for label, cells in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                usable = label is not None and cells and None not in cells
                v = np.array(cells, dtype=np.float64) + 0.0 if usable else None
                if v is None or not np.isfinite(v).all() or not v.any():
                    out.append((None, None, None))
                    continue
                raw = v.tobytes()
                out.append((hashlib.md5(f"{label}:".encode() + raw).digest(), len(v), raw))
            key, dim, raw = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(key, pa.binary()), batch.column(1), pa.array(dim, pa.int32()), pa.array(raw, pa.binary())],
                names=["vec_id", "key", "label", "dim", "vector"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    schema = f"vec_id {kinds['vec_id']}, key binary, label {kinds['label']}, dim int, vector binary"
    return vectors.select("vec_id", "label", "embedding").mapInArrow(rows, schema)


def unit(raw: list[bytes], dim: int) -> np.ndarray:
    v = np.frombuffer(b"".join(raw)).reshape(-1, dim)
    v = v / np.abs(v).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """Leading eigenvectors of the second moments, for each vector length.

    A sum over tasks of ``dim ** 2`` numbers. Axes only decide what can be skipped, never a result.
    """

    def rows(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(0).to_numpy()
            raw = np.array(batch.column(1).to_pylist(), dtype=object)
            for dim in np.unique(dims):
                v = unit(list(raw[dims == dim]), int(dim))
                sums[int(dim)] = sums.get(int(dim), 0) + v.T @ v
        for dim, s in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(dim * dim, dim, np.int32)), pa.array(np.arange(dim * dim)), pa.array(s.reshape(-1))], names=["dim", "cell", "sum"]
            )

    found = classes.select("dim", "vector").mapInArrow(rows, "dim int, cell long, sum double").groupBy("dim", "cell").agg(F.sum("sum").alias("sum")).toArrow()
    dim, cell, total = (found.column(c).to_numpy() for c in ("dim", "cell", "sum"))
    axes = {}
    for d in np.unique(dim):
        moments = np.zeros(d * d)
        moments[cell[dim == d]] = total[dim == d]
        axes[int(d)] = np.linalg.eigh(moments.reshape(d, d))[1][:, ::-1][:, :AXES]
    return axes


def blocks_of(classes: DataFrame, axes: dict[int, np.ndarray], width: float) -> DataFrame:
    """Consecutive vectors in epsilon grid order, packed as (label, dim, block, keys, sizes, vectors, low, high)."""
    cells = [f"c{k}" for k in range(AXES)]

    def placed(batches):
        for batch in batches:
            dims = batch.column(1).to_numpy()
            raw = np.array(batch.column(3).to_pylist(), dtype=object)
            cell = np.zeros((len(dims), AXES), np.int64)
            for dim in np.unique(dims):
                y = unit(list(raw[dims == dim]), int(dim)) @ axes[int(dim)]
                cell[dims == dim, : y.shape[1]] = np.floor(y / width)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c) for c in cell.T]], names=[*batch.schema.names, *cells])

    def packed(batches):
        task, made, held = TaskContext.get().partitionId(), 0, []

        def block():
            dim = held[0][1]
            v = unit([h[3] for h in held], dim)
            y = v @ axes[dim]
            y = np.hstack([y, np.zeros((len(y), AXES - y.shape[1]))])
            sizes = np.array([h[4] for h in held], dtype=np.int64)
            return [
                held[0][0], dim, (task << 32) + made, b"".join(h[2] for h in held), sizes.tobytes(), v.tobytes(),
                y.min(0).tolist(), y.max(0).tolist(),
            ]

        for batch in batches:
            out = []
            for row in zip(*[c.to_pylist() for c in batch.columns[:5]]):
                if held and (len(held) == BLOCK or held[0][:2] != row[:2]):
                    out.append(block())
                    made, held = made + 1, []
                held.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(block()), arrow)], schema=arrow)

    label = classes.schema["label"].dataType.simpleString()
    box = pa.list_(pa.float64())
    arrow = pa.schema([
        ("label", {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[label]), ("dim", pa.int32()), ("block", pa.int64()),
        ("keys", pa.binary()), ("sizes", pa.binary()), ("vectors", pa.binary()), ("low", box), ("high", box),
    ])
    schema = f"label {label}, dim int, block long, keys binary, sizes binary, vectors binary, low array<double>, high array<double>"
    partitions = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["label", "dim", *cells, "key"]
    in_cells = classes.select("label", "dim", "key", "vector", "size").mapInArrow(
        placed, f"label {label}, dim int, key binary, vector binary, size long, " + ", ".join(f"{c} long" for c in cells)
    )
    return in_cells.repartitionByRange(partitions, *order).sortWithinPartitions(*order).mapInArrow(packed, schema)


def near_pairs(blocks: DataFrame, width: float) -> DataFrame:
    """(a, b): blocks that may hold vectors within ``width``, a <= b in the sequence."""
    order = Window.partitionBy("label", "dim").orderBy("block")
    boxes = stage(
        blocks.select("label", "dim", "block", "low", "high").withColumn("at", (F.row_number().over(order) - 1).cast("long")), "boxes"
    )
    most = boxes.agg(F.max("at")).first()[0]
    levels = 0 if most is None else -(-int(most).bit_length() // PARTS_LOG2)

    def level(k: int) -> DataFrame:
        ends = [F.min(F.col("low")[i]).alias(f"l{i}") for i in range(AXES)] + [F.max(F.col("high")[i]).alias(f"h{i}") for i in range(AXES)]
        return boxes.groupBy("label", "dim", F.shiftright("at", k * PARTS_LOG2).alias("at")).agg(F.min("block").alias("block"), *ends)

    # Intervals of the top level: whole labels, each paired with itself.
    pairs = boxes.select("label", "dim").distinct().select("label", "dim", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    for k in reversed(range(levels + 1)):
        parts = stage(level(k).withColumn("up", F.shiftright("at", PARTS_LOG2)), "level")
        x, y = parts.alias("x"), parts.alias("y")
        same = lambda side, end: (F.col("p.label") == F.col(f"{side}.label")) & (F.col("p.dim") == F.col(f"{side}.dim")) & (F.col(f"p.{end}") == F.col(f"{side}.up"))
        gaps = [
            F.pow(F.greatest(F.lit(0.0), F.col(f"y.l{i}") - F.col(f"x.h{i}"), F.col(f"x.l{i}") - F.col(f"y.h{i}")), F.lit(2.0)) for i in range(AXES)
        ]
        near = sum(gaps[1:], gaps[0]) <= width * width
        pairs = stage(
            pairs.alias("p")
            .join(x, same("x", "a"))
            .join(y, same("y", "b"))
            .where((F.col("x.at") <= F.col("y.at")) & near)
            .select("x.label", "x.dim", F.col("x.at").alias("a"), F.col("y.at").alias("b"), F.col("x.block").alias("block_a"), F.col("y.block").alias("block_b")),
            "pairs",
        )
    return pairs.select(F.col("block_a").alias("a"), F.col("block_b").alias("b"))


def compared(pairs: DataFrame, blocks: DataFrame, least: float) -> DataFrame:
    """(key, links, root) of every class with a link in a block pair; ``root`` is one class of its local component."""

    def rows(batches):
        for batch in batches:
            for a, b, dim, keys_a, keys_b, sizes_a, sizes_b, va, vb in zip(*[c.to_pylist() for c in batch.columns]):
                x, y = np.frombuffer(va).reshape(-1, dim), np.frombuffer(vb).reshape(-1, dim)
                hit = x @ y.T >= least
                if a == b:
                    np.fill_diagonal(hit, False)
                if not hit.any():
                    continue
                nx = len(x)
                root = np.arange(nx + len(y))
                if a == b:
                    root[nx:] = root[:nx]
                # Least label of the neighbourhood, until nothing changes: the local components.
                while True:
                    was = root.copy()
                    np.minimum(root[:nx], np.where(hit, root[None, nx:], nx + len(y)).min(1), out=root[:nx])
                    np.minimum(root[nx:], np.where(hit, root[:nx, None], nx + len(y)).min(0), out=root[nx:])
                    if a == b:
                        root[nx:] = root[:nx] = np.minimum(root[:nx], root[nx:])
                    if (root == was).all():
                        break
                links = [hit @ np.frombuffer(sizes_b, np.int64), hit.T @ np.frombuffer(sizes_a, np.int64)]
                keys = [np.array([k[i : i + KEY] for i in range(0, len(k), KEY)], dtype=object) for k in (keys_a, keys_b)]
                everyone = np.concatenate(keys)
                for side in (0,) if a == b else (0, 1):
                    some = np.flatnonzero(hit.any(1 - side))
                    of = root[:nx] if side == 0 else root[nx:]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(keys[side][some]), pa.binary()), pa.array(links[side][some].astype(np.int64)), pa.array(list(everyone[of[some]]), pa.binary())],
                        names=["key", "links", "root"],
                    )

    both = (
        pairs.alias("p")
        .join(blocks.alias("x"), F.col("p.a") == F.col("x.block"))
        .join(blocks.alias("y"), F.col("p.b") == F.col("y.block"))
        .select("p.a", "p.b", "x.dim", "x.keys", "y.keys", "x.sizes", "y.sizes", "x.vectors", "y.vectors")
        .toDF("a", "b", "dim", "keys_a", "keys_b", "sizes_a", "sizes_b", "va", "vb")
    )
    return both.mapInArrow(rows, "key binary, links long, root binary")


def near_duplicates(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors``; see the module for the method."""
    width = float(np.sqrt(max(0.0, 2 - 2 * least))) + 1e-9
    rows = stage(readable(vectors), "vectors")
    classes = stage(
        rows.where("key is not null").groupBy("key", "label", "dim", "vector").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("size")), "classes"
    )
    with batches_of(vectors.sparkSession, 8):
        blocks = stage(blocks_of(classes, principal_axes(classes), width), "blocks")
        found = stage(compared(near_pairs(blocks, width), blocks, least), "found")
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    member = components(found.select("key", "root")).toDF("key", "component")
    named = (
        classes.select("key", "first_id", "size")
        .join(member, "key", "left")
        .join(links, "key", "left")
        .select("key", "first_id", "size", F.coalesce("component", "key").alias("component"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    named = stage(named, "named")
    ids = stage(named.groupBy("component").agg(F.min("first_id").alias("component_id")), "ids")
    known = stage(
        named.join(ids, "component").select("key", (F.col("size") - 1 + F.col("links")).alias("n_links"), "component_id"), "known"
    )
    return (
        rows.join(known, "key", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
