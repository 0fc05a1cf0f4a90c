"""Gradient boosted trees for several classes, with early stopping, from distributed histograms.

Values become bins at quantiles of all training rows; a missing value is a bin
of its own, and each split learns which way it goes. In a round every class
gets a tree, grown level by level: a task adds up gradients and second
derivatives of its rows by node, feature and bin, Spark sums the tasks' tables,
and the best splits are chosen from the sums. What reaches the driver is a table
of nodes x classes x features x bins, whatever the number of rows.

Rows carry their margins, written anew every ``KEPT`` rounds; trees since then
are applied in the task. The loss of the validation rows comes with the first
table of the next round. When it hasn't improved for ``patience`` rounds,
boosting ends and the trees up to the best round stand.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hindsight.session import stage

#: Rounds after which margins are written.
KEPT = 10
NODES = "round int, class int, node int, feature string, cut double, missing_left boolean, gain double, cover double, value double"


@dataclass(frozen=True)
class Boosting:
    rounds: int = 200
    depth: int = 4
    rate: float = 0.1
    #: L2 penalty of leaf values, least gain of a split, least second derivative on either side.
    shrinkage: float = 1.0
    least_gain: float = 0.0
    least_cover: float = 1.0
    bins: int = 64
    patience: int = 10


@dataclass
class Tree:
    """A complete tree as arrays: children of node i are 2i + 1 and 2i + 2; a node without a feature is a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    gain: np.ndarray
    cover: np.ndarray
    value: np.ndarray

    @staticmethod
    def empty(depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return Tree(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n, bool), np.zeros(n), np.zeros(n), np.zeros(n))

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The node where each row of bins comes to rest."""
        at = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        while True:
            feature = self.feature[at]
            inner = feature >= 0
            if not inner.any():
                return at
            found = bins[rows, np.maximum(feature, 0)]
            left = np.where(found == 0, self.missing_left[at], found <= self.cut[at])
            at = np.where(inner, 2 * at + np.where(left, 1, 2), at)


@dataclass
class Boosted:
    """A fitted model: ``cuts`` of each feature, the margins that all rows start with, and trees by round and class."""

    features: list[str]
    cuts: list[list[float]]
    start: list[float]
    trees: list[list[Tree]] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    def binned(self, values: list[np.ndarray]) -> np.ndarray:
        """Bins from 1 on, of columns of doubles; NaN, which null is too, is bin 0."""
        out = [np.where(np.isnan(v), 0, np.searchsorted(np.array(c), v, side="left") + 1) for v, c in zip(values, self.cuts)]
        return np.stack(out, axis=1).astype(np.uint8) if out else np.zeros((0, 0), np.uint8)

    def margins(self, bins: np.ndarray) -> np.ndarray:
        out = np.tile(np.array(self.start), (len(bins), 1))
        for trees in self.trees:
            for k, tree in enumerate(trees):
                out[:, k] += tree.value[tree.place(bins)]
        return out

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prob``, the classes' probabilities."""
        model = self

        def rows(batches):
            for batch in batches:
                values = [batch.column(batch.num_columns - len(model.features) + i).to_numpy(zero_copy_only=False).astype(float) for i in range(len(model.features))]
                prob = softmax(model.margins(model.binned(values)))
                kept = batch.columns[: batch.num_columns - len(model.features)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(list(prob), pa.list_(pa.float64()))], names=names)

        plain = df.select(*df.columns, *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(self.features)])
        names = [*df.columns, "prob"]
        schema = df.select("*", F.array(F.lit(0.0)).alias("prob")).schema
        return plain.mapInArrow(rows, schema)

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The model as a table, one row a node that rows can reach; ``cut`` is the greatest value that goes left."""
        rows = []
        for r, trees in enumerate(self.trees):
            for k, tree in enumerate(trees):
                reached = {0}
                for i in range(len(tree.feature)):
                    if i in reached:
                        inner = tree.feature[i] >= 0
                        if inner:
                            reached |= {2 * i + 1, 2 * i + 2}
                        cuts = self.cuts[tree.feature[i]] if inner else []
                        cut = (float(cuts[tree.cut[i] - 1]) if tree.cut[i] <= len(cuts) else float("inf")) if inner else None
                        rows.append((r, k, i, self.features[tree.feature[i]] if inner else None, cut, bool(tree.missing_left[i]) if inner else None,
                                     float(tree.gain[i]) if inner else None, float(tree.cover[i]), None if inner else float(tree.value[i])))
        return spark.createDataFrame(rows, NODES)

    def save(self, spark: SparkSession, path: str) -> None:
        """The node table and, as JSON, what bins values."""
        self.nodes(spark).write.mode("overwrite").parquet(f"{path}/nodes")
        told = json.dumps({"features": self.features, "cuts": self.cuts, "start": self.start, "losses": self.losses})
        spark.createDataFrame([(told,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/model")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Boosted:
        told = json.loads(spark.read.text(f"{path}/model").first()["value"])
        model = Boosted(**told)
        rows = spark.read.parquet(f"{path}/nodes").collect()  # as many as the model has
        depth = max((r["node"] + 1).bit_length() - 1 for r in rows) if rows else 0
        shape = (max((r["round"] for r in rows), default=-1) + 1, len(model.start))
        model.trees = [[Tree.empty(depth) for _ in range(shape[1])] for _ in range(shape[0])]
        for r in rows:
            tree, i = model.trees[r["round"]][r["class"]], r["node"]
            tree.cover[i] = r["cover"]
            if r["feature"] is None:
                tree.value[i] = r["value"]
                continue
            cuts = model.cuts[model.features.index(r["feature"])]
            tree.feature[i], tree.missing_left[i], tree.gain[i] = model.features.index(r["feature"]), r["missing_left"], r["gain"]
            tree.cut[i] = cuts.index(r["cut"]) + 1 if r["cut"] in cuts else len(cuts) + 1
        return model


def importances(nodes: DataFrame) -> DataFrame:
    """(feature, weight, gain, cover, total_gain, total_cover) from a node table: splits on it, and their means and sums."""
    inner = nodes.where(F.col("feature").isNotNull())
    return inner.groupBy("feature").agg(
        F.count("*").alias("weight"), F.avg("gain").alias("gain"), F.avg("cover").alias("cover"),
        F.sum("gain").alias("total_gain"), F.sum("cover").alias("total_cover"),
    )


def softmax(margins: np.ndarray) -> np.ndarray:
    p = np.exp(margins - margins.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def gradients(margins: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the weighted log loss by each class's margin."""
    p = softmax(margins)
    y = np.zeros_like(p)
    y[np.arange(len(p)), label] = 1
    return weight[:, None] * (p - y), weight[:, None] * np.maximum(p * (1 - p), 1e-16)


def cut_points(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Of each feature the quantiles between which its bins lie: at most ``bins`` - 2, the missing bin and the last have none."""
    at = [(i + 1) / (bins - 1) for i in range(bins - 2)]
    value = lambda f: F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double"))
    row = df.agg(*[F.percentile_approx(value(f), at, 10_000).alias(f"q{i}") for i, f in enumerate(features)]).first()
    return [sorted(set(row[i] or [])) for i in range(len(features))]


def best_splits(g: np.ndarray, h: np.ndarray, s: Boosting):
    """Of sums by (feature, bin) of one node: (gain, feature, last bin to the left, missing goes left), or None."""
    whole_g, whole_h = g[0].sum(), h[0].sum()
    score = lambda a, b: a * a / (b + s.shrinkage)
    best = None
    left_g, left_h = np.cumsum(g[:, 1:], axis=1), np.cumsum(h[:, 1:], axis=1)
    for missing_left in (False, True):
        gl = left_g + (g[:, :1] if missing_left else 0)
        hl = left_h + (h[:, :1] if missing_left else 0)
        gain = score(gl, hl) + score(whole_g - gl, whole_h - hl) - score(whole_g, whole_h)
        gain = np.where((hl >= s.least_cover) & (whole_h - hl >= s.least_cover), gain, -np.inf)
        f, b = np.unravel_index(np.argmax(gain), gain.shape)
        if gain[f, b] > max(s.least_gain, 1e-12) and (best is None or gain[f, b] > best[0] + 1e-12):
            best = (float(gain[f, b]), int(f), int(b) + 1, missing_left)
    return best


def _tables(rows: DataFrame, recent: list[list[Tree]], growing: list[Tree], level: int, s: Boosting, n_features: int):
    """Sums of gradients by (class, node of the level, feature, bin), and the validation rows' loss and weight."""
    first, n_nodes, bins = 2**level - 1, 2**level, s.bins
    classes = len(growing)
    cells = n_nodes * n_features * bins

    def add(batches):
        sums = np.zeros((classes, 2, cells))
        loss = np.zeros(2)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, margins, label, weight, valid = unpacked(batch, n_features, classes)
            for trees in recent:
                for k, tree in enumerate(trees):
                    margins[:, k] += tree.value[tree.place(x)]
            if level == 0 and valid.any():
                p = softmax(margins[valid])[np.arange(valid.sum()), label[valid]]
                loss += [-(weight[valid] * np.log(np.maximum(p, 1e-15))).sum(), weight[valid].sum()]
            g, h = gradients(margins, label, weight)
            x, past = x[~valid], ~valid
            offsets = np.arange(n_features) * bins
            for k, tree in enumerate(growing):
                at = tree.place(x) - first
                inside = at >= 0
                index = (at[inside, None] * (n_features * bins) + offsets[None, :] + x[inside]).ravel()
                for j, value in enumerate((g, h)):
                    sums[k, j] += np.bincount(index, np.repeat(value[past][inside, k], n_features), cells)
        found = np.flatnonzero(sums[:, 1].ravel())
        cell = np.concatenate([found, [-1]])
        columns = (np.append(sums[:, 0].ravel()[found], loss[0]), np.append(sums[:, 1].ravel()[found], loss[1]))
        yield pa.RecordBatch.from_arrays([pa.array(cell), *map(pa.array, columns)], ["cell", "g", "h"])

    summed = rows.mapInArrow(add, "cell long, g double, h double").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
    g, h = np.zeros(classes * cells), np.zeros(classes * cells)
    cell, gs, hs = (summed.column(i).to_numpy() for i in range(3))
    inner = cell >= 0
    g[cell[inner]], h[cell[inner]] = gs[inner], hs[inner]
    shape = (classes, n_nodes, n_features, bins)
    return g.reshape(shape), h.reshape(shape), (gs[~inner].sum(), hs[~inner].sum())


def unpacked(batch: pa.RecordBatch, n_features: int, classes: int):
    """Bins, margins, label, weight and whether for validation, as arrays."""
    x = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, n_features)
    margins = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, classes).copy()
    return x, margins, batch.column(2).to_numpy(), batch.column(3).to_numpy(), batch.column(4).to_numpy(zero_copy_only=False).astype(bool)


def _moved(rows: DataFrame, recent: list[list[Tree]], n_features: int, classes: int) -> DataFrame:
    """Rows with the margins that trees since the last writing have added."""

    def add(batches):
        for batch in batches:
            x, margins, *_ = unpacked(batch, n_features, classes)
            for trees in recent:
                for k, tree in enumerate(trees):
                    margins[:, k] += tree.value[tree.place(x)]
            yield batch.set_column(1, "margins", pa.array(list(margins), pa.list_(pa.float64())))

    return rows.mapInArrow(add, rows.schema)


def fit(df: DataFrame, features: Sequence[str], label: str = "label", weight: str | None = None, valid: str | None = None, s: Boosting = Boosting()) -> Boosted:
    """Boost on the rows of ``df`` that ``valid`` doesn't say to be for validation; without such, all rounds stand.

    ``label`` is 0, 1, … without gaps; rows without a label or with a weight of 0 or less are left out.
    """
    features = list(features)
    weighed = F.col(weight).cast("double") if weight else F.lit(1.0)
    checked = F.coalesce(F.col(valid), F.lit(False)) if valid else F.lit(False)
    named = df.select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)], F.col(label).cast("int").alias("label"), weighed.alias("weight"), checked.alias("valid"))
    named = named.where("label IS NOT NULL AND weight > 0")
    shares = named.where("NOT valid").groupBy("label").agg(F.sum("weight").alias("w")).collect()
    if not shares:
        raise ValueError("no rows to train on")
    classes = max(r["label"] for r in shares) + 1
    mass = np.full(classes, 1e-9)
    for r in shares:
        mass[r["label"]] += r["w"]
    model = Boosted(features, cut_points(named.where("NOT valid"), [f"x{i}" for i in range(len(features))], s.bins), np.log(mass / mass.sum()).tolist())

    def encoded(batches):
        for batch in batches:
            x = model.binned([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(len(features))])
            margins = [model.start] * batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.tobytes() for r in x], pa.binary()), pa.array(margins, pa.list_(pa.float64())), *batch.columns[len(features) :]],
                names=["bins", "margins", "label", "weight", "valid"],
            )

    # A validation row of a class that training has none of can't be told from the others: its loss is the floor's.
    known = named.where(F.col("label") < classes)
    rows = stage(known.mapInArrow(encoded, "bins binary, margins array<double>, label int, weight double, valid boolean"), "boosting")
    recent: list[list[Tree]] = []
    best = (np.inf, 0)
    for r in range(s.rounds + 1):
        growing = [Tree.empty(s.depth) for _ in range(classes)]
        for level in range(s.depth + 1):
            g, h, loss = _tables(rows, recent, growing, level, s, len(features))
            if level == 0 and loss[1] > 0:
                model.losses.append(float(loss[0] / loss[1]))
                if model.losses[-1] < best[0] - 1e-9:
                    best = (model.losses[-1], r)
            if r == s.rounds or (level == 0 and loss[1] > 0 and r - best[1] >= s.patience):
                return replace(model, trees=model.trees[: best[1]] if loss[1] > 0 or model.losses else model.trees)
            grown = _grow(growing, level, g, h, s)
            if not grown:
                break
        model.trees.append(growing)
        recent.append(growing)
        if len(recent) == KEPT:
            rows, recent = stage(_moved(rows, recent, len(features), classes), "boosting"), []
    return model


def _grow(growing: list[Tree], level: int, g: np.ndarray, h: np.ndarray, s: Boosting) -> bool:
    """Split the nodes of a level, or make them leaves; whether any was split."""
    split = False
    first = 2**level - 1
    for k, tree in enumerate(growing):
        for i in range(2**level):
            total_g, total_h = g[k, i, 0].sum(), h[k, i, 0].sum()
            if total_h <= 0:
                continue
            node = first + i
            tree.cover[node] = total_h
            found = best_splits(g[k, i], h[k, i], s) if level < s.depth else None
            if found is None:
                tree.value[node] = -s.rate * total_g / (total_h + s.shrinkage)
                continue
            tree.gain[node], tree.feature[node], tree.cut[node], tree.missing_left[node] = found
            split = True
    return split
