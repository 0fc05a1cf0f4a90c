"""Toxicity scores: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (with word boundaries), each a row of
a hashed embedding table; a word's vector is the mean of its n-grams', a text's
vector the mean of its words'. A softmax layer on top is trained jointly with
the table, in numpy, by Adam over batches of texts. Misspellings that never occurred in
training still share most n-grams with the words that did.

Training sees a bounded sample of labelled rows (``Settings.most`` of each
class, picked by hash of the id), scoring sees every text from end to end. The
layer is linear, so for scoring each n-gram has one number, each word the mean
of its n-grams' numbers, and a text is scored by one look-up a word.

Edge cases: null and empty texts, and texts without words, score by the bias
alone; rows with null ids are scored and never learned from; several labels of
one id count as the highest; null labels are no labels; without labels of both
classes the score is the share of label 1 among them (0 without any).
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Settings:
    #: Most labelled rows that training sees of label 0 and of label 1, the only bound here.
    most: tuple[int, int] = (10_000, 5_000)
    buckets: int = 1 << 17
    dim: int = 4
    shortest: int = 3
    longest: int = 5
    #: Texts of a training step.
    batch: int = 1000
    steps: int = 150
    rate: float = 0.1
    decay: float = 1e-6
    #: Factor before the softmax: an average over a text of mostly plain words is small.
    gain: float = 60.0
    threshold: float = 0.3
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """``weights``: log odds of an n-gram bucket, ``buckets`` numbers, whatever the input's size."""

    weights: np.ndarray
    bias: float
    settings: Settings


def held_out(doc_id: str = "doc_id"):
    """Rows that training never sees: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def subwords(word: str, s: Settings) -> list[int]:
    padded = f"<{word}>"
    grams = [padded]
    for n in range(s.shortest, s.longest + 1):
        grams += [padded[i : i + n] for i in range(len(padded) - n + 1)]
    return [zlib.crc32(g.encode("utf-8", "surrogatepass")) % s.buckets for g in grams]


def bag_rows(batches):
    """Arrow batches of (text, toxic, weight) to (words, counts, toxic, weight), words and counts deflated."""
    for batch in batches:
        bags = [Counter(WORD.findall((t or "").lower())) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([zlib.compress(" ".join(b).encode(), 1) for b in bags], pa.binary()),
                pa.array([zlib.compress(np.array([*b.values()], np.int32).tobytes(), 1) for b in bags], pa.binary()),
                batch.column(1),
                batch.column(2),
            ],
            names=["words", "counts", "toxic", "weight"],
        )


def inflated(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """What ``bag_rows`` made, one text after the other: sizes, numbers of words in order of first use, the words, counts."""
    sizes, at, numbers, counts = array("q"), array("i"), {}, array("i")
    for words, times in zip(rows.column("words"), rows.column("counts")):
        found = zlib.decompress(words.as_py()).decode().split()
        sizes.append(len(found))
        at.extend([numbers.setdefault(w, len(numbers)) for w in found])
        counts.frombytes(zlib.decompress(times.as_py()))
    return np.frombuffer(sizes, np.int64), np.frombuffer(at, np.int32), [*numbers], np.frombuffer(counts, np.int32)


def sample(docs: DataFrame, labels: DataFrame, s: Settings) -> DataFrame:
    """At most ``most`` labelled rows of each class with the weight that restores the class's share."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).where("toxic in (0, 1)").collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [
        known.where(F.col("toxic") == c).orderBy(*order).limit(s.most[c]).withColumn("weight", F.lit(n / min(n, s.most[c])))
        for c, n in sizes.items()
    ]
    if not parts:
        return docs.sparkSession.createDataFrame([], "text string, toxic int, weight double")
    picked = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # At most ``sum(most)`` narrow rows, whatever the input.
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    # An id that several rows have trains with one of their texts, so the bound holds for rows too.
    one = rows.groupBy("doc_id", "toxic", "weight").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return one.orderBy("doc_id").select("text", "toxic", "weight")


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model:
    schema = "words binary, counts binary, toxic int, weight double"
    rows = sample(docs, labels, s).mapInArrow(bag_rows, schema).toArrow()
    y = rows.column("toxic").to_numpy()
    weight = rows.column("weight").to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(s.buckets, np.float32), float(np.log((share + 1e-9) / (1 - share + 1e-9))), s)
    sizes, at, vocabulary, counts = inflated(rows)
    del rows
    bags = Bags.of(sizes, at, vocabulary, counts, s)
    del vocabulary, counts
    return fit(bags, y, weight, s)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all stretches, one stretch after the other."""
    numbers = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    numbers += np.arange(len(numbers))
    return numbers


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of stretches of rows; empty stretches give 0."""
    out = np.zeros((len(sizes), values.shape[1]), np.float32)
    full = np.flatnonzero(sizes)
    if len(full):
        out[full] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[full], axis=0)
    return out


def added(to: np.ndarray, columns: Iterable[np.ndarray], n: int) -> np.ndarray:
    """Rows added up by their numbers in ``to``; their columns are made one at a time."""
    return np.stack([np.bincount(to, weights=column, minlength=n).astype(np.float32) for column in columns], axis=1)


@dataclass(frozen=True)
class Bags:
    """Texts of ``sizes`` different words, ``at`` their numbers and ``share`` their part of the text; words of ``lengths`` n-grams."""

    sizes: np.ndarray
    at: np.ndarray
    share: np.ndarray
    lengths: np.ndarray
    grams: np.ndarray

    @staticmethod
    def of(sizes: np.ndarray, at: np.ndarray, words: list[str], times: np.ndarray, s: Settings) -> Bags:
        grams, lengths = array("i"), []
        for w in words:
            own = subwords(w, s)
            grams.extend(own)
            lengths.append(len(own))
        ends, share = np.cumsum(sizes), np.empty(len(at), np.float32)
        for first in range(0, len(sizes), s.batch):
            some = sizes[first : first + s.batch]
            own = slice(int(ends[first] - sizes[first]), int(ends[first + len(some) - 1]))
            total = np.bincount(np.repeat(np.arange(len(some)), some), weights=times[own], minlength=len(some))
            share[own] = times[own] / np.repeat(total, some)
        return Bags(sizes, at, share, np.array(lengths, np.int64), np.frombuffer(grams, np.int32))

    def some(self, texts: np.ndarray) -> Bags:
        """Those texts alone, with the words that they have."""
        sizes = self.sizes[texts]
        entries = ranges((np.cumsum(self.sizes) - self.sizes)[texts], sizes)
        words, at = np.unique(self.at[entries], return_inverse=True)
        lengths = self.lengths[words]
        return Bags(sizes, at, self.share[entries], lengths, self.grams[ranges((np.cumsum(self.lengths) - self.lengths)[words], lengths)])

    def vectors(self, table: np.ndarray) -> np.ndarray:
        """A text's mean of its words' means of their n-grams' rows."""
        words = sums(table[self.grams], self.lengths) / self.lengths[:, None].astype(np.float32)
        return sums(words[self.at] * self.share[:, None], self.sizes)

    def gradient(self, by_text: np.ndarray, buckets: int) -> np.ndarray:
        """The table's gradient from that of the texts' vectors."""
        by_word = added(self.at, (np.repeat(column, self.sizes) * self.share for column in by_text.T), len(self.lengths))
        return added(self.grams, (np.repeat(column / self.lengths, self.lengths) for column in by_word.T), buckets)


def gradients(bags: Bags, wanted: np.ndarray, weight: np.ndarray, params: list[np.ndarray], s: Settings) -> tuple[float, list[np.ndarray]]:
    """Weighted log loss of the texts, with decay, and its gradient by table, layer and bias."""
    table, layer, bias = params
    hidden = bags.vectors(table)
    logits = s.gain * (hidden @ layer) + bias
    p = np.exp(logits - logits.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    delta = (p - wanted) * weight[:, None]
    loss = -float((weight * np.log((p * wanted).sum(1))).sum()) + s.decay / 2 * float((table**2).sum() + (layer**2).sum())
    return loss, [bags.gradient(s.gain * delta @ layer.T, s.buckets) + s.decay * table, s.gain * hidden.T @ delta + s.decay * layer, delta.sum(0)]


def fit(bags: Bags, y: np.ndarray, weight: np.ndarray, s: Settings) -> Model:
    """Adam over batches of the texts, its rate falling to 0; memory beyond ``bags`` is that of a batch."""
    if not len(bags.lengths):
        share = float((weight * y).sum() / weight.sum())
        return Model(np.zeros(s.buckets, np.float32), float(np.log((share + 1e-9) / (1 - share + 1e-9))), s)
    rng = np.random.default_rng(s.seed)
    table = (rng.uniform(-1, 1, (s.buckets, s.dim)) / s.dim).astype(np.float32)
    layer, bias = rng.uniform(-1, 1, (s.dim, 2)) / s.dim, np.zeros(2)
    params = [table, layer, bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    wanted, order = np.eye(2)[y], np.empty(0, np.int64)
    for step in range(1, s.steps + 1):
        if len(order) < min(s.batch, len(y)):
            order = np.concatenate([order, rng.permutation(len(y))])
        texts, order = order[: s.batch], order[s.batch :]
        own = weight[texts] / weight[texts].sum()
        rate = s.rate * (1 - (step - 1) / s.steps)
        for k, (param, g) in enumerate(zip(params, gradients(bags.some(texts), wanted[texts], own, params, s)[1])):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            param -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(param.dtype)
    seen = np.zeros(s.buckets, bool)
    for first in range(0, len(bags.grams), s.buckets):  # numpy widens an index to 64 bits
        seen[bags.grams[first : first + s.buckets]] = True
    # N-grams that training never saw say nothing.
    weights = np.where(seen, s.gain * (table @ (layer[:, 1] - layer[:, 0])), 0).astype(np.float32)
    return Model(weights, float(bias[1] - bias[0]), s)


class Scorer:
    """Scores texts; remembers words, up to a bound after which it starts anew."""

    def __init__(self, model: Model, remembered: int = 400_000):
        self.model, self.remembered, self.known = model, remembered, {}

    def _word(self, word: str) -> float:
        value = float(self.model.weights[subwords(word, self.model.settings)].mean())
        if len(self.known) >= self.remembered:
            self.known.clear()
        self.known[word] = value
        return value

    def __call__(self, text: str | None) -> float:
        known, total, words = self.known, 0.0, WORD.findall((text or "").lower())
        for w in words:
            v = known.get(w)
            total += self._word(w) if v is None else v
        z = self.model.bias + (total / len(words) if words else 0.0)
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -50, 50))))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    threshold = model.settings.threshold

    def rows(batches):
        scorer = Scorer(model)
        for batch in batches:
            scores = np.array([scorer(t) for t in batch.column(2).to_pylist()], dtype=float)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        rows, f"doc_id {kind}, held_out boolean, score double, predicted int"
    )


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows predicted toxic, columns unchanged; one pass, no shuffle."""
    threshold = model.settings.threshold
    at = docs.columns.index("text")

    def rows(batches):
        scorer = Scorer(model)
        for batch in batches:
            yield batch.filter(pa.array([scorer(t) < threshold for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)
