"""URL verdicts: rules by host and path, and two character language models for the rest.

Urls that a rule accepts train one variable-order Markov model, urls that a rule
rejects another. Each predicts a character from up to three before it and backs
off to fewer by Witten-Bell smoothing. An unruled url is allowed if the mean of
its characters' log-likelihood differences reaches a threshold, set where the
balanced error over all ruled urls is least; for that each half of them is
scored by models of the other half.

Counts come from all distinct ruled urls, gathered in the tasks and summed by
Spark. Models have ``SYMBOLS ** 4`` cells however many urls there are: that is
the proven bound of what is collected and broadcast.

Edge cases: a null url counts as empty, host and path are empty without
``://``; the empty url is scored by its end symbol; characters outside the
alphabet share one symbol a byte; repeated urls train once and are judged each
time; with ruled urls of one verdict only, all others get that verdict, and
with none ``allow``.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PUNCTUATION = "/.-_?=&#%:"
ALPHABET = string.ascii_lowercase + string.digits + PUNCTUATION
OTHER = len(ALPHABET)
EDGE = OTHER + 1
SYMBOLS = EDGE + 1
ORDER = 3
CELLS = SYMBOLS ** (ORDER + 1)
CODES = bytes(ALPHABET.index(chr(b)) if chr(b) in ALPHABET else OTHER for b in range(256))
#: Histogram for the threshold: steps of 0.01 from -16 to 16, all scores beyond in the last ones.
STEP, SPAN = 0.01, 1600


@dataclass(frozen=True)
class Rule:
    """``prefix`` is host and path in one; the host ends before the first slash."""

    prefix: str
    verdict: str

    @property
    def host(self) -> str:
        return self.prefix.partition("/")[0]

    @property
    def path(self) -> str:
        return self.prefix[len(self.host) :]


def located(pages: DataFrame) -> DataFrame:
    """Adds ``host`` and ``path``."""
    url = F.coalesce(F.col("url"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(coalesce(url, ''), instr(coalesce(url, ''), '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return pages.withColumns(
        {
            "host": F.translate(host, string.ascii_uppercase, string.ascii_lowercase),
            "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
        }
    )


def ruled(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``rule`` and ``verdict`` of the longest rule that fits, else nulls."""

    def fits(r: Rule):
        host = (F.col("host") == r.host) | F.col("host").endswith("." + r.host)
        return host & F.col("path").startswith(r.path)

    longest_first = sorted(rules, key=lambda r: -len(r.prefix))
    pick = lambda value: F.coalesce(*[F.when(fits(r), F.lit(value(r))) for r in longest_first], F.lit(None).cast("string"))
    return located(pages).withColumns({"rule": pick(lambda r: r.prefix), "verdict": pick(lambda r: r.verdict)})


def cells(urls: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Each character's cell (three before it, itself), all urls in a row, and each url's number of them."""
    coded = [(u or "").lower().encode("utf-8", "surrogatepass").translate(CODES) for u in urls]
    edge = bytes([EDGE])
    line = np.frombuffer(b"".join(edge * ORDER + c + edge for c in coded), np.uint8).astype(np.int64)
    sizes = np.array([len(c) + 1 for c in coded], dtype=np.int64)
    ends = np.cumsum(sizes + ORDER)
    keep = np.ones(len(line), bool)
    for k in range(ORDER):
        keep[ends - sizes - ORDER + k] = False
    cell = line.copy()
    for k in range(1, ORDER + 1):
        cell[k:] += line[:-k] * SYMBOLS**k
    return cell[keep], sizes


def count_rows(batches):
    """Arrow batches of (url, part) to (cell, n), cells of a part beginning at part * CELLS."""
    for batch in batches:
        cell, sizes = cells(batch.column(0).to_pylist())
        part = np.repeat(batch.column(1).to_numpy(), sizes)
        found, n = np.unique(cell + part * CELLS, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], names=["cell", "n"])


def probabilities(counts: np.ndarray) -> np.ndarray:
    """Witten-Bell smoothed conditional probabilities of every cell."""
    full = counts.reshape((SYMBOLS,) * (ORDER + 1))
    p = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for order in range(ORDER + 1):
        n = full.sum(axis=tuple(range(ORDER - order)), dtype=np.float64)
        seen, kinds = n.sum(-1, keepdims=True), (n > 0).sum(-1, keepdims=True)
        p = np.where(seen > 0, (n + kinds * p) / np.maximum(seen + kinds, 1), p)
    return p.reshape(-1)


def difference(accepted: np.ndarray, rejected: np.ndarray) -> np.ndarray:
    return (np.log(probabilities(accepted)) - np.log(probabilities(rejected))).astype(np.float32)


def means(table: np.ndarray, urls: list[str | None], offset: np.ndarray | int = 0) -> np.ndarray:
    """Length-normalised difference of each url; ``offset`` picks a table for each url."""
    if not urls:
        return np.zeros(0)
    cell, sizes = cells(urls)
    shift = np.repeat(offset, sizes) if isinstance(offset, np.ndarray) else offset
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return np.add.reduceat(table[cell + shift].astype(np.float64), starts) / sizes


def threshold_of(histogram: np.ndarray) -> float:
    """Where accepted (row 1) and rejected (row 0) parts on the wrong side are fewest."""
    share = histogram / histogram.sum(1, keepdims=True)
    wrong = np.concatenate([[0], np.cumsum(share[1])]) + np.concatenate([np.cumsum(share[0][::-1])[::-1], [0]])
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    return (best[len(best) // 2] - SPAN) * STEP


@dataclass(frozen=True)
class Model:
    table: np.ndarray
    threshold: float


def fit(judged: DataFrame) -> Model:
    """Models and threshold from the rows of ``judged`` that a rule decided."""
    spark = judged.sparkSession
    # Part: verdict and half. Distinct urls only, or one hot url would be the model.
    known = (
        judged.where("rule is not null")
        .select("url", (F.col("verdict") == "allow").cast("long").alias("accepted"))
        .distinct()
        .withColumn("half", F.pmod(F.xxhash64("url"), F.lit(2)))
        .withColumn("part", F.col("accepted") * 2 + F.col("half"))
    )
    sums = known.select("url", "part").mapInArrow(count_rows, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(4 * CELLS, np.float32)
    counts[sums.column("cell").to_numpy()] = sums.column("n").to_numpy()
    counts = counts.reshape(4, CELLS)
    totals = counts.sum(1)
    if not totals[2:].any() or not totals[:2].any():
        return Model(np.zeros(CELLS, np.float32), np.inf if totals[:2].any() else -np.inf)
    halves = spark.sparkContext.broadcast(np.concatenate([difference(counts[3], counts[1]), difference(counts[2], counts[0])]))

    def bins(batches):
        for batch in batches:
            half = batch.column(2).to_numpy()
            score = means(halves.value, batch.column(0).to_pylist(), half * CELLS)
            at = np.clip(np.floor(score / STEP) + SPAN, 0, 2 * SPAN - 1).astype(np.int64)
            found, n = np.unique(batch.column(1).to_numpy() * 2 * SPAN + at, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], names=["bin", "n"])

    rows = known.select("url", "accepted", "half").mapInArrow(bins, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    histogram = np.zeros(4 * SPAN)
    histogram[rows.column("bin").to_numpy()] = rows.column("n").to_numpy()
    halves.destroy()
    return Model(difference(counts[2] + counts[3], counts[0] + counts[1]), threshold_of(histogram.reshape(2, -1)))


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row of ``pages``."""
    judged = ruled(pages.select("page_id", "url"), rules)
    model = fit(judged)
    table, threshold = pages.sparkSession.sparkContext.broadcast(model.table), model.threshold

    def rows(batches):
        for batch in batches:
            score = means(table.value, batch.column(1).to_pylist())
            own = np.where(score >= threshold, "allow", "block")
            verdict = [v or str(o) for v, o in zip(batch.column(5).to_pylist(), own)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[batch.column(k) for k in (2, 3, 4)], pa.array(verdict, pa.string()), pa.array(score)],
                names=["page_id", "host", "path", "rule", "verdict", "score"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, host string, path string, rule string, verdict string, score double"
    return judged.select("page_id", "url", "host", "path", "rule", "verdict").mapInArrow(rows, schema)
