"""Best-fit packing of token pieces into sequences, large pieces by matching.

Documents are tokenized where they lie; only those longer than a sequence are
cut, their first piece taking the remainder. Pieces of one length are alike, so
the packing is worked out on the histogram of lengths, which has ``capacity``
cells at most, however many documents there are:

* Large pieces (above a third of the capacity, so at most two a sequence): from
  the longest down, each is matched with the longest other one that fits.
* Smaller pieces, from the longest down, go where they leave the least gap, or
  into a new sequence where none fits.

The result is a plan of runs: so many sequences of the same make-up. A piece
finds its place in the plan by its rank among the pieces of its length. Ranks
are numbered within the task that tokenized the piece and shifted by the counts
of the tasks before it, so no group of pieces meets anywhere.

Tokens come from ``tokenizers``' vocabulary; the same vocabulary as ranks in
``tiktoken``, several times as fast, gives the same ids (tests compare them)
wherever the text doesn't hold a special token's string.

Edge cases: a null text counts as empty, and an empty document is its end token
alone; repeated rows are packed each time; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hindsight.llm.work import stage

CAPACITY = 1024
END = 2


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit numbers."""

    def __init__(self, vocabulary: str, ranks: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as f:
            known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=known, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            ids = self.slow.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array([*ids, END], dtype="<u4")


def public_encoder() -> Encoder:
    """The byte-level BPE vocabulary of 50,257 ids, from the public tokenizers' folder of each machine."""
    import public_tokenizers as p

    return Encoder(p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken"), p.PATTERN)


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; all but the first are full."""
    first = n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def pieces(docs: DataFrame, encoder=public_encoder, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, nth): ``nth`` counts a task's pieces of one length from 0."""

    def rows(batches):
        encode, seen, task = encoder(), Counter(), TaskContext.get().partitionId()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text or "")
                for k, (start, length) in enumerate(cuts(len(ids), capacity)):
                    out.append((doc_id, k, start, length, zlib.crc32(ids[start : start + length].tobytes()), task, seen[length]))
                    seen[length] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*out)) or [()] * 7, arrow)], schema=arrow)

    field = docs.schema["doc_id"]
    kind = field.dataType.simpleString()
    arrow = pa.schema([
        ("doc_id", {"bigint": pa.int64(), "int": pa.int32()}[kind]), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
        ("ids_crc32", pa.int64()), ("task", pa.int32()), ("nth", pa.int64()),
    ])
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long"
    return docs.select("doc_id", "text").mapInArrow(rows, schema)


@dataclass
class Run:
    """``n`` sequences of the same make-up: (length, times) in order, and the tokens left free."""

    n: int
    parts: list[tuple[int, int]]
    gap: int


def plan(histogram: np.ndarray, capacity: int = CAPACITY) -> list[Run]:
    """Runs for ``histogram[length]`` pieces. Works on counts: its size follows from the capacity alone."""
    left = histogram.astype(np.int64).copy()
    runs: list[Run] = []
    least = capacity // 3 + 1
    for long in range(capacity, least - 1, -1):
        while left[long]:
            short = min(long, capacity - long)
            while short >= least and not (left[short] >= (2 if short == long else 1)):
                short -= 1
            if short < least:
                runs.append(Run(int(left[long]), [(long, 1)], capacity - long))
                left[long] = 0
            elif short == long:
                runs.append(Run(int(left[long]) // 2, [(long, 2)], capacity - 2 * long))
                left[long] %= 2
            else:
                n = int(min(left[long], left[short]))
                runs.append(Run(n, [(long, 1), (short, 1)], capacity - long - short))
                left[long] -= n
                left[short] -= n
    by_gap: dict[int, list[Run]] = {}
    for r in runs:
        by_gap.setdefault(r.gap, []).append(r)
    for size in range(least - 1, 0, -1):
        n = int(left[size])
        for gap in range(size, capacity):
            if not n:
                break
            while n and by_gap.get(gap):
                run = by_gap[gap].pop()
                times = run.gap // size
                whole = min(run.n, n // times)
                part = n % times if whole < run.n and n // times == whole else 0
                if rest := run.n - whole - bool(part):
                    by_gap[gap].append(Run(rest, run.parts, gap))
                for k, t in ((whole, times), (1 if part else 0, part)):
                    if k:
                        by_gap.setdefault(gap - t * size, []).append(Run(k, [*run.parts, (size, t)], gap - t * size))
                        n -= k * t
        if n:
            times = capacity // size
            for k, t in ((n // times, times), (1 if n % times else 0, n % times)):
                if k:
                    by_gap.setdefault(capacity - t * size, []).append(Run(k, [(size, t)], capacity - t * size))
    return [r for gap in sorted(by_gap) for r in by_gap[gap]]


class Places:
    """Where the r-th piece of a length goes."""

    def __init__(self, runs: list[Run]):
        slots: dict[int, list[tuple[int, int, int, int]]] = {}
        taken: Counter = Counter()
        sequence = 0
        for run in runs:
            offset = 0
            for length, times in run.parts:
                slots.setdefault(length, []).append((taken[length], sequence, times, offset))
                taken[length] += run.n * times
                offset += length * times
            sequence += run.n
        self.slots = {length: np.array(s, dtype=np.int64) for length, s in slots.items()}

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for value in np.unique(length):
            at = length == value
            slots = self.slots[int(value)]
            first, base, times, begin = slots[np.searchsorted(slots[:, 0], rank[at], side="right") - 1].T
            nth = rank[at] - first
            sequence[at], offset[at] = base + nth // times, begin + nth % times * value
        return sequence, offset


def pack(docs: DataFrame, encoder=public_encoder, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every row."""
    found = stage(pieces(docs, encoder, capacity), "pieces")
    counts = stage(found.groupBy("task", "length").agg(F.count("*").alias("n")), "counts")
    histogram = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        histogram[row["length"]] = row["n"]
    places = Places(plan(histogram, capacity))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = found.join(starts, ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank")
    )

    def rows(batches):
        for batch in batches:
            sequence, offset = places.of(batch.column(3).to_numpy(), batch.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(rows, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
