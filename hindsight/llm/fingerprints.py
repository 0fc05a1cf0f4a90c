"""Document fingerprints: one-permutation MinHash with optimal densification, packed low-order bits.

A text's shingles (five lower-cased words in a row; all words, if fewer) are
hashed once. The top bits of a hash name its bin, and each bin keeps its least
hash. An empty bin borrows from the first full one in a random order of its
own. Of each bin the lowest ``BITS`` bits are stored, two bins a byte. Equal
bits by chance are taken out when two fingerprints are compared.

Edge cases: a null text counts as empty; texts without words have the
fingerprint of one fixed shingle; documents with equal ids follow each other by
text, null ids come last; a table of one document has itself as the next.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WORD = re.compile(r"\w+")
WORDS_A_SHINGLE = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
BITS = 4
CHANCE = 1 / (1 << BITS)
#: Order in which an empty bin asks the others: a random permutation for each bin.
ASKED = np.array([np.random.default_rng(k).permutation(BINS) for k in range(BINS)])
#: One odd number for each place in a shingle.
MULTIPLIERS = np.array([0x9E3779B97F4A7C15 * (2 * k + 1) % 2**64 for k in range(WORDS_A_SHINGLE)], dtype=np.uint64)
NOTHING = np.array([0xD1B54A32D192ED03], dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of 64-bit numbers over all others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words(dict):
    """Hashes of words, remembered up to a bound after which it starts anew."""

    def __init__(self, remembered: int = 400_000):
        super().__init__()
        self.remembered = remembered

    def __missing__(self, word: str) -> int:
        if len(self) >= self.remembered:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h

    def of(self, text: str) -> np.ndarray:
        words = WORD.findall(text.lower())
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of all runs of five words, in text order; of all words if there are fewer; none of none."""
    width = min(WORDS_A_SHINGLE, len(words))
    if not width:
        return words
    n = len(words) - width + 1
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += mixed(words[k : k + n] * MULTIPLIERS[k])
    return mixed(total)


def fingerprint(words: np.ndarray) -> np.ndarray:
    """``BINS`` numbers of ``BITS`` bits."""
    h = np.sort(shingles(words) if len(words) else NOTHING)
    of = (h >> np.uint64(64 - BIN_BITS)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    least = np.zeros(BINS, np.uint64)
    full = np.zeros(BINS, bool)
    least[of[first]] = h[first]
    full[of[first]] = True
    empty = np.flatnonzero(~full)
    if len(empty):
        asked = ASKED[empty]
        least[empty] = least[asked[np.arange(len(empty)), full[asked].argmax(1)]]
    return (least & np.uint64((1 << BITS) - 1)).astype(np.uint8)


def packed(bins: np.ndarray) -> str:
    return ((bins[0::2] << 4) | bins[1::2]).tobytes().hex()


def unpacked(fingerprint: str) -> np.ndarray:
    both = np.frombuffer(bytes.fromhex(fingerprint), np.uint8)
    return np.stack([both >> 4, both & 15], 1).reshape(-1)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity: share of equal bins, less what chance makes equal."""
    return min(1.0, max(0.0, (float((a == b).mean()) - CHANCE) / (1 - CHANCE)))


def in_order(docs: DataFrame, pieces: int) -> DataFrame:
    """Rows (piece, guest, doc_id, text), partitioned and sorted so that each is followed by its next document.

    Ids are cut into ``pieces`` ranges at approximate quantiles, one partition holding whole ranges. The
    first row of the next range is added to each range as a guest; that is one row a range.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cuts = docs.select(F.percentile_approx("doc_id", [k / pieces for k in range(1, pieces)], 100 * pieces)).first()[0] if pieces > 1 else []
    cuts = np.unique(np.array(cuts or [], dtype=np.int64))

    @F.pandas_udf("long")
    def piece_of(ids: pd.Series) -> pd.Series:
        # Descending ids: the highest are in piece 0; nulls come behind all others.
        at = len(cuts) - np.searchsorted(cuts, ids.fillna(0).astype(np.int64).to_numpy(), side="left")
        return pd.Series(np.where(ids.isna(), len(cuts) + 1, at))

    cut = docs.withColumn("piece", piece_of("doc_id"))
    # One narrow row a range, so both frames below are bounded by ``pieces``.
    tops = cut.groupBy("piece").agg(F.max("doc_id").alias("top"))
    order = Window.orderBy("piece")
    around = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tops = tops.withColumn("before", F.coalesce(F.lag("piece").over(order), F.last("piece").over(around)))
    same = (cut["piece"] == tops["piece"]) & cut["doc_id"].eqNullSafe(tops["top"])
    guests = (
        cut.join(F.broadcast(tops), same)
        .groupBy("before")
        .agg(F.first("top").alias("doc_id"), F.min("text").alias("text"))
        .select(F.col("before").alias("piece"), F.lit(True).alias("guest"), "doc_id", "text")
    )
    own = cut.select("piece", F.lit(False).alias("guest"), "doc_id", "text")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return own.unionByName(guests).repartition(partitions, "piece").sortWithinPartitions("piece", "guest", F.desc_nulls_last("doc_id"), "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """A row for each document: its fingerprint, its edited text's, and how like they are.

    The edited text has its last half replaced by the beginning of the next document's.
    """
    pieces = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def rows(batches):
        words, held = Words(), None
        for batch in batches:
            out = []
            for piece, guest, doc_id, text in zip(*[c.to_pylist() for c in batch.columns]):
                bins = fingerprint(words.of(text))
                if held is not None and held[0] == piece:
                    _, own_id, own, own_bins = held
                    half = len(own) // 2
                    edited = own[: len(own) - half] + text[:half]
                    edited_bins = fingerprint(words.of(edited))
                    out.append((
                        own_id, len(own), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                        packed(own_bins), packed(edited_bins), likeness(own_bins, edited_bins), likeness(own_bins, bins),
                    ))
                held = None if guest else (piece, doc_id, text, bins)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*out)) or [()] * 7, arrow)], schema=arrow)

    kind = docs.schema["doc_id"].dataType.simpleString()
    arrow = pa.schema([
        ("doc_id", {"bigint": pa.int64(), "int": pa.int32()}[kind]), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ])
    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return in_order(docs, pieces).mapInArrow(rows, schema)
