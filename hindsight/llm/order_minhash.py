"""Near-duplicate documents by Order MinHash and banded alignment.

The k-mers are runs of five lower-cased words, labelled with their occurrence in
the text. A sketch holds, for each of several hash functions, the two least
labelled k-mers in the order that they have in the text, so it agrees with the
probability that texts share k-mers *in order* (Marcais et al., 2019). Sketches
are grouped into bands; texts that agree in a whole band are candidates.

Candidates are verified by alignment: S, the longest common subsequence of the
two k-mer sequences, within the band of offsets that a similar pair can have.
They link if S / (n + m - S) >= 0.8. For pairs at the threshold the chance to be
no candidates is 2e-5.

Texts of equal words are one class and are compared once. Within a bucket no
list of all pairs is made. First every member is aligned with the bucket's
least member. Buckets whose members are then all in one component are done.
Components that still meet in a bucket form a cluster. It falls apart into
texts that share one of the rare k-mers which a linking pair must share, so that
texts with a long template in common and nothing else are compared with nothing.
In what is left all texts outside the largest component are compared with all
others, in blocks: one matrix product gives the shared k-mers of all pairs of
two blocks, a bound on S, and pairs that can still link two components are
aligned. So no link that would join two components is lost.

Edge cases: null texts and texts without words link with nothing and stay; a
text under five words is one k-mer; rows of equal ids stay or go together; in a
component the document of the least id stays; rows with null ids stay only in
components without other ids. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindsight.llm.components import components
from hindsight.llm.fingerprints import WORD, Words, mixed, shingles
from hindsight.llm.work import stage

LEAST = 0.8
BANDS, ROWS = 36, 3
FACTORS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)
#: Members of a block on either side of a block comparison.
FEW, MANY = 192, 768
#: Cells of temporary arrays.
CELLS = 1 << 21


def labelled(kmers: np.ndarray) -> np.ndarray:
    """Hashes of (k-mer, how many equal ones came before)."""
    order = np.argsort(kmers, kind="stable")
    run = kmers[order]
    new = np.concatenate([[True], run[1:] != run[:-1]])
    nth = np.arange(len(run)) - np.maximum.accumulate(np.where(new, np.arange(len(run)), 0))
    out = np.empty_like(kmers)
    out[order] = mixed(run + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out


def sketch(kmers: np.ndarray) -> np.ndarray:
    """``BANDS`` keys of a text with at least one k-mer."""
    x = labelled(kmers)
    n = len(x)
    if n == 1:
        vectors = mixed(x[0] ^ FACTORS)
    else:
        vectors = np.empty(len(FACTORS), np.uint64)
        step = max(1, CELLS // n)
        for at in range(0, len(FACTORS), step):
            h = x[None, :] * FACTORS[at : at + step, None]
            line = np.arange(len(h))
            first = h.argmin(1)
            h[line, first] = np.uint64(2**64 - 1)
            second = h.argmin(1)
            early, late = np.minimum(first, second), np.maximum(first, second)
            vectors[at : at + step] = mixed(x[early] * np.uint64(3) + mixed(x[late]))
    keys = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + vectors[k::ROWS])
    return keys.view(np.int64)


def word_key(words: list[str]) -> bytes:
    return hashlib.md5(" ".join(words).encode("utf-8", "surrogatepass")).digest()


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, bands): ``key`` stands for the text's words; both are null without words."""

    def rows(batches):
        hashes, known = Words(), {}
        for batch in batches:
            keys, bands = [], []
            for text in batch.column(1).to_pylist():
                words = WORD.findall((text or "").lower())
                if not words:
                    keys.append(None)
                    bands.append(None)
                    continue
                key = word_key(words)
                if key not in known:
                    if len(known) > 20_000:
                        known.clear()
                    known[key] = sketch(shingles(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))))
                keys.append(key)
                bands.append(known[key])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "key", "bands"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, key binary, bands array<long>")


def needed(n: int, m: int, least: float) -> int:
    """Common k-mers that texts of n and m k-mers must have."""
    return math.ceil(least * (n + m) / (1 + least) - 1e-9)


def common(a: np.ndarray, b: np.ndarray, width: int) -> int:
    """Longest common subsequence over matches at most ``width`` places apart."""
    where: dict[int, list[int]] = {}
    for j, v in enumerate(b.tolist()):
        where.setdefault(v, []).append(j)
    tails: list[int] = []
    budget = 64 * (len(a) + len(b)) + 4096
    for i, v in enumerate(a.tolist()):
        places = where.get(v)
        if places is None:
            continue
        inside = places[bisect_left(places, i - width) : bisect_left(places, i + width + 1)]
        budget -= len(inside)
        if budget < 0:  # many repeats: the table costs less than the matches
            return common_by_table(a, b, width)
        for j in reversed(inside):
            k = bisect_left(tails, j)
            tails[k : k + 1] = [j]
    return len(tails)


def common_by_table(a: np.ndarray, b: np.ndarray, width: int) -> int:
    """The same by dynamic programming, a row of the band at a time."""
    n, m, low = len(a), len(b), -(1 << 40)
    span = 2 * width + 1
    before = np.full(span + 1, low, np.int64)  # row 0: cell k is column k - width
    ks = np.arange(span)
    before[:span][(ks - width >= 0) & (ks - width <= m)] = 0
    padded = np.concatenate([b, [np.uint64(0)]])
    for i in range(1, n + 1):
        j = ks + (i - width)
        fits = (j >= 1) & (j <= m)
        equal = fits & (padded[np.where(fits, j - 1, m)] == a[i - 1])
        row = np.maximum(before[1:], np.where(equal, before[:span] + 1, low))
        row[(j < 0) | (j > m)] = low
        before[:span] = np.maximum.accumulate(row)
        before[:span][(j < 0) | (j > m)] = low
    at = m - n + width
    return int(before[at]) if 0 <= at < span else 0


def similarity(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> float:
    """S / (n + m - S) by banded alignment; 0 if it can't reach ``least``."""
    n, m = len(a), len(b)
    need = needed(n, m, least)
    if min(n, m) < need:
        return 0.0
    short = min(n, m)
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    rest = short - head
    differ = np.flatnonzero(a[n - rest :][::-1] != b[m - rest :][::-1])
    tail = int(differ[0]) if len(differ) else rest
    s = head + tail + common(a[head : n - tail], b[head : m - tail], n + m - 2 * need)
    return s / (n + m - s) if s >= need else 0.0


def words_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(key, words) of the texts in ``chosen`` (doc_id, key)."""

    def rows(batches):
        for batch in batches:
            out = []
            for text, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = WORD.findall((text or "").lower())
                if word_key(words) == key:  # ids may repeat
                    out.append((key, " ".join(words)))
            keys, texts = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(texts, pa.string())], names=["key", "words"])

    d, c = docs.select("doc_id", "text").alias("d"), chosen.alias("c")
    found = d.join(c, F.col("d.doc_id").eqNullSafe(F.col("c.doc_id"))).select("text", "key")
    return found.mapInArrow(rows, "key binary, words string").dropDuplicates(["key"])


def kmers_of(words: str, hashes: Words) -> np.ndarray:
    split = words.split(" ")
    return shingles(np.fromiter(map(hashes.__getitem__, split), np.uint64, len(split)))


def verified(pairs: DataFrame, words: DataFrame, least: float) -> DataFrame:
    """The rows of ``pairs`` (a, b) that link."""

    def rows(batches):
        hashes, last = Words(), (None, None)
        for batch in batches:
            out = []
            for a, b, wa, wb in zip(*[c.to_pylist() for c in batch.columns]):
                if last[0] != a:
                    last = (a, kmers_of(wa, hashes))
                if similarity(last[1], kmers_of(wb, hashes), least):
                    out.append((a, b))
            left, right = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])

    x, y = words.toDF("a", "wa"), words.toDF("b", "wb")
    return pairs.join(y, "b").join(x, "a").select("a", "b", "wa", "wb").mapInArrow(rows, "a binary, b binary")


class Joined(dict):
    """Union-find over the components of one block."""

    def root(self, x):
        while (up := self.get(x, x)) != x:
            self[x] = x = self.get(up, up)
        return x


def shared_kmers(sets: list[np.ndarray], few: int) -> np.ndarray:
    """Numbers of labelled k-mers that the first ``few`` sets share with each set."""
    everything, at = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    often = np.bincount(at, minlength=len(everything)) > 1
    keep = often[at]
    column = (np.cumsum(often) - 1)[at[keep]]
    owner = owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total = np.zeros((few, len(sets)), np.float32)
    step = max(1, CELLS // len(sets))
    for first in range(0, int(often.sum()), step):
        begin, end = np.searchsorted(column, [first, first + step])
        table = np.zeros((len(sets), step), np.float32)
        table[owner[begin:end], column[begin:end] - first] = 1
        total += table[:few] @ table.T
    return total


def compare_block(group: pd.DataFrame, least: float) -> pd.DataFrame:
    """Links between components among ``few`` rows and all rows of one block pair."""
    group = group.sort_values("few", ascending=False, kind="stable", ignore_index=True)
    few, hashes = int(group["few"].sum()), Words()
    kmers = [kmers_of(w, hashes) for w in group["words"]]
    sizes = np.array([len(k) for k in kmers], dtype=float)
    keys, component = group["key"].tolist(), group["component"].tolist()
    shared = shared_kmers([labelled(k) for k in kmers], few)
    possible = shared >= least * (sizes[:few, None] + sizes[None, :]) / (1 + least) - 1e-6
    joined, links = Joined(), []
    for i, j in zip(*np.nonzero(possible)):
        a, b = joined.root(component[i]), joined.root(component[j])
        if a != b and similarity(kmers[i], kmers[j], least):
            joined[a] = b
            links.append((keys[i], keys[j]))
    return pd.DataFrame(links, columns=["a", "b"])


def meeting_clusters(placed: DataFrame) -> DataFrame:
    """(cluster, key, component) of the texts in buckets (bucket, key, component) where components meet.

    Components that meet in a bucket form a cluster. Two texts of different components that share a
    bucket are both here, in one cluster.
    """
    meeting = placed.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most")
    texts = stage(placed.join(stage(meeting, "meeting"), "bucket").select("key", "component", "least"), "texts")
    pairs = texts.select("component", "least").where("least < component").distinct()
    cluster = components(stage(pairs, "pairs")).toDF("component", "cluster")
    return stage(texts.select("key", "component").distinct().join(stage(cluster, "cluster"), "component").select("cluster", "key", "component"), "texts")


def cluster_kmers(texts: DataFrame, words: DataFrame) -> DataFrame:
    """(key, component, kmers): the labelled k-mers of texts, hashed with the cluster."""

    def rows(batches):
        hashes = Words()
        for batch in batches:
            out = []
            for cluster, words in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                salt = np.uint64(int.from_bytes(cluster[:8], "little"))
                out.append(mixed(labelled(kmers_of(words, hashes)) ^ salt).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(out, pa.list_(pa.int64()))], names=["key", "component", "kmers"])

    return texts.join(words, "key").select("cluster", "key", "component", "words").mapInArrow(rows, "key binary, component binary, kmers array<long>")


def rare_kmers(texts: DataFrame, words: DataFrame, least: float) -> DataFrame:
    """(bucket, key, component): what a text must share one of with any text of another component that it links with.

    A link takes ``least`` of a text's n k-mers, and such k-mers are in two components of its cluster.
    Of c k-mers of that kind, put in one order for all texts, rarest first, all but the last
    ceil(least n) - 1 are taken: the first k-mer common to a linking pair is among them for both. A text
    with fewer than ceil(least n) links with nothing. So a template that many texts share joins none of them.
    """
    kmers = stage(cluster_kmers(texts, words), "kmers")
    each = kmers.select("key", "component", F.ceil(F.size("kmers") * least - 1e-9).alias("need"), F.explode("kmers").alias("bucket"))
    often = each.groupBy("bucket").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
    often = stage(often.where("low < high").select("bucket", "n"), "often")
    shared = (
        each.join(often, "bucket")
        .groupBy("key", "component", "need")
        .agg(F.sort_array(F.collect_list(F.struct("n", "bucket"))).alias("shared"))
        .where(F.size("shared") >= F.col("need"))
    )
    first = F.slice("shared", F.lit(1), (F.size("shared") - F.col("need") + 1).cast("int"))
    return stage(shared.select("key", "component", F.explode(first).alias("at")).select(F.col("at.bucket").alias("bucket"), "key", "component"), "rare")


def remaining(members: DataFrame, links: DataFrame, words: DataFrame, least: float) -> DataFrame:
    """(cluster, i, j, few, key, component): block pairs of what may still link components.

    Texts are clustered by the buckets in which components meet, and within these clusters by the rare
    k-mers that a linking pair must share. A cluster's texts outside its largest component
    are dealt into groups of about ``FEW``, all its texts into groups of about ``MANY``; each pair of
    groups is one block. Each text is in one cluster, however many buckets hold it, so two texts are
    compared once, and any two that share a bucket and can link are.
    """
    named = components(links).toDF("key", "component")
    placed = members.join(named, "key", "left").select("bucket", "key", F.coalesce("component", "key").alias("component"))
    candidates = meeting_clusters(stage(placed, "placed"))
    texts = meeting_clusters(rare_kmers(candidates, words, least)).select("cluster", "component", "key", F.xxhash64("key").alias("h"))
    sizes = texts.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    shape = (
        sizes.groupBy("cluster")
        .agg(F.sum("n").alias("all"), F.max(F.struct("n", "component")).alias("main"))
        .select("cluster", "main.component", F.ceil((F.col("all") - F.col("main.n")) / FEW).alias("groups"), F.ceil(F.col("all") / MANY).alias("pieces"))
        .withColumnRenamed("component", "main")
    )
    inside = texts.join(stage(shape, "shape"), "cluster")
    each = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    few = inside.where(F.col("component") != F.col("main")).select(
        "cluster", F.pmod("h", "groups").alias("i"), F.explode(each("pieces")).alias("j"), F.lit(1).alias("few"), "key", "component"
    )
    many = inside.select("cluster", F.explode(each("groups")).alias("i"), F.pmod("h", "pieces").alias("j"), F.lit(0).alias("few"), "key", "component")
    return few.unionByName(many)


def near_duplicates(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """(doc_id, component_id, kept) of every row of ``docs``."""
    signatures = stage(signed(docs), "signatures")
    classes = stage(
        signatures.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands")), "classes"
    )
    entries = stage(classes.select("key", F.explode("bands").alias("bucket")), "entries")
    leaders = stage(entries.groupBy("bucket").agg(F.min("key").alias("a"), F.count("*").alias("n")).where("n > 1").select("bucket", "a"), "leaders")
    members = stage(entries.join(leaders, "bucket").select("bucket", "key", "a"), "members")
    chosen = classes.join(members.select("key").distinct(), "key", "left_semi").select(F.col("first_id").alias("doc_id"), "key")
    words = stage(words_of(docs, chosen), "words")
    pairs = stage(members.where(F.col("a") != F.col("key")).select("a", F.col("key").alias("b")).distinct(), "pairs")
    links = stage(verified(pairs, words, least), "links")

    blocks = stage(remaining(members, links, words, least), "blocks")
    rest = (
        blocks.join(words, "key")
        .groupBy("cluster", "i", "j")
        .applyInPandas(lambda g: compare_block(g[["few", "key", "component", "words"]], least), "a binary, b binary")
    )
    links = links.unionByName(stage(rest, "rest"))

    member = components(links).toDF("key", "component")
    named = stage(
        classes.select("key", "first_id").join(member, "key", "left").select("key", "first_id", F.coalesce("component", "key").alias("component")), "named"
    )
    ids = stage(named.groupBy("component").agg(F.min("first_id").alias("component_id")), "ids")
    known = stage(named.join(ids, "component").select("key", "component_id"), "known")
    wordless = F.col("key").isNull()
    return (
        signatures.select("doc_id", "key")
        .join(known, "key", "left")
        .select("doc_id", F.when(wordless, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), (wordless | F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept"))
    )


def keep_one(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """``docs`` without all but one document of each component; columns unchanged, repeated equal rows once."""
    kept = near_duplicates(docs, least).where("kept").select(F.col("doc_id").alias("id_")).distinct()
    # Rows go through as one struct, so that no column of theirs clashes with ours.
    rows = docs.select(F.struct("*").alias("row_"))
    rows = rows.join(kept, F.col("row_")["doc_id"].eqNullSafe(F.col("id_")), "left_semi")
    return rows.select("row_.*").dropDuplicates(["doc_id", "text"])
