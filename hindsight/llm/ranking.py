"""Ranked lexical search: documents grouped by which terms of an item they hold, groups judged best first.

Two passes. The first reads whole texts and writes, for each document, its
number of terms and its counts of the terms that any item asks for. From that
Spark sums documents, terms and documents a term. The second takes the written
counts in blocks of documents. In a block each term of an item is a bitmap; the
bitmaps' columns are the presence masks of the documents, and documents of one
mask form a group. No document of a group scores more than the block's largest
contributions of the mask's terms add up to, so groups are scored by descending
bound and the block is left as soon as the next bound is below the score that
the item's list asks for. A bound equal to it is still scored, as ties go by
``doc_id``. Each task returns the best ``k`` for each item, Spark ranks those.

Items are a stated query set, taken in blocks of ``ITEMS`` items or
``QUERY_BYTES`` bytes of text, whichever is reached first; with more items
there are more passes. What a task holds is bounded by ``POSTINGS`` counts.

Edge cases: a null text has no term and counts nowhere, an empty one neither;
items without terms, or whose terms no document holds, have no rows; terms that
nearly every document holds weigh 0, and only scores above 0 are returned;
repeated rows of documents are documents each; items repeated with id and text
count once; null ids come first among equal scores. ``doc_id`` is of any
integer type; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hindsight.llm.work import stage

#: Letters are lowered and everything that is in no term becomes a blank; bytes from 0x80 on are parts of letters.
FOLD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
ITEMS, QUERY_BYTES = 2_000, 4_000_000
#: A block of documents ends after so many documents or counts.
DOCUMENTS, POSTINGS = 1 << 15, 1 << 21
#: Lists of the tasks meet in so many parts of an item first.
PARTS = 64
NO_ID = np.iinfo(np.int64).min


def terms(text: bytes) -> list[bytes]:
    """All terms of a text in UTF-8, in order."""
    return text.translate(FOLD).split()


def blocks(items: DataFrame) -> Iterator[list[tuple[int | None, Counter]]]:
    """The items in blocks, each as its id and how often it has each term."""
    block, size = [], 0
    for row in items.select("item_id", F.col("text").cast("binary").alias("text")).distinct().toLocalIterator():
        found = Counter(terms(bytes(row["text"] or b"")))
        if found:
            block.append((row["item_id"], found))
            size += len(row["text"])
        if len(block) >= ITEMS or size >= QUERY_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts) of each document that has a term; ``terms`` are numbers of the vocabulary, ascending."""

    def count(batches):
        for batch in batches:
            ids, sizes, held, often, ends = [], [], [], [], [0]
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = terms(text.as_buffer().to_pybytes()) if text.is_valid else []
                if found:
                    ids.append(i)
                    sizes.append(len(found))
                    numbered = sorted(Counter(map(vocabulary.get, found)).items(), key=lambda x: -1 if x[0] is None else x[0])
                    numbered = numbered[1:] if numbered[0][0] is None else numbered
                    held.extend(t for t, _ in numbered)
                    often.extend(n for _, n in numbered)
                    ends.append(len(held))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, kind)) for v, kind in ((held, pa.int32()), (often, pa.int64()))]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "counts"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(count, "doc_id long, n long, terms array<int>, counts array<long>")


def weights(n_docs: int, holding: dict[int, int], size: int) -> np.ndarray:
    """Weight of each term by how many documents hold it."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding.get(t, 0) + 1))) for t in range(size)], np.int64)


def lengths(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a document's length counts for; in Python's integers where 64 bits might not do."""
    if n.size and int(n.max()) * 25 * n_docs >= 1 << 63:
        return np.array([75 + 25 * int(x) * n_docs // n_terms for x in n], np.int64)
    return 75 + 25 * n * n_docs // n_terms


class Block:
    """Counts of some documents, by document and by term."""

    def __init__(self, ids, n, ends, held, often, weight, n_docs, n_terms):
        self.ids, self.ends, self.held = ids, ends, held
        of = np.repeat(np.arange(len(ids)), np.diff(ends))
        m = lengths(n, n_docs, n_terms)[of]
        self.gives = weight[held] * (1_000_000_000 * often // (1000 * often + 12 * m))
        by_term = np.argsort(held, kind="stable")
        self.terms, first = np.unique(held[by_term], return_index=True)
        self.begins = np.append(first, len(held))
        self.docs = of[by_term]
        self.most = np.maximum.reduceat(self.gives[by_term], first) if len(held) else np.empty(0, np.int64)

    def masks(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the terms asked for (places in ``terms``): bits of each distinct mask, documents, the mask of each."""
        bits = np.zeros((-(-len(asked) // 64) * 64, len(self.ids)), bool)
        for i, t in enumerate(asked):
            bits[i, self.docs[self.begins[t] : self.begins[t + 1]]] = True
        words = np.ascontiguousarray(np.packbits(bits, axis=0).T).view(np.uint64)
        docs = np.flatnonzero(words.any(axis=1))
        words = words[docs]
        _, first, group = np.unique(words[:, 0], return_index=True, return_inverse=True)
        for i in range(1, words.shape[1]):  # masks that agree so far part by their next 64 bits
            _, next_ = np.unique(words[:, i], return_inverse=True)
            _, first, group = np.unique(group * (next_.max(initial=0) + 1) + next_, return_index=True, return_inverse=True)
        return bits[: len(asked), docs[first]], docs, group

    def scores(self, docs: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Scores of some documents; ``times`` says how often the item has each term of the vocabulary."""
        begin, size = self.ends[docs], self.ends[docs + 1] - self.ends[docs]
        starts = np.cumsum(size) - size
        at = np.repeat(begin - starts, size) + np.arange(size.sum())
        return np.add.reduceat(times[self.held[at]] * self.gives[at], starts)

    def best(self, asked: dict[int, int], times: np.ndarray, k: int, top: tuple[np.ndarray, np.ndarray]):
        """``top``, the best (scores, ids) so far, with what this block has to add to it, and how many documents it scored."""
        at = np.searchsorted(self.terms, list(asked))
        at = np.array([a for a, t in zip(at, asked) if a < len(self.terms) and self.terms[a] == t], np.int64)
        if not len(at):
            return top, 0
        most = self.most[at] * np.array([asked[int(t)] for t in self.terms[at]], np.int64)
        if len(top[0]) == k and most.sum() < top[0][-1]:
            return top, 0
        bits, docs, group = self.masks(at)
        bound = most @ bits
        order = np.argsort(-bound[group], kind="stable")
        docs, bound = docs[order], bound[group][order]
        done, step = 0, 4 * k
        while done < len(docs) and not (len(top[0]) == k and bound[done] < top[0][-1]):
            some = docs[done : done + step]
            found = self.scores(some, times)
            scores, ids = (np.concatenate(x) for x in zip(top, (found[found > 0], self.ids[some][found > 0])))
            first = np.lexsort((ids, -scores))[:k]
            top = scores[first], ids[first]
            done, step = done + len(some), 2 * step
        return top, done


def ranked_in_tasks(postings: DataFrame, items: list[dict[int, int]], weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The best ``k`` documents of each task for each item: (item, part, doc_id, score)."""

    def blocks_of(batches):
        held: list[pa.RecordBatch] = []
        rows = counts = 0
        for batch in batches:
            held.append(batch)
            rows, counts = rows + batch.num_rows, counts + len(batch.column(2).flatten())
            if rows >= DOCUMENTS or counts >= POSTINGS:
                yield pa.Table.from_batches(held).combine_chunks()
                held, rows, counts = [], 0, 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks()

    def rank(batches):
        none = np.empty(0, np.int64)
        top = [(none, none)] * len(items)
        times = np.zeros(len(weight), np.int64)
        for table in blocks_of(batches):
            lists = [table.column(i).combine_chunks() for i in (2, 3)]
            held, often = (x.flatten().to_numpy(zero_copy_only=False) for x in lists)
            ends = np.append(0, np.cumsum(lists[0].value_lengths().to_numpy(zero_copy_only=False))).astype(np.int64)
            ids = table.column(0).fill_null(int(NO_ID)).to_numpy()
            block = Block(ids, table.column(1).to_numpy(), ends, held, often, weight, n_docs, n_terms)
            for i, asked in enumerate(items):
                for t, n in asked.items():
                    times[t] = n
                top[i], _ = block.best(asked, times, k, top[i])
                times[list(asked)] = 0
        sizes = [len(s) for s, _ in top]
        if sum(sizes):
            ids = np.concatenate([x for _, x in top])
            columns = [
                pa.array(np.repeat(np.arange(len(items)), sizes), pa.int32()),
                pa.array(ids, pa.int64(), mask=ids == NO_ID),
                pa.array(np.concatenate([s for s, _ in top]), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    found = postings.where(F.size("terms") > 0).mapInArrow(rank, "item int, doc_id long, score long")
    return found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item, best first."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType
    out = spark.createDataFrame([], T.StructType([T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    for block in blocks(items):
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*(c for _, c in block))))}
        postings = stage(counted(docs, vocabulary), "postings")
        n_docs, n_terms = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            continue
        holding = postings.select(F.explode("terms").alias("term")).groupBy("term").count()
        weight = weights(n_docs, {r["term"]: r["count"] for r in holding.toLocalIterator()}, len(vocabulary))
        asked = [{vocabulary[t]: n for t, n in c.items()} for _, c in block]
        found = ranked_in_tasks(postings, asked, weight, n_docs, n_terms, k)
        by_score = [F.desc("score"), F.asc("doc_id")]
        for keys in (["item", "part"], ["item"]):
            found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*by_score))).where(F.col("rank") <= k)
        names = spark.createDataFrame(
            [(i, name) for i, (name, _) in enumerate(block)], T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", kind)])
        )
        out = out.unionByName(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out
