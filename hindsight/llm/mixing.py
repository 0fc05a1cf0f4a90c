"""Mixing sources to target weights by entropy balancing.

Every document gets a rate: the number of times that it is expected in the mix.
Among all rates between 0 and ``CEILING`` that give each source its token
target, those closest to one copy a document (by entropy) are exponentially
tilted in the document's size: ``CEILING / (1 + exp(-tilt * size / mean))``,
with the tilt from the convex dual of the token constraints. The dual is
separable: one unknown a source. Newton steps for all sources run at once, each
one aggregation over the (source, size) histogram. A source that is to shrink
gives up long documents first, one that is to grow doubles them first.

Documents of one source and size have the same rate, so their copies are
rounded as a group: from the largest size down, each group takes the number of
copies that brings the source's running sum of tokens closest to what the rates
ask for. Within a group the extra copies go by hash of the id.

Sizes of work: the histogram has no more rows than documents and, for a hot
source, no more than there are text lengths; a hot (source, size) group is cut
into buckets of ``BUCKET`` documents for ranking. One row a source passes
through one task to number the sources in order.

Edge cases: null text has size 0 and takes 0; a null source is a source, last
in order; documents with equal ids are ranked as they come and share a hash; a
source without tokens has target 0; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindsight.llm.work import stage

#: Copies of a document, and tokens of a source as a multiple of its own, at most.
CEILING = 2
BUCKET = 256
WORDS = "[^\\x20\\x09-\\x0D]+"
#: Newton stops when every source is this close to its target, as a share of it.
CLOSE, MOST_STEPS = 1e-9, 60


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: list[float], share: float) -> DataFrame:
    """Adds ``target`` to (source, source_size): ``share`` of all tokens by weight, excess over the ceiling reshared.

    A source is at its ceiling when the level of tokens a unit of weight reaches
    ``CEILING * source_size / weight``. Taking sources by that number, the level
    is final at the first one that it doesn't reach.
    """
    whole = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank"), F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.withColumn("rank", F.row_number().over(whole) - 1).withColumn("weight", weight)
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        ranked.withColumn("most", CEILING * F.col("source_size").cast("double"))
        .withColumn("total", F.lit(share) * F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("filled", F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        .withColumn("gone", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("filled")) / (F.col("weights") - F.col("gone")))
        .withColumn("open", F.col("level") * F.col("weight") < F.col("most"))
    )
    final = F.min(F.when(F.col("open"), F.struct(F.col("most") / F.col("weight"), F.col("rank"), F.col("level")))).over(everything)
    level = final.getField("level")
    return levels.withColumn("target", F.coalesce(F.least(F.col("most"), level * F.col("weight")), F.col("most"))).select(
        "source", "source_size", "target"
    )


def tilts(histogram: DataFrame, wanted: DataFrame) -> DataFrame:
    """(source, source_size, target, mean, tilt, off): the dual's solution by distributed Newton iterations.

    The unknown ``tilt`` multiplies a size over the source's mean size; at 0 each document has one copy, half the
    ceiling. Targets at the ceiling and at zero have no finite tilt: ``tilt`` is null.

    From 0 towards the solution, what a source gets is concave (if it grows) or convex (if it shrinks) in its tilt.
    So Newton never oversteps, and gap times slope falls to a quarter or less at each step.
    """
    mean = histogram.groupBy("source").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"))
    inner = (F.col("target") > 0) & (F.col("target") < CEILING * F.col("source_size") * (1 - 1e-12))
    state = stage(
        wanted.join(mean, wanted["source"].eqNullSafe(mean["source"]))
        .select(wanted["source"], "source_size", "target", "mean")
        .withColumn("tilt", F.when(inner, F.lit(0.0)))
        .withColumn("off", F.when(inner, F.lit(1.0))),
        "tilts",
    )
    x = F.col("size") / F.col("mean")
    p = 1 / (1 + F.exp(-F.col("tilt") * x))
    gap = F.col("target") - F.col("got")
    for _ in range(MOST_STEPS):
        open_ = state.where(F.col("off") >= CLOSE)
        sums = (
            histogram.alias("h")
            .join(open_.alias("s"), F.col("h.source").eqNullSafe(F.col("s.source")))
            .select("s.source", (F.col("n") * F.col("size") * CEILING * p).alias("got"), (F.col("n") * F.col("size") * CEILING * p * (1 - p) * x).alias("slope"))
            .groupBy("source")
            .agg(F.sum("got").alias("got"), F.sum("slope").alias("slope"))
        )
        state = stage(
            state.alias("s")
            .join(sums.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")), "left")
            .select(
                "s.source", "source_size", "target", "mean",
                (F.col("tilt") + F.coalesce(gap / F.greatest(F.col("slope"), F.lit(1e-300)), F.lit(0.0))).alias("tilt"),
                F.coalesce(F.abs(gap) / F.col("target"), F.col("off")).alias("off"),
            ),
            "tilts",
        )
        if (state.agg(F.max("off")).first()[0] or 0.0) < CLOSE:
            return state
    raise RuntimeError(f"a source's tilt isn't solved after {MOST_STEPS} steps")


def rounded(group: pd.DataFrame) -> pd.DataFrame:
    """Copies of each (source, size) group of one source, largest size first, running sum kept closest to the rates'."""
    group = group.sort_values("size", ascending=False, ignore_index=True)
    size, n = group["size"].to_numpy(), group["n"].to_numpy()
    owed, copies = 0.0, np.zeros(len(group), np.int64)
    for k in range(len(group)):
        if size[k] <= 0:
            break
        owed += group["rate"].iat[k] * n[k] * size[k]
        copies[k] = min(max(round(owed / size[k]), 0), CEILING * n[k])
        owed -= copies[k] * size[k]
    return pd.DataFrame({"source": group["source"], "size": size, "n": n, "source_size": group["source_size"], "target": group["target"], "copies": copies})


def mix(docs: DataFrame, weights: list[float] = (3, 1, 2), share: float = 1.5) -> DataFrame:
    """(doc_id, size, source, source_size, target, copies, taken) of every row of ``docs``."""
    rows = stage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64(F.lit("mix"), "doc_id").alias("h")), "sizes")
    histogram = stage(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "histogram")
    sizes = histogram.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    solved = tilts(histogram, targets(sizes, list(weights), share))
    rate = F.when(F.col("tilt").isNotNull(), CEILING / (1 + F.exp(-F.col("tilt") * F.col("size") / F.col("mean")))).otherwise(
        F.when(F.col("target") > 0, F.lit(float(CEILING))).otherwise(0.0)
    )
    kind = docs.schema["source"].dataType.simpleString()
    groups = stage(
        histogram.alias("h")
        .join(solved.alias("s"), F.col("h.source").eqNullSafe(F.col("s.source")))
        .select("h.source", "size", "n", "source_size", "target", rate.alias("rate"))
        .groupBy("source")
        .applyInPandas(rounded, f"source {kind}, size long, n long, source_size long, target double, copies long"),
        "groups",
    )
    same = F.col("d.source").eqNullSafe(F.col("g.source")) & (F.col("d.size") == F.col("g.size"))
    joined = stage(
        rows.alias("d")
        .join(groups.alias("g"), same)
        .select("doc_id", "d.source", "d.size", "h", "n", "source_size", "target", "copies", F.pmod("h", F.ceil(F.col("n") / BUCKET)).alias("bucket")),
        "joined",
    )
    # Ranks within a group: by bucket, then within the bucket. Extra copies go to the first ranks.
    key = ["source", "size", "bucket"]
    earlier = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(
        joined.groupBy(*key).agg(F.count("*").alias("held")).withColumn("start", F.coalesce(F.sum("held").over(earlier), F.lit(0))), "starts"
    )
    ranked = joined.withColumn("place", F.row_number().over(Window.partitionBy(*key).orderBy("h", "doc_id")))
    at = F.col("start") + F.col("place")
    same = F.col("d.source").eqNullSafe(F.col("b.source")) & (F.col("d.size") == F.col("b.size")) & (F.col("d.bucket") == F.col("b.bucket"))
    each = F.floor(F.col("copies") / F.col("n"))
    return (
        ranked.alias("d")
        .join(starts.alias("b"), same)
        .withColumn("own", (each + (at <= F.col("copies") - each * F.col("n")).cast("long")).cast("long"))
        .select("doc_id", "d.size", "d.source", "source_size", "target", F.col("own").alias("copies"), (F.col("own") * F.col("d.size")).alias("taken"))
    )


def mixed(docs: DataFrame, weights: list[float] = (3, 1, 2), share: float = 1.5) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; columns unchanged. Ids must be those of one row each."""
    taken = mix(docs, weights, share).where("copies > 0").select(F.col("doc_id").alias("id_"), F.col("copies").alias("copies_"))
    rows = docs.select(F.struct("*").alias("row_"))
    joined = rows.join(taken, F.col("row_")["doc_id"].eqNullSafe(F.col("id_")))
    return joined.select("row_", F.explode(F.sequence(F.lit(1).cast("long"), "copies_"))).select("row_.*")
