"""Keeping a table at the latest version per key while snapshots stream in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from hindsight.sources.merging import MergeTable


def stream_upsert(
    stream: DataFrame,
    table: MergeTable,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    compact: bool = True,
) -> StreamingQuery:
    """Upsert each micro-batch, newest row per key, into ``table``; then stop.

    A batch writes its own rows only. Late and repeated snapshots are settled by
    the table's order: a row older than the stored one loses. The commit of a
    batch carries its number under the checkpoint's name, so that a replayed
    batch is found to be there already.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        table.append(prepare(batch), (checkpoint, batch_id))
        if compact:
            table.compact()

    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
