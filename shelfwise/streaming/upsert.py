"""Streaming upsert of captures: each micro-batch is merged into a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import keep_last, upsert
from ..sources.catalog import read_table, replace_table


def merge_stream(stream: DataFrame, path: str, keys: list[str], order: str, checkpoint: str) -> StreamingQuery:
    """Merges what has arrived into the table at ``path`` (``read_table``), then ends.

    A replayed batch gives the same table: the last row of each key wins, empty values keep the old.
    """

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = keep_last(batch, keys, order)
        old = read_table(spark, path)
        replace_table(new if old is None else upsert(old, new, keys), path)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
