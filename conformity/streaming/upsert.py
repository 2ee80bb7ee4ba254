"""Streams into combined tables: each micro-batch is merged like a batch run."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.conform import conform
from ..sources.store import Store
from ..sources.tables import upsert


def upsert_stream(source: DataFrame, columns: dict[str, dict[str, Any]], path: str, keys: list[str], order_by: str, checkpoint: str, **options: Any) -> StreamingQuery:
    """Conform a stream and merge it into the keyed table at ``path``; a batch rewrites the buckets of its keys.

    Of the rows of a batch that share a key the last by ``order_by`` counts. A batch that runs again after
    a failure merges the same rows again, which changes nothing. ``vacuum_after``: versions that stay when a
    batch is done (all if it is not given).
    """

    def merge(batch: DataFrame, number: int) -> None:
        rest = [F.col(f"`{c}`").asc_nulls_last() for c in batch.columns]
        last = Window.partitionBy(*keys).orderBy(F.col(order_by).desc_nulls_last(), *rest)
        latest = batch.withColumn("__rank", F.row_number().over(last)).where("__rank = 1").drop("__rank")
        latest.persist()  # the merge reads it twice
        try:
            upsert(batch.sparkSession, latest, path, keys)
        finally:
            latest.unpersist()
        if options.get("vacuum_after"):
            Store(batch.sparkSession, path).vacuum(options["vacuum_after"])

    writer = conform(source, columns).writeStream.outputMode("append").foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if options.get("once", True) else writer).start()
