"""Resumable runs: rows not yet done are processed in micro-batches and appended; the last row of an id says whether it is done."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def done_ids(log: DataFrame, key: str = "document_id", order: str = "seq", method: str | None = None) -> DataFrame:
    """Ids whose last row has the method asked for and no transient (fetch) error."""
    last = log.groupBy(key).agg(F.max_by(F.struct("method", "error"), order).alias("last"))
    ok = ~F.coalesce(F.col("last.error").startswith("fetch:"), F.lit(False))
    return last.filter(ok if method is None else ok & (F.col("last.method") == method)).select(key)


def todo(items: DataFrame, log: DataFrame, key: str = "document_id", **options) -> DataFrame:
    return items.join(done_ids(log, key, **options), key, "left_anti")


def run_stream(items: DataFrame, read_log: Callable[[], DataFrame | None], work: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, key: str = "document_id") -> StreamingQuery:
    """Work through a stream of items once; what an earlier run has done is left out of each micro-batch."""

    def step(batch: DataFrame, number: int) -> None:
        log = read_log()
        left = batch if log is None else todo(batch, log, key)
        work(left).write.mode("append").parquet(sink)

    return items.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
