"""A circuit breaker over a log of calls."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType


def breaker(calls: DataFrame, key: str, ts: str, tie: str, failed: Column, failures: int = 2, seconds: int = 900) -> DataFrame:
    """calls with `refused`: after `failures` failures in a row a key is refused for `seconds`; a call at the very end of that is made.

    A refused call isn't made, so its outcome changes nothing. The next failure after the time refuses anew; a success clears the count.
    Null keys are one key, a null outcome is no failure, a null time comes first and is never refused. What a call meets depends on all
    before it, so a key's calls pass one task in order of time and `tie`; it holds one count and one time, not the calls.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in calls.columns])
    keyed = calls.select(F.hash(key).alias("h"), F.struct(F.col(key).cast("string").alias("k")).alias("key"), F.unix_micros(F.col(ts).cast("timestamp")).alias("at"), F.col(tie).alias("tie"), F.coalesce(failed, F.lit(False)).alias("bad"), row.alias("row"))
    ordered = keyed.repartition("h").sortWithinPartitions("key", "at", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, count, until = (), 0, None
        for batch in batches:
            refused = []
            for k, at, bad in zip(batch.column("key").to_pylist(), batch.column("at").to_pylist(), batch.column("bad").to_pylist(), strict=True):
                if k != now:
                    now, count, until = k, 0, None
                stop = until is not None and at is not None and at < until
                refused.append(stop)
                if not stop:
                    count, until = (count + 1, until) if bad else (0, None)
                    if bad and count >= failures and at is not None:
                        until = at + seconds * 1_000_000
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(refused, pa.bool_())], names=["row", "refused"])

    out = StructType([StructField("row", keyed.schema["row"].dataType), StructField("refused", BooleanType())])
    kept = [F.col(f"row.`{c}`").alias(c) for c in calls.columns if c != "refused"]
    return ordered.mapInArrow(run, out).select(*kept, "refused")
