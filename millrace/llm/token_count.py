"""Token counts of whole texts by rank-synchronous array merging (see `bpe`).

A null text counts as empty: 0 bytes, 0 tokens. Rows keep nothing but what is asked for; repeated rows are each answered. The
tokenizer's file must lie at the same path on every executor (a package or an image), and is read once per worker.
Texts are taken in slices of SLICE characters' worth of rows, so a worker's arrays stay small whatever the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bpe import merger
from millrace.llm.common import give_back

SLICE = 2_000_000


def slices(texts: list[str | None]) -> Iterator[list[str | None]]:
    held, n = [], 0
    for t in texts:
        held.append(t)
        n += len(t or "")
        if n >= SLICE:
            yield held
            held, n = [], 0
    if held:
        yield held


def count_tokens(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merger(path)
        for batch in batches:
            parts = [m.count(part) for part in slices(batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(parts) if parts else [], pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])
        m.rest()
        give_back()

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), F.col(text).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")


def digest(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    return count_tokens(docs, path).withColumn("over_limit", F.col("n_tokens") > limit)
