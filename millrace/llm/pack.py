"""Token-ID / binary output: best-fit-decreasing packing.

Texts become token ids, each text closed by `end_id`. Documents longer than `length` are split without loss into pieces. Pieces are
gathered into packing groups of about `group_tokens` tokens; inside one, in decreasing size, each goes into the fullest sequence it
fits, found by a segment tree over remaining capacities. Every row out is one packed sequence: ids as little-endian binary, the
cumulative lengths of its segments (position ids restart at each), and which piece of which document each segment is.

Groups are formed inside a task from rows in input order, so a task repeated after a loss gives the same rows. A null or empty text
is its end token only. Documents of equal id are packed each. `unpack` gives every document's ids back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bpe import merger
from millrace.llm.common import give_back
from millrace.llm.token_count import slices

SCHEMA = "pack_id long, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, doc_ids array<long>, doc_rows array<long>, pieces array<int>"
_ARROW = pa.schema([("pack_id", pa.int64()), ("n_tokens", pa.int32()), ("ids", pa.binary()), ("cu_seqlens", pa.list_(pa.int32())), ("position_resets", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())), ("doc_rows", pa.list_(pa.int64())), ("pieces", pa.list_(pa.int32()))])


class CapacityTree:
    """Segment tree over remaining capacities 0..most: finds the smallest one that is open and at least a size."""

    def __init__(self, most: int):
        self.width = 1 << most.bit_length()
        self.open = [0] * (2 * self.width)
        self.bins: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, capacity: int, number: int) -> None:
        self.bins[capacity].append(number)
        self._count(capacity, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """(capacity, bin) of the best fit, removed; None if nothing fits."""
        at = size + self.width
        if not self.open[at]:
            while at > 1 and (at & 1 or not self.open[at + 1]):  # up until a subtree to the right is open
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.width:
                at = 2 * at + (not self.open[2 * at])
        capacity = at - self.width
        self._count(capacity, -1)
        return capacity, self.bins[capacity].pop()

    def _count(self, capacity: int, by: int) -> None:
        at = capacity + self.width
        while at:
            self.open[at] += by
            at >>= 1


def best_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Numbers of the pieces in each sequence; each size is 1 to length."""
    tree, bins = CapacityTree(length), []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        found = tree.take(size)
        if found is None:
            bins.append([i])
            capacity, number = length, len(bins) - 1
        else:
            capacity, number = found
            bins[number].append(i)
        if capacity > size:
            tree.put(capacity - size, number)
    return bins


def pack(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", length: int = 2048, end_id: int = 50_256, group_tokens: int = 4_000_000) -> DataFrame:
    """One row per packed sequence (SCHEMA). ids are uint16 if the vocabulary allows, else uint32."""
    if length < 1:
        raise ValueError("length must be at least 1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, task = merger(path), TaskContext.get().partitionId()
        kind = "<u2" if max(m.size, end_id + 1, *(v + 1 for v in m.special.values())) <= 1 << 16 else "<u4"
        held: list[tuple[int | None, int, int, np.ndarray]] = []
        n = made = row = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal made
            bins = best_fit(np.array([len(p[3]) for p in held], np.int64), length)
            for k in range(0, len(bins), 512):
                cols: list[list] = [[] for _ in _ARROW]
                for b in bins[k : k + 512]:
                    parts = [held[i] for i in b]
                    ends = np.cumsum([0, *(len(p[3]) for p in parts)]).tolist()
                    values = ((task << 36) + made, ends[-1], np.concatenate([p[3] for p in parts]).astype(kind).tobytes(), ends, ends[:-1], [p[0] for p in parts], [p[1] for p in parts], [p[2] for p in parts])
                    for c, v in zip(cols, values, strict=True):
                        c.append(v)
                    made += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW, strict=True)], schema=_ARROW)
            held.clear()

        for batch in batches:
            ids_of, at = batch.column(0).to_pylist(), 0
            for part in slices(batch.column(1).to_pylist()):
                ids, counts = m.encode(part)
                begin = 0
                for count in counts.tolist():
                    own = np.append(ids[begin : begin + count], np.int32(end_id))
                    begin += count
                    for piece, k in enumerate(range(0, len(own), length)):
                        held.append((ids_of[at], (task << 36) + row, piece, own[k : k + length]))
                    n += len(own)
                    at += 1
                    row += 1
                    if n >= group_tokens:
                        yield from flush()
                        n = 0
        if held:
            yield from flush()
        m.rest()
        give_back()

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(run, SCHEMA)


def unpack(packed: DataFrame, kind: str = "<u2") -> DataFrame:
    """(doc_id, doc_row, ids array<int>): each document's tokens with its end token, put together from its pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], [], []]
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], kind).astype(np.int32)
                for i, (d, w, p) in enumerate(zip(r["doc_ids"], r["doc_rows"], r["pieces"], strict=True)):
                    for c, v in zip(rows, (d, w, p, ids[r["cu_seqlens"][i] : r["cu_seqlens"][i + 1]].tolist()), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32())), strict=True)], names=["doc_id", "doc_row", "piece", "ids"])

    pieces = packed.mapInArrow(run, "doc_id long, doc_row long, piece int, ids array<int>")
    whole = pieces.groupBy("doc_row", "doc_id").agg(F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("p"))
    return whole.select("doc_id", "doc_row", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"))
