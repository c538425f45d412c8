"""Exact nearest vectors by cosine (Y5), in blocks of matrix products."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Score differences that rounding to six places can hide, with room for the order of additions.
SLACK = 2e-6
#: Scores held at once.
CELLS = 1 << 22


def _rounded(x: np.ndarray) -> np.ndarray:
    """To six places, halves away from zero; no negative zero."""
    return np.sign(x) * np.floor(np.abs(x) * 1e6 + 0.5) / 1e6 + 0.0


def _vectors(table: pa.Table) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Ids; by dimension the rows that have a vector, and their matrix; the rows without one or with a null in it."""
    ids, lists = table.column("id").to_numpy(), table.column("e").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) and lists.num_chunks else lists
    sizes = np.array(lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False), dtype=np.int64)
    flat = lists.flatten()
    values = flat.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)
    starts = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
    if flat.null_count:
        holes = np.concatenate([[0], np.cumsum(flat.is_null().to_numpy(zero_copy_only=False))])
        sizes = np.where((sizes > 0) & (holes[starts + np.maximum(sizes, 0)] > holes[starts]), -1, sizes)
    held = {}
    for size in np.unique(sizes[sizes >= 0]):
        rows = np.flatnonzero(sizes == size)
        held[int(size)] = rows, values[starts[rows][:, None] + np.arange(size)]
    return ids, held, np.flatnonzero(sizes < 0)


def _best(qids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, keep: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, id, score) of each query's `keep` nearest others, a few queries at once; ties to the smaller id, NaN before all."""
    # Sums go from the first element to the last, so that equal vectors have equal scores wherever they stand.
    squares = [sum((m[:, j] * m[:, j] for j in range(m.shape[1])), np.zeros(len(m))) for m in (q, v)]
    with np.errstate(all="ignore"):
        unit_q, unit_v = q / np.sqrt(squares[0])[:, None], (v / np.sqrt(squares[1])[:, None]).T
    order = np.argsort(ids, kind="stable")
    lo, hi = np.searchsorted(ids[order], qids, "left"), np.searchsorted(ids[order], qids, "right")
    out, step = [], max(1, CELLS // max(1, len(ids)))
    for at in range(0, len(qids), step):
        with np.errstate(all="ignore"):
            s = unit_q[at : at + step] @ unit_v
        s[np.isnan(s)] = 2.0
        for r in range(len(s)):
            s[r, order[lo[at + r] : hi[at + r]]] = -np.inf
        least = np.partition(s, -keep, axis=1)[:, -keep] if s.shape[1] > keep else np.full(len(s), -3.0)
        rows, cols = np.nonzero(s >= np.maximum(least - SLACK, -3.0)[:, None])
        dot = np.zeros(len(rows))
        with np.errstate(all="ignore"):
            for j in range(q.shape[1]):
                dot += q[at + rows, j] * v[cols, j]
            score = _rounded(dot / np.sqrt(squares[0][at + rows] * squares[1][cols]))
        by = np.lexsort((ids[cols], -np.where(np.isnan(score), np.inf, score), rows))
        rows, cols, score = rows[by], cols[by], score[by]
        first = np.arange(len(rows)) - np.searchsorted(rows, rows, "left") < keep
        out.append((qids[at + rows[first]], ids[cols[first]], score[first]))
    return out


def block_nearest(asked: pa.Table, given: pa.Table, keep: int, schema: pa.Schema) -> pa.Table:
    """Of each query in a block its `keep` nearest rows in another; without a score, which comes last, if a vector lacks or has another dimension."""
    qids, queries, bad = _vectors(asked)
    ids, held, _ = _vectors(given)
    parts = [p for size, (rows, q) in queries.items() if size in held for p in _best(qids[rows], q, ids[held[size][0]], held[size][1], keep)]
    for size, rows in [*((s, r) for s, (r, _) in queries.items()), (-1, bad)]:
        fits = np.zeros(len(ids), dtype=bool)
        if size in held:
            fits[held[size][0]] = True
        # One more than kept, as one may be the query's own; more if ids stand several times.
        others = np.sort(ids[~fits])
        for r in rows if len(others) else []:
            mine = others[others != qids[r]][:keep]
            parts.append((np.full(len(mine), qids[r]), mine, None))
    columns = [pa.concat_arrays([pa.array(p[i], type=schema.types[i]) for p in parts] or [pa.array([], type=schema.types[i])]) for i in (0, 1)]
    scores = pa.concat_arrays([pa.nulls(len(p[0]), pa.float64()) if p[2] is None else pa.array(p[2], type=pa.float64()) for p in parts] or [pa.array([], type=pa.float64())])
    return pa.Table.from_arrays([*columns, scores], schema=schema)


def cosine(queries: DataFrame, vectors: DataFrame, keep: int = 5, query_rows: int = 8192, rows: int = 16384) -> DataFrame:
    """(qid, vec_id, score, place): of each query its `keep` nearest vectors with another id, to six places; ties to the smaller id.

    Both have id (long) and e (array of numbers); null ids take no part. Every query is compared with every vector: the work grows with the
    product of both. Parts of the queries meet blocks of the vectors, a task holds one of each, and a block passes on its `keep` best.
    """
    left, right = queries.filter("id is not null"), vectors.filter("id is not null")
    parts, blocks = -(-left.count() // query_rows) or 1, -(-right.count() // rows) or 1
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    dealt = left.select("id", "e", F.pmod(F.xxhash64("id"), F.lit(parts)).alias("part"), every(blocks).alias("block"))
    held = right.select("id", "e", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), every(parts).alias("part"))
    schema = pa.schema([("qid", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(asked: pa.Table, given: pa.Table) -> pa.Table:
        return block_nearest(asked, given, keep, schema)

    scored = dealt.groupBy("part", "block").cogroup(held.groupBy("part", "block")).applyInArrow(run, "qid long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("place", place).filter(F.col("place") <= keep).select("qid", "vec_id", "score", F.col("place").cast("long").alias("place"))
