"""Approximate nearest neighbours by balanced posting lists.

Largest inner product becomes smallest distance by one more component, sqrt(M^2 - |x|^2) with M the largest norm, that queries have
as 0. Centroids come from balanced k-means on a bounded sample (SAMPLE rows); every vector is then put in the list of its nearest
centroid and, if it lies near a boundary (distance ratio up to `replica_ratio`), of up to `replicas` lists. Vectors find
their lists by best-first walks in an in-memory neighbour graph of the centroids. A query is compared with all centroids, and visits at
least `least_lists` lists and all others whose distance ratio to the nearest is up to `list_ratio`, however many they are. Lists are cut into blocks of about `block_rows` vectors and meet blocks of queries, so neither a
hot list nor a hot query region is one task. Scores are double-precision inner products of the original vectors, summed in order.

Centroids number n / list_rows, MOST_LISTS at most: what is broadcast is bounded. All vectors are indexed. Vectors that are null, zero,
or hold null or non-finite components take no part, neither as queries nor as candidates; vectors of another length than the most
common one raise. Ties go to the smaller vec_id. Rows of equal id are one candidate each time they differ in score; a query's own id
is no candidate. Fewer than k candidates give fewer rows. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import materialize

SAMPLE, MOST_LISTS = 65_536, 8_192
#: (query, candidate) pairs that a search task holds before it writes them.
HELD = 1_000_000
#: Parts that a list's queries are dealt to.
PARTS = 4


def usable(v: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return v.isNotNull() & F.coalesce(F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False))


def balanced_kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """k centroids; a list's growing size adds to its distance, so that lists end alike."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    size, weight = np.full(k, len(x) / k), 0.0
    for _ in range(rounds):
        d = np.einsum("ij,ij->i", c, c)[None] - 2 * x @ c.T + weight * (size * k / len(x))[None]
        at = d.argmin(1)
        size = np.bincount(at, minlength=k).astype(float)
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        c = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], x[rng.choice(len(x), k)])
        weight = 0.1 * float(np.var(x, axis=0).sum())
    return c


class CentroidGraph:
    """Neighbour graph of the centroids, walked best-first for many vectors at once."""

    def __init__(self, centroids: np.ndarray, degree: int = 24):
        self.c = centroids.astype(np.float64)
        self.sq = np.einsum("ij,ij->i", self.c, self.c)
        k, degree = len(self.c), min(degree, len(self.c) - 1)
        near = np.zeros((k, degree), np.int64)
        for i in range(0, k, 1024):
            d = self.sq[None] - 2 * self.c[i : i + 1024] @ self.c.T
            d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
            near[i : i + 1024] = np.argsort(d, 1)[:, :degree]
        # Far links keep the graph connected: number i also leads to numbers spread over all.
        far = (np.arange(k)[:, None] + np.array([k // 2, k // 3, 1])[None]) % max(k, 1)
        self.near = np.concatenate((near, far), 1)

    def nearest_first(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid numbers, distances) of all centroids, nearest first."""
        dist = np.einsum("ij,ij->i", x, x)[:, None] + self.sq[None] - 2 * x @ self.c.T
        order = np.argsort(dist, 1, kind="stable")
        return order, np.sqrt(np.maximum(np.take_along_axis(dist, order, 1), 0))

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroid numbers, distances), nearest first, of the beam's size or all centroids."""
        n, k = len(x), len(self.c)
        beam = min(beam, k)
        xx = np.einsum("ij,ij->i", x, x)
        seen = np.zeros((n, k), bool)
        row = np.arange(n)[:, None]

        def distances(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
            return xx[rows][:, None] + self.sq[at] - 2 * np.einsum("ij,ikj->ik", x[rows], self.c[at])

        at = np.tile(np.unique(np.linspace(0, k - 1, min(k, beam)).astype(np.int64)), (n, 1))
        at = np.pad(at, ((0, 0), (0, beam - at.shape[1])), mode="edge")
        seen[row, at] = True
        dist = distances(np.arange(n), at)
        dup = np.zeros_like(at, bool)
        dup[:, 1:] = at[:, 1:] == at[:, :-1]
        dist[dup] = np.inf
        done = np.zeros((n, beam), bool)
        while True:
            open_dist = np.where(done, np.inf, dist)
            best = open_dist.argmin(1)
            live = np.flatnonzero(np.isfinite(open_dist[np.arange(n), best]))
            if not len(live):
                break
            done[live, best[live]] = True
            new = self.near[at[live, best[live]]]
            d = distances(live, new)
            d[seen[live[:, None], new]] = np.inf
            order = np.sort(new, 1)
            if (order[:, 1:] == order[:, :-1]).any():  # the same centroid by two links counts once
                first = np.argsort(new, 1, kind="stable")
                same = np.zeros_like(new, bool)
                s = np.take_along_axis(new, first, 1)
                np.put_along_axis(same, first[:, 1:], s[:, 1:] == s[:, :-1], 1)
                d[same] = np.inf
            seen[live[:, None], new] = True
            all_at = np.concatenate((at[live], new), 1)
            all_d = np.concatenate((dist[live], d), 1)
            all_done = np.concatenate((done[live], np.zeros_like(new, bool)), 1)
            pick = np.argpartition(all_d, beam - 1, 1)[:, :beam]
            at[live], dist[live], done[live] = (np.take_along_axis(a, pick, 1) for a in (all_at, all_d, all_done))
        order = np.argsort(dist, 1, kind="stable")
        return np.take_along_axis(at, order, 1), np.sqrt(np.maximum(np.take_along_axis(dist, order, 1), 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


_graphs: dict[str, CentroidGraph] = {}


def _graph(held) -> CentroidGraph:
    key, centroids = held.value
    if key not in _graphs:
        _graphs.clear()
        _graphs[key] = CentroidGraph(centroids)
    return _graphs[key]


def _lists(held, top: float, ratio: float, least: int, most: int | None, query: bool):
    """(list, id, vec) rows: one for each list of a vector, `most` if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = _graph(held)
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                x = _matrix(part.column(1))
                more = np.zeros(len(x)) if query else np.sqrt(np.maximum(top * top - np.einsum("ij,ij->i", x, x), 0))
                full = np.column_stack((x, more))
                at, dist = graph.nearest_first(full) if most is None else graph.search(full, max(32, 2 * most))
                take = np.isfinite(dist) & ((dist <= ratio * dist[:, :1]) | (np.arange(dist.shape[1]) < least)[None])
                if most is not None:
                    take[:, most:] = False
                all_rows, all_cols = np.nonzero(take)
                for j in range(0, len(all_rows), 20_000):
                    rows, cols = all_rows[j : j + 20_000], all_cols[j : j + 20_000]
                    yield pa.RecordBatch.from_arrays([pa.array(at[rows, cols], pa.int32()), part.column(0).take(pa.array(rows)), part.column(1).take(pa.array(rows))], names=["list", "id", "vec"])

    return run


def _best(q: np.ndarray, v: np.ndarray, s: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's k best candidates, each candidate once."""
    order = np.lexsort((v, -s, q))
    a, b, c = q[order], v[order], s[order]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])))
    order, a = order[new], a[new]
    start = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
    rank = np.arange(len(a)) - np.repeat(start, np.diff(np.append(start, len(a))))
    return order[rank < k]


def _inner(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row-wise inner products, components added in order, so equal vectors have equal scores."""
    total = np.zeros(len(x))
    for j in range(x.shape[1]):
        total += x[:, j] * y[:, j]
    return total


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        n = 0

        def shrink() -> tuple[np.ndarray, ...]:
            q, v, s = (np.concatenate(c) for c in zip(*held, strict=True))
            best = _best(q, v, s, k)
            return q[best], v[best], s[best]

        def rows(found: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["query_id", "vec_id", "score"])

        for batch in batches:
            for r in range(batch.num_rows):
                vec, query = batch.column(0)[r].values, batch.column(1)[r].values
                ids, x = np.asarray(vec.field(0)), _matrix(vec.field(1))
                qids, y = np.asarray(query.field(0)), _matrix(query.field(1))
                for i in range(0, len(y), 256):
                    s = y[i : i + 256] @ x.T
                    s[qids[i : i + 256, None] == ids[None]] = -np.inf
                    cut = np.partition(s, -k, 1)[:, -k] if s.shape[1] > k else np.full(len(s), -np.inf)
                    a, b = np.nonzero((s >= cut[:, None] - 1e-9 * np.abs(cut[:, None], where=np.isfinite(cut[:, None]), out=np.zeros((len(s), 1)))) & np.isfinite(s))
                    if len(a):
                        q, v, exact = qids[i + a], ids[b], _inner(y[i + a], x[b])
                        best = _best(q, v, exact, k)
                        held.append((q[best], v[best], exact[best]))
                        n += len(best)
                if n > HELD:
                    held[:] = [shrink()]
                    n = len(held[0][0])
                    if n > HELD // 2:
                        yield rows(held.pop())
                        n = 0
        if held:
            yield rows(shrink())

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding", list_rows: int = 1000, replicas: int = 4, replica_ratio: float = 1.15, list_ratio: float = 1.2, least_lists: int = 16, block_rows: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): for rows where is_query holds, the k best of all others."""
    spark = vectors.sparkSession
    all_ = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("vec"), is_query.alias("q")).filter(usable(F.col("vec")) & F.col("id").isNotNull())
    stats = all_.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("vec")).alias("lo"), F.max(F.size("vec")).alias("hi"), F.max(F.aggregate("vec", F.lit(0.0), lambda t, x: t + x * x)).alias("top")).first()
    if not stats.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if stats.lo != stats.hi:
        raise ValueError(f"vectors of {stats.lo} and of {stats.hi} components")
    top = float(stats.top) ** 0.5
    lists = max(1, min(MOST_LISTS, -(-stats.n // list_rows)))
    part = min(1.0, 1.2 * SAMPLE / stats.n)
    sample = all_.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < part * 1_000_000).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vec").toArrow().column("vec").combine_chunks()
    x = _matrix(sample)
    x = np.column_stack((x, np.sqrt(np.maximum(top * top - np.einsum("ij,ij->i", x, x), 0))))
    lists = min(lists, len(x))
    held = spark.sparkContext.broadcast((f"{id(all_)}-{stats.n}-{top}", balanced_kmeans(x, lists)))
    shape = "list int, id long, vec array<double>"
    posted = materialize(all_.select("id", "vec").mapInArrow(_lists(held, top, replica_ratio, 1, replicas, False), shape), "postings")
    asked = all_.filter("q").select("id", "vec").mapInArrow(_lists(held, top, list_ratio, least_lists, None, True), shape)
    blocks = F.broadcast(posted.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("blocks")))  # one row per list
    pack = F.collect_list(F.struct("id", "vec"))
    posted = posted.join(blocks, "list").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks"))).groupBy("list", "block").agg(pack.alias("vecs"))
    # Every block of a list meets every part of its queries as a pair of its own, so neither a hot list nor a hot region is one task.
    asked = asked.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(PARTS))).groupBy("list", "part").agg(pack.alias("queries"))
    asked = asked.join(blocks, "list").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    found = posted.join(asked.hint("shuffle_hash"), ["list", "block"]).select("vecs", "queries").mapInArrow(_search(k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


def digest(vectors: DataFrame) -> DataFrame:
    return nearest(vectors, F.pmod(F.col("vec_id"), F.lit(20)) == 0)
