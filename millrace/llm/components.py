"""Connected components of an edge table by alternating large-star and small-star steps.

Both steps are joins and aggregations of (a, b) rows; nothing is collected. Chains shrink by half or better in each round, and
stars, which near-duplicate groups are after a pass against group leaders, are done in one. A node with very many neighbours is
merged on the map side where it is aggregated, and its join partition can be split.

Nulls take no part; equal edges count once; an empty table gives an empty result. Nodes may be of any type with an order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of edges (a, b); component is the smallest node reachable."""
    now = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialize(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        was, state = state, _state(now)
        if state == was:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.coalesce(F.sum(F.xxhash64("b").cast("decimal(20,0)")).cast("string"), F.lit(""))).first())
