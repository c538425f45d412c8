"""Ancestors of entities over their parents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ancestors(edges: DataFrame, most: int = 6) -> DataFrame:
    """(child, ancestor, depth) of every path of `most` steps or fewer up from a child.

    `edges` has child and parent, texts; a row is a link. The paths are first followed from children that are parents themselves, which are
    few, one join for each step: a row whose path ends where the step stands passes on itself and its continuations. Then each link meets
    the paths from its parent. Loops end at `most`; no row limit of a recursive query applies.
    """
    parents = edges.select(F.col("parent").alias("child")).distinct()
    inner = edges.join(parents, "child", "left_semi")
    above = inner.groupBy(F.col("child").alias("at")).agg(F.collect_list(F.struct("parent")).alias("next"))
    paths = inner.select("child", F.col("parent").alias("ancestor"), F.lit(1).alias("depth"))
    for depth in range(1, most - 1):
        more = F.transform(F.coalesce("next", F.array().cast("array<struct<parent:string>>")), lambda x: F.struct(x["parent"].alias("ancestor"), F.lit(depth + 1).alias("depth")))  # noqa: B023
        met = paths.join(above, (F.col("ancestor") == F.col("at")) & (F.col("depth") == depth), "left")
        paths = met.select("child", F.explode(F.concat(F.array(F.struct("ancestor", "depth")), more)).alias("p")).select("child", "p.ancestor", "p.depth")
    direct = edges.select("child", F.col("parent").alias("ancestor"), F.lit(1).alias("depth"))
    if most < 2:
        return direct
    further = edges.join(paths.withColumnRenamed("child", "at"), F.col("parent") == F.col("at")).select("child", "ancestor", (F.col("depth") + 1).alias("depth"))
    return direct.unionByName(further)
