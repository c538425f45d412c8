"""Places of rows in an order, without a task that holds all of them (O1, O2, O3).

The order is cut at up to 255 keys of a sample of 4,096 rows, taken by hash; where the cuts fall changes how the work is dealt, not the
result. Each range numbers its own rows, and the at most 256 ranges' sizes give their offsets. Nulls come first. Rows equal in all keys
get following places in any order and share a range, so keys should end in an id. Empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGES, PER_RANGE = 256, 16


def _ranged(held: DataFrame) -> DataFrame:
    """held, whose key is k, with the range of its key."""
    sample = held.select("k").orderBy(F.xxhash64("k"), "k").limit(RANGES * PER_RANGE)
    cuts = sample.agg(F.filter(F.array_sort(F.collect_list("k")), lambda x, i: i % PER_RANGE == PER_RANGE - 1).alias("cuts"))
    cuts = cuts.select(F.slice("cuts", 1, RANGES - 1).alias("cuts"))
    # Binary search: how many cuts lie before the key.
    steps = F.array(*[F.lit(RANGES >> i) for i in range(1, RANGES.bit_length())])
    before = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get("cuts", at + step - 1) < F.col("k"), at + step).otherwise(at))
    return held.join(F.broadcast(cuts)).select(*held.columns, before.alias("range"))  # one row


def numbered(rows: DataFrame, *keys: Column, name: str = "place", within: Column | None = None) -> DataFrame:
    """rows with `name`, a long: the place by the keys, from 1, in all or among the rows that share `within` (null is a value of its own).

    A column of rows called `name` is replaced.
    """
    first = F.struct((F.lit(0) if within is None else within).alias("g"))
    held = rows.select(F.struct("*").alias("row"), F.struct(first.alias("g"), *[c.alias(f"k{i}") for i, c in enumerate(keys)]).alias("k"))
    ranged = _ranged(held)
    sizes = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select(F.col("range").alias("r"), (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("offset"))
    own = F.row_number().over(Window.partitionBy("range").orderBy("k"))
    placed = ranged.withColumn("own", own).join(F.broadcast(offsets), F.col("range") == F.col("r")).select("row", "k", (F.col("offset") + F.col("own")).alias("at"))
    if within is not None:
        starts = ranged.groupBy(F.col("k.g").alias("group")).agg(F.count(F.lit(1)).alias("n"))
        starts = numbered_sums(starts)
        placed = placed.join(starts, F.col("k.g").eqNullSafe(F.col("group"))).withColumn("at", F.col("at") - F.col("before"))
    kept = [F.col(f"row.`{c}`").alias(c) for c in rows.columns if c != name]
    return placed.select(*kept, F.col("at").cast("long").alias(name))


def numbered_sums(groups: DataFrame) -> DataFrame:
    """(group, n) to (group, before): the sum of n of the groups that come before, by ranges of groups."""
    ranged = _ranged(groups.withColumn("k", F.col("group")))
    sizes = ranged.groupBy("range").agg(F.sum("n").alias("all"))
    offsets = sizes.select(F.col("range").alias("r"), (F.sum("all").over(Window.orderBy("range")) - F.col("all")).alias("offset"))
    own = F.sum("n").over(Window.partitionBy("range").orderBy("k").rowsBetween(Window.unboundedPreceding, -1))
    return ranged.withColumn("own", F.coalesce(own, F.lit(0))).join(F.broadcast(offsets), F.col("range") == F.col("r")).select("group", (F.col("offset") + F.col("own")).alias("before"))


def interleave(rows: DataFrame, group: str, key: str, seed: Column | None = None) -> DataFrame:
    """(key, group, place): groups in turn, rows of a group by `seed`, or by the hash of their key (O2)."""
    by = F.md5(F.col(key).cast("string")) if seed is None else seed
    turns = numbered(rows.select(key, group), by, F.col(key), name="_turn", within=F.col(group))
    return numbered(turns, F.col("_turn"), F.col(group), F.col(key)).select(key, group, "place")


def budget_order(rows: DataFrame, group: str, key: str, size: str, head: float = 0.25) -> DataFrame:
    """(key, part, place): a share of each group first, one row at least and halves to even; then the rest, smallest first (O3)."""
    counted = rows.select(key, F.col(group).alias("_group"), F.col(size).alias("_size"))
    n = counted.groupBy(F.col("_group").alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
    turns = numbered(counted, F.md5(F.col(key).cast("string")), F.col(key), name="_turn", within=F.col("_group"))
    marked = turns.join(n, F.col("_group").eqNullSafe(F.col("_g")))
    first = F.col("_turn") <= F.greatest(F.lit(1.0), F.bround(F.col("_n") * F.lit(head)))
    marked = marked.select(key, F.when(first, "head").otherwise("tail").alias("part"), F.when(first, F.col("_turn")).otherwise(F.col("_size")).alias("_by"))
    return numbered(marked, F.col("part"), F.col("_by"), F.col(key)).select(key, "part", "place")
