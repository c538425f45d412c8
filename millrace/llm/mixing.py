"""Mixing sources to target weights.

Each row gets a hash-random key; within its source, rows are ranged by that key into buckets and ordered, and distributed
prefix sums of token counts (a running sum inside each bucket plus the sum of the buckets before it) say where the source's
budget is reached. The budget is the target rounded to a whole word. Whole epochs come first; the last, partial epoch ends at
exactly that word, so one row of a source at most is taken in part: its last copy holds the words up to there.

All of it is DataFrame expressions. A source with any share of the rows is spread over its buckets, so no task holds a source.
Only one row per source and one per (source, bucket) pass through a single window, of a size set by the number of buckets.
Null texts and texts without words have size 0 and take 0; a null source is a source of its own, in the last place. An empty
table gives an empty result. Equal rows are ordered arbitrarily among themselves, which changes no result; rows that share id,
source and size are told apart by their text's hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import carried, materialize, unpacked

#: Fixed cycle of source weights.
WEIGHTS = (5, 2, 1)


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, as it is written."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++"), F.lit(0)), F.lit(1), n), "")


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """From (source, source_size), one row per source with its target.

    Sharing a total by weight, with caps and their excess shared again until none is above, ends at min(cap, level x weight)
    for one level; the sources that reach their cap are the first in the order of cap / weight.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").cast("binary").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levels = ranked.withColumn("level", level).withColumn("free", F.col("cap") > F.col("level") * F.col("weight"))
    # The first source in this order that stays below its cap fixes the level for all after it.
    fixed = F.min(F.when(F.col("free"), F.struct((F.col("cap") / F.col("weight")).alias("o"), F.col("rank"), F.col("level")))).over(everything)
    return levels.withColumn("fixed", fixed["level"]).select("source", "source_size", F.when(F.col("fixed").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("fixed") * F.col("weight"))).alias("target"))


def plan(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", size: str = "size", seed: str = "mix", share: float = 1.5, most: float = 2.0, bucket_rows: int = 5_000) -> DataFrame:
    """Adds source_size, target, epochs (whole copies that the mix takes) and cut (words of one more copy) to rows with an id, a source and a size."""
    keyed = docs.withColumn("mix_key", F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary")))
    stats = keyed.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    goal = targets(stats.select("source", "source_size"), share, most).withColumnsRenamed({"source": "t_source", "source_size": "t_size", "target": "t_target"})
    stats = stats.join(goal, F.col("source").eqNullSafe(F.col("t_source"))).select(F.col("source").alias("s_source"), "source_size", F.col("t_target").alias("target"), F.ceil(F.col("source_rows") / bucket_rows).alias("buckets"))
    # 28 bits of the key, spread evenly over the source's buckets, keep the order of the key.
    at = F.conv(F.substring("mix_key", 1, 7), 16, 10).cast("long")
    rows = keyed.join(stats, F.col(source).eqNullSafe(F.col("s_source"))).withColumn("mix_bucket", F.floor(at * F.col("buckets") / F.lit(float(1 << 28))))
    inside = Window.partitionBy("s_source", "mix_bucket").orderBy("mix_key", doc_id, size).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = rows.groupBy("s_source", "mix_bucket").agg(F.sum(size).alias("bucket_size"))
    ahead = Window.partitionBy("s_source").orderBy("mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("s_source").alias("b_source"), F.col("mix_bucket").alias("b_bucket"), F.coalesce(F.sum("bucket_size").over(ahead), F.lit(0)).alias("ahead"))
    rows = rows.withColumn("until", F.sum(size).over(inside)).join(sums, F.col("s_source").eqNullSafe(F.col("b_source")) & (F.col("mix_bucket") == F.col("b_bucket")))
    budget = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    # Words of the row that the partial epoch reaches.
    part = F.greatest(F.lit(0), F.least(F.col(size), budget - F.col("whole") * F.col("source_size") - F.col("ahead") - F.col("until") + F.col(size))).cast("long")
    rows = rows.withColumn("whole", whole.cast("int")).withColumn("part", part)
    full = F.col("part") == F.col(size)
    epochs = F.when(F.col(size) > 0, F.col("whole") + full.cast("int")).otherwise(0)
    return rows.select(*docs.columns, "source_size", "target", epochs.alias("epochs"), F.when(full, F.lit(0).cast("long")).otherwise(F.col("part")).alias("cut"))


def digest(docs: DataFrame) -> DataFrame:
    sized = materialize(docs.select("doc_id", "source", words_of(F.col("text")).alias("size")), "mix-sizes")
    return plan(sized).select("doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("cut")).cast("long").alias("taken"))


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The mixed rows with the columns of docs, each as often as it is taken; a source's last row has the words up to its budget."""
    own = {"doc_id": F.col(doc_id), "source": F.col(source), "size": words_of(F.col(text))}
    # One text as key: window and join then agree on where a row lies, and rows travel once.
    key_of = lambda **part: F.coalesce(F.to_json(F.struct(*[c.alias(n) for n, c in part.items()])), F.lit(""))
    sized = carried(docs, key=key_of(**own), hash=F.xxhash64(F.col(text)))
    narrow = materialize(docs.select(*[c.alias(n) for n, c in own.items()]), "mix-sizes")
    # Rows of one key differ by a copy at most: `more` of them take it whole, and the next one `cut` words of it.
    low = F.min("epochs")
    chosen = plan(narrow, **options).groupBy(key_of(**{n: F.col(n) for n in own}).alias("chosen")).agg(low.alias("low"), (F.sum("epochs") - low * F.count(F.lit(1))).alias("more"), F.max("cut").alias("words"))
    order = F.row_number().over(Window.partitionBy("key").orderBy("hash"))
    rows = sized.withColumn("nth", order).join(chosen, F.col("key") == F.col("chosen"))
    whole = F.col("low") + (F.col("nth") <= F.col("more")).cast("int")
    cut = F.when(F.col("nth") == F.col("more") + 1, F.col("words")).otherwise(F.lit(0))
    rows = rows.select("row", whole.alias("whole"), cut.alias("cut")).filter("whole > 0 or cut > 0")
    rows = rows.select("row", "whole", "cut", F.explode(F.sequence(F.lit(1), F.col("whole") + (F.col("cut") > 0).cast("int"))).alias("copy"))
    old = F.col(f"row.`{text}`")
    return rows.select(*unpacked(docs.columns, **{text: F.when(F.col("copy") > F.col("whole"), first_words(old, F.col("cut").cast("int"))).otherwise(old)}))
