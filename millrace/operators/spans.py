"""Spans inside blocks of text: facts and inventory items that belong together, and legends of markers.

Spans are code point offsets, the end exclusive. Everything is joined or sorted by document and block, whose rows a text bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.normal import normal_text


def link_items(evidence: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, fact_id, item_id), each once: items of a block that a fact's evidence names, if their spans overlap or one text holds the other.

    `evidence` has doc_id, fact_id, block_id, a, b, text (the fact's value; a and b may be null), `items` has doc_id, item_id, block_id, a, b, text.
    Texts are compared in normal form; empty ones hold nothing and are held by nothing.
    """
    left = evidence.select("doc_id", "block_id", "fact_id", F.col("a").alias("fa"), F.col("b").alias("fb"), normal_text(F.col("text")).alias("ft"))
    right = items.select("doc_id", "block_id", "item_id", "a", "b", normal_text(F.col("text")).alias("t"))
    overlap = (F.col("a") < F.col("fb")) & (F.col("fa") < F.col("b"))
    held = (F.col("t") != "") & (F.col("ft") != "") & (F.contains("ft", "t") | F.contains("t", "ft"))
    met = left.join(right, ["doc_id", "block_id"]).filter(F.coalesce(overlap, F.lit(False)) | held)
    return met.select("doc_id", "fact_id", "item_id").distinct()


def uncovered(spans: DataFrame, covers: DataFrame, *keys: str) -> DataFrame:
    """The spans (keys, a, b and other columns) that no cover (keys, a, b) of the same keys contains.

    In order of their starts, the furthest end of the covers so far tells it: no pairs of spans arise.
    """
    both = spans.select(*keys, "a", "b", F.struct("*").alias("row")).unionByName(covers.select(*keys, "a", "b", F.lit(None).alias("row")), allowMissingColumns=True)
    # Covers of the same start come first, so that they count.
    order = Window.partitionBy(*keys).orderBy("a", F.col("row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    furthest = F.max(F.when(F.col("row").isNull(), F.col("b"))).over(order)
    marked = both.withColumn("far", furthest).filter(F.col("row").isNotNull() & (F.col("far").isNull() | (F.col("far") < F.col("b"))))
    return marked.select("row.*")


def nearest_legend(uses: DataFrame, legends: DataFrame, at: str = "ord", legend: str = "legend", keys: tuple[str, ...] = ("doc_id", "marker")) -> DataFrame:
    """uses with the legend of the same keys that is nearest, one at or after the use before any earlier one.

    Of legends at one place the smallest counts. Uses without a legend have none and are dropped. Both sides are sorted once.
    """
    held = F.struct("*").alias("row")
    marks = legends.groupBy(*keys, at).agg(F.min(legend).alias("found"))
    both = uses.select(*keys, at, held).unionByName(marks, allowMissingColumns=True)
    order = Window.partitionBy(*keys).orderBy(at, F.col("found").isNotNull())
    after = F.first("found", ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
    before = F.last("found", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("chosen", F.coalesce(after, before)).filter(F.col("row").isNotNull() & F.col("chosen").isNotNull())
    return found.select("row.*", F.col("chosen").alias(legend))
