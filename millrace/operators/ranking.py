"""Texts for many queries at once: BM25 (O8, Y4), and those that hold a query's words."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import search_tokens
from millrace.operators.dealing import parts as parts_of

#: Distinct words of queries, summed over queries, up to which they are broadcast: about 30 MB.
BROADCAST_TERMS = 500_000


def bm25(docs: DataFrame, queries: DataFrame, doc: str = "doc_id", query: str = "item_id", text: str = "text", keep: int = 10, k1: float = 1.5, b: float = 0.75, eps: float = 0.25) -> DataFrame:
    """(query, doc, score, place): the `keep` best texts of each query with a score above 0, to nine places, ties to the smaller id.

    A word of a query counts as often as it stands there. Words in over half of the texts have a negative weight, which becomes `eps`
    times the mean weight of all words. Null and empty texts count as one word that no query has; rows that share an id are one text.
    Only words of queries are kept after counting, and each text's counts of them are added up before queries meet.
    """
    # Texts are dealt by id once, to parts in proportion to their size; words are counted and lengths added up where they then are.
    texts = docs.select(F.col(doc).alias("d"), F.col(text).alias("t")).repartition(parts_of(docs), "d").select("d", search_tokens(F.col("t")).alias("ws"))
    words = texts.select("d", F.explode(F.when(F.size("ws") > 0, F.col("ws")).otherwise(F.array(F.lit("_")))).alias("w"))
    counts = words.groupBy("d", "w").agg(F.count(F.lit(1)).alias("f")).withColumn("len", F.sum("f").over(Window.partitionBy("d")))
    lengths = words.groupBy("d").agg(F.count(F.lit(1)).alias("len"))
    whole = lengths.agg(F.count(F.lit(1)).alias("docs"), F.avg("len").alias("mean_len"))
    known = counts.groupBy("w").agg(F.count(F.lit(1)).alias("k")).join(F.broadcast(whole)).withColumn("idf", F.log(F.col("docs") - F.col("k") + 0.5) - F.log(F.col("k") + 0.5))
    mean = known.agg(F.avg("idf").alias("mean_idf"))  # one row
    asked = queries.select(F.col(query).alias("q"), F.explode(search_tokens(F.col(text))).alias("w")).groupBy("q", "w").agg(F.count(F.lit(1)).alias("times"))
    idf = F.when(F.col("idf") < 0, F.lit(eps) * F.col("mean_idf")).otherwise(F.col("idf"))
    terms = known.join(asked.groupBy("w").agg(F.count(F.lit(1)).alias("_")), "w", "left_semi").join(F.broadcast(mean)).select("w", "mean_len", idf.alias("idf")).join(asked, "w")
    # Few terms go to the texts, whose words then stay where they are; many meet them by word.
    terms = F.broadcast(terms) if asked.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS else terms
    weight = F.col("idf") * F.col("f") * (k1 + 1) / (F.col("f") + k1 * (1 - b + b * F.col("len") / F.col("mean_len")))
    parts = counts.join(terms, "w").select("q", "d", (weight * F.col("times")).alias("part"))
    scores = parts.groupBy("q", "d").agg(F.round(F.sum("part"), 9).alias("score")).filter(F.col("score") > 0)
    # The ties and the order are decided on the rounded score; a first choice per task keeps a query's rows few before they meet.
    dealt = scores.withColumn("deal", F.pmod(F.xxhash64("d"), F.lit(64)))
    some = dealt.withColumn("r", F.row_number().over(Window.partitionBy("q", "deal").orderBy(F.desc("score"), "d"))).filter(F.col("r") <= keep)
    best = some.withColumn("place", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "d"))).filter(F.col("place") <= keep)
    return best.select(F.col("q").alias(query), F.col("d").alias(doc), "score", F.col("place").cast("long").alias("place"))


def holding(docs: DataFrame, queries: DataFrame, doc: str = "doc_id", query: str = "item_id", text: str = "text") -> DataFrame:
    """(query, doc, hit, n): the texts that hold four fifths or more of a query's n distinct words.

    Rows that share an id are one text. Each text's distinct words are dealt by id once; hits are counted and judged where they then are.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    keys = queries.filter(F.col(query).isNotNull()).select(F.col(query).alias("q"), F.explode(words).alias("w")).distinct()
    keys = keys.join(keys.groupBy("q").agg(F.count(F.lit(1)).alias("n")), "q")
    asked = keys.select("w").distinct()
    if keys.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS:
        keys, asked = F.broadcast(keys), F.broadcast(asked)
    held = docs.select(F.col(doc).alias("d"), words.alias("ws")).repartition(parts_of(docs), "d").select("d", F.explode("ws").alias("w"))
    met = held.join(asked, "w", "left_semi").select("d", "w").distinct().join(keys, "w")
    hits = met.groupBy("d", "q").agg(F.count(F.lit(1)).alias("hit"), F.first("n").alias("n")).filter("5 * hit >= 4 * n")
    return hits.select(F.col("q").alias(query), F.col("d").alias(doc), "hit", "n")
