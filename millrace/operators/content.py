"""Main content of web pages: site templates learnt from repetition, subtracted from the visible lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import host, locale
from millrace.operators.dealing import parts
from millrace.sources.html import visible_lines


def site_lines(pages: DataFrame) -> DataFrame:
    """(page_id, host, loc, ln, line, link_share, tag)."""
    keyed = pages.select(F.struct("page_id", host(F.col("url")).alias("host"), locale(F.col("url")).alias("loc")).alias("page"), "html")
    return visible_lines(keyed, "page").select("page.*", "ln", "line", "link_share", "tag")


def templates(lines: DataFrame, pages: DataFrame, keys: tuple[str, ...] = ("host",), least_pages: int = 5, share: float = 0.3) -> DataFrame:
    """(keys, line) of lines on at least `share` of the pages of a group with `least_pages` or more."""
    sizes = pages.select("page_id", host(F.col("url")).alias("host"), locale(F.col("url")).alias("loc")).groupBy(*keys).agg(F.countDistinct("page_id").alias("n")).filter(F.col("n") >= least_pages)
    return lines.groupBy(*keys, "line").agg(F.countDistinct("page_id").alias("k")).join(sizes, list(keys)).filter(F.col("k") >= F.greatest(F.lit(2.0), F.col("n") * share)).select(*keys, "line")


def main_content(pages: DataFrame) -> DataFrame:
    """(page_id, content, n_lines): lines that are in no template of the page's locale, or of its host where the locale has few pages.

    Pages are counted once by host, locale and line; the host's counts are sums of its locales'. A page of template lines only has
    empty content.
    """
    lines = site_lines(pages)
    where = pages.select("page_id", host(F.col("url")).alias("host"), locale(F.col("url")).alias("loc")).distinct()
    sizes = where.groupBy("host", "loc").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumn("all_n", F.sum("n").over(Window.partitionBy("host")))
    counts = lines.groupBy("host", "loc", "line").agg(F.countDistinct("page_id").alias("k"))
    # A line of the host counts in each of its locales with few pages, also where it doesn't stand; those can't lose it.
    counts = counts.withColumn("all_k", F.sum("k").over(Window.partitionBy("host", "line"))).join(sizes, ["host", "loc"])
    often = lambda k, n: (F.col(n) >= 4) & (F.col(k) >= F.greatest(F.lit(2.0), F.col(n) * 0.3))
    every = counts.filter(F.when(F.col("n") >= 4, often("k", "n")).otherwise(often("all_k", "all_n"))).select("host", "loc", "line")
    kept = lines.join(every, ["host", "loc", "line"], "left_anti")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ln", "line"))), lambda x: x["line"]), "\n")
    found = kept.groupBy("page_id").agg(text.alias("content"), F.count(F.lit(1)).alias("n_lines"))
    found = where.select(F.col("page_id").alias("id")).distinct().join(found, F.col("id").eqNullSafe(F.col("page_id")), "left")
    return found.select(F.col("id").alias("page_id"), F.coalesce("content", F.lit("")).alias("content"), F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"))


def trim_to_prose(lines: DataFrame) -> DataFrame:
    """Lines without link lines before the first prose line, or after the last where prose prevails."""
    page = Window.partitionBy("page_id")
    n = F.size(F.regexp_extract_all(F.lower("line"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    prose = (n >= 12) & (F.col("link_share") < 0.5)
    marked = lines.withColumns({"n": n, "first": F.min(F.when(prose, F.col("ln"))).over(page), "last": F.max(F.when(prose, F.col("ln"))).over(page)})
    marked = marked.withColumns({"prose_n": F.sum(F.when(prose, F.col("n")).otherwise(0)).over(page), "link_n": F.sum(F.when(F.col("link_share") >= 0.5, F.col("n")).otherwise(0)).over(page), "all_n": F.sum("n").over(page)})
    link = F.col("link_share") >= 0.5
    drop = (link & (F.col("ln") < F.col("first"))) | (link & (F.col("ln") > F.col("last")) & (F.col("prose_n") >= 200) & (F.col("link_n") < 0.3 * F.col("all_n")))
    return marked.filter(~F.coalesce(drop, F.lit(False))).select(*lines.columns)


def run_free_prf(docs: DataFrame) -> DataFrame:
    """(doc_id, prec, rec, f1): a text's words against those of its lines without runs of equal ones, as multisets, to six places.

    Texts are dealt by id once, to parts in proportion to their size. No word goes over a line's end, so each word of a line counts for the
    text, and for its run-free form if the line before differs.
    """
    texts = docs.filter("doc_id is not null").select("doc_id", "text").repartition(parts(docs), "doc_id")
    lines = texts.select("doc_id", F.posexplode(F.split("text", "\n")).alias("ln", "line"))
    first = F.coalesce(F.lag("line").over(Window.partitionBy("doc_id").orderBy("ln")) != F.col("line"), F.lit(True))
    words = lines.withColumn("first", first).select("doc_id", "first", F.explode(F.regexp_extract_all(F.lower("line"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))).alias("word"))
    counts = words.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("p"), F.count(F.when(F.col("first"), 1)).alias("g"))
    sums = counts.groupBy("doc_id").agg(F.sum(F.least("p", "g")).cast("double").alias("hit"), F.sum("p").alias("p"), F.sum("g").alias("g")).filter("g > 0")
    return sums.select("doc_id", F.round(F.col("hit") / F.col("p"), 6).alias("prec"), F.round(F.col("hit") / F.col("g"), 6).alias("rec"), F.round(2.0 * F.col("hit") / (F.col("p") + F.col("g")), 6).alias("f1"))
