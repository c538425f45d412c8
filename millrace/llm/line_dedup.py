"""Line dedup by distinct-site spread.

Every line is hashed; a HyperLogLog sketch of the sites that show it is kept per hash and merged by aggregation. Lines whose
estimate lies near the threshold get an exact distinct count, and lines on `min_sites` sites or more are cross-site boilerplate
and are removed.

A line is the text between line feeds, trimmed of blanks at its ends. Blank lines are never removed. A null site counts for no
line; null and empty texts have no lines. Rows keep their other columns; repeated rows are each answered. All expressions are
built in. The hot line of a corpus is one aggregate row after map-side merging.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import carried, materialize, unpacked

SALT = 16

def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _key(line: Column) -> Column:
    """96 bits of hash of the trimmed line; null for a blank one."""
    bare = F.trim(line)
    return F.when(bare != "", F.struct(F.xxhash64(bare).alias("a"), F.hash(bare).alias("b")))


def boilerplate(docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = 8, lg_k: int = 9) -> DataFrame:
    """(a, b) hashes of the lines on min_sites sites or more."""
    lines = docs.select(F.col(site).cast("string").alias("site"), F.explode(lines_of(F.col(text))).alias("line")).select("site", _key(F.col("line")).alias("k")).filter("k is not null and site is not null").select("k.a", "k.b", "site")
    # A line of one row can't be on several sites; sketches are merged from the sketches of map tasks.
    spread = lines.groupBy("a", "b").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("sites"))
    slack = 4 * 1.04 / (1 << lg_k) ** 0.5
    low, high = min_sites * (1 - slack) - 1, min_sites * (1 + slack) + 1
    spread = materialize(spread.filter(F.col("sites") >= low), "line-spread")
    near = spread.filter(F.col("sites") <= high).select("a", "b")
    # Distinct first: a near-threshold line then has few rows, however often it occurs.
    exact = lines.distinct().join(near, ["a", "b"], "left_semi").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_sites)
    return spread.filter(F.col("sites") > high).select("a", "b").unionByName(exact.select("a", "b"))


def remove_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = 8, lg_k: int = 9) -> DataFrame:
    """docs with the text cleaned, and n_lines (not blank) and n_removed added; columns of docs of these names are replaced.

    Boilerplate hashes meet the documents' line hashes, not their texts; each document then gets its own few. Documents that
    share an id share that list, which changes nothing: it holds boilerplate only. A null text stays null.
    """
    bad = materialize(boilerplate(docs, text, site, min_sites, lg_k), "line-boilerplate")
    keys = docs.select(F.col(doc_id).alias("id"), F.explode(lines_of(F.col(text))).alias("line")).select("id", _key(F.col("line")).alias("k")).filter("k is not null").select("id", "k.a", "k.b")
    # A boilerplate line is on many rows by definition: each key is dealt to SALT places.
    keys = keys.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALT)))
    salted = bad.select("a", "b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))).alias("salt"))
    own = keys.join(salted, ["a", "b", "salt"], "left_semi").groupBy("id").agg(F.collect_set(F.struct("a", "b")).alias("bad"))
    rows = carried(docs, key=F.col(doc_id)).join(own, F.col("key").eqNullSafe(F.col("id")), "left")
    old = F.col(f"row.`{text}`")
    lines = lines_of(old)
    is_bad = lambda x: F.coalesce(F.array_contains(F.col("bad"), _key(x)), F.lit(False))
    kept = F.when(F.col("bad").isNull(), old).otherwise(F.array_join(F.filter(lines, lambda x: ~is_bad(x)), "\n"))
    removed = F.when(F.col("bad").isNull(), F.lit(0)).otherwise(F.size(F.filter(lines, is_bad)))
    total = F.size(F.filter(lines, lambda x: F.trim(x) != ""))
    return rows.select(*unpacked(docs.columns, **{text: kept, "n_lines": total.cast("long"), "n_removed": removed.cast("long")}))


def digest(docs: DataFrame) -> DataFrame:
    clean = remove_lines(docs.select("doc_id", "source", "text"))
    return clean.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("clean_sha256"))
