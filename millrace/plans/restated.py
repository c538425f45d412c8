"""Queries that call operators on DataFrames; their SQL states the rule another way.

Where a query bears the name of one in `relational` or `evidence`, that one's SQL is only what it is compared with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.text import host, locale
from millrace.operators import content, lineage, nearest, ordering, ranking, spans
from millrace.operators.dealing import parts
from millrace.streaming.breaker import breaker


def interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups in turn (O2)."""
    return ordering.interleave(spark.read.parquet(f"{sf_dir}/documents.parquet"), "source", "doc_id")


def budget_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of each group first, then the smallest (O3)."""
    return ordering.budget_order(spark.read.parquet(f"{sf_dir}/documents.parquet"), "lang", "doc_id", "n_chars")


def crawl_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priority of pages: listings last, then by host, locale and id (O1)."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return ordering.numbered(pages, F.col("url").contains("page=").cast("int"), host(F.col("url")), locale(F.col("url")), F.col("page_id")).select("page_id", "place")


def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    found = ranking.bm25(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.withColumn("score", F.round("score", 6))


def circuit_breaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls refused after two failures in a row."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return breaker(events, "user_id", "ts", "event_id", F.col("event_type") == "error", seconds=86_400).select("event_id", "user_id", "refused")


def nearest_legend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders as uses and closed ones as legends of a customer, in order of time."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    placed = orders.withColumn("ord", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")))
    uses = placed.filter("o_orderstatus = 'O'").selectExpr("o_custkey as doc", "o_orderkey as k", "ord")
    legends = placed.filter("o_orderstatus = 'F'").selectExpr("o_custkey as doc", "o_orderkey as legend", "ord")
    return spans.nearest_legend(uses, legends, keys=("doc",)).select("doc", "k", "legend")


def item_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order as facts, and as items moved by two."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    span = {"a": F.col("l_linenumber") * 10, "b": F.col("l_linenumber") * 10 + F.col("l_quantity").cast("int")}
    text = F.concat(F.col("l_returnflag"), F.lit("  "), F.col("l_quantity").cast("int"))
    facts = lines.select(F.col("l_orderkey").alias("doc_id"), F.col("l_suppkey").alias("block_id"), F.col("l_linenumber").alias("fact_id"), span["a"].alias("a"), span["b"].alias("b"), text.alias("text"))
    items = lines.select(F.col("l_orderkey").alias("doc_id"), F.col("l_suppkey").alias("block_id"), F.col("l_linenumber").alias("item_id"), (span["a"] + 2).alias("a"), (span["b"] + 2).alias("b"), F.lower(text).alias("text"))
    return spans.link_items(facts, items)


def uncovered_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order that no returned line's span contains."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("l_orderkey", "l_linenumber", "l_returnflag", "l_linenumber * 10 as a", "l_linenumber * 10 + cast(l_quantity as int) as b")
    covers = lines.filter("l_returnflag = 'R'").select("l_orderkey", "a", "b")
    return spans.uncovered(lines.filter("l_returnflag <> 'R'"), covers, "l_orderkey").select("l_orderkey", "l_linenumber", "a", "b")


def token_prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token precision, recall and F1 of a text against its run-free form, as multisets."""
    return content.run_free_prf(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def usable_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold four fifths of a key's distinct words."""
    return ranking.holding(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def dot_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of leaders with rising pages are contents, others labels with values (P3); an order is a document."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    leaders = lines.filter("l_returnflag <> 'A'").selectExpr("l_orderkey as doc", "l_linenumber as ln", "l_suppkey as page").repartition(parts(lines), "doc")
    run = Window.partitionBy("doc", "island")
    numbered = leaders.withColumn("island", F.col("ln") - F.row_number().over(Window.partitionBy("doc").orderBy("ln", "page"))).filter("doc is not null and island is not null")
    falls = numbered.withColumn("falls", F.when(F.col("page") < F.lag("page").over(run.orderBy("ln", "page")), 1).otherwise(0))
    contents = (F.count(F.lit(1)).over(run) >= 4) & (F.sum("falls").over(run) == 0) & (F.size(F.collect_set("page").over(run)) >= 3)
    return falls.select("doc", "ln", F.when(contents, "navigation").otherwise("value").alias("kind"))


def cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors by cosine of every fiftieth one."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("e"))
    return nearest.cosine(vectors.filter("id % 50 = 0"), vectors)


def product_ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ancestors of a customer, six steps at most."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr("concat('c', cast(c_custkey as string)) as child", "concat('n', cast(c_nationkey as string)) as parent")
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet").selectExpr("concat('n', cast(n_nationkey as string)) as child", "concat('r', cast(n_regionkey as string)) as parent")
    return lineage.ancestors(customers.unionAll(nations))


BM25 = r"""
with w0 as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9À-ɏЀ-ӿ]+|[°%″′"]') as ws from documents),
w as (select doc_id, unnest(case when len(ws) = 0 then ['_'] else ws end) as word from w0), tf as (select doc_id, word, count(*) as f from w group by all),
dl as (select doc_id, sum(f) as n from tf group by doc_id), st as (select count(*) as docs, avg(n) as mean from dl),
df as (select word, ln(docs - count(*) + 0.5) - ln(count(*) + 0.5) as idf from tf cross join st group by word, docs), mi as (select avg(idf) as m from df),
q as (select item_id, unnest(regexp_extract_all(lower(text), '[a-z0-9À-ɏЀ-ӿ]+|[°%″′"]')) as word from benchmark),
sc as (select item_id, doc_id, round(sum(case when idf < 0 then 0.25 * m else idf end * f * 2.5 / (f + 1.5 * (0.25 + 0.75 * n / mean))), 9) as score
  from q join tf using (word) join df using (word) join dl using (doc_id) cross join st cross join mi group by item_id, doc_id)
select item_id, doc_id, round(score, 6) as score, row_number() over (partition by item_id order by score desc, doc_id) as place from sc where score > 0
qualify place <= 10"""
BREAKER = """
with recursive e as (select *, row_number() over (partition by user_id order by ts, event_id) as i from events),
s(user_id, i, event_id, refused, fails, until) as (select user_id, cast(0 as bigint), cast(null as bigint), false, 0, cast(null as timestamp) from (select distinct user_id from events) u
  union all select e.user_id, e.i, e.event_id, coalesce(e.ts < s.until, false), case when e.ts < s.until then fails when event_type = 'error' then fails + 1 else 0 end,
    case when e.ts < s.until then s.until when event_type <> 'error' then null when fails >= 1 then cast(e.ts as timestamp) + interval 1 day else s.until end
  from s join e on e.user_id = s.user_id and e.i = s.i + 1)
select event_id, user_id, refused from s where i > 0"""
LINKS = """
with s as (select *, l_linenumber * 10 as a, l_linenumber * 10 + cast(l_quantity as int) as b, cast(cast(l_quantity as int) as varchar) as v from lineitem)
select distinct x.l_orderkey as doc_id, x.l_linenumber as fact_id, y.l_linenumber as item_id from s x join s y on x.l_orderkey = y.l_orderkey and x.l_suppkey = y.l_suppkey
where (x.a < y.b + 2 and y.a + 2 < x.b) or (x.l_returnflag = y.l_returnflag and (starts_with(x.v, y.v) or starts_with(y.v, x.v)))"""
UNCOVERED = """
with s as (select l_orderkey, l_linenumber, l_returnflag, l_linenumber * 10 as a, l_linenumber * 10 + cast(l_quantity as int) as b from lineitem)
select l_orderkey, l_linenumber, a, b from s x where l_returnflag <> 'R' and not exists (select 1 from s y where y.l_orderkey = x.l_orderkey and y.l_returnflag = 'R' and y.a <= x.a and x.b <= y.b)"""

CRAWL = r"""
select page_id, row_number() over (order by case when url like '%page=%' then 1 else 0 end, replace(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1), 'www.', ''), regexp_extract(url, '^[a-z]+://[^/]+/([a-z][a-z])([/?#]|$)', 1), page_id) as place from pages"""

QUERIES = {f.__name__: f for f in (interleave, budget_order, crawl_order, bm25_topk, circuit_breaker, nearest_legend, item_links, uncovered_values, product_ancestors, cosine_topk, token_prf, usable_keys, dot_leaders)}
ORACLES = {"crawl_order": CRAWL, "bm25_topk": BM25, "circuit_breaker": BREAKER, "item_links": LINKS, "uncovered_values": UNCOVERED}
