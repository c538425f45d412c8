"""Queries of the rules on facts, on rows built of order lines; the SQL works from how they were built, or states the rule another way."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators import facts
from millrace.operators.dealing import parts


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def _one(lines: DataFrame) -> DataFrame:
    """Of lines that share their order and number the smallest, so that these are an id."""
    by = Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_discount", "l_tax")
    return lines.withColumn("_r", F.row_number().over(by)).filter("_r = 1").drop("_r")


def inventory_dismissal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why items are dismissed."""
    items = _lines(spark, sf_dir).selectExpr(
        "l_orderkey",
        "l_linenumber",
        """case (l_orderkey + l_linenumber) % 8 when 0 then concat('$', cast(l_extendedprice as bigint)) when 1 then date_format(l_shipdate, 'dd/MM/yyyy') when 2 then concat('555 ', lpad(l_partkey % 10000, 4, '0'))
           when 3 then concat('555 ', lpad(l_partkey % 10000, 4, '0')) when 4 then '24' when 5 then '10:30 am' when 6 then concat(cast(l_quantity as int), ' kg') else '1999' end as text""",
        "if((l_orderkey + l_linenumber) % 8 = 4, 'Opening hours', 'Height') as label",
        "(l_orderkey + l_linenumber) % 8 = 3 as measured",
        "if(l_returnflag = 'R', 'navigation', 'main') as scope",
    )
    return items.select("l_orderkey", "l_linenumber", facts.dismissal(F.col("text"), F.col("scope"), F.col("label"), F.col("measured")).alias("reason"))


def readable_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks that are read (F1): order lines in sections of suppliers."""
    lines = _lines(spark, sf_dir)
    blocks = lines.selectExpr("l_orderkey as doc_id", "l_linenumber as block_id", "l_suppkey as section_id", "element_at(array('main', 'sidebar', 'footer', 'breadcrumb', 'comments'), cast(l_partkey % 5 + 1 as int)) as scope", "if(l_tax > 0.06, 'metadata', 'paragraph') as type", "if(l_discount > 0.05, 'title', 'body') as source", "if(l_returnflag = 'A', '1', null) as dup_of")
    sections = lines.selectExpr("l_orderkey as doc_id", "l_suppkey as section_id", "if(l_suppkey % 2 = 0, 'variants', 'news') as role").distinct()
    return facts.extractable(blocks, sections).select("doc_id", "block_id")


def fact_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rules without a model decide on facts."""
    lines = _one(_lines(spark, sf_dir)).withColumn("block", F.concat_ws("-", "l_suppkey", "l_linenumber"))
    given = lines.selectExpr("l_orderkey as doc_id", "l_linenumber as fact_id", "if(l_linenumber = 7, ' TBD', concat('Part  ', l_partkey)) as value", "if(l_linenumber = 5, 'marketing_claim', 'technical_specification') as fact_class", "if(l_returnflag = 'A', null, l_suppkey) as owner", "if(l_quantity < 5, 'verified', 'pending') as verification", "cast(null as string) as rejection_reason")
    evidence = lines.filter("l_suppkey % 10 <> 0").selectExpr("l_orderkey as doc_id", "l_linenumber as fact_id", "block as block_id")
    blocks = lines.selectExpr("l_orderkey as doc_id", "block as block_id", "if(l_partkey % 3 = 0, 'nothing', concat('tbd, SEE PART ', l_partkey, '.')) as text").filter("block_id not like '%-3'")
    return facts.gate(given, evidence, blocks).select("doc_id", "fact_id", "verification", "rejection_reason")


def ledger_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of order lines as items, and of the lines not returned as facts of their own and of the item before (AG11)."""
    lines = _one(_lines(spark, sf_dir))
    items = lines.selectExpr("l_orderkey as doc_id", "l_linenumber as item_id", "l_suppkey as section_id", "element_at(array('main', 'sidebar', 'related_content'), cast(l_partkey % 3 + 1 as int)) as scope", "if(l_discount > 0.08, 'price', null) as dismissed_reason", "if(l_tax > 0.07, 'duplicate_of_fact', null) as audit_reason", "l_quantity > 25 as skipped")
    given = lines.filter("l_returnflag <> 'R'").selectExpr("l_orderkey as doc_id", "l_linenumber as fact_id", "l_linenumber as place", "element_at(array('verified', 'unresolved', 'rejected', 'verified_low_confidence'), cast(l_suppkey % 4 + 1 as int)) as verification", "case when l_partkey % 5 = 0 then 'split_into_parts' when l_partkey % 5 = 1 then 'no_owner' end as rejection_reason")
    links = given.filter("fact_id <> 3").select("doc_id", "fact_id", F.explode(F.array(F.col("fact_id"), F.col("fact_id") - 1)).alias("item_id"))
    sections = lines.selectExpr("l_orderkey as doc_id", "l_suppkey as section_id", "element_at(array('variants', 'news', 'related_products'), cast(l_suppkey % 3 + 1 as int)) as role").distinct()
    return facts.ledger(items, given, links, sections)


def param_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters with several values (F9, AG13)."""
    given = _lines(spark, sf_dir).selectExpr("l_suppkey as doc_id", "l_orderkey", "l_linenumber", "l_partkey as owner", "l_returnflag as param", "cast(null as string) as conditions", "concat(cast(l_quantity / 10 as int), if(l_linenumber % 2 = 0, ' KG', '  kg')) as value", "l_returnflag <> 'N' as single")
    return facts.conflicting(given).select("l_orderkey", "l_linenumber", "conflict")


def row_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as tables keyed by products."""
    rows = _lines(spark, sf_dir).selectExpr("l_suppkey % 3 as doc_id", "l_orderkey as table_id", "l_linenumber as block_id", "if(l_linenumber = 2, null, 'x') as label", "if(l_quantity > 25, l_partkey % 3, null) as owner")
    return facts.row_owners(rows)


def structural_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners by row, column and section (J9): each line's evidence is its own block, then the next one."""
    lines = _one(_lines(spark, sf_dir))
    evidence = lines.selectExpr("l_orderkey as doc_id", "l_linenumber as fact_id", "explode(array(0, 1)) as place").selectExpr("*", "fact_id + place as block_id", "cast((fact_id + place) % 3 as string) as section_id")
    by_row = lines.filter("l_returnflag = 'A'").selectExpr("l_orderkey as doc_id", "l_linenumber as block_id", "concat('p', l_partkey) as owner")
    by_column = lines.filter("l_returnflag = 'R'").selectExpr("l_orderkey as doc_id", "l_linenumber as fact_id", "l_linenumber as block_id", "concat('c', l_suppkey) as owner")
    sections = lines.select(F.col("l_orderkey").alias("doc_id")).distinct().selectExpr("doc_id", "explode(array('0', '1', '2')) as section_id").selectExpr("*", "case section_id when '0' then array(concat('s', doc_id)) when '1' then array('x', 'y') end as owners", "'heading' as source")
    return facts.structural_owner(evidence, by_row, by_column, sections, parts(_lines(spark, sf_dir)))


DISMISSAL = """
select l_orderkey, l_linenumber, case when l_returnflag = 'R' then 'navigation_contamination' else (case (l_orderkey + l_linenumber) % 8 when 0 then 'price' when 1 then 'date' when 7 then 'date' when 3 then null when 6 then null else 'not_technical' end) end as reason from lineitem"""
READABLE = """
select l_orderkey as doc_id, l_linenumber as block_id from lineitem where l_returnflag <> 'A' and (l_tax <= 0.06 or l_discount > 0.05) and (l_partkey % 5 = 0 or (l_partkey % 5 in (1, 4) and l_suppkey % 2 = 0))"""
GATES = """
with li as (select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_quantity, l_returnflag, l_discount, l_tax) = 1), g as (select *, case when l_quantity < 5 then null when l_linenumber = 5 then 'marketing_only' when l_suppkey % 10 = 0 or l_linenumber = 3 or l_partkey % 3 = 0 then 'unsupported' when l_linenumber = 7 then 'placeholder' when l_returnflag = 'A' then 'no_owner' end as why from li)
select l_orderkey as doc_id, l_linenumber as fact_id, case when l_quantity < 5 then 'verified' when why is null then 'pending' when why = 'no_owner' then 'unresolved' else 'rejected' end as verification, why as rejection_reason from g"""
LEDGER = """
with li as (select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_quantity, l_returnflag, l_discount, l_tax) = 1), f as (select l_orderkey as d, l_linenumber as f, l_partkey % 5 = 0 as split, case l_suppkey % 4 when 0 then 'extracted' when 3 then 'extracted' when 1 then 'unresolved' else (case when l_partkey % 5 = 0 then 'duplicate' else 'rejected' end) end as status,
    case when l_suppkey % 4 in (0, 3) then null when l_partkey % 5 = 0 then 'split_into_parts' when l_partkey % 5 = 1 then 'no_owner' when l_suppkey % 4 = 1 then 'unresolved' else 'unsupported' end as reason from li where l_returnflag <> 'R'),
k as (select *, f as i from f where f <> 3 union all select *, f - 1 from f where f <> 3),
r as (select *, row_number() over (partition by d, i order by split, case status when 'extracted' then 0 when 'unresolved' then 1 else 2 end, f) as r from k)
select l_orderkey as doc_id, 'inventory' as origin, cast(l_linenumber as varchar) as id,
  case when r.status is not null then r.status when l_discount > 0.08 or l_tax > 0.07 or (l_partkey % 3 > 0 and l_suppkey % 3 > 0) then 'rejected' else 'unresolved' end as status,
  case when r.status is not null then r.reason when l_discount > 0.08 then 'price' when l_tax > 0.07 then 'duplicate_of_fact' when l_partkey % 3 > 0 and l_suppkey % 3 > 0 then case when l_suppkey % 3 = 2 or l_partkey % 3 = 2 then 'related_content' else 'out_of_scope_section' end
    when l_quantity > 25 then 'not_processed_document_budget' else 'unexplained_inventory_item' end as reason
from li left join r on d = l_orderkey and i = l_linenumber and r.r = 1
union all select d, 'discovery', cast(f as varchar), status, reason from f where f = 3"""
CONFLICTS = """
with g as (select l_suppkey, l_partkey, l_returnflag, count(distinct cast(trunc(l_quantity / 10) as int)) as n from lineitem group by all)
select l_orderkey, l_linenumber, n > 1 and l_returnflag <> 'N' as conflict from lineitem join g using (l_suppkey, l_partkey, l_returnflag)"""
ROWS = """
with x as (select l_suppkey % 3 as doc_id, l_orderkey as table_id, l_linenumber as block_id, l_linenumber <> 2 as labelled, case when l_quantity > 25 and l_linenumber <> 2 then l_partkey % 3 end as owner from lineitem),
g as (select doc_id, table_id from x group by all having count(distinct owner) >= 2 and count(owner) >= greatest(2, count(case when labelled then 1 end) // 2))
select doc_id, table_id, block_id, owner from x join g using (doc_id, table_id) where owner is not null"""
OWNERS = """
with li as (select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_quantity, l_returnflag, l_discount, l_tax) = 1), x as (select a.l_orderkey as doc_id, a.l_linenumber as fact_id, case when a.l_returnflag = 'A' then concat('p', a.l_partkey) when a.l_returnflag = 'R' then concat('c', a.l_suppkey) when b.l_returnflag = 'A' then concat('p', b.l_partkey) when a.l_linenumber % 3 = 0 then concat('s', a.l_orderkey) end as owner,
  case when a.l_returnflag = 'A' then 'table_row' when a.l_returnflag = 'R' then 'table_column' when b.l_returnflag = 'A' then 'table_row' else 'section:heading' end as via from li a left join li b on b.l_orderkey = a.l_orderkey and b.l_linenumber = a.l_linenumber + 1)
select doc_id, fact_id, owner, via from x where owner is not null"""

QUERIES = {f.__name__: f for f in (inventory_dismissal, readable_blocks, fact_gates, ledger_closure, param_conflicts, row_owners, structural_owner)}
ORACLES = {"inventory_dismissal": DISMISSAL, "readable_blocks": READABLE, "fact_gates": GATES, "ledger_closure": LEDGER, "param_conflicts": CONFLICTS, "row_owners": ROWS, "structural_owner": OWNERS}
