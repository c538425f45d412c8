"""Queries by name, and the SQL that each equals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import normal, similarity
from millrace.operators import chunks, content, dates, evaluation, measurements
from millrace.plans import evidence, facts, relational, restated
from millrace.sources.blocks import blocks
from millrace.sources.html import page_text, visible_lines


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main content of pages."""
    return content.main_content(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def page_visible_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible lines with link shares (H1, H2, H3)."""
    return visible_lines(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def template_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Template lines of hosts (M1)."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return content.templates(content.site_lines(pages), pages)


def prose_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines after prose trimming (M9)."""
    return content.trim_to_prose(visible_lines(spark.read.parquet(f"{sf_dir}/pages.parquet")))


def html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of pages with scopes, sections, tables and pairs."""
    return blocks(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def html_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks packed in order."""
    return chunks.build_chunks(html_blocks(spark, sf_dir), max_tokens=200)


def text_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements in documents."""
    return measurements.measurements(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def spec_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements in sheets whose values are known."""
    sheet = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr("p_partkey", "concat('Length: ', p_size, ' cm; Speed: up to ', p_size, ' km/h; Body ', p_size, ' x 20 x 10 mm') as text")
    return measurements.measurements(sheet, "p_partkey").select("p_partkey", "kind", "comparator", "value", "unit", F.round("base", 4).alias("base"))


def fuzzy_shortlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand and type labels by the nearest part names."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return similarity.shortlist(part.select(F.concat_ws(" ", F.lower("p_type"), "p_name").alias("label")), part.select(F.col("p_name").alias("name")))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten parts are a document. Its result has a part's value as it is, on another product, undecided, not at all, or in a longer text, in turn."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr("concat('d', p_partkey div 10) as doc_id", "cast(p_partkey as int) as n", "p_partkey % 5 as turn", "concat('Model ', p_partkey) as name", "concat(p_partkey, ' mm') as v")
    fact = F.struct(F.col("name").alias("p"), "v", F.lit("spec").alias("k"), F.lit("length").alias("param"), F.array().cast("array<string>").alias("alt"), F.array().cast("array<string>").alias("any"), F.array().cast("array<double>").alias("nums"), F.element_at(F.array(F.lit("start"), F.lit("middle"), F.lit("end")), F.col("n") % 3 + 1).alias("pos"), F.lit(None).cast("int").alias("page"), F.col("n"))
    product = F.struct(F.col("name").alias("id"), F.concat("name", F.lit("™")).alias("name"), F.array(F.upper("name")).alias("aliases"))
    keys = part.groupBy("doc_id").agg(F.array_sort(F.collect_list(product)).alias("products"), F.array_sort(F.collect_list(fact), lambda x, y: x["n"] - y["n"]).alias("facts"))
    keys = keys.select("doc_id", F.lit(False).alias("partial"), "products", "facts", F.array(F.lit("overall")).alias("negatives"))
    value = F.when(F.col("turn") == 4, F.concat(F.lit("about "), F.col("v"), F.lit(" overall"))).otherwise(F.col("v"))
    spec = F.struct(value.alias("value_text"), F.struct(F.when(F.col("turn") == 0, "length").otherwise("width").alias("id"), F.lit("Length").alias("source_label"), F.lit("canonical").alias("status")).alias("parameter"), F.lit("verified").alias("verification"))
    left = F.struct(F.lit(None).cast("string").alias("owner_entity_id"), F.col("v").alias("value_text"), F.lit("length").alias("parameter"))
    owned = F.struct(F.concat(F.lit("e"), F.col("n")).alias("entity_id"), F.col("name"), F.when(F.col("turn").isin(0, 4), F.array(spec)).alias("specifications"))
    stray = F.struct(F.concat(F.lit("x"), F.col("n")).alias("entity_id"), F.lit("Something").alias("name"), F.array(spec).alias("specifications"))
    results = part.groupBy("doc_id").agg(F.concat(F.collect_list(owned), F.collect_list(F.when(F.col("turn") == 1, stray))).alias("products"), F.collect_list(F.when(F.col("turn") == 2, left)).alias("unattributed"))
    return evaluation.score_documents(keys, results.select("doc_id", F.to_json(F.struct("products", "unattributed")).alias("result")))


def score_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of every key fact."""
    rows = evaluation.outcomes(_judged(spark, sf_dir))
    return rows.select("doc_id", F.regexp_extract(F.col("doc_id"), "[0-9]+", 0).cast("long").alias("d"), "outcome", "match", "value", "param")


def score_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a run (E4, E7, AG5)."""
    return evaluation.run_totals(_judged(spark, sf_dir)).select("documents", "scored", "core_n", "core_matched", "core_misattributed", "core_unresolved", "core_missed", "core_recall", "text_n", "param_correct", "param_wrong_canonical", "verbatim_share", "merged", "extras", "others", "violations")


def score_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall by position (AG5, W9)."""
    return evaluation.by_position(_judged(spark, sf_dir))


def document_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates by witnesses (T1 to T4, F4), on pages built of orders."""
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    turn, later = F.col("o_orderkey") % 6, F.date_add("d", 40)
    url = F.when(turn == 0, F.date_format("d", "'https://www.example.org/'yyyy/MM/dd'/item'")).when(turn == 1, F.date_format("d", "'https://example.org/'yyyy/MM'/item'")).when(turn == 5, F.lit("https://example.org/news")).otherwise(F.lit("https://example.org/item"))
    html = F.when(turn.isin(0, 2), F.concat(F.lit('<meta property="article:published_time" content="'), F.date_format(later, "yyyy-MM-dd"), F.lit('T10:00:00Z">')))
    text = F.when(turn.isin(2, 3), F.concat(F.lit("CITY, "), F.date_format(later, "d MMMM yyyy"), F.lit(" - Something."))).otherwise(F.lit("No date."))
    pages = rows.select("o_orderkey", url.alias("url"), html.alias("html"), text.alias("text"), F.when(turn == 4, F.date_format("d", "yyyy-MM-dd")).alias("published_at"), F.date_format("d", "yyyy-MM-dd").alias("fetched_at"))
    return dates.resolve(pages, F.to_date(F.lit("2030-01-01"))).select("o_orderkey", "date", "status")


def stored_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as text from stored bytes (S10, S11): UTF-8 or UTF-16 in turn."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    raw = F.when(F.col("page_id") % 2 == 0, F.encode("html", "UTF-8")).otherwise(F.encode("html", "UTF-16"))
    return pages.select("page_id", F.sha2(page_text(raw).cast("binary"), 256).alias("html_sha256"))


def normal_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normal forms of names."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return part.select("p_partkey", normal.normal_name(F.concat(F.lit("  “"), F.upper("p_name"), F.lit("”®  – "), F.col("p_brand"), F.lit(" ."))).alias("name"))


SCORE_SQL = """
with p as (select concat('d', cast(cast(floor(p_partkey / 10) as bigint) as varchar)) as doc_id, cast(floor(p_partkey / 10) as bigint) as d, p_partkey % 5 as turn, p_partkey % 3 as third, concat(cast(p_partkey as varchar), ' mm') as v from part)"""
OUTCOME_SQL = SCORE_SQL + """
select doc_id, d, case turn when 1 then 'misattributed' when 2 then 'unresolved' when 3 then 'missed' else 'matched' end as outcome, case turn when 0 then 'exact' when 4 then 'contains' end as "match",
       case turn when 3 then null when 4 then concat('about ', v, ' overall') else v end as value, case turn when 0 then 'correct' when 4 then 'wrong_canonical' end as param from p"""
RUN_SQL = SCORE_SQL + """, n as (select count(*) as n, count(distinct doc_id) as docs, count(case when turn = 0 then 1 end) as a, count(case when turn = 1 then 1 end) as b, count(case when turn = 2 then 1 end) as c, count(case when turn = 3 then 1 end) as m, count(case when turn = 4 then 1 end) as e from p)
select docs as documents, docs as scored, n as core_n, a + e as core_matched, b as core_misattributed, c as core_unresolved, m as core_missed, round(cast(a + e as double) / n, 4) as core_recall, 0 as text_n,
       a as param_correct, e as param_wrong_canonical, cast(1 as double) as verbatim_share, 0 as merged, 0 as extras, b as others, e as violations from n"""
POSITION_SQL = SCORE_SQL + """
select case third when 0 then 'start' when 1 then 'middle' else 'end' end as pos, count(*) as n, count(case when turn in (0, 4) then 1 end) as matched, round(cast(count(case when turn in (0, 4) then 1 end) as double) / count(*), 4) as recall from p group by third"""
DATE_SQL = """
with o as (select o_orderkey, o_orderkey % 6 as turn, cast(o_orderdate as date) as d from orders)
select o_orderkey, case turn when 0 then strftime(d, '%Y-%m-%d') when 1 then strftime(d, '%Y-%m') when 2 then strftime(d + 40, '%Y-%m-%d') when 3 then strftime(d + 40, '%Y-%m-%d') end as date,
       case turn when 0 then 'proven' when 1 then 'single-month' when 2 then 'proven' when 3 then 'single' when 4 then 'undated' else 'listing' end as status from o"""
NAME_SQL = """select p_partkey, concat(lower(p_name), '" - ', lower(p_brand)) as name from part"""
PAGE_SQL = "select page_id, sha256(html) as html_sha256 from pages"

SHEET_SQL = """
select p_partkey, 'scalar' as kind, 'eq' as comparator, cast(p_size as double) as value, 'cm' as unit, round(p_size * 0.01, 4) as base from part
union all select p_partkey, 'bound', 'up_to', cast(p_size as double), 'km/h', round(p_size / 3.6, 4) from part
union all select p_partkey, 'composite', 'eq', cast(p_size as double), 'mm', round(p_size * 0.001, 4) from part"""

QUERIES = {"score_outcomes": score_outcomes, "score_run": score_run, "score_positions": score_positions, "document_dates": document_dates, "stored_pages": stored_pages, "normal_names": normal_names, "html_blocks": html_blocks, "html_chunks": html_chunks, "text_measurements": text_measurements, "spec_measurements": spec_measurements, "fuzzy_shortlist": fuzzy_shortlist, "main_content": flagship, "page_visible_lines": page_visible_lines, "template_lines": template_lines, "prose_lines": prose_lines} | relational.QUERIES | evidence.QUERIES | restated.QUERIES | facts.QUERIES
ORACLES = {"score_outcomes": OUTCOME_SQL, "score_run": RUN_SQL, "score_positions": POSITION_SQL, "document_dates": DATE_SQL, "stored_pages": PAGE_SQL, "normal_names": NAME_SQL, "spec_measurements": SHEET_SQL} | relational.ORACLES | evidence.ORACLES | restated.ORACLES | facts.ORACLES
