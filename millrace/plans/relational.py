"""Relational operators in SQL that Spark and DuckDB both run; only how a text becomes rows differs (MACROS)."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

#: Macro: (Spark SQL, DuckDB SQL).
MACROS = {
    "$LINES$": (
        "(select doc_id, source, cast(p + 1 as bigint) as ln, line from documents lateral view posexplode(split(text, '\\n')) t as p, line)",
        "(select doc_id, source, i as ln, line from documents, unnest(string_split(text, chr(10))) with ordinality as t(line, i))",
    ),
    "$WORDS$": (
        "(select doc_id, word from documents lateral view explode(regexp_extract_all(lower(text), r'[\\p{L}\\p{N}]+', 0)) t as word)",
        "(select doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) as word from documents)",
    ),
    "$ITEMWORDS$": (
        "(select item_id, word from benchmark lateral view explode(regexp_extract_all(lower(text), r'[\\p{L}\\p{N}]+', 0)) t as word)",
        "(select item_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) as word from benchmark)",
    ),
    "$LINEWORDS$": (
        "(select doc_id, ln, word from lines lateral view explode(regexp_extract_all(lower(line), r'[\\p{L}\\p{N}]+', 0)) t as word)",
        "(select doc_id, ln, unnest(regexp_extract_all(lower(line), '[\\p{L}\\p{N}]+')) as word from lines)",
    ),
    "$DAY$": ("date_format({}, 'yyyy-MM-dd')", "strftime({}, '%Y-%m-%d')"),
}

SQL = {
    # Host, locale and listing test of a URL.
    "page_locale_host": """
select page_id, regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) as host, regexp_extract(url, '^[a-z]+://[^/]+/([a-z][a-z])/', 1) as loc,
       url like '%page=%' as is_listing, not (url like '%.pdf' or url like '%.zip') as fetchable from pages""",
    # M1: lines that recur over the documents of a source.
    "recurring_lines": """
with lines as $LINES$ select source, line, cast(count(distinct doc_id) as bigint) as n from lines where trim(line) <> '' group by source, line having count(distinct doc_id) >= 2""",
    # Consecutive equal lines once; blank lines stay.
    "dedupe_line_runs": """
with lines as $LINES$, seen as (select *, lag(line) over (partition by doc_id order by ln) as before from lines)
select doc_id, ln, line from seen where before is null or before <> line or trim(line) = ''""",
    # The first block with the same text.
    "duplicate_blocks": """
with lines as $LINES$, firsts as (select doc_id, ln, min(ln) over (partition by doc_id, lower(trim(line))) as dup_of from lines where length(trim(line)) > 15)
select doc_id, ln, dup_of from firsts where dup_of < ln""",
    # Token precision, recall and F1 of a text against its run-free form, as multisets.
    "token_prf": """
with lines0 as $LINES$, seen as (select *, lag(line) over (partition by doc_id order by ln) as before from lines0),
lines as (select doc_id, ln, line from seen where before is null or before <> line), gold as (select doc_id, word, count(*) as n from $LINEWORDS$ x group by doc_id, word),
pred as (select doc_id, word, count(*) as n from $WORDS$ y group by doc_id, word),
sums as (select pred.doc_id, sum(least(pred.n, coalesce(gold.n, 0))) as hit, sum(pred.n) as p from pred left join gold on pred.doc_id = gold.doc_id and pred.word = gold.word group by pred.doc_id),
golds as (select doc_id, sum(n) as g from gold group by doc_id)
select sums.doc_id, round(cast(hit as double) / p, 6) as prec, round(cast(hit as double) / g, 6) as rec, round(2.0 * cast(hit as double) / (p + g), 6) as f1 from sums join golds on sums.doc_id = golds.doc_id""",
    # Token estimate, density of digits, size class.
    "text_profile": """
select doc_id, cast(floor(length(text) / 3.6) + 1 as bigint) as est_tokens, round(cast(length(regexp_replace(text, '[^0-9]', '', 'g')) as double) / greatest(1.0, length(text) / 1000.0), 6) as density,
       case when length(text) < 4000 then 'small' when length(text) < 12000 then 'medium' when length(text) < 30000 then 'large' else 'huge' end as size_class from documents""",
    # Values of a spec sheet in base units.
    "spec_normalised": """
with sheet as (select p_partkey, concat('Length: ', cast(p_size as varchar(20)), ' cm') as line, 'cm' as unit from part
               union all select p_partkey, concat('Speed: up to ', cast(p_size as varchar(20)), ' km/h'), 'km/h' from part),
parsed as (select p_partkey, regexp_extract(line, '^([A-Za-z]+):', 1) as label, cast(regexp_extract(line, '([0-9]+)', 1) as double) as v, unit, line like '%up to%' as bound from sheet)
select p_partkey, label, v, unit, case when bound then 'up_to' else 'exact' end as comparator, round(case unit when 'cm' then v * 0.01 else v / 3.6 end, 6) as base from parsed""",
    # Facts and inventory items of one block whose spans overlap; containment apart.
    "span_link": """
with s as (select l_orderkey as block, l_linenumber as item, l_linenumber * 10 as a, l_linenumber * 10 + cast(l_quantity as int) as b from lineitem)
select x.block, x.item as fact, y.item as item, x.a <= y.a and y.b <= x.b as covers from s x join s y on x.block = y.block and x.item <> y.item and x.a < y.b and y.a < x.b""",
    # The nearest legend of a marker, a following one first.
    "nearest_legend": """
with o as (select o_custkey as doc, o_orderkey as k, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as pos, o_orderstatus as st from orders),
c as (select u.doc, u.k, l.k as legend, row_number() over (partition by u.doc, u.k order by case when l.pos < u.pos then 1 else 0 end, abs(l.pos - u.pos), l.k) as r from o u join o l on u.doc = l.doc and u.st = 'O' and l.st = 'F')
select doc, k, legend from c where r = 1""",
    # Labels to catalogue parameters.
    "alias_mapping": """
with alias as (select 'economy' as a, 'cost_class' as param union all select 'standard', 'cost_class' union all select 'large', 'size_class' union all select 'small', 'size_class' union all select 'promo', 'offer')
select p_partkey, p_type, param from part join alias on lower(regexp_extract(p_type, '^([A-Za-z]+)', 1)) = a""",
    # Of equal facts the best, with the number merged.
    "merge_duplicates": """
with r as (select l_partkey, l_returnflag, l_orderkey, l_linenumber, l_quantity, row_number() over (partition by l_partkey, l_returnflag order by l_quantity desc, l_orderkey, l_linenumber) as r, count(*) over (partition by l_partkey, l_returnflag) as n from lineitem)
select l_partkey, l_returnflag, l_orderkey, l_linenumber, l_quantity, cast(n as bigint) as merged from r where r = 1""",
    # All ancestors of a customer, six steps at most.
    "product_ancestors": """
with recursive edges as (select concat('c', cast(c_custkey as varchar(20))) as child, concat('n', cast(c_nationkey as varchar(20))) as parent from customer union all select concat('n', cast(n_nationkey as varchar(20))), concat('r', cast(n_regionkey as varchar(20))) from nation),
up(child, ancestor, depth) as (select child, parent, 1 from edges union all select up.child, edges.parent, up.depth + 1 from up join edges on up.ancestor = edges.child where up.depth < 6)
select child, ancestor, depth from up""",
    # AG14: parts of a parent rolled up.
    "subsystem_rollup": """
select n_name, cast(count(s_suppkey) as bigint) as parts, round(sum(s_acctbal), 2) as total from nation left join supplier on n_nationkey = s_nationkey group by n_name""",
    # A section's scope by characters.
    "section_scope_vote": """
with lines as $LINES$, v as (select doc_id, case when length(line) < 40 then 'nav' when line like '%.%' then 'main' else 'aside' end as scope, sum(length(line)) as n from lines group by 1, 2),
t as (select *, sum(n) over (partition by doc_id) as total, row_number() over (partition by doc_id order by n desc, scope) as r, max(case when scope = 'main' then n else 0 end) over (partition by doc_id) as main_n from v)
select doc_id, case when main_n >= greatest(150, 0.15 * total) then 'main' else scope end as scope from t where r = 1""",
    # AG5, J13: recall by source, no ratio without labels.
    "eval_recall": """
select source, cast(count(quality) as bigint) as n, cast(count(case when quality = 1 and length(text) > 400 then 1 end) as bigint) as hit,
       case when count(quality) = 0 then null else round(cast(count(case when quality = 1 and length(text) > 400 then 1 end) as double) / count(quality), 6) end as recall
from documents d left join labels l on d.doc_id = l.doc_id group by source""",
    # AG1, AG3: one aggregate over several single keys and over all.
    "run_stats_sets": """
select n_name, o_orderstatus, c_mktsegment, cast(count(*) as bigint) as n, round(sum(o_totalprice), 2) as total from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
group by grouping sets ((n_name), (o_orderstatus), (c_mktsegment), ())""",
    # T4: the day with most witnesses; ties by witness.
    "date_witness_vote": """
with w as (select l_orderkey as doc, 'U' as who, 0 as pref, cast(o_orderdate as date) as d from orders join (select distinct l_orderkey from lineitem) x on o_orderkey = l_orderkey
           union all select l_orderkey, 'H', 1, cast(l_shipdate as date) from lineitem where l_linenumber = 1 union all select l_orderkey, 'T', 2, cast(l_shipdate as date) from lineitem where l_linenumber = 2),
g as (select doc, d, count(*) as n, min(pref) as pref from w group by doc, d), r as (select *, row_number() over (partition by doc order by n desc, pref, d) as r from g)
select doc, cast(d as varchar(20)) as day, cast(n as bigint) as witnesses, n >= 2 or pref = 0 as proven from r where r = 1""",
    # O2: groups in turn.
    "interleave": """
with r as (select doc_id, source, row_number() over (partition by source order by md5(cast(doc_id as varchar(20)))) as turn from documents) select doc_id, source, cast(row_number() over (order by turn, source, doc_id) as bigint) as place from r""",
    # O3: a quarter of every group first, then the smallest.
    "budget_order": """
with r as (select doc_id, lang, n_chars, row_number() over (partition by lang order by md5(cast(doc_id as varchar(20)))) as k, count(*) over (partition by lang) as n from documents)
select doc_id, case when k <= greatest(1, case when n % 4 = 2 then 2 * floor((n + 2) / 8) else round(0.25 * n) end) then 'head' else 'tail' end as part, cast(row_number() over (order by case when k <= greatest(1, case when n % 4 = 2 then 2 * floor((n + 2) / 8) else round(0.25 * n) end) then 0 else 1 end, case when k <= greatest(1, case when n % 4 = 2 then 2 * floor((n + 2) / 8) else round(0.25 * n) end) then k else n_chars end, doc_id) as bigint) as place from r""",
    # AG6: medians and costs by agent.
    "call_stats": """
select event_type, cast(count(*) as bigint) as n, round(sum(value), 4) as cost, round(percentile_cont(0.5) within group (order by value), 6) as median_value from events group by event_type""",
    # AG7, AG8: progress by day.
    "progress": """
select cast(cast(ts as date) as varchar(20)) as day, event_type, cast(count(*) as bigint) as n, round(sum(value), 4) as cost from events group by 1, 2""",
    # AG9: what each call adds to its document's total.
    "usage_delta": """
select event_id, user_id, round(value - coalesce(lag(value) over (partition by user_id order by ts, event_id), 0), 6) as delta from events""",
    # Calls after which a document is over its budget.
    "budget_guard": """
with r as (select event_id, user_id, sum(value) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as spent from events)
select user_id, event_id, round(spent, 4) as spent, spent >= 500 as over_cap from r""",
    # The last status of an id decides whether it is done.
    "resume_done_ids": """
with r as (select user_id, event_type, row_number() over (partition by user_id order by ts desc, event_id desc) as r from events) select user_id, event_type as last_status from r where r = 1 and event_type <> 'error'""",
    # Runs of five lines or more of at most six words.
    "link_runs": """
with lines as $LINES$, short as (select doc_id, ln, ln - row_number() over (partition by doc_id order by ln) as island from lines where length(line) - length(replace(line, ' ', '')) < 6)
select doc_id, cast(min(ln) as bigint) as first_ln, cast(max(ln) as bigint) as last_ln, cast(count(*) as bigint) as n from short group by doc_id, island having count(*) >= 5""",
    # Position by thirds.
    "position_thirds": """
with lines as $LINES$, p as (select doc_id, 3 * (ln - 1) as x, count(*) over (partition by doc_id) as n from lines)
select case when x < n then 'start' when x < 2 * n then 'middle' else 'end' end as part, cast(count(*) as bigint) as n from p group by 1""",
    # Batches of 150 sections.
    "section_batches": """
with lines as $LINES$, b as (select doc_id, cast(floor((row_number() over (partition by doc_id order by ln) - 1) / 150) as bigint) as batch, length(line) as n from lines) select doc_id, batch, cast(count(*) as bigint) as lines, cast(sum(n) as bigint) as chars from b group by doc_id, batch""",
    # The block before, and the characters around.
    "antecedents": """
with lines as $LINES$ select doc_id, ln, lag(line) over (partition by doc_id order by ln) as before, cast(sum(length(line)) over (partition by doc_id order by ln rows between 2 preceding and 1 following) as bigint) as around from lines""",
    # Two runs side by side.
    "devset_diff": """
with a as (select l_orderkey, sum(l_quantity) as q from lineitem where l_returnflag <> 'A' group by l_orderkey), b as (select l_orderkey, sum(l_quantity) as q from lineitem where l_returnflag <> 'R' group by l_orderkey)
select coalesce(a.l_orderkey, b.l_orderkey) as k, a.q as was, b.q as now from a full outer join b on a.l_orderkey = b.l_orderkey where a.q is distinct from b.q""",
    # Facts found on the page or one beside it.
    "wrong_place_guard": """
select g.l_orderkey, g.l_linenumber as gold, p.l_linenumber as found from lineitem g join lineitem p on g.l_orderkey = p.l_orderkey and abs(g.l_linenumber - p.l_linenumber) <= 1 and g.l_returnflag = 'R' and p.l_returnflag = 'A'""",
    # Files of equal content; the first one stays.
    "duplicate_files": """
with h as (select doc_id, md5(text) as h from documents), f as (select doc_id, h, min(doc_id) over (partition by h) as first_id, count(*) over (partition by h) as n from h) select doc_id, first_id, cast(n as bigint) as copies from f where doc_id <> first_id""",
    # Bands of gain and their upper median.
    "gain_bands": """
with c as (select source, n_chars, row_number() over (partition by source order by n_chars, doc_id) as r, count(*) over (partition by source) as n from documents)
select source, max(case when r = floor(n / 2) + 1 then n_chars end) as upper_median, cast(count(case when n_chars < 1000 then 1 end) as bigint) as small, cast(count(case when n_chars >= 1000 and n_chars < 5000 then 1 end) as bigint) as medium, cast(count(case when n_chars >= 5000 then 1 end) as bigint) as large from c group by source""",
    # Confidence as the least part, cost by tokens.
    "confidence_cost": """
select event_id, least(greatest(value / 100.0, 0.0), 1.0, case when event_type = 'error' then 0.5 else 1.0 end) as confidence, round(value * 0.36e-6 + user_id * 0.40e-6, 12) as cost from events""",
    # Union, intersection and difference of facts.
    "set_operations": """
with a as (select l_partkey from lineitem where l_returnflag = 'A'), r as (select l_partkey from lineitem where l_returnflag = 'R')
select 'both' as part, l_partkey from (select l_partkey from a intersect select l_partkey from r) x union all select 'only_a', l_partkey from (select l_partkey from a except select l_partkey from r) y union all select 'any', l_partkey from (select l_partkey from a union select l_partkey from r) z""",
    # The latest stored copy of a document.
    "latest_copy": """
with r as (select o_custkey, o_orderkey, o_totalprice, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as r from orders) select o_custkey, o_orderkey, o_totalprice from r where r = 1""",
    # Ids without a result.
    "missing_ids": """
select d.doc_id from documents d left join labels l on d.doc_id = l.doc_id where l.doc_id is null""",
    # The last manufacturer of a product wins.
    "manufacturer": """
with r as (select l_partkey, l_suppkey, row_number() over (partition by l_partkey order by l_orderkey desc, l_linenumber desc) as r from lineitem) select p_partkey, s_name from part left join r on p_partkey = l_partkey and r = 1 left join supplier on l_suppkey = s_suppkey""",
    # Sessions of calls with a gap of half an hour.
    "idle_sessions": """
with e as (select user_id, ts, event_id, case when lag(ts) over (partition by user_id order by ts, event_id) is null or ts > lag(ts) over (partition by user_id order by ts, event_id) + interval '30' minute then 1 else 0 end as fresh from events),
s as (select user_id, sum(fresh) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as session from e) select user_id, cast(session as bigint) as session, cast(count(*) as bigint) as n from s group by user_id, session""",
    # AG4: counts in a fixed order of buckets, zeros kept.
    "category_buckets": """
with b as (select 1 as k, 'AUTOMOBILE' as name union all select 2, 'BUILDING' union all select 3, 'MACHINERY' union all select 4, 'AEROSPACE') select k, name, cast(count(c_custkey) as bigint) as n from b left join customer on c_mktsegment = name group by k, name""",
}


#: $JOIN(value;separator;order)$: an ordered concatenation.
JOIN = re.compile(r"\$JOIN\((.+?);('.+?');(.+?)\)\$")


def render(sql: str, dialect: int) -> str:
    for name, forms in MACROS.items():
        sql = sql.replace(name, forms[dialect])
    sql = JOIN.sub((r"listagg(\1, \2) within group (order by \3)", r"string_agg(\1, \2 order by \3)")[dialect], sql)
    return sql.replace(", '', 'g')", ", '')") if dialect == 0 else sql


def runner(text: str) -> Callable[[SparkSession, str], DataFrame]:
    """The query over a folder's tables; they are named inside it alone, so that a session's own views stay as they are."""
    used = [t for t in TABLES if re.search(rf"\b{t}\b", text)]
    recursive, rest = re.fullmatch(r"(?s)\s*(?:with\s+(recursive\s)?)?(.*)", text).groups()
    follows = ", " if re.match(r"\s*with\b", text) else " "

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        views = {t: f"millrace_{t}_{uuid.uuid4().hex}" for t in used}
        for t, view in views.items():
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(view)
        try:
            named = ", ".join(f"{t} as (select * from {view})" for t, view in views.items())
            return spark.sql(f"with {recursive or ''}{named}{follows}{rest}")
        finally:
            for view in views.values():
                spark.catalog.dropTempView(view)

    return query


QUERIES = {name: runner(render(sql, 0)) for name, sql in SQL.items()}
ORACLES = {name: render(sql, 1) for name, sql in SQL.items()}
