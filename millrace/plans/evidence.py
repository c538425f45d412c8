"""Relational operators on evidence, layout lines, catalogues and evaluation, in SQL for both engines; PAIRS where the engines' array functions differ."""

from __future__ import annotations

from millrace.plans import relational

SQL = {
    # K9: numbered lines for annotators.
    "numbered_view": """
with lines as $LINES$ select doc_id, ln, concat(lpad(cast(ln as varchar(20)), cast(greatest(4, length(cast(ln as varchar(20)))) as int), ' '), '  ', line) as shown from lines""",
    # F8: why a page is not fetched.
    "prefetch_skip": """
select page_id, case when html is null then 'missing' when html not like '%<%' then 'no_html' when length(html) > 30000000 then 'too_big' else 'ok' end as reason from pages""",
    # All reasons to review a document, and none else.
    "review_reasons": """
with r as (select doc_id, concat_ws(',', case when length(trim(text)) = 0 then 'no_text' end, case when n_chars > 20000 then 'large' end, case when lang <> 'en' then 'language' end, case when regexp_extract(text, '[0-9]{5}', 0) <> '' then 'numbers' end) as reasons from documents) select doc_id, reasons from r where reasons <> ''""",
    # H7: rows of wide tables keyed by their headers, two-column ones as label and value.
    "keyed_rows": """
with cells as (select p_brand as tab, 0 as r, c, h as v from (select distinct p_brand from part) b cross join (select 0 as c, 'Type' as h union all select 1, 'Size' union all select 2, 'Price') hs
  union all select p_brand, p_partkey, 0, p_type from part union all select p_brand, p_partkey, 1, cast(p_size as varchar(20)) from part union all select p_brand, p_partkey, 2, cast(cast(floor(p_retailprice) as bigint) as varchar(20)) from part),
head as (select tab, c, v as h from cells where r = 0), plain as (select tab, max(case when regexp_extract(v, '[0-9]', 0) <> '' then 1 else 0 end) as digits, count(*) as wide from cells where r = 0 group by tab),
body as (select cells.tab, r, cells.c, case when cells.c = 0 or digits = 1 or wide = 2 then v else concat(h, ': ', v) end as v from cells join head on cells.tab = head.tab and cells.c = head.c join plain on cells.tab = plain.tab where r > 0)
select tab, cast(r as bigint) as r, $JOIN(v;' | ';c)$ as line from body group by tab, r""",
    # Kind of a line.
    "line_kinds": """
with lines as $LINES$ select doc_id, ln, case when trim(line) = '' then 'blank' when regexp_extract(line, '^[-+]?[0-9][0-9.,]*$', 0) <> '' then 'num' when regexp_extract(line, '^[-+]?[0-9][0-9.,]* ?[A-Za-z/%]{1,5}$', 0) <> '' then 'valunit'
  when regexp_extract(line, '^[-*] ', 0) <> '' then 'list' when length(line) < 40 and line not like '%.' then 'label' else 'text' end as kind from lines""",
    # Lines owned by the last heading above them.
    "heading_owner": """
with lines as $LINES$, h as (select doc_id, ln, line, case when length(line) between 1 and 40 and line not like '%.' then 1 else 0 end as head from lines),
s as (select *, sum(head) over (partition by doc_id order by ln rows between unbounded preceding and current row) as sec from h)
select doc_id, ln, max(case when head = 1 then line end) over (partition by doc_id, sec) as heading, cast(sec as bigint) as sec from s""",
    # M7: lines between the first and the last long line, three around.
    "content_region": """
with lines as $LINES$, a as (select *, min(case when length(line) >= 80 then ln end) over (partition by doc_id) as lo, max(case when length(line) >= 80 then ln end) over (partition by doc_id) as hi from lines)
select doc_id, ln, line from a where ln between lo - 3 and hi + 3""",
    # Lines of a document and its benchmark passages, each once.
    "line_union": """
with lines as $LINES$ select source, lower(line) as line, cast(min(doc_id) as bigint) as first_doc from lines where trim(line) <> '' group by source, lower(line)""",
    # Shares of letters, digits and capitals.
    "text_quality": """
select doc_id, round(cast(length(regexp_replace(text, '[^a-zA-Z]', '', 'g')) as double) / greatest(1, length(text)), 3) as letters, round(cast(length(regexp_replace(text, '[^0-9]', '', 'g')) as double) / greatest(1, length(text)), 3) as digits, round(cast(length(regexp_replace(text, '[^A-Z]', '', 'g')) as double) / greatest(1, length(text)), 3) as capitals from documents""",
    # Runs of leaders with rising pages are contents, others labels with values.
    "dot_leaders": """
with l as (select l_orderkey as doc, l_linenumber as ln, l_suppkey as page, l_linenumber - row_number() over (partition by l_orderkey order by l_linenumber, l_suppkey) as island from lineitem where l_returnflag <> 'A'),
d as (select *, case when page < lag(page) over (partition by doc, island order by ln, page) then 1 else 0 end as falls from l),
g as (select doc, island, count(*) as n, sum(falls) as falls, count(distinct page) as pages from d group by doc, island)
select d.doc, d.ln, case when g.n >= 4 and g.falls = 0 and g.pages >= 3 then 'navigation' else 'value' end as kind from d join g on d.doc = g.doc and d.island = g.island""",
    # Runs of following pages with one text source.
    "ocr_windows": """
with p as (select l_orderkey as doc, l_linenumber as page, l_returnflag = 'R' as ocr, l_linenumber - row_number() over (partition by l_orderkey, l_returnflag = 'R' order by l_linenumber) as island from lineitem)
select doc, ocr, min(page) as first_page, max(page) as last_page from p group by doc, ocr, island""",
    # Tables without header take the last one's before them.
    "table_carry": """
with t as (select o_custkey as doc, o_orderkey as tab, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as pos, case when o_orderstatus = 'F' then o_orderpriority end as header from orders),
i as (select *, sum(case when header is not null then 1 else 0 end) over (partition by doc order by pos rows between unbounded preceding and current row) as k from t)
select doc, tab, header is null as continued, max(header) over (partition by doc, k) as header from i""",
    # Documents by flag, share and first example.
    "flag_prevalence": """
with f as (select doc_id, 'digits' as flag from documents where regexp_extract(text, '[0-9]', 0) <> '' union all select doc_id, 'mail' from documents where text like '%@%' union all select doc_id, 'long' from documents where n_chars > 5000 union all select doc_id, 'foreign' from documents where lang <> 'en')
select flag, cast(count(*) as bigint) as files, round(100.0 * cast(count(*) as double) / max(t.n), 2) as pct, min(doc_id) as example from f cross join (select count(*) as n from documents) t group by flag""",
    # Route of a document and its kind, hints only where the type is open.
    "document_kind": """
select doc_id, case when n_chars < 200 then 'vision' when n_chars > 20000 then 'windows' else 'text' end as route, case when quality = 1 then 'product_sheet' when toxic = 1 then 'news' when lang = 'en' then 'tender' else 'other' end as kind from documents left join labels using (doc_id)""",
    # Where a line stands in its text, from 0.
    "quote_spans": """
with lines as $LINES$, q as (select doc_id, min(case when length(line) > 20 then line end) as quote from lines group by doc_id)
select d.doc_id, cast(instr(text, quote) - 1 as bigint) as a, cast(instr(text, quote) - 1 + length(quote) as bigint) as b from documents d join q on d.doc_id = q.doc_id where quote is not null""",
    # Whole-word mentions of names by document, 60 at most.
    "mention_scan": """
with w as (select doc_id, word, count(*) as n from $WORDS$ x group by doc_id, word), b as (select item_id, word from (select item_id, regexp_extract(lower(text), '([a-z]{7,})', 1) as word from benchmark) y where word <> ''),
r as (select item_id, doc_id, n, row_number() over (partition by item_id order by n desc, doc_id) as r from w join b using (word)) select item_id, doc_id, cast(n as bigint) as n from r where r <= 60""",
    # U4: a x b as calibre, multiplier or composite.
    "axb_class": """
with s as (select p_partkey, concat(cast(p_size as varchar(20)), case when p_partkey % 3 = 0 then 'x51mm' when p_partkey % 3 = 1 then ' x 30 mm' else ' x 20 x 10 mm' end) as t from part)
select p_partkey, t, case when regexp_extract(t, 'x.*x', 0) <> '' then 'composite' when regexp_extract(t, '^[0-9.]+x[0-9]+mm$', 0) <> '' then 'calibre' when cast(regexp_extract(t, '^([0-9]+)', 1) as int) <= 12 then 'multiplier' else 'composite' end as kind from s""",
    # Comparator of a bound's words.
    "comparators": """
with s as (select p_partkey, concat(case p_partkey % 6 when 0 then 'up to ' when 1 then 'over ' when 2 then 'at least ' when 3 then 'max ' when 4 then 'about ' else '' end, cast(p_size as varchar(20)), ' km') as t from part)
select p_partkey, case when t like 'up to %' or t like 'max %' then 'up_to' when t like 'over %' then 'greater' when t like 'at least %' then 'at_least' when t like 'about %' then 'approx' else 'exact' end as comparator, cast(regexp_extract(t, '([0-9]+)', 1) as bigint) as v from s""",
    # Labels whose bracketed unit agrees with the value's dimension.
    "label_unit_fit": """
with s as (select p_partkey, case p_partkey % 3 when 0 then 'Weight (kg)' when 1 then 'Length (mm)' else 'Crew' end as label, case p_size % 2 when 0 then 'mass' else 'length' end as dim from part),
u as (select *, case regexp_extract(label, '[(]([a-z]+)[)]', 1) when 'kg' then 'mass' when 'mm' then 'length' end as want from s) select p_partkey, label, dim, want, want is null or want = dim as fits from u""",
    # Date in a URL; an impossible day gives none, without trying the month.
    "url_dates": """
with u as (select l_orderkey, l_linenumber, concat('https://news.example.org/', case when l_linenumber = 1 then replace(cast(cast(l_shipdate as date) as varchar(20)), '-', '/') when l_linenumber = 2 then '2024/13/45' when l_linenumber = 3 then substr(replace(cast(cast(l_shipdate as date) as varchar(20)), '-', '/'), 1, 7) else 'item' end, '/a.html') as url from lineitem),
x as (select *, regexp_extract(url, '/([12][0-9]{3})/[0-9]{1,2}/[0-9]{1,2}/', 1) as y, regexp_extract(url, '/[12][0-9]{3}/([0-9]{1,2})/[0-9]{1,2}/', 1) as m, regexp_extract(url, '/[12][0-9]{3}/[0-9]{1,2}/([0-9]{1,2})/', 1) as d, regexp_extract(url, '/([12][0-9]{3}/[0-9]{2})/', 1) as ym from u)
select l_orderkey, l_linenumber, case when y <> '' then cast(try_cast(concat(y, '-', m, '-', d) as date) as varchar(20)) when ym <> '' then replace(ym, '/', '-') end as day from x""",
    # T5: how often a witness agrees with the URL's date.
    "witness_accuracy": """
with w as (select o_orderkey, cast(o_orderdate as date) as u, min(cast(l_shipdate as date)) as h, max(cast(l_shipdate as date)) as t from orders join lineitem on l_orderkey = o_orderkey group by o_orderkey, o_orderdate)
select cast(count(*) as bigint) as n, cast(count(case when h = u then 1 end) as bigint) as h_day, cast(count(case when t = u then 1 end) as bigint) as t_day, cast(count(case when extract(year from h) = extract(year from u) then 1 end) as bigint) as h_year from w""",
    # What became of values judged missing.
    "recover_status": """
with e as (select d.doc_id, max(case when l.quality = 1 then 1 else 0 end) as on_page, max(case when l.toxic = 1 then 1 else 0 end) as had from documents d left join labels l on d.doc_id = l.doc_id group by d.doc_id)
select doc_id, case when had = 1 then 'already' when on_page = 0 then 'no proof' else 'added' end as status from e""",
    # A local copy before a remote one.
    "local_copy_first": """
select d.doc_id, case when l.doc_id is not null then 'local' else 'remote' end as place from documents d left join (select distinct doc_id from labels) l on d.doc_id = l.doc_id""",
    # AG12, AG16, AG17: coverage of facts and share on a wrong owner.
    "coverage": """
select l_linestatus, l_returnflag, cast(count(*) as bigint) as facts, cast(count(distinct l_partkey) as bigint) as products, round(cast(count(case when l_discount > 0.05 then 1 end) as double) / count(*), 6) as wrong_rate from lineitem group by l_linestatus, l_returnflag""",
    # AG15, E28: labels in three documents or more become proposals, with the curated decision.
    "proposals": """
with p as (select p_type as label, count(distinct p_brand) as docs, count(*) as n from part group by p_type having count(distinct p_brand) >= 3), d as (select 'ECONOMY' as head, 'merge' as decision union all select 'PROMO', 'reject' union all select 'STANDARD', 'promote')
select label, cast(docs as bigint) as docs, cast(n as bigint) as n, coalesce(decision, 'open') as decision from p left join d on upper(regexp_extract(label, '^([A-Za-z]+)', 1)) = head""",
    # AG20: type of an entity by majority, ties to the smaller name.
    "entity_votes": """
with v as (select l_partkey, l_returnflag, count(*) as n, min(l_orderkey) as seen from lineitem group by l_partkey, l_returnflag), r as (select *, row_number() over (partition by l_partkey order by n desc, l_returnflag) as r, min(seen) over (partition by l_partkey) as first_seen from v)
select l_partkey, l_returnflag as entity_type, cast(n as bigint) as votes, first_seen from r where r = 1""",
    # Five documents of each source and language at most.
    "source_quota": """
with r as (select doc_id, source, lang, row_number() over (partition by source, lang order by md5(cast(doc_id as varchar(20)))) as r from documents) select doc_id, source, lang from r where r <= 5""",
    # Densest batches first.
    "densest_first": """
with lines as $LINES$, b as (select doc_id, cast(floor((ln - 1) / 10) as bigint) as chunk, sum(length(regexp_replace(line, '[^0-9]', '', 'g'))) as digits, sum(length(line)) as n from lines group by 1, 2)
select doc_id, chunk, cast(row_number() over (partition by doc_id order by cast(digits as double) / greatest(1, n) desc, chunk) as bigint) as place from b""",
    # Entities near a fact in order of kind, 40 at most.
    "local_entities": """
with c as (select o_custkey as sec, l_partkey as entity, min(case l_returnflag when 'N' then 0 when 'A' then 1 else 2 end) as pref from orders join lineitem on l_orderkey = o_orderkey group by o_custkey, l_partkey),
r as (select *, row_number() over (partition by sec order by pref, entity) as r from c) select sec, entity, pref from r where r <= 40""",
    # A catalogue with additions and removals.
    "catalogue_extension": """
select n_name as param from nation where n_regionkey <> 3 union select concat('ext_', r_name) from region""",
    # Conditions of a fact as one sorted key.
    "applicability_key": """
select l_orderkey, $JOIN(concat('line', cast(l_linenumber as varchar(20)), '=', l_returnflag);';';concat('line', cast(l_linenumber as varchar(20)), '=', l_returnflag))$ as akey from lineitem group by l_orderkey""",
    # Whether parameter and unit of a match are right.
    "param_outcomes": """
select l_returnflag, case when l_linestatus = 'F' and l_discount < 0.03 then 'correct' when l_discount < 0.06 then 'dynamic_ok' when l_tax > 0.05 then 'wrong_canonical' else 'dynamic_other' end as outcome, cast(count(*) as bigint) as n from lineitem group by 1, 2""",
    # Matches by value alone and with the product.
    "old_key_compare": """
select cast(count(*) as bigint) as n, cast(count(case when s_nationkey is not null then 1 end) as bigint) as value_only, cast(count(case when s_nationkey = c_nationkey then 1 end) as bigint) as with_product
from orders join customer on c_custkey = o_custkey join lineitem on l_orderkey = o_orderkey left join supplier on s_suppkey = l_suppkey and s_acctbal > 0""",
    # Lines of the ranges a key names.
    "gold_text": """
with lines as $LINES$, g as (select doc_id, 2 as a, 4 as b from documents union all select doc_id, 4, 6 from documents) select distinct lines.doc_id, ln, line from lines join g on lines.doc_id = g.doc_id and ln between a and b""",
    # Documents that hold four fifths of a key's distinct words.
    "usable_keys": """
with k as (select distinct item_id, word from $ITEMWORDS$ x), n as (select item_id, count(*) as n from k group by item_id),
h as (select item_id, doc_id, count(*) as hit from k join (select distinct doc_id, word from $WORDS$ y) w using (word) group by item_id, doc_id) select h.item_id, doc_id, cast(hit as bigint) as hit, cast(n as bigint) as n from h join n on h.item_id = n.item_id where 5 * hit >= 4 * n""",
    # New dates only where the old ones are missing.
    "backfill_dates": """
select o_orderkey, cast(coalesce(min(case when l_returnflag = 'R' then cast(l_shipdate as date) end), cast(o_orderdate as date)) as varchar(20)) as day from orders left join lineitem on l_orderkey = o_orderkey group by o_orderkey, o_orderdate""",
    # Corrections of owner that go back.
    "revert_corrections": """
select l_orderkey, l_linenumber, case when l_returnflag = 'R' and (p_size < 10 or l_discount > 0.08) then l_suppkey else l_partkey end as owner from lineitem join part on p_partkey = l_partkey""",
    # Conjunctive filter and free text over several columns.
    "results_filter": """
select p_brand, p_type, cast(count(*) as bigint) as n from part where p_size between 5 and 40 and lower(concat_ws(' ', p_name, p_brand, p_type)) like '%e%' group by p_brand, p_type""",
    # The latest cached answer to a request.
    "response_cache": """
with e as (select event_id, md5(concat(event_type, ':', cast(user_id as varchar(20)))) as req, value, ts from events), r as (select *, row_number() over (partition by req order by ts, event_id) as r from e)
select event_id, req, r > 1 as hit from r""",
}

#: (Spark SQL, DuckDB SQL)
PAIRS = {
    # S3: a page list such as 4-7,51 as pages.
    "page_ranges": (
        """with s as (select p_partkey, concat(cast(p_size as string), '-', cast(p_size + 2 as string), ',', cast(p_size + 9 as string)) as spec from part)
select p_partkey, explode(flatten(transform(split(spec, ','), x -> sequence(cast(split(x, '-')[0] as bigint), cast(element_at(split(x, '-'), -1) as bigint))))) as page from s""",
        """with s as (select p_partkey, concat(p_size, '-', p_size + 2, ',', p_size + 9) as spec from part)
select p_partkey, unnest(flatten(list_transform(string_split(spec, ','), lambda x: generate_series(cast(string_split(x, '-')[1] as bigint), cast(string_split(x, '-')[-1] as bigint))))) as page from s""",
    ),
    # Lines with a part that the text lacks.
    "novel_lines": (
        """with s as (select p_partkey, concat(p_brand, ': ', p_type) as line, lower(concat(p_type, if(p_partkey % 2 = 0, p_brand, ''))) as t from part)
select p_partkey, line from s where not forall(split(line, '[:|]'), p -> trim(p) = '' or instr(t, lower(trim(p))) > 0)""",
        """with s as (select p_partkey, concat(p_brand, ': ', p_type) as line, lower(concat(p_type, case when p_partkey % 2 = 0 then p_brand else '' end)) as t from part)
select p_partkey, line from s where len(list_filter(regexp_split_to_array(line, '[:|]'), lambda p: trim(p) <> '' and instr(t, lower(trim(p))) = 0)) > 0""",
    ),
    # B1: spans of the values of a row text.
    "value_spans": (
        """with s as (select p_partkey, concat('Size: ', cast(p_size as string), '; Brand: ', p_brand, '; Type: ', p_type) as t from part),
x as (select p_partkey, p, part from s lateral view posexplode(split(t, '; ')) e as p, part), o as (select *, sum(length(part) + 2) over (partition by p_partkey order by p) - length(part) - 2 as off from x)
select p_partkey, substring_index(part, ': ', 1) as label, off + instr(part, ': ') + 1 as a, off + length(part) as b from o""",
        """with s as (select p_partkey, concat('Size: ', p_size, '; Brand: ', p_brand, '; Type: ', p_type) as t from part),
x as (select p_partkey, i as p, part from s, unnest(string_split(t, '; ')) with ordinality as e(part, i)), o as (select *, sum(length(part) + 2) over (partition by p_partkey order by p) - length(part) - 2 as off from x)
select p_partkey, string_split(part, ': ')[1] as label, cast(off + instr(part, ': ') + 1 as bigint) as a, cast(off + length(part) as bigint) as b from o""",
    ),
    # Lists of two parts or more as single values.
    "list_split": (
        "select p_partkey, pos + 1 as part, value from part lateral view posexplode(split(p_name, ' ')) e as pos, value where size(split(p_name, ' ')) >= 2 and length(value) between 2 and 120",
        "select p_partkey, cast(i as int) as part, value from part, unnest(string_split(p_name, ' ')) with ordinality as e(value, i) where len(string_split(p_name, ' ')) >= 2 and length(value) between 2 and 120",
    ),
    # Label pairs that share words, and the words left.
    "label_overlap": (
        """with s as (select p_partkey, split(lower(p_type), ' ') as a, split(lower(p_name), ' ') as b from part)
select p_partkey, cast(size(array_intersect(a, b)) as bigint) as same, array_join(array_sort(array_except(a, b)), ' ') as rest from s""",
        """with s as (select p_partkey, string_split(lower(p_type), ' ') as a, string_split(lower(p_name), ' ') as b from part)
select p_partkey, cast(len(list_intersect(a, b)) as bigint) as same, coalesce(array_to_string(list_sort(list_distinct(list_filter(a, lambda x: not list_contains(b, x)))), ' '), '') as rest from s""",
    ),
    # Five nearest by cosine, in double precision, of every fiftieth vector. Queries are dealt to 16 blocks, which all rows meet in turn.
    "cosine_topk": (
        """with q as (select pmod(hash(vec_id), 16) as block, vec_id as qid, transform(embedding, x -> cast(x as double)) as qe from embeddings where vec_id % 50 = 0),
e as (select vec_id, transform(embedding, x -> cast(x as double)) as v, explode(sequence(0, 15)) as block from embeddings),
s as (select qid, vec_id, round(aggregate(zip_with(qe, v, (x, y) -> x * y), 0d, (a, x) -> a + x) / sqrt(aggregate(qe, 0d, (a, x) -> a + x * x) * aggregate(v, 0d, (a, x) -> a + x * x)), 6) as score from q join e on q.block = e.block and qid <> vec_id),
r as (select *, row_number() over (partition by qid order by score desc, vec_id) as place from s) select qid, vec_id, score, cast(place as bigint) as place from r where place <= 5""",
        """with e as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings), s as (select a.vec_id as qid, b.vec_id, round(list_cosine_similarity(a.v, b.v), 6) as score from e a join e b on a.vec_id <> b.vec_id and a.vec_id % 50 = 0),
r as (select *, row_number() over (partition by qid order by score desc, vec_id) as place from s) select qid, vec_id, score, place from r where place <= 5""",
    ),
}

QUERIES = {n: relational.runner(relational.render(s, 0)) for n, s in SQL.items()} | {n: relational.runner(p[0]) for n, p in PAIRS.items()}
ORACLES = {n: relational.render(s, 1) for n, s in SQL.items()} | {n: p[1] for n, p in PAIRS.items()}
