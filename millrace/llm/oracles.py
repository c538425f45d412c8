"""DuckDB SQL for the queries that SQL can express."""

_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = """
with lines as (select doc_id, source, trim(l.line) as bare, l.line, l.i
               from (select doc_id, source, string_split(coalesce(text, ''), chr(10)) as ls from documents) d,
                    unnest(d.ls) with ordinality as l(line, i)),
bad as (select bare from lines where bare <> '' group by bare having count(distinct source) >= 8),
marked as (select lines.*, bad.bare is not null as is_bad from lines left join bad using (bare))
select doc_id, cast(count(*) filter (where bare <> '') as bigint) as n_lines, cast(count(*) filter (where is_bad) as bigint) as n_removed,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not is_bad), '')) as clean_sha256
from marked group by doc_id
"""

OP3 = rf"""
with items as (select item_id, regexp_extract_all({_LOW.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark where text is not null),
win as (select distinct item_id, least(10, len(w)) as n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') as k
        from items, unnest(range(1, len(w) - least(10, len(w)) + 2)) as t(i) where len(w) > 0),
docs as (select doc_id, coalesce(regexp_extract_all({_LOW.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w from documents),
spans as (select doc_id, i, lens.n as n, array_to_string(w[i : i + lens.n - 1], ' ') as k
          from docs, (select distinct n from win) as lens, unnest(range(1, greatest(len(w) - lens.n + 2, 1))) as t(i)),
hits as (select distinct spans.doc_id, spans.i, spans.n, win.item_id from spans join win on spans.n = win.n and spans.k = win.k),
words as (select doc_id, count(distinct p) as n_hit from hits, unnest(range(i, i + n)) as t(p) group by doc_id),
names as (select doc_id, count(*) as n_items, string_agg(name, ',' order by name) as names
          from (select distinct doc_id, cast(item_id as varchar) as name from hits) group by doc_id)
select docs.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
       sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join words using (doc_id) left join names using (doc_id)
"""

OP4 = rf"""
with recursive docs as (select doc_id, coalesce(regexp_extract_all({_LOW.format("text")}, '[^\x20\x09-\x0D]+'), []) as w from documents),
sh as (select distinct doc_id, array_to_string(w[i : i + 4], ' ') as s from docs, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as t(i) where len(w) > 0),
sizes as (select doc_id, count(*) as n from sh group by doc_id),
pairs as (select a.doc_id as x, b.doc_id as y, count(*) as k from sh a join sh b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
links as (select x, y from pairs join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * k >= 75 * (p.n + q.n - k)),
reach as (select doc_id as x, doc_id as y from docs union select reach.x, links.y from reach join links on reach.y = links.x)
select d.doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, c.component_id, d.doc_id = c.component_id as kept
from docs d left join sizes using (doc_id) join (select x, min(y) as component_id from reach group by x) c on c.x = d.doc_id
"""

OP9 = r"""
with rows as (select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
                     md5('mix:' || coalesce(cast(doc_id as varchar), '')) as key from documents),
src as (select source, cast(sum(size) as bigint) as source_size from rows group by source),
ranked as (select *, row_number() over (order by source nulls last) - 1 as rank, source_size * 2.0::double as cap from src),
weighed as (select *, case rank % 3 when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as weight from ranked),
levels as (select *, (sum(source_size) over () * 1.5::double - coalesce(sum(cap) over (order by cap / weight, rank rows between unbounded preceding and 1 preceding), 0))
                     / sum(weight) over (order by cap / weight, rank rows between current row and unbounded following) as level from weighed),
fixed as (select arg_min(level, (cap / weight, rank)) as level from levels where cap > level * weight),
goal as (select source, source_size, case when f.level is null then cap else least(cap, f.level * weight) end as target from levels left join fixed f on true),
running as (select rows.*, goal.source_size, goal.target, cast(round(goal.target) as bigint) as budget,
                   sum(size) over (partition by rows.source order by key, doc_id, size rows between unbounded preceding and current row) as until
            from rows join goal on rows.source is not distinct from goal.source)
select doc_id, size, source_size, target,
       cast(case when size = 0 then 0 else size * (budget // source_size) + greatest(0, least(size, budget % source_size - until + size)) end as bigint) as taken
from running
"""

ORACLES = {"op1_line_dedup": OP1, "op3_decontaminate": OP3, "op4_near_dup": OP4, "op9_mix": OP9}
