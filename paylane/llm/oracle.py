"""DuckDB counterparts, written plainly: all pairs within a length, inverted lists, recursive reachability."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# One edit of code points; the distance that DuckDB has counts bytes, of which one character has four at most.
_DIFFERS = "len(list_filter(range(1, a.n + 1), lambda i: substr(a.t, i, 1) <> substr(b.t, i, 1))) = 1"
_LEFT_OUT = "len(list_filter(range(1, {l}.n + 1), lambda i: left({l}.t, i - 1) || substr({l}.t, i + 1) = {s}.t)) > 0"
ONE_EDIT = f"""levenshtein(a.t, b.t) <= 4 and case when a.n = b.n then {_DIFFERS}
 when a.n > b.n then {_LEFT_OUT.format(l='a', s='b')} else {_LEFT_OUT.format(l='b', s='a')} end"""

LINE_DEDUP = f"""
with l as (select doc_id, no, line, trim(line) as t, length(trim(line)) as n
           from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as no from documents)),
 f as (select t, n, min((doc_id, no)) as first from l where n >= 1 group by t, n),
 near as (select distinct a.t from f a join (select *, n + d as other from f, (values (-1), (0), (1)) v(d)) b
          on a.n = b.other and a.t <> b.t and b.first < a.first and {ONE_EDIT}),
 marked as (select l.*, f.first is not null and ((l.doc_id, l.no) <> f.first or near.t is not null) as dropped
            from l left join f on l.t = f.t left join near on l.t = near.t)
select d.doc_id, cast(coalesce(len(string_split(d.text, chr(10))), 0) as bigint) as n_lines, coalesce(m.n_dropped, 0) as n_dropped,
       case when d.text is not null then sha256(coalesce(m.kept, '')) end as kept_sha256
from documents d left join (select doc_id, count(*) filter (dropped) as n_dropped, string_agg(line, chr(10) order by no) filter (not dropped) as kept
                            from marked group by doc_id) m on d.doc_id = m.doc_id
"""

NEAR_DEDUP = f"""
with recursive w as (select doc_id, regexp_extract_all({LOWERED}, '[^\\x20\\x09-\\x0D]+') as ws from documents),
 s as (select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) = 1 then [ws[1]]
         else list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) end) as sh from w),
 c as (select doc_id, count(*) as n from s group by 1),
 same as (select min(c.doc_id) as rep, list(c.doc_id) as members from c join (select doc_id, md5(string_agg(sh, chr(10) order by sh)) as h from s group by 1) using (doc_id) group by h),
 r as (select s.* from s join same on s.doc_id = same.rep),
 p as (select a.doc_id as x, b.doc_id as y, count(*) as shared from r a join r b on a.sh = b.sh and a.doc_id < b.doc_id group by 1, 2),
 link as (select x, y from p join c cx on cx.doc_id = x join c cy on cy.doc_id = y where 100 * shared >= 80 * (cx.n + cy.n - shared)),
 edge as (select x, y from link union select y, x from link union select rep, unnest(members) from same union select unnest(members), rep from same),
 reach as (select doc_id as x, doc_id as y from documents union select reach.x, edge.y from reach join edge on reach.y = edge.x)
select d.doc_id, cast(coalesce(c.n, 0) as bigint) as n_shingles, min(reach.y) as component_id, d.doc_id = min(reach.y) as kept
from documents d left join c using (doc_id) join reach on reach.x = d.doc_id group by d.doc_id, c.n
"""

_COUNTED = r"""select doc_id, source, lang, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as old,
 len(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]')) as new,
 coalesce(doc_id > min(doc_id) over (partition by text) and text is not null, false) as is_copy from documents"""
TOKEN_COUNTS = f"""
with c as ({_COUNTED}), left_over as (select * from c where not is_copy)
select source, lang, case when lang <> 'en' then 'marks-1' else 'words-1' end as version, cast(count(*) as bigint) as n_docs,
       cast(sum(case when lang <> 'en' then new else old end) as bigint) as n_tokens
from left_over group by 1, 2, 3
"""

DECONTAMINATION = f"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all({LOWERED}, '{WORD}') as ws from documents),
 b as (select item_id, regexp_extract_all({LOWERED}, '{WORD}') as ws from benchmark),
 win as (select distinct item_id, list_slice(ws, s, s + 9) as words, least(len(ws), 10) as n
         from (select item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) as s from b where len(ws) > 0)),
 cut as (select rid, s, n, list_slice(ws, s, s + n - 1) as words
         from (select rid, ws, n, unnest(range(1, len(ws) - n + 2)) as s from d, (select distinct n from win) where len(ws) >= n)),
 found as (select rid, s, cut.n, item_id from cut join win on cut.words = win.words),
 hit as (select rid, count(distinct pos) as n_hit from (select rid, unnest(range(s, s + n)) as pos from found) group by 1),
 items as (select rid, count(*) as n_items, string_agg(i, ',' order by i) as ids from (select distinct rid, cast(item_id as varchar) as i from found) group by 1)
select doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (rid) left join items using (rid)
"""

LEXICAL = f"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all({LOWERED}, '{WORD}') as ws from documents),
 b as (select row_number() over () as q, item_id, regexp_extract_all({LOWERED}, '{WORD}') as ws from benchmark),
 total as (select count(*) as n, sum(len(ws)) as l from d where len(ws) > 0),
 asked as (select q, term, count(*) as often from (select q, unnest(ws) as term from b) group by 1, 2),
 tf as (select rid, term, count(*) as tf from (select rid, unnest(ws) as term from d) where term in (select term from asked) group by 1, 2),
 weight as (select term, cast(floor(1000 * ln((2 * n + 2)::double / (2 * df + 1)::double)) as bigint) as w
            from (select term, count(*) as df from tf group by 1), total),
 damp as (select rid, doc_id, 25 + cast((75 * len(ws)::bigint * n) // l as bigint) as m from d, total),
 scored as (select q, rid, doc_id, cast(sum(often * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
            from asked join tf using (term) join weight using (term) join damp using (rid) group by 1, 2, 3),
 placed as (select *, row_number() over (partition by q order by score desc, doc_id) as rank from scored where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from placed join b using (q) where rank <= 10
"""
