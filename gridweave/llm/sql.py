"""DuckDB SQL for the rows of those queries that SQL can express. The others are tested against brute force."""

from __future__ import annotations

from . import quality

_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_RATIOS = ", ".join(f"('{k}', {s}, {str(low).lower()})" for k, (_, s, low) in quality.RATIOS.items())
_VALUES = ", ".join(f"struct_pack(ratio := '{k}', x := ({e.replace('/', '::double /')})::double)" for k, (e, _, _) in quality.RATIOS.items())

OP1 = rf"""
with w as (select doc_id, lang, source, coalesce(text, '') as text, coalesce({_WORDS}, []) as w from documents),
windows as (select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as n from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from w)),
repeats as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from windows where n > 1) group by doc_id),
lines as (select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines from (select doc_id, unnest(string_split(text, chr(10))) as line from w) where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id),
m as (select w.doc_id, lang, source, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(r.n, 0)::bigint as n_repeat_words,
  coalesce(n_lines, 0) as n_lines, length(regexp_replace(text, '[^\p{{Lu}}]', '', 'g')) as n_capitals, length(text) as n_chars from w left join repeats r using (doc_id) left join lines l on l.doc_id = w.doc_id),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m),
v as (select doc_id, lang, source, unnest([{_VALUES}], recursive := true) from b where not base_failed),
c as (select level, case when level < 2 then lang end as lang, case when level < 1 then source end as source, ratio, case when x > 0 then ceil(ln(x) / ln({quality.GAMMA})) end as bucket, count(*) as n from v, (select unnest([0, 1, 2]) as level) group by all),
q as (select *, sum(n) over (partition by level, lang, source, ratio order by bucket nulls first) as upto, sum(n) over (partition by level, lang, source, ratio) as number, coalesce(pow({quality.GAMMA}, bucket), 0) as x from c),
t as (select level, lang, source, ratio, any_value(number) as number, min(x) filter (upto >= number * 0.25) as q25, min(x) filter (upto >= number * 0.75) as q75 from q group by all),
f as (select t.*, q75 + {quality.REACH} * greatest(q75 - q25, spread) as high, case when low then q25 - {quality.REACH} * greatest(q75 - q25, spread) end as low_bound from t join (values {_RATIOS}) as r(ratio, spread, low) using (ratio)),
judged as (select v.doc_id, bool_and(v.x <= coalesce(case when f0.number >= {quality.LEAST} then f0.high end, case when f1.number >= {quality.LEAST} then f1.high end, f2.high) and v.x >= coalesce(case when f0.number >= {quality.LEAST} then f0.low_bound end, case when f1.number >= {quality.LEAST} then f1.low_bound end, f2.low_bound, -1e300)) as ok
  from v left join f f0 on f0.level = 0 and f0.lang is not distinct from v.lang and f0.source is not distinct from v.source and f0.ratio = v.ratio left join f f1 on f1.level = 1 and f1.lang is not distinct from v.lang and f1.ratio = v.ratio left join f f2 on f2.level = 2 and f2.ratio = v.ratio group by v.doc_id)
select b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and coalesce(ok, true) as kept from b left join judged using (doc_id)"""

OP2 = rf"""
with w as (select doc_id, coalesce({_WORDS}, []) as w from documents),
windows as (select doc_id, i, array_to_string(w[i:i + 12], ' ') as k from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from w)),
first as (select k, min(doc_id) as least from windows group by k),
gone as (select distinct doc_id, i + j as p from (select doc_id, i from windows join first using (k) where least < doc_id), (select unnest(range(0, 13)) as j)),
words as (select doc_id, unnest(range(1, len(w) + 1)) as p, unnest(w) as word from w),
kept as (select words.doc_id, string_agg(word, ' ' order by words.p) filter (gone.p is null) as text, count(gone.p) as n from words left join gone on gone.doc_id = words.doc_id and gone.p = words.p group by words.doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(text, '')) as kept_sha256 from w left join kept using (doc_id)"""

OP6 = rf"""
with recursive w as (select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, k from (select doc_id, unnest(case when len(w) = 0 then [] when len(w) = 1 then [w[1]] else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) as k from w)),
sizes as (select doc_id, count(*) as n from s group by doc_id),
links as (select a.doc_id as x, b.doc_id as y from s a join s b on a.k = b.k and a.doc_id < b.doc_id join sizes m on m.doc_id = a.doc_id join sizes o on o.doc_id = b.doc_id group by a.doc_id, b.doc_id, m.n, o.n having 100 * count(*) >= 80 * (m.n + o.n - count(*))),
edges as (select x, y from links union select y, x from links),
reach as (select x, y from edges union select r.x, e.y from reach r join edges e on r.y = e.x)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, least(d.doc_id, coalesce(l, d.doc_id)) as component_id, d.doc_id = least(d.doc_id, coalesce(l, d.doc_id)) as kept from documents d left join sizes using (doc_id) left join (select x as doc_id, min(y) as l from reach group by x) using (doc_id)"""

OP10 = rf"""
with d as (select doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
p as (select distinct item_id, m, array_to_string(w[i:i + m - 1], ' ') as k from (select item_id, w, least(10, len(w)) as m, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from b where len(w) > 0)),
found as (select doc_id, i, t.m, item_id from (select doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') as k from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as i from d, (select distinct m from p) where len(w) >= m)) t join p on p.m = t.m and p.k = t.k),
hit as (select doc_id, count(distinct i + j) as n from (select doc_id, i, unnest(range(0, m)) as j from found) group by doc_id),
items as (select doc_id, count(*) as n, string_agg(item, ',' order by item) as s from (select distinct doc_id, item_id::varchar as item from found) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(hit.n, 0)::bigint as n_hit, coalesce(items.n, 0)::bigint as n_items, sha256(coalesce(s, '')) as items_sha256, coalesce(hit.n, 0) > 0 as contaminated from d left join hit using (doc_id) left join items using (doc_id)"""
