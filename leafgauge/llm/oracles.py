"""DuckDB SQL for the queries that SQL can express, written from the contracts, not from the operators.

Only the licence texts themselves are the operator's."""

from __future__ import annotations

from .licences import BASE, TEMPLATES

SPACE = "[^\\x20\\x09-\\x0D]+"
LOWERED = "translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz')"

_base = "\nunion all\n".join(
    f"select d.doc_id, '{label}' as label, (i - 1)::bigint as pos from d, unnest(generate_series(1, len(w))) as u(i) where " + " and ".join(f"w[i + {j}] = '{x}'" for j, x in enumerate(phrase.split()))
    for phrase, label in BASE
)
_template = ", ".join(f"({t}, '{label}', string_split('{passage}', ' '), string_split('{key}', ' '))" for t, (label, passage, key) in enumerate(TEMPLATES))

# A template is found where its key phrase stands and half of its words at least stand at their places beside it.
LICENCES = f"""
with d as materialized (select doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
t(t, label, words, key) as (values {_template}),
tk as materialized (select *, list_filter(range(1, len(words) + 1), lambda i: words[i:i + len(key) - 1] = key)[1] as pos0 from t),
spot as (select doc_id, tk.t, label, i - pos0 as d, w, words from d, unnest(generate_series(1, len(w))) as u(i), tk where w[i] = key[1] and w[i:i + len(key) - 1] = key),
seen as (select doc_id, label, len(list_filter(range(1, len(words) + 1), lambda i: d + i >= 1 and w[d + i] = words[i])) / len(words)::double as cover from spot),
found as (select doc_id, label, cover from seen where cover >= 0.5),
base as ({_base}),
b as (select doc_id, count(*) as n_base, min(pos) as first_word, max(pos) as last_word, string_agg(distinct label, ',' order by label) as base_labels from base group by 1),
l as (select doc_id, string_agg(distinct label, ',' order by label) as labels from (select doc_id, label from base union select doc_id, label from found) group by 1),
c as (select doc_id, max(cover) as cover from found group by 1)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word, last_word, coalesce(base_labels, '') as base_labels,
  coalesce(labels, '') as labels, case when n_base > 0 then 1.0::double else coalesce(cover, 0.0)::double end as score
from d left join b using (doc_id) left join l using (doc_id) left join c using (doc_id)
"""

SUBSTRINGS = f"""
with d as materialized (select doc_id, regexp_extract_all(coalesce(text, ''), '{SPACE}') as w from documents),
win as materialized (select doc_id, i, array_to_string(w[i:i + 12], ' ') as s from d, unnest(generate_series(1, len(w) - 12)) as u(i)),
hit as (select doc_id, i from (select doc_id, i, min(doc_id) over (partition by s) as o from win) where o < doc_id),
gone as (select distinct doc_id, i + j as p from hit, unnest(generate_series(0, 12)) as u(j)),
word as (select doc_id, i, w[i] as x from d, unnest(generate_series(1, len(w))) as u(i)),
kept as (select doc_id, string_agg(x, ' ' order by i) as t, count(*) as n from word anti join gone on gone.doc_id = word.doc_id and gone.p = word.i group by 1)
select d.doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256 from d left join kept using (doc_id)
"""

PRODUCTS = """
with v as materialized (select vec_id, [floor(64 * x::double)::bigint for x in embedding] as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.e::double[], c.e::double[])::bigint as score from v q, v c where q.vec_id % 20 = 0 and c.vec_id <> q.vec_id)
select query_id, rank::int as rank, vec_id, score from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 20
"""

NEAR = f"""
with recursive d as materialized (select doc_id, regexp_extract_all({LOWERED}, '{SPACE}') as w from documents),
sh as materialized (select distinct doc_id, array_to_string(w[i:i + 3], ' ') as s from d, unnest(generate_series(1, greatest(least(len(w), 1), len(w) - 3))) as u(i)),
n as materialized (select doc_id, count(*)::bigint as n from sh group by 1),
pair as (select a.doc_id as a, b.doc_id as b, count(*) as k from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
link as materialized (select a, b from pair join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)),
both_ways as materialized (select a, b from link union all select b, a from link),
reach(a, b) as (select a, b from both_ways union select reach.a, e.b from reach join both_ways e on e.a = reach.b),
comp as (select a, least(a, min(b)) as c from reach group by a)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(c, d.doc_id)::bigint as component_id, coalesce(c, d.doc_id) = d.doc_id as kept
from d left join n using (doc_id) left join comp on comp.a = d.doc_id
"""

MIXING = f"""
with d as materialized (select doc_id, source, coalesce(len(regexp_extract_all(text, '{SPACE}')), 0)::bigint as size, md5('mix:' || doc_id::varchar) as h from documents),
s as (select *, [5, 2, 1][(si % 3 + 1)::int]::bigint as w, 3 * source_size as cap from (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as si from d group by 1)),
o as (select *, cap / w::double as r, (sum(source_size) over () - coalesce(sum(cap) over before, 0)) / (sum(w) over () - coalesce(sum(w) over before, 0))::double as x
  from s window before as (order by cap / w::double, si rows between unbounded preceding and 1 preceding)),
x as (select min_by(x, (r, si)) as x from o where r >= x),
t as materialized (select si, source, source_size, coalesce(least(cap::double, w * x.x), cap::double) as target, least(round(coalesce(least(cap::double, w * x.x), cap::double))::bigint, cap) as quota from s, x),
q as materialized (select si, quota, source_size, (source_size + 511) // 512 as nb, (quota // source_size) * ((source_size + 511) // 512) + (quota % source_size + 511) // 512 as q,
  nullif(quota % source_size % 512, 0) as last from t where source_size > 0 and quota > 0),
span as (select si, (sum(q) over (order by si) - q) / (sum(q) over ())::double as lo, sum(q) over (order by si) / (sum(q) over ())::double as hi from q),
slot as (select i as slot, ((i % 2147483648) * 1327217885 % 2147483648) / 2147483648::double as u from (select unnest(range(sum(q)::bigint)) as i from q)),
dealt as (select slot, si, row_number() over (partition by si order by slot) - 1 as k from slot join span on u >= lo and u < hi),
m as (select si, count(*) as m from dealt group by 1),
late as (select (select sum(q) from q) + row_number() over (order by k, si) - 1 as slot, si, k from (select si, unnest(range(coalesce(m, 0), q::bigint)) as k from q left join m using (si))),
used as materialized (select slot, si, k % nb as block, case when k = q - 1 then last end as cut from (select * from dealt union all select * from late) join q using (si) where k < q),
l as materialized (select d.*, t.si, t.source_size, t.target, t.quota, sum(size) over (partition by d.source order by h, doc_id rows unbounded preceding) - size as start from d join t on d.source is not distinct from t.source),
part as (select doc_id, si, start, size, unnest(range((start // 512)::bigint, ((start + size - 1) // 512 + 1)::bigint)) as block from l where size > 0),
seen as (select doc_id, min(slot) as first_slot, count(*) as n_slots from part join used using (si, block)
  where least(start + size, block * 512 + coalesce(cut, 512)) > greatest(start, block * 512) group by 1)
select doc_id, size, source_size, target, first_slot::bigint as first_slot, coalesce(n_slots, 0)::bigint as n_slots,
  (case when source_size = 0 then 0 else (quota // source_size) * size + greatest(0, least(start + size, quota % source_size) - start) end)::bigint as taken from l left join seen using (doc_id)
"""

MARKUP, EDGES = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>", r"^[\s]+|[\s]+$"

LINES = f"""
with p as materialized (select page_id, coalesce(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1)), '') as host,
  list_filter(list_transform(string_split(regexp_replace(coalesce(html, ''), '{MARKUP}', chr(10), 'g'), chr(10)), lambda x: regexp_replace(x, '{EDGES}', '', 'g')), lambda x: x <> '') as lines from pages),
total as (select host, count(*) as pages from p group by 1),
often as (select host, line, count(distinct page_id) as n from p, unnest(lines) as u(line) group by 1, 2),
gone as (select host, list(line) as g from often join total using (host) where n >= 5 and n > 0.3 * pages group by 1),
k as (select page_id, p.host, lines, list_filter(lines, lambda x: not coalesce(list_contains(g, x), false)) as kept from p left join gone using (host))
select page_id, host, len(lines)::bigint as n_lines, (len(lines) - len(kept))::bigint as n_dropped, sha256(array_to_string(kept, chr(10))) as kept_sha256 from k
"""
