"""Page facts: spans from order lines and drawings from orders, sixteen orders to a page, built by the same SQL on both sides."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import geometry, layout
from .registry import query

_LINES = "select cast(floor(l_orderkey / 16.0) as bigint) as page, cast(l_orderkey % 16 as int) as line, cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) as int) as seg, l_partkey as a, l_suppkey as b, cast(l_quantity as int) as q, l_returnflag as f from {lineitem}"
_TEXT = "case a % 12 when 0 then '●​item w' || a when 1 then '3.​num [' || a || '] x' when 2 then '[Figure 1] w' || a when 3 then ' ​ ' when 4 then cast(q as varchar(9)) when 5 then '1.2.3 Head w' || a when 6 then '[label]' when 7 then 'Ends.' when 8 then 'b.​sub' || a else 'word' || a || ' two,' end"
_SPANS = f"""select page, line, seg, page * 1000 + line * 50 + seg as id, a, b, q, 72.0 + (seg - 1) * 60 + b % 3 as x0, 92.0 + (seg - 1) * 60 + b % 3 + q as x1, 40.0 * line + 20 + (a % 4) * 0.5 as y0, 40.0 * line + 28 + (a % 4) * 0.5 + b % 7 as y1,
8.5 + (a + b) % 6 as size, f = 'A' as bold, cast(b % 32 as int) as flags, case b % 4 when 0 then 0 when 1 then 6710886 when 2 then 16777215 else 1193046 end as color, case a % 5 when 0 then 'RobotoMono-Bold' when 1 then 'RobotoMono' else 'Sans' end as font, {_TEXT} as text from ({_LINES})"""
_DOUBLES = "select * replace (x0::double as x0, x1::double as x1, y0::double as y0, y1::double as y1, size::double as size)"
_RECTS = """select page, id, c, x0, y0, x0 + 10 + t % 300 as x1, y0 + 4 + t % 36 as y1, case c % 6 when 0 then '#aa0000' when 1 then '#d9ead3' when 2 then '#e8f0fe' when 3 then '#f3f3f3' when 4 then '#eeeeee' else '#ffffff' end as color
from (select cast(floor(o_orderkey / 16.0) as bigint) as page, o_orderkey as id, o_custkey as c, 60.0 + o_custkey % 200 as x0, 40.0 * (o_orderkey % 16) + 15 + o_custkey % 5 as y0, cast(floor(o_totalprice) as bigint) as t from {orders})"""
_fix = f"s as materialized ({_DOUBLES} from ({_SPANS.format(lineitem='lineitem')})), r as materialized (select * replace (x0::double as x0, x1::double as x1, y0::double as y0, y1::double as y1) from ({_RECTS.format(orders='orders')}))"
COLORS = {0: "#aa0000", 1: "#d9ead3", 2: "#e8f0fe", 3: "#f3f3f3"}
HEIGHT = 660


def _floats(df):
    return df.withColumns({c: F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1", "size") if c in df.columns})


def spans(spark, sf_dir):
    return _floats(spark.sql(_SPANS.format(lineitem=f"parquet.`{sf_dir}/lineitem.parquet`")))


def rects(spark, sf_dir, *kinds):
    r = _floats(spark.sql(_RECTS.format(orders=f"parquet.`{sf_dir}/orders.parquet`")))
    return r.where((F.col("c") % 6).isin(*kinds)) if kinds else r


_kind = """case when regexp_replace(translate(text, '​', ''), '\\s+', '', 'g') = '' then 'invisible' when regexp_matches(ltrim(text), '^([●•◦▪‣○]|\\d{1,2}[.)]|[a-z][.)])​') then 'list' when regexp_matches(ltrim(text), '^\\[(Figure|Table|Transcript)\\b') then 'caption' when regexp_matches(text, '^(\\d+(?:\\.\\d+)*)\\s+\\S') then 'head' else 'text' end"""


@query(f"""with {_fix} select id, case when regexp_full_match(text, '\\d+') and y1 > {HEIGHT} - 45 then 'pagenum' when regexp_full_match(text, '\\d+') and flags % 2 = 1 then 'fnref' else 'body' end as zone, '#' || lpad(lower(hex(color)), 6, '0') as hex, (flags // 16) % 2 = 1 or font like '%Bold%' as bold, (flags // 2) % 2 = 1 as italic, font like '%Mono%' as mono, {_kind} as kind from s where trim(text) <> ''""")
def page_spans(spark, sf_dir):
    return layout.span_facts(spans(spark, sf_dir), HEIGHT).select("id", "zone", "hex", "bold", "italic", "mono", "kind")


@query(f"""with {_fix} select id, case when y1 - y0 <= 2.5 or x1 - x0 <= 2.5 then 'rule' when y1 - y0 > 6 and y1 - y0 < 30 and x1 - x0 > 20 and x1 - x0 < 420 then 'pill' else 'box' end as class from r""")
def census_classes(spark, sf_dir):
    return rects(spark, sf_dir).select("id", layout.census_class(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")).alias("class"))


_line = """l0 as (select *, case when x0 - lag(x1) over (partition by page, line order by seg) > 1 then ' ' else '' end || text as piece from s), l1 as (select page, line, string_agg(piece, '' order by seg) as text, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1, max(size) as size, bool_and(bold) as bold, list_sort(list(distinct color)) as colors,
sum(case when font like '%Mono%' then len(text) else 0 end) / sum(len(text)) >= 0.5 as mono, arg_min(bold, seg) as lead_bold from l0 group by 1, 2), ln as materialized (select *, row_number() over (partition by page order by round_even(y0, 0), x0, line)::int as place from l1)"""


@query(f"""with {_fix}, {_line} select page, line, place, text, x0, y0, x1, y1, size, bold, array_to_string(colors, ',') as colors, mono from ln""")
def page_lines(spark, sf_dir):
    l = layout.lines(spans(spark, sf_dir))
    return l.select("page", "line", "place", "text", "x0", "y0", "x1", "y1", "size", "bold", F.array_join("colors", ",").alias("colors"), "mono")


_holds = lambda k: f"s.x0 >= r.x0 - {k} and s.y0 >= r.y0 - {k} and s.x1 <= r.x1 + {k} and s.y1 <= r.y1 + {k}"


@query(f"""with {_fix} select s.page, s.id, min(r.id) as pill, arg_min(r.color, r.id) as color from s join r on s.page = r.page and r.c % 6 in (0, 1) and {_holds(2.5)} group by 1, 2""")
def chip_spans(spark, sf_dir):
    return layout.in_pill(spans(spark, sf_dir), rects(spark, sf_dir, 0, 1))


@query(f"""with {_fix}, j as (select s.page, s.id, r.id as pill, s.text as t, len(s.text) as n, (r.x0 - s.x0) / ((s.x1 - s.x0) / greatest(1, len(s.text))) as l, (r.x1 - s.x0) / ((s.x1 - s.x0) / greatest(1, len(s.text))) as h from s join r on s.page = r.page and r.c % 6 = 1
  and not ({_holds(2.5)}) and least(s.y1, r.y1) - greatest(s.y0, r.y0) > 0.6 * (r.y1 - r.y0) and least(s.x1, r.x1) - greatest(s.x0, r.x0) > 2),
e as (select *, greatest(0, trunc(l))::int as a, least(n, trunc(h + 0.5))::int as b from j), f as (select *, coalesce((select min(i) from (select unnest(range(greatest(0, a - 4), least(n, a + 4))) as i) where t[i + 1] = '['), -1) as lb from e),
g as (select *, case when lb < 0 then -1 else coalesce((select min(i) from (select unnest(range(greatest(lb + 1, b - 4), least(n, b + 5))) as i) where t[i + 1] = ']'), (select min(i) from (select unnest(range(lb + 1, least(n, greatest(b + 4, lb + 40)))) as i) where t[i + 1] = ']'), -1) end as rb from f),
k as (select *, case when lb >= 0 and rb > lb then lb else a - len(regexp_extract(t[:a], '(\\S*)$', 1)) end as x, case when lb >= 0 and rb > lb then rb + 1 else b + len(regexp_extract(t[b + 1:], '^(\\S*)', 1)) end as y from g), z as (select page, id, pill, x + len(t[x + 1:y]) - len(ltrim(t[x + 1:y], ' ')) as "start", y - len(t[x + 1:y]) + len(rtrim(t[x + 1:y], ' ')) as "end" from k)
select page, id, pill, "start"::int as "start", "end"::int as "end" from z where "end" > "start" """)
def placeholder_ranges(spark, sf_dir):
    return layout.pill_ranges(spans(spark, sf_dir), rects(spark, sf_dir, 1))


@query(f"""with {_fix} select s.page, s.id, min(r.id) as link from s join r on s.page = r.page and r.c % 6 = 4 and (s.y0 + s.y1) / 2 between r.y0 - 1 and r.y1 + 1 and (least(s.x1, r.x1) - greatest(s.x0, r.x0)) / greatest(s.x1 - s.x0, 0.1) > 0.5 group by 1, 2""")
def link_spans(spark, sf_dir):
    return layout.in_link(spans(spark, sf_dir), rects(spark, sf_dir, 4))


@query(f"""with {_fix}, free as (select * from s where len(trim(text)) > 1 and not exists (select 1 from r where r.page = s.page and r.c % 6 = 4 and (s.y0 + s.y1) / 2 between r.y0 and r.y1 and least(s.x1, r.x1) - greatest(s.x0, r.x0) > 0.5 * (s.x1 - s.x0))),
j as (select s.page, s.id, r.id as rule, s.text as t, s.x0 as sx, (s.x1 - s.x0) / len(s.text) as w, greatest(s.x0, r.x0) - 1 as low, least(s.x1, r.x1) + 1 as high from free s join r on r.page = s.page and r.c % 6 in (0, 5) and r.y0 + 16 between s.y1 - 2.5 and s.y1 + 5 and least(s.x1, r.x1) - greatest(s.x0, r.x0) > 2),
c as (select *, unnest(range(len(t))) as i from j), b as (select *, i as p, i + len(regexp_extract(t[i + 1:], '^([^ ]+)', 1)) as e from c where t[i + 1] <> ' ' and (i = 0 or t[i] = ' ')), hit as (select *, t[p + 1:e] as word from b where sx + w * (p + e) / 2 between low and high),
o as (select page, id, rule, min(p) as "start", max(p) + len(regexp_replace(arg_max(word, p), '[.,;:]+$', '')) as "end" from hit group by 1, 2, 3) select page, id, rule, "start"::int as "start", "end"::int as "end" from o where "end" > "start" """)
def underlines(spark, sf_dir):
    return layout.underlined(spans(spark, sf_dir), rects(spark, sf_dir, 0, 5).withColumn("y0", F.col("y0") + 16), rects(spark, sf_dir, 4))


@query(f"""with {_fix}, {_line} select page, line from ln where not exists (select 1 from r where r.page = ln.page and r.c % 6 = 3 and (ln.x0 + ln.x1) / 2 between r.x0 - 3 and r.x1 + 3 and (ln.y0 + ln.y1) / 2 between r.y0 - 3 and r.y1 + 3)""")
def lines_outside_tables(spark, sf_dir):
    return layout.outside(layout.lines(spans(spark, sf_dir)), rects(spark, sf_dir, 3)).select("page", "line")


@query(f"""with {_fix} select s.page, s.id, r.id as "table" from s join r on s.page = r.page and r.c % 6 = 3 and {_holds(3)}""")
def spans_in_tables(spark, sf_dir):
    return layout._sides(spans(spark, sf_dir), rects(spark, sf_dir, 3), []).where(layout.holds(3)).select("page", "id", F.col("o_id").alias("table"))


@query(f"""with {_fix}, {_line} select page, line from ln where exists (select 1 from r where r.page = ln.page and r.c % 6 = 5 and ln.x0 < r.x1 and r.x0 < ln.x1 and ln.y0 < r.y1 and r.y0 < ln.y1)""")
def lines_on_figures(spark, sf_dir):
    return layout.meeting(layout.lines(spans(spark, sf_dir)), rects(spark, sf_dir, 5)).select("page", "line")


@query(f"""with {_fix} select n.page, n.id, arg_max(s.text, {{'x': s.x1, 't': s.text}}) as anchor from s n join s on n.page = s.page and s.a % 12 <> 4 and s.y0 < n.y1 and n.y0 < s.y1 and s.x1 <= n.x0 + 2 where n.a % 12 = 4 group by 1, 2""")
def note_anchors(spark, sf_dir):
    """Of each footnote reference the text that ends last before it on its line."""
    s, box = spans(spark, sf_dir), ("x0", "y0", "x1", "y1")
    refs = s.where("a % 12 = 4").select("page", "id", *(F.col(c).alias(f"i_{c}") for c in box))
    body = s.where("a % 12 <> 4").select("page", "text", *(F.col(c).alias(f"o_{c}") for c in box))
    return geometry.nearest_left(refs, body, ["page"], "id")


_role = """held as (select ln.page, ln.line, r.id, (r.x1 - r.x0) * (r.y1 - r.y0) as area, case r.c % 6 when 2 then 'turn' when 3 then 'transcript' when 4 then 'code' end as role from ln join r on r.page = ln.page and r.c % 6 in (2, 3, 4, 5) and ln.x0 >= r.x0 - 4 and ln.y0 >= r.y0 - 4 and ln.x1 <= r.x1 + 4 and ln.y1 <= r.y1 + 4),
role as (select page, line, arg_min(role, {'a': area, 'i': id}) filter (role is not null) as role, coalesce(bool_or(role = 'transcript'), false) as in_transcript from held group by 1, 2)"""


def _roles(spark, sf_dir):
    l = layout.lines(spans(spark, sf_dir)).withColumn("colors", F.transform("colors", lambda c: F.concat(F.lit("#"), F.lower(F.lpad(F.hex(c), 6, "0")))))
    return layout.box_roles(l, rects(spark, sf_dir, 2, 3, 4, 5), {"#e8f0fe": "turn", "#f3f3f3": "transcript", "#eeeeee": "code"}, ["line"])


@query(f"""with {_fix}, {_line}, {_role}, x as (select ln.*, role, coalesce(in_transcript, false) as in_transcript, regexp_extract(text, '^(\\d+(?:\\.\\d+)*)\\s+\\S', 1) as num, exists (select 1 from r where r.page = ln.page and r.c % 6 = 5 and ln.x0 < r.x1 and r.x0 < ln.x1 and ln.y0 < r.y1 and r.y0 < ln.y1) as fig from ln left join role using (page, line))
select page, line, role, in_transcript, x0 >= 112 and role is null as quote, case when size >= 12.6 or (colors = [6710886] and num <> '') or (len(num) - len(replace(num, '.', '')) >= 2 and bold) then 'heading' when role in ('turn', 'code') then role when role = 'transcript' then case when list_contains(colors, 6710886) then 'commentary' else 'turn' end
when regexp_matches(ltrim(text), '^\\[(Figure|Table|Transcript)\\b') or (size <= 9.5 and fig) then 'caption' when regexp_matches(ltrim(text), '^([●•◦▪‣○]|(\\d{{1,2}}|[a-z])[.)]​)') then 'item' else 'prose' end as class from x""")
def line_classes(spark, sf_dir):
    """What block each line belongs to, by size, colour, number, boxes, captions and list marks; quotes stand in, outside boxes."""
    l = _roles(spark, sf_dir)
    fig = layout.meeting(l.select("page", "line", "x0", "y0", "x1", "y1"), rects(spark, sf_dir, 5)).select("page", "line", F.lit(True).alias("fig"))
    l = l.join(fig, ["page", "line"], "left")
    return l.select("page", "line", "role", "in_transcript", ((F.col("x0") >= 112) & F.col("role").isNull()).alias("quote"), layout.line_class("#666666", F.coalesce("fig", F.lit(False))).alias("class"))


@query(f"""with {_fix}, h as (select s.page, s.line, exists (select 1 from r where r.page = s.page and r.c % 6 in (0, 1) and {_holds(2.5)}) as held from s where regexp_matches(text, '[\\p{{L}}\\p{{N}}_]')) select page, line from h group by 1, 2 having bool_and(held)""")
def chip_lines(spark, sf_dir):
    return layout.chip_only(spans(spark, sf_dir), rects(spark, sf_dir, 0, 1))


_tall = "select * replace (y0 + (place % 3) * 6 as y0, y0 + 36 + (place % 3) * 6 as y1) from ln"


@query(f"""with recursive {_fix}, {_line}, t as materialized ({_tall}), f as (select page, place, 0 as block, x0 >= 112 as quote, x1 as "right", text as tail, y0, y1, x1, bold from t where place = 1 union all
select t.page, t.place, case when ok then f.block else f.block + 1 end, t.x0 >= 112, case when ok then greatest(f."right", t.x1) else t.x1 end, t.text, t.y0, t.y1, t.x1, t.bold from f join t on t.page = f.page and t.place = f.place + 1,
lateral (select f.x1 < greatest(f."right", t.x1) - 40 as short) sh, lateral (select t.y0 - f.y1 < greatest(4.0, 0.55 * (f.y1 - f.y0)) and not (t.lead_bold and regexp_matches(f.tail, '[.!?:”"]\\s*$') and sh.short) and not (f.bold and sh.short and not t.lead_bold) and f.quote = (t.x0 >= 112) as ok) o)
select f.page, f.block, min(f.place) as first, max(f.place) as last, arg_min(f.quote, f.place) as quote, string_agg(t.text, ' ' order by t.place) as text from f join t using (page, place) group by 1, 2""")
def page_paragraphs(spark, sf_dir):
    l = layout.lines(spans(spark, sf_dir))
    k = (F.col("place") % 3) * 6
    return layout.paragraphs(l.withColumn("y1", F.col("y0") + 36 + k).withColumn("y0", F.col("y0") + k))


@query(f"""with recursive {_fix}, o as materialized (select page, id, x0, floor(y0 * 0.25) as y0, floor(y0 * 0.25) + 4 as y1, row_number() over (partition by page order by line, seg) as k from s), f as (select page, k, [x0] as keys from o where k = 1 union all select o.page, o.k, case when len(list_filter(f.keys, lambda v: abs(v - o.x0) <= 2)) > 0 then f.keys else f.keys || [o.x0] end from f join o on o.page = f.page and o.k = f.k + 1),
keys as (select page, arg_max(keys, k) as keys from f group by 1), x as (select o.*, list_filter(keys, lambda v: abs(v - o.x0) <= 2)[1] as x from o join keys using (page)), n as (select *, case when y0 - lag(y1) over w < 9 then 0 else 1 end as new from x window w as (partition by page, x order by y0, id)),
g as (select *, sum(new) over (partition by page, x order by y0, id rows unbounded preceding) as run from n) select page, x, arg_min(id, {{'y': y0, 'i': id}}) as first, count(*)::bigint as n from g group by page, x, run having count(*) > 1""")
def column_chains(spark, sf_dir):
    top = F.floor(F.col("y0") * 0.25).cast("double")
    return layout.column_chains(spans(spark, sf_dir).withColumn("y0", top).withColumn("y1", F.col("y0") + 4))


_images = "select cast(floor(l_orderkey / 16.0) as bigint) as page, cast(row_number() over (partition by floor(l_orderkey / 16.0) order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) as bigint) as num, case when l_partkey % 3 = 0 then 'smask' else 'image' end as type, l_suppkey % 2 as object from {lineitem}"


@query(f"""with i as ({_images.format(lineitem='lineitem')}), n as (select *, lead(type) over w as t, lead(object) over w as o, lead(num) over w as m from i window w as (partition by page order by num)) select page, num, 'p' || case when page < 1000 then lpad(page::varchar, 3, '0') else left(page::varchar, 3) end || '-' || row_number() over (partition by page order by num) || '.png' as file, case when t = 'smask' and o = object then m end as mask from n where type = 'image'""")
def image_files(spark, sf_dir):
    """Images by page with the names of their files and their soft masks."""
    return layout.image_files(spark.sql(_images.format(lineitem=f"parquet.`{sf_dir}/lineitem.parquet`")))


@query(f"""with {_fix}, x as (select page, id, regexp_replace(text, '\\s+', '', 'g') as key, row_number() over (partition by page, regexp_replace(text, '\\s+', '', 'g') order by id) as nth from s) select page, key, nth::int as nth, id, id - page * 1000 as cell from x""")
def key_occurrences(spark, sf_dir):
    """Equal keys used up from left to right: the n-th cell of a key takes its n-th span."""
    s = spans(spark, sf_dir).withColumn("key", F.regexp_replace("text", r"\s+", ""))
    a = layout.nth_of_key(s, ["page", "key"], ["id"]).select("page", "key", "nth", "id")
    cells = s.select("page", "key", (F.col("id") - F.col("page") * 1000).alias("cell"))
    return a.join(layout.nth_of_key(cells, ["page", "key"], ["cell"]), ["page", "key", "nth"])


@query(f"""with {_fix}, w as (select page, avg(bold::int) as share from s where color <> 16777215 group by 1) select page, round(share, 6) as share, share < 0.9 as signifies from w""")
def bold_shares(spark, sf_dir):
    """How much of a page is bold, white text aside: bold says something where not nearly all is."""
    share = spans(spark, sf_dir).where("color <> 16777215").groupBy("page").agg(F.avg(F.col("bold").cast("int")).alias("share"))
    return share.select("page", F.round("share", 6).alias("share"), (F.col("share") < 0.9).alias("signifies"))


@query(f"""with {_fix}, c as (select page, color, count(*) as n, min(id) as f from s group by 1, 2) select page, arg_max(color, {{'n': n, 'f': -f}}) as color, max(n)::bigint as n from c group by 1""")
def body_colors(spark, sf_dir):
    from ..operators import islands

    return islands.most_common(spans(spark, sf_dir), ["page"], "color", "id")


@query(f"""with {_fix}, b as (select page, line, list_sort(list((y0 + y1) / 2)) as v from s group by 1, 2) select page, line, case when v[len(v)] - v[1] <= 7 then v[len(v) // 2 + 1] end as band from b""")
def row_bands(spark, sf_dir):
    """The upper median of a row's middles, unless they spread by more than 7."""
    v = F.sort_array(F.collect_list((F.col("y0") + F.col("y1")) / 2))
    return spans(spark, sf_dir).groupBy("page", "line").agg(v.alias("v")).select("page", "line", F.when(F.element_at("v", -1) - F.element_at("v", 1) <= 7, F.element_at("v", F.expr("cast(size(v) div 2 + 1 as int)"))).alias("band"))


_class = f"""x as (select ln.*, role, regexp_extract(text, '^(\\d+(?:\\.\\d+)*)\\s+\\S', 1) as num, exists (select 1 from r where r.page = ln.page and r.c % 6 = 5 and ln.x0 < r.x1 and r.x0 < ln.x1 and ln.y0 < r.y1 and r.y0 < ln.y1) as fig from ln left join role using (page, line)),
t as materialized (select * replace (y0 + (place % 3) * 6 as y0, y0 + 36 + (place % 3) * 6 as y1), x0 >= 112 and role is null as quote, case when size >= 12.6 or (colors = [6710886] and num <> '') or (len(num) - len(replace(num, '.', '')) >= 2 and bold) then 'heading' when role in ('turn', 'code') then role when role = 'transcript' then case when list_contains(colors, 6710886) then 'commentary' else 'turn' end
when regexp_matches(ltrim(text), '^\\[(Figure|Table|Transcript)\\b') or (size <= 9.5 and fig) then 'caption' when regexp_matches(ltrim(text), '^([●•◦▪‣○]|(\\d{{1,2}}|[a-z])[.)]​)') then 'item' else 'prose' end as class from x)"""


@query(f"""with recursive {_fix}, {_line}, {_role}, {_class}, f as (select page, place, 0 as block, case when class = 'prose' then 'paragraph' else class end as type, role, quote, x1 as "right", text as tail, x0, y0, y1, x1, size, bold from t where place = 1 union all
select t.page, t.place, case when ok then f.block else f.block + 1 end, case when ok then f.type when t.class = 'prose' then 'paragraph' else t.class end, case when ok then f.role else t.role end, case when ok then f.quote else t.quote end, case when ok then greatest(f."right", t.x1) else t.x1 end, t.text, case when ok then f.x0 else t.x0 end, t.y0, t.y1, t.x1, case when ok then f.size else t.size end, t.bold
from f join t on t.page = f.page and t.place = f.place + 1, lateral (select f.x1 < greatest(f."right", t.x1) - 40 as short, t.y0 - f.y1 as gap, abs(t.size - f.size) < 0.6 as near) sh, lateral (select coalesce(case when t.class = 'heading' then f.type = 'heading' and gap < 10 and near when t.class in ('turn', 'commentary', 'code') then f.type = t.class and not (t.class = 'turn' and (t.role is distinct from f.role or t.lead_bold))
when t.class <> 'prose' then false when f.type = 'caption' then (t.size <= 9.5 or near) and gap < 8 when f.type = 'item' then gap < 8 and (t.x0 > f.x0 + 6 or (abs(t.x0 - f.x0) <= 2 and (not regexp_matches(f.tail, '[.!?;:”"’]\\s*$') or regexp_matches(t.text, '^\\s*\\p{{Ll}}'))))
when f.type = 'paragraph' then gap < greatest(4.0, 0.55 * (f.y1 - f.y0)) and not (t.lead_bold and regexp_matches(f.tail, '[.!?:”"]\\s*$') and sh.short) and not (f.bold and sh.short and not t.lead_bold) and f.quote = t.quote else false end, false) as ok) o)
select f.page, f.block, min(f.place) as first, max(f.place) as last, any_value(f.type) as type, any_value(f.role) as role, any_value(f.quote) as quote, string_agg(t.text, ' ' order by t.place) as text from f join t using (page, place) group by 1, 2""")
def page_blocks(spark, sf_dir):
    """A page's lines as headings, paragraphs, items, captions, turns and boxes."""
    l = _roles(spark, sf_dir)
    fig = layout.meeting(l.select("page", "line", "x0", "y0", "x1", "y1"), rects(spark, sf_dir, 5)).select("page", "line", F.lit(True).alias("fig"))
    l = l.join(fig, ["page", "line"], "left").withColumn("class", layout.line_class("#666666", F.coalesce("fig", F.lit(False)))).withColumn("quote", (F.col("x0") >= 112) & F.col("role").isNull())
    k = (F.col("place") % 3) * 6
    return layout.assembled(l.withColumn("y1", F.col("y0") + 36 + k).withColumn("y0", F.col("y0") + k))
