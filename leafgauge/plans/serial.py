"""From blocks to text: markers, fences, stitching over pages, marks, footnotes, and the small lookups beside them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import blocks, islands, layout
from . import card, sheet
from .registry import query, table

_TYPES = "case a % 7 when 0 then 'paragraph' when 1 then 'paragraph' when 2 then 'item' when 3 then 'turn' when 4 then 'code' when 5 then 'commentary' else 'caption' end"
_BLOCKS = f"""select doc, cast(row_number() over (partition by doc order by page, ln, a, b, e, s) as bigint) as k, page, {_TYPES} as type, b % 4 = 0 as quote, case when b % 2 = 0 then 'user' else 'assistant' end as role, case a % 5 when 0 then 'Ends here.' when 1 then 'goes on' when 2 then 'Upper start,' when 3 then '[label]:' else 'word ' || a end as text,
cast(72 + (b % 3) * 18 as double) as x0, cast(72 as double) as marker_x0, 8.5 + b % 3 as size, a, b from (select cast(floor(l_orderkey / 8.0) as bigint) as doc, 1 + l_orderkey % 8 as page, l_linenumber as ln, l_partkey as a, l_suppkey as b, l_extendedprice as e, l_shipdate as s from {{lineitem}})"""
_b = f"b as materialized ({_BLOCKS.format(lineitem='lineitem')})"
_w = "over (partition by doc order by k)"


def rows(spark, sf_dir):
    return spark.sql(_BLOCKS.format(lineitem=f"parquet.`{sf_dir}/lineitem.parquet`")).withColumn("size", F.col("size").cast("double"))


@query(f"""with {_b}, l as (select *, lag(page, 1, 1) {_w} as before, lag(type) {_w} as above from b) select doc, k, page, case when type = 'item' and above = 'item' then 'inline' else 'alone' end as place from l where page <> before""")
def page_markers(spark, sf_dir):
    return blocks.page_markers(rows(spark, sf_dir))


@query(f"""with {_b}, l as (select *, lag(type) {_w} as t, lag(quote) {_w} as q from b) select doc, k, t is not null and not (type = 'item' and t = 'item' and quote = q) as blank from l""")
def block_separators(spark, sf_dir):
    return blocks.separators(rows(spark, sf_dir))


@query(f"""with {_b}, i as (select *, type in ('turn', 'commentary') or (type = 'code' and a % 2 = 0) as fenced from b), g as (select *, k - row_number() over (partition by doc, fenced order by k) as g from i) select doc, min(k) as first, max(k) as last from g where fenced group by doc, g""")
def transcript_fences(spark, sf_dir):
    return blocks.transcripts(rows(spark, sf_dir), F.expr("type in ('turn', 'commentary') or (type = 'code' and a % 2 = 0)"))


@query(f"""with {_b} select doc, k, type, case when type <> 'item' then quote else quote and coalesce((select arg_max(p.quote, p.k) from b p where p.doc = b.doc and p.k < b.k and p.type = 'paragraph'), false) end as quote from b""")
def quote_carry(spark, sf_dir):
    return blocks.carried_quotes(rows(spark, sf_dir)).select("doc", "k", "type", "quote")


@query(f"""with {_b}, x as (select c.doc, c.k, (select max(t.k) from b t where t.doc = c.doc and t.k < c.k and t.type = 'turn') as turn, (select max(t.k) from b t where t.doc = c.doc and t.k < c.k and t.type <> 'code') as head from b c where c.type = 'code')
select x.doc, x.k, x.turn, t.role, case when h.type = 'turn' and h.a % 5 = 3 then 'absorbed' else 'inherited' end as how from x join b t on t.doc = x.doc and t.k = x.turn join b h on h.doc = x.doc and h.k = x.head""")
def boxed_turns(spark, sf_dir):
    """Code after a turn: the turn's own where the turn is a label only, else in the role of the last turn."""
    return blocks.boxed_turns(rows(spark, sf_dir), F.col("text").rlike(r"^\[[^\]]{1,30}\]:?\s*$"))


@query(f"""with recursive {_b}, f as (select doc, k, k as first, page, type, quote, role, text as tail, page as last_page, 1 as n, text from b where k = 1 union all
select b.doc, b.k, case when ok then f.first else b.k end, case when ok then f.page else b.page end, case when ok then f.type else b.type end, case when ok then f.quote else b.quote end, case when ok then f.role else b.role end, b.text, b.page, case when ok then f.n + 1 else 1 end,
  case when ok then f.text || case when b.page <> f.last_page then '<!-- p.' || b.page || ' --> ' else ' ' end || b.text else b.text end from f join b on b.doc = f.doc and b.k = f.k + 1,
lateral (select f.tail not like '%.' and f.tail not like '%:' as open, b.a % 5 in (1, 4) as low, f.tail like '%,' as comma) l,
lateral (select b.page = f.page + 1 and ((b.type = 'code' and f.type = 'code') or (b.type = 'turn' and f.type = 'turn' and b.role = f.role and open and (low or comma)) or (b.type = 'paragraph' and open and ((f.type = 'caption' and b.size <= 9.5 and (low or comma)) or (f.type = 'paragraph' and (low or (b.quote = f.quote and comma))) or (f.type = 'item' and b.x0 > 78)))) as ok) o)
select doc, first, max(n)::int as n, max(last_page) - any_value(page) + 1 as pages, any_value(type) as type, arg_max(text, k) as text from f group by doc, first""")
def stitched_blocks(spark, sf_dir):
    """Blocks that a page's end tore apart, joined, with the marker where the page begins."""
    return blocks.stitched(rows(spark, sf_dir))


_notes = "n as materialized (select page, line, row_number() over (partition by page order by line)::int as place, min(y0) as y0, max(y1) as y1, any_value(a order by seg) as a, any_value(b order by seg) as b from s group by 1, 2), m as materialized (select *, a % 3 > 0 or b % 5 = 0 as small, case when b % 5 = 0 then a % 40 end as marker from n)"


@query(f"""with recursive {sheet._fix}, {_notes}, f as (select page, place, case when marker is not null then marker end as note from m where place = 1 union all select m.page, m.place, case when m.marker is not null then m.marker when m.small then f.note end from f join m on m.page = f.page and m.place = f.place + 1),
first as (select page, min(place) as first from m where marker is not null group by 1), t as (select m.page, m.place from m join first on first.page = m.page and m.place = first.first - 1 where small and y0 > 300 and (select y0 from m x where x.page = m.page and x.place = m.place + 1) - y1 <= 40 union all
select m.page, m.place from t join m on m.page = t.page and m.place = t.place - 1 where small and y0 > 300 and (select y0 from m x where x.page = m.page and x.place = m.place + 1) - y1 <= 40) select page, place, note from f where note is not null union all select page, place, null from t""")
def footnote_lines(spark, sf_dir):
    """Lines of footnotes by their number; the tail of the page before's last note has none."""
    s = sheet.spans(spark, sf_dir).groupBy("page", "line").agg(F.min("y0").alias("y0"), F.max("y1").alias("y1"), F.min_by("a", "seg").alias("a"), F.min_by("b", "seg").alias("b"))
    s = s.withColumn("place", F.row_number().over(Window.partitionBy("page").orderBy("line"))).withColumn("small", F.expr("a % 3 > 0 or b % 5 = 0")).withColumn("marker", F.expr("if(b % 5 = 0, a % 40, null)"))
    return blocks.footnote_lines(s, 300, 40)


@query(f"""with {sheet._fix}, {sheet._line}, w as (select *, max(x1) over (partition by page) as edge, lag(y1) over p as py1, lag(y0) over p as py0, lag(x1) over p as px1, lag(text) over p as pt from ln window p as (partition by page order by place))
select page, place from w where y0 - py1 > greatest(4.0, 0.55 * (py1 - py0)) or (px1 < edge - 50 and (regexp_matches(pt, '[.!?:…"”\\x27\\)\\]]\\s*$') or regexp_matches(text, '^\\s*\\p{{Lu}}')))""")
def turn_breaks(spark, sf_dir):
    return blocks.turn_breaks(layout.lines(sheet.spans(spark, sf_dir)), ["page"], "place")


@query(f"""with {sheet._fix}, {sheet._line}, w as (select *, max(x1) over (partition by page order by place rows between unbounded preceding and 1 preceding) as edge, lag(x0) over p as px0, lag(x1) over p as px1, lag(text) over p as pt from ln window p as (partition by page order by place))
select page, place, place > 2 and edge - px1 < (len(regexp_extract(text, '^\\s*(\\S*)', 1)) + 1) * ((px1 - px0) / greatest(len(pt), 1)) as fits from w""")
def wrap_fits(spark, sf_dir):
    return blocks.wrap_fits(layout.lines(sheet.spans(spark, sf_dir)), ["page"], "place")


@query("""with l as (select doc_id, list_transform(string_split(text, chr(10)), lambda x: trim(x)) as l, doc_id % 3 as c from documents) select doc_id, case when c = 0 then trim(array_to_string(l, ' ')) else trim(array_to_string(l[:c], ' ')) || '<!-- p.' || doc_id || ' --> ' || trim(array_to_string(l[c + 1:], ' ')) end as body from l""")
def spliced_bodies(spark, sf_dir):
    """Lines of a block as text, with a page's marker inline where it begins."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.transform(F.split("text", "\n"), lambda x: F.trim(x)).alias("l"))
    return d.select("doc_id", blocks.spliced(F.col("l"), F.expr("nullif(cast(doc_id % 3 as int), 0)"), F.col("doc_id")).alias("body"))


@query("""select p_partkey, case p_partkey % 5 when 0 then '**' || w[1] || '** ' || w[2] || ' [' || w[3] || '](u)' when 1 then '[**' || w[1] || ' ' || w[2] || '**](u) ' || w[3] when 2 then '*' || w[1] || '* [*' || w[2] || '*](u) ' || w[3]
when 3 then '<span class="ph">`' || w[1] || '`</span>[^7] \\*' || w[3] else '\\<b ' || w[1] || ' a*b `<c` ' end as md from (select p_partkey, string_split(p_name || ' x y z', ' ') as w from part)""")
def marked_texts(spark, sf_dir):
    """Bold, links, code, placeholders and notes written into texts, cut at links and nested."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.split(F.concat("p_name", F.lit(" x y z")), " ").alias("w")).withColumn("m", F.col("p_partkey") % 5)
    w = lambda k: F.get("w", F.lit(k - 1))
    a, b, c = F.length(w(1)), F.length(w(2)), F.length(w(3))
    text = F.when(F.col("m") == 3, F.concat(w(1), F.lit("7 *"), w(3))).when(F.col("m") == 4, F.concat(F.lit("<b "), w(1), F.lit(" a*b <c "))).otherwise(F.concat_ws(" ", w(1), w(2), w(3)))
    mark = lambda kind, x, y, data=None: F.struct(F.lit(kind).alias("kind"), (x if not isinstance(x, int) else F.lit(x)).cast("int").alias("a"), y.cast("int").alias("b"), F.lit(data).cast("string").alias("data"))
    marks = F.when(F.col("m") == 0, F.array(mark("bold", 0, a), mark("link", a + b + 2, a + b + c + 2, "u"))).when(F.col("m") == 1, F.array(mark("bold", 0, a + b + 1), mark("link", 0, a + b + 1, "u")))
    marks = marks.when(F.col("m") == 2, F.array(mark("italic", 0, a + b + 1), mark("link", a + 1, a + b + 1, "u"))).when(F.col("m") == 3, F.array(mark("code", 0, a), mark("placeholder", 0, a), mark("fnref", a, a + 1, "7"))).otherwise(F.array(mark("code", a + 8, a + 10)))
    literal, plain = blocks.marked(text, marks, True), blocks.marked(text, marks)
    return p.select("p_partkey", F.when(F.col("m") == 3, literal).otherwise(plain).alias("md"))


@query("""select p_partkey, '<pre><b>' || replace(replace(p_name, '&', '&amp;'), '<', '&lt;') || chr(10) || p_brand || '</b> &lt;x&gt; <span class="ph">[' || p_size || ']</span></pre>' as html from part""")
def code_boxes(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    n, b, s = F.length("p_name"), F.length("p_brand"), F.length(F.col("p_size").cast("string"))
    mark = lambda kind, x, y: F.struct(F.lit(kind).alias("kind"), x.cast("int").alias("a"), y.cast("int").alias("b"))
    first = F.struct(F.col("p_name").alias("text"), F.array(mark("bold", F.lit(0), n)).alias("marks"))
    second = F.struct(F.concat("p_brand", F.lit(" <x> ["), F.col("p_size").cast("string"), F.lit("]")).alias("text"), F.array(mark("bold", F.lit(0), b), mark("placeholder", b + 5, b + 7 + s)).alias("marks"))
    return p.select("p_partkey", blocks.code_box(F.array(first, second)).alias("html"))


@query(f"""with recursive {sheet._fix}, k as materialized (select page, id, x0, y0 - 40 * (id % 16) as y0, x1, y1 - 40 * (id % 16) as y1, c % 3 as digest, row_number() over (partition by page order by id) as k from r), f as (select page, k, [{{'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1, 'd': digest, 'id': id}}] as kept from k where k = 1 union all
select k.page, k.k, case when len(list_filter(f.kept, lambda s: s.d = k.digest and greatest(0, least(k.x1, s.x1) - greatest(k.x0, s.x0)) * greatest(0, least(k.y1, s.y1) - greatest(k.y0, s.y0)) > 0.8 * least((k.x1 - k.x0) * (k.y1 - k.y0), (s.x1 - s.x0) * (s.y1 - s.y0)))) > 0 then f.kept
  else f.kept || [{{'x0': k.x0, 'y0': k.y0, 'x1': k.x1, 'y1': k.y1, 'd': k.digest, 'id': k.id}}] end from f join k on k.page = f.page and k.k = f.k + 1), l as (select page, arg_max(kept, k) as kept from f group by 1) select page, unnest(kept).id as k from l""")
def distinct_figures(spark, sf_dir):
    up = 40 * (F.col("id") % 16)  # all of a page's in one place
    r = sheet.rects(spark, sf_dir).withColumn("y0", F.col("y0") - up).withColumn("y1", F.col("y1") - up).withColumn("digest", F.col("c") % 3).withColumn("k", F.col("id"))
    return blocks.distinct_figures(r).select("page", "k")


@query(f"""with {card._page}, l as (select doc, page as id, case page % 4 when 0 then 'see § ' || (doc % 9 + 1) || '.' || (page // 3 * 3 + 1) || ' there' when 1 then (doc % 9 + 1) || '.' || page || '.' when 2 then 'Section 99.9' else 'plain' end as text, case page % 4 when 0 then page // 3 * 3 + 1 when 1 then page end as want from p), h as (select doc, page from f where page % 3 = 1)
select l.doc, l.id, coalesce(case when h.page is not null then 's-' || h.page end, 'near-' || l.id) as slug from l left join h on h.doc = l.doc and h.page = l.want""")
def link_targets(spark, sf_dir):
    """Links that name a section's number go to it, others to the heading nearest by place."""
    p = card.pages(spark, sf_dir)
    number = lambda page: F.concat(F.expr("cast(doc % 9 + 1 as string)"), F.lit("."), page.cast("string"))
    k, turn = F.col("page") % 4, F.expr("page div 3 * 3 + 1")
    text = F.when(k == 0, F.concat(F.lit("see § "), number(turn), F.lit(" there"))).when(k == 1, F.concat(number(F.col("page")), F.lit("."))).when(k == 2, "Section 99.9").otherwise("plain")
    links = p.select("doc", F.col("page").alias("id"), text.alias("text"), F.concat(F.lit("near-"), F.col("page").cast("string")).alias("near"))
    heads = p.where("full and page % 3 = 1").select("doc", F.col("page").alias("ord"), number(F.col("page")).alias("number"), F.concat(F.lit("s-"), F.col("page").cast("string")).alias("slug"))
    return blocks.link_targets(links, heads)


@query(f"""with {sheet._fix}, k as (select page, line, seg, regexp_replace(text, '\\s+', '', 'g') as key from s), c as (select page, line, list(key order by seg) as keys, list(seg order by seg) as segs from k group by 1, 2), runs as (select page, line, i, j, array_to_string(keys[i:j], '') as key, segs[i] as first from c, unnest(range(1, len(keys) + 1)) as u(i), unnest(range(i, least(i + 5, len(keys)) + 1)) as v(j)),
cell as (select page, line, i as cell, array_to_string(keys[i:i + 1], '') as key from c, unnest(range(1, len(keys) + 1, 2)) as u(i)) select cell.page, cell.line, cell.cell::int as cell, min(first)::int as first, count(*)::bigint as n from cell join runs using (page, line, key) group by 1, 2, 3""")
def cell_spans(spark, sf_dir):
    """Cells beside the runs of spans that read the same; here each cell is two spans that were glued."""
    s = sheet.spans(spark, sf_dir).withColumn("key", F.regexp_replace("text", r"\s+", ""))
    runs = blocks.composites(s, ["page", "line"], "seg", "key")
    pos = F.row_number().over(Window.partitionBy("page", "line").orderBy("seg"))
    two = s.withColumn("cell", pos).withColumn("key", F.concat("key", F.coalesce(F.lead("key").over(Window.partitionBy("page", "line").orderBy("seg")), F.lit("")))).where("cell % 2 = 1")
    return two.select("page", "line", "cell", "key").join(runs, ["page", "line", "key"]).groupBy("page", "line", "cell").agg(F.min("first").alias("first"), F.count("*").alias("n"))


@query(f"""with {card._page}, h as (select doc, page, left(replace(head, ' ', ''), 24) as key from f where page % 3 = 1), l as (select doc, page, case when page % 2 = 0 then left(replace(head, ' ', ''), 10) else replace(head, ' ', '') || 'more' end as line from f) select l.doc, l.page::bigint as page from l join h using (doc, page) where starts_with(line, key) or starts_with(key, line)""")
def boundary_pages(spark, sf_dir):
    """Pages that a section's first heading splits: a line that begins the heading, or that the heading begins."""
    p = card.pages(spark, sf_dir).where("full")
    head = F.concat(F.expr("concat(doc % 9 + 1, '.', page)"), F.array_join(F.slice("c", 1, 3), ""))
    heads = p.where("page % 3 = 1").select("doc", "page", F.substring(head, 1, 24).alias("key"))
    line = F.when(F.col("page") % 2 == 0, F.substring(head, 1, 10)).otherwise(F.concat(head, F.lit("more")))
    return p.select("doc", "page", line.alias("line")).join(heads, ["doc", "page"]).where("startswith(line, key) or startswith(key, line)").select("doc", "page")


@query(f"""with {_b}, t as (select distinct doc, page from b where type = 'caption'), z as (select distinct doc, page + d as page from t, (select unnest([-1, 0, 1]) as d)), want as (select distinct doc, page from b where page between 2 and 7 except select distinct doc, page from b where type = 'code') select doc, page, exists (select 1 from z where z.doc = want.doc and z.page = want.page) as zone from want""")
def gate_pages(spark, sf_dir):
    """The pages that a run of the checks looks at: those asked for without the contents', and which of them are next to tables."""
    b = rows(spark, sf_dir)
    tables = b.where("type = 'caption'").select("doc", "page")
    zone = tables.union(tables.select("doc", F.col("page") - 1)).union(tables.select("doc", F.col("page") + 1)).distinct().withColumn("zone", F.lit(True))
    want = b.where("page between 2 and 7").select("doc", "page").subtract(b.where("type = 'code'").select("doc", "page"))
    return want.join(zone, ["doc", "page"], "left").select("doc", "page", F.coalesce("zone", F.lit(False)).alias("zone"))


@query("""with c as (select doc_id, lang, text, reverse(text) || case when doc_id % 3 = 0 then '!' else '' end as other from documents) select doc_id, list_sort(string_split(text, '')) = list_sort(string_split(other, '')) as same from c where text <> ''""")
def character_bags(spark, sf_dir):
    """Whether two texts hold the same characters equally often."""
    d = table(spark, sf_dir, "documents").where("text <> ''")
    bag = lambda c: F.sort_array(F.split(c, ""))
    other = F.concat(F.reverse("text"), F.when(F.col("doc_id") % 3 == 0, "!").otherwise(""))
    return d.select("doc_id", (bag("text") == bag(other)).alias("same"))


@query("""with n as (select user_id, event_type, count(*)::bigint as n from events group by 1, 2) select user_id, event_type, n from n qualify row_number() over (partition by user_id order by n desc, event_type) <= 8""")
def most_common_kinds(spark, sf_dir):
    n = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return n.withColumn("k", F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("n"), "event_type"))).where("k <= 8").drop("k")


@query(f"""with {sheet._fix}, c as (select page, line, list({{'x': x0, 'id': id}} order by x0, id) as c from s group by 1, 2) select page, line, array_to_string(list_transform(c, lambda v: v.id), ',') as ids from c""")
def cells_by_place(spark, sf_dir):
    """A row's cells put in order of their left edges."""
    cells = F.sort_array(F.collect_list(F.struct("x0", "id")))
    return sheet.spans(spark, sf_dir).groupBy("page", "line").agg(F.array_join(F.transform(cells, lambda c: c["id"].cast("string")), ",").alias("ids"))


@query(f"""with {_b}, n as (select doc, k, page, case when a % 6 = 0 then null else a % 50 end as n from b where type = 'caption') select doc, k, page, n, row_number() over (partition by doc order by page, n is not null, n, k)::int as place from n""")
def note_order(spark, sf_dir):
    """Footnotes in a document's order: by page, tails first, then by number."""
    n = rows(spark, sf_dir).where("type = 'caption'").select("doc", "k", "page", F.expr("if(a % 6 = 0, null, a % 50)").alias("n"))
    return n.withColumn("place", F.row_number().over(Window.partitionBy("doc").orderBy("page", F.col("n").isNotNull(), "n", "k")))


@query("""with v as (select distinct p_brand, p_partkey % 2 = 0 as quote, p_size from part), r as (select p_brand, quote, list_sort(list(p_size::double)) as a from v group by 1, 2), t as (select p_brand, quote, list_reduce([[x] for x in a], lambda t, x: case when x[1] - t[len(t)] <= 4 then t else t || x end) as tiers from r)
select p.p_partkey, list_position(list_transform(tiers, lambda t: abs(p.p_size - t) <= 4), true)::int - 1 as level from part p join t on t.p_brand = p.p_brand and t.quote = (p.p_partkey % 2 = 0)""")
def item_levels(spark, sf_dir):
    """The depth of list items by how far their marks are indented, quotes apart."""
    p = table(spark, sf_dir, "part").withColumn("quote", F.col("p_partkey") % 2 == 0)
    tiers = p.groupBy("p_brand", "quote").agg(islands.tiers(F.array_sort(F.collect_set("p_size"))).alias("t"))
    level = F.array_position(F.transform("t", lambda t: F.abs(F.col("p_size") - t) <= 4), F.lit(True)) - 1
    return p.join(tiers, ["p_brand", "quote"]).select("p_partkey", level.cast("int").alias("level"))


@query("""with c as (select l_orderkey as doc, l_partkey % 100 as a, l_partkey % 100 + 1 + l_quantity::int % 30 as b from lineitem), s as (select doc, list_sort(list(distinct {'a': a, 'n': -b})) as s from c group by 1),
k as (select doc, list_reduce([[x] for x in s], lambda t, x: case when x[1].a >= -t[len(t)].n then t || x else t end) as k from s) select doc, unnest(k).a::int as start, -unnest(k).n::int as "end" from k""")
def outermost_marks(spark, sf_dir):
    """Of marks inside each other the outer ones."""
    l = table(spark, sf_dir, "lineitem")
    a = (F.col("l_partkey") % 100).cast("int")
    m = F.struct(a.alias("start"), (a + 1 + F.col("l_quantity").cast("int") % 30).alias("end"))
    kept = l.groupBy(F.col("l_orderkey").alias("doc")).agg(islands.outermost(F.collect_list(m)).alias("k"))
    return kept.select("doc", F.explode("k").alias("m")).select("doc", "m.start", "m.end")


@query("""with recursive l as (select l_orderkey as doc, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) as k, l_partkey % 3 = 0 as below, l_suppkey % 2 = 0 as bare from lineitem),
y as materialized (select *, sum(below::int) over (partition by doc order by k) as y from l), f as (select doc, k, k as first, y as top from y where k = 1 union all select y.doc, y.k, case when bare and y.y > f.top then f.first else y.k end, case when bare and y.y > f.top then f.top else y.y end from f join y on y.doc = f.doc and y.k = f.k + 1)
select doc, (first * 10)::int as a, (max(k) * 10 + 5)::int as b from f group by doc, first""")
def stacked_marks(spark, sf_dir):
    """Pills that go on on the next line are one mark; those beside each other, or with words between, stay apart."""
    l = table(spark, sf_dir, "lineitem")
    k = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"))
    m = l.select(F.col("l_orderkey").alias("doc"), k.alias("k"), (F.col("l_partkey") % 3 == 0).alias("below"), (F.col("l_suppkey") % 2 == 0).alias("bare"))
    up = F.sum(F.when(F.col("below"), 20).otherwise(0)).over(Window.partitionBy("doc").orderBy("k"))
    m = m.withColumn("y", up.cast("double")).withColumn("piece", F.concat(F.when(F.col("bare"), "     ").otherwise(" and "), F.lit("pills")))
    mark = F.struct((F.col("k") * 10).alias("a"), (F.col("k") * 10 + 5).alias("b"), F.lit(0.0).alias("x0"), F.col("y").alias("y0"), F.lit(9.0).alias("x1"), (F.col("y") + 12).alias("y1"))
    per = m.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("k", mark.alias("m"), "piece"))).alias("x"))
    text = F.concat(F.lit("lead "), F.array_join(F.transform("x", lambda x: x["piece"]), ""))
    marks = blocks.stacked_marks(F.transform("x", lambda x: x["m"]), text)
    return per.select("doc", F.explode(marks).alias("m")).select("doc", "m.a", "m.b")


@query("""with t as (select l_orderkey as doc, list_sort(list((l_partkey * 3 % 400)::double)) as t from lineitem group by 1), s as (select doc, list_reduce([[x] for x in t], lambda a, x: a || [greatest(x[1], a[len(a)] + 34)]) as s from t) select doc, generate_subscripts(s, 1)::int - 1 as k, unnest(s) as top from s""")
def note_tops(spark, sf_dir):
    """Notes beside a text pushed down so that none covers the one above."""
    t = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("doc")).agg(F.sort_array(F.collect_list((F.col("l_partkey") * 3 % 400).cast("double"))).alias("t"))
    return t.select("doc", F.posexplode(islands.spaced(F.col("t"), 34)).alias("k", "top"))


@query("""select l_orderkey, l_linenumber, l_partkey, case when l_partkey % 10 = 0 then 'minor' when l_quantity >= 3 then 'major' else 'minor' end as severity, case l_suppkey % 3 when 0 then 'auto-link' else 'uri' end as kind, l_partkey % 4 in (0, 1) as open, left('word ' || l_partkey || repeat(' x', l_quantity::int), 80) as sample from lineitem""")
def flag_rules(spark, sf_dir):
    """Severities by number of words and table pages, links that a writer made by itself, sentences without an end, samples cut to length."""
    from ..operators import bags

    l = table(spark, sf_dir, "lineitem")
    severity = F.when(F.col("l_partkey") % 10 == 0, "minor").otherwise(bags.severity(F.col("l_quantity")))
    uri = F.concat(F.when(F.col("l_suppkey") % 3 < 2, "http").otherwise("https"), F.lit("://a.b/"), F.col("l_suppkey").cast("string"))
    anchor = F.when(F.col("l_suppkey") % 3 == 0, F.concat(F.lit("a.b/"), F.col("l_suppkey").cast("string"))).otherwise("click")
    text = F.concat(F.lit("word"), F.element_at(F.array(*map(F.lit, (",", "", ".", "”"))), (F.col("l_partkey") % 4 + 1).cast("int")))
    sample = F.substring(F.concat(F.lit("word "), F.col("l_partkey").cast("string"), F.repeat(F.lit(" x"), F.col("l_quantity").cast("int"))), 1, 80)
    return l.select("l_orderkey", "l_linenumber", "l_partkey", severity.alias("severity"), F.when(bags.auto_link(uri, anchor), "auto-link").otherwise("uri").alias("kind"), bags.unterminated(text).alias("open"), sample.alias("sample"))


@query("""select doc_id, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') as escaped, text || ' é € A' as decoded from documents""")
def entities(spark, sf_dir):
    """Texts escaped for pages, and decoded again with every named and numbered entity."""
    from ..operators import tables

    d = table(spark, sf_dir, "documents").withColumn("e", tables.escape(F.col("text")))
    return d.select("doc_id", F.col("e").alias("escaped"), T.decoded(F.concat("e", F.lit(" &eacute; &euro; &#65;"))).alias("decoded"))
