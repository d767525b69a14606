"""What sites, search and serialising make of sections: stitched texts, anchors, boxes, lists, search records, indexes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import markdown as M
from ..functions import text as T
from ..operators import islands, search
from . import card
from .registry import query, table

BASE = "/cards/x"


@query("""select doc_id // 10 as card, count(*)::bigint as files, md5(string_agg(regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', ''), chr(10) || chr(10) order by doc_id)) as h from documents group by 1""")
def stitched(spark, sf_dir):
    """The texts of a card's files, each trimmed, one after the other; ten documents are a card."""
    d = table(spark, sf_dir, "documents").select(F.expr("doc_id div 10").alias("card"), "doc_id", T.trim(F.col("text")).alias("t"))
    parts = F.array_sort(F.collect_list(F.struct("doc_id", "t")))
    return d.groupBy("card").agg(F.count("*").alias("files"), F.md5(F.array_join(F.transform(parts, lambda x: x["t"]), "\n\n")).alias("h"))


_site = "'<!-- source: source.pdf pages 1-2 -->' || chr(10) || '# Title ' || doc_id || chr(10) || chr(10) || case when doc_id % 2 = 0 then '*March 4, 2025*' || chr(10) || chr(10) else '' end || '<!-- p.' || doc_id || ' -->' || chr(10) || text || chr(10) || '![f](assets/figures/p1.png)<!-- note' || chr(10) || 'more -->'"
_mark = f"""'<a class="pagemark" id="p-' || doc_id || '" href="{BASE}/source.pdf#page=' || doc_id || '" title="Page ' || doc_id || ' of the source PDF" aria-label="Page ' || doc_id || ' of the source PDF" data-page="p.' || doc_id || '" target="_blank" rel="noopener"></a>'"""


def _prefaced(spark, sf_dir):
    table(spark, sf_dir, "documents").createOrReplaceTempView("_site_documents")
    return spark.sql(f"select doc_id, {_site} as md from _site_documents")


@query(f"""select doc_id, chr(10) || {_mark} || chr(10) || text || chr(10) || '![f]({BASE}/figures/p1.png)' as md from documents""")
def site_markdown(spark, sf_dir):
    return _prefaced(spark, sf_dir).select("doc_id", M.site_markdown(F.col("md"), BASE).alias("md"))


@query(f"""select doc_id, replace(replace({_site}, '<!-- source: source.pdf pages 1-2 -->' || chr(10), ''), '](assets/figures/', ']({BASE}/figures/') as md from documents""")
def portable_markdown(spark, sf_dir):
    return _prefaced(spark, sf_dir).select("doc_id", M.portable_markdown(F.col("md"), BASE).alias("md"))


_refs = "select doc_id, i, case when i % 4 = 1 then '<table><tr><td>' || line || '[^' || (i % 5 + 1) || ']</td></tr></table>' when i % 3 = 0 then line || '[^' || (i % 7 + 1) || ']' else line end as line, i % 4 = 1 as tab, case when i % 4 = 1 then i % 5 + 1 when i % 3 = 0 then i % 7 + 1 end as ref from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as i from documents)"


@query(f"""with l as ({_refs}), t as (select doc_id, ref, min(i) as i from l where tab group by 1, 2), lone as (select t.* from t where not exists (select 1 from l where l.doc_id = t.doc_id and l.ref = t.ref and not l.tab)),
s as (select doc_id, i, string_agg('[^' || ref || ']', '' order by ref) as refs from lone group by 1, 2),
o as (select doc_id, i, case when tab then replace(line, '[^' || ref || ']', '<sup class="fn-html"><a href="#user-content-fn-' || ref || '">' || ref || '</a></sup>') else line end || coalesce(chr(10) || chr(10) || '<span class="fnref-shim">' || refs || '</span>' || chr(10), '') as line from l left join s using (doc_id, i))
select doc_id, string_agg(line, chr(10) order by i) as md from o group by 1""")
def table_footnotes(spark, sf_dir):
    """References in table lines become links; those that stand in tables only are named again after their first table."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    note = lambda n: F.concat(F.lit("[^"), n.cast("string"), F.lit("]"))
    cell = F.concat(F.lit("<table><tr><td>"), "line", note(F.col("i") % 5 + 1), F.lit("</td></tr></table>"))
    lines = d.withColumn("line", F.when(F.col("i") % 4 == 1, cell).when(F.col("i") % 3 == 0, F.concat("line", note(F.col("i") % 7 + 1))).otherwise(F.col("line")))
    return search.with_table_notes(lines, "doc_id", "i", "line").groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "line"))), lambda x: x["line"]), "\n").alias("md"))


_cards = "select o_custkey, o_orderkey, '- [' || 'Order ' || o_orderkey || '](/' || o_custkey || '/' || o_orderkey || '/card.md): ' || o_custkey || ', ' || strftime(o_orderdate, '%Y-%m-%d') || '. ' || o_orderpriority as line, o_orderdate from orders"


@query(f"""select o_custkey as vendor, count(*)::bigint as cards, '# Cards' || chr(10) || chr(10) || string_agg(line, chr(10) order by o_orderdate desc, o_orderkey) || chr(10) as index from ({_cards}) group by 1""")
def card_index(spark, sf_dir):
    """Each vendor's cards, the newest first, as the lines of its index."""
    o = table(spark, sf_dir, "orders")
    key, vendor = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    line = search.index_line(F.concat(F.lit("Order "), key), F.concat(F.lit("/"), vendor, F.lit("/"), key, F.lit("/card.md")), vendor, F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderpriority"))
    return search.card_index(o.select(F.col("o_custkey").alias("vendor"), F.col("o_orderdate").alias("date"), F.col("o_orderkey").alias("card"), line.alias("line")))


_article = f"""{card._page}, part as (select doc, page, page % 5 + 2 as level, doc % 9 + 1 || '.' || page || ' & ' || c[1] as title, array_to_string(c[2:], ' ') as body from p)"""


@query(f"""with {_article} select doc, '/d/' || doc || '/#s-' || page as url, title, title || case when body <> '' then '. ' || body else '' end as content from part union all select distinct doc, '/d/' || doc || '/', 'Doc ' || doc, 'Doc ' || doc || '. Doc ' || doc || ' intro' from p""")
def search_records(spark, sf_dir):
    """One record for each heading of an article, and one for what stands before the first."""
    p = card.pages(spark, sf_dir)
    level = (F.col("page") % 5 + 2).cast("string")
    title = F.concat(F.expr("concat(doc % 9 + 1, '.', page, ' &amp; ')"), F.lit("<b>"), F.get("c", F.lit(0)), F.lit("</b>"))
    head = F.concat(F.lit("<h"), level, F.lit(' id="s-'), F.col("page").cast("string"), F.lit('">'), title, F.lit("</h"), level, F.lit(">\n<p>"), F.array_join(F.slice("c", 2, card.WORDS), "</p>  <p>"), F.lit("</p>"))
    doc = F.col("doc").cast("string")
    parts = p.groupBy("doc").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", head.alias("h")))), lambda x: x["h"]), "\n").alias("a"))
    html = F.concat(F.lit('<html><body><article class="article" lang="en"><h1>Doc '), doc, F.lit("</h1><p>intro</p>"), "a", F.lit("</article></body></html>"))
    return search.records(parts.select("doc", F.concat(F.lit("/d/"), doc, F.lit("/")).alias("url"), html.alias("html")), "url", "html").select("doc", "url", "title", "content")


_words = "select doc_id, word, count(*)::bigint as tf from (select doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) as word from documents) group by 1, 2"


@query(f"""with w as materialized ({_words}), n as (select doc_id, sum(tf)::bigint as n from w group by 1), df as (select word, count(*)::bigint as df from w group by 1), q as (select distinct item_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')[1:3]) as word from benchmark),
k as (select item_id, count(*) as k from q group by 1), m as (select item_id, doc_id, count(*) as k, round(sum(tf * ln(1 + (select count(*) from documents) / df::double)) / n, 6) as score from q join w using (word) join df using (word) join n using (doc_id) group by item_id, doc_id, n),
r as (select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id)::int as rank from m join k using (item_id, k)) select * from r where rank <= 10""")
def search_ranked(spark, sf_dir):
    """Documents that hold all words of a query (a passage's first three), the ten best by how often, how rare, and how short."""
    word = lambda c: F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}]+"), 0)
    q = table(spark, sf_dir, "benchmark").select("item_id", F.explode(F.slice(word(F.col("text")), 1, 3)).alias("word")).distinct()
    return search.ranked(table(spark, sf_dir, "documents").select("doc_id", word(F.col("text")).alias("words")), "doc_id", q, "item_id", 10)


@query(f"""with {card._page} select doc, page::bigint as page, '<span class="chip chip-' || case label when 'high' then 'red' when 'low' then 'green' else 'gray' end || '">' || label || '</span>' as chip from f""")
def chip_colors(spark, sf_dir):
    """Chips with the registry's colours, grey where it has none."""
    colors = spark.createDataFrame([("high", "red"), ("low", "green")], "label string, color string")
    chips = card.pages(spark, sf_dir).where("full").select("doc", "page", "label")
    return chips.join(F.broadcast(colors), "label", "left").select("doc", "page", M.chip_html(F.col("label"), F.col("color")).alias("chip"))  # a registry: a few rows


@query("""select conv_id, turn, case when turn % 4 = 0 then '<div class="turn turn-' || case when role = 'user' then 'user' else 'assistant' end || '"><div class="turn-label">' || case when role = 'user' then 'User' else 'Assistant' end || '</div>'
when turn % 4 = 1 then '<div class="turn turn-' || case when role = 'user' then 'user' else 'assistant' end || '"><div class="turn-label">L ' || turn || '</div>' when turn % 4 = 2 then '<aside class="box box-transcript"><div class="box-label">Transcript</div>' else '<div class="caption">' end as open, text as body from conversations""")
def box_lines(spark, sf_dir):
    """Directive lines as the boxes they open; other lines stay."""
    c = table(spark, sf_dir, "conversations")
    k = F.col("turn") % 4
    role = F.concat(F.lit(":::turn{role="), "role")
    line = F.when(k == 0, F.concat(role, F.lit("}"))).when(k == 1, F.concat(role, F.lit(' label="L '), F.col("turn").cast("string"), F.lit('"}'))).when(k == 2, "::::transcript").otherwise(":::caption")
    return c.select("conv_id", "turn", M.box_html(line).alias("open"), M.box_html(F.col("text")).alias("body"))


_letters = "select l_orderkey as list, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) as k, l_partkey as p from lineitem"


@query(f"""with l as ({_letters}), g as (select list, count(*) as n, bool_and(p % 9 > 0) as ok from l group by 1) select list, k::int as k, 'a' as type, 'item ' || p as item from l join g using (list) where n >= 2 and ok""")
def letter_lists(spark, sf_dir):
    """Lists whose items lead with a., b., c.: here one item in nine breaks the row."""
    l = table(spark, sf_dir, "lineitem")
    order = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"))
    text = F.concat(F.when(F.col("p") % 9 > 0, F.expr("char(96 + k)")).otherwise("z"), F.lit(". item "), F.col("p").cast("string"))
    rows = l.select(F.col("l_orderkey").alias("list"), order.alias("k"), F.col("l_partkey").alias("p")).withColumn("t", text)
    rows = rows.groupBy("list").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "t"))), lambda x: x["t"]).alias("items"))
    found = rows.select("list", M.letter_list(F.col("items")).alias("items")).where("items is not null")
    return found.select("list", F.posexplode("items").alias("k", "item")).select("list", (F.col("k") + 1).alias("k"), F.lit("a").alias("type"), "item")


_blocks = "select l_orderkey as doc, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) as k, case l_partkey % 5 when 0 then 'text' when 1 then 'marker' when 2 then 'heading' else 'image' end as kind, l_suppkey % 3 = 0 as captioned from lineitem"


@query(f"""with b as ({_blocks}), c as (select *, kind = 'image' and captioned as cap from b), n as (select *, case when kind = 'image' and lag(kind) over w = 'image' and not lag(cap) over w then 0 else 1 end as new from c window w as (partition by doc order by k)),
g as (select *, sum(new) over (partition by doc order by k rows unbounded preceding) as g from n) select doc, min(k)::int as first, count(*)::bigint as images, bool_or(cap) as captioned from g where kind = 'image' group by doc, g""")
def figure_groups(spark, sf_dir):
    """Images that follow each other are one figure, up to a caption, a marker or another block."""
    return search.figures(_block_rows(spark, sf_dir), "doc", "k")


def _block_rows(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    order = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"))
    kind = F.element_at(F.array(*map(F.lit, ("text", "marker", "heading", "image", "image"))), (F.col("l_partkey") % 5 + 1).cast("int"))
    return l.select(F.col("l_orderkey").alias("doc"), order.alias("k"), kind.alias("kind"), (F.col("l_suppkey") % 3 == 0).alias("captioned"))


@query(f"""with b as ({_blocks}), n as (select *, lead(kind) over (partition by doc order by k) as next from b) select doc, k::int as k, case when next = 'heading' then 'in heading' else 'alone' end as place from n where kind = 'marker'""")
def marker_places(spark, sf_dir):
    """Markers before a heading go into it; others stand alone."""
    b = _block_rows(spark, sf_dir)
    below = F.lead("kind").over(Window.partitionBy("doc").orderBy("k"))
    return b.withColumn("place", F.when(below == "heading", "in heading").otherwise("alone")).where("kind = 'marker'").select("doc", "k", "place")


@query(f"""with {card._page} select f.doc, f.page::bigint as page, c[4] || ' ' || c[8] || ' note' as body, (f.page * 40)::double as top from f where page % 6 <> 0""")
def sidenotes(spark, sf_dir):
    """References with the notes they name, where there is one that isn't hidden."""
    facts = card.page_facts(spark, sf_dir)
    refs = facts["spans"].where("zone = 'fnref'").select("doc", "page", F.col("text").cast("bigint").alias("n"))
    notes = facts["notes"].where("page % 6 <> 0").select("doc", "n", F.col("text").alias("body"))
    return refs.join(notes, ["doc", "n"]).select("doc", "page", "body", (F.col("page") * 40).cast("double").alias("top"))


@query(f"""with h as (select l_orderkey as doc, (l_partkey * 7 % 900)::double as top, min(l_partkey) as head from lineitem where l_linenumber % 2 = 1 group by 1, 2), s as (select distinct l_orderkey as doc, (l_suppkey * 11 % 1000)::double as scroll from lineitem where l_linenumber % 2 = 0)
select s.doc, s.scroll, h.head from s asof left join h on s.doc = h.doc and s.scroll + 96 >= h.top""")
def scroll_heads(spark, sf_dir):
    """The heading a reader is under at each place: the last one at most 96 below the top."""
    l = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "doc")
    heads = l.where("l_linenumber % 2 = 1").groupBy("doc", (F.col("l_partkey") * 7 % 900).cast("double").alias("at")).agg(F.min("l_partkey").alias("head"))
    places = l.where("l_linenumber % 2 = 0").select("doc", ((F.col("l_suppkey") * 11 % 1000).cast("double") + 96).alias("at")).distinct()
    return islands.as_of(places, heads, ["doc"], "at", "head").select("doc", (F.col("at") - 96).alias("scroll"), "head")


@query(f"""with {card._page} select doc, max(page)::bigint as pages, left(any_value(case when p1 then replace(head, ' ', '') end), 40) as first from (select p.doc, p.page, f.page = 1 as p1, f.head from p left join f using (doc, page)) group by 1""")
def section_heads(spark, sf_dir):
    """Pages of a section by its markers, and its first heading as it is compared."""
    s = card.sections(spark, sf_dir)
    pages = F.array_max(F.transform(F.regexp_extract_all("text", F.lit(M.MARKER), 1), lambda x: x.cast("bigint")))
    first = F.get(F.filter(F.split("text", "\n"), lambda x: x.startswith("#")), F.lit(0))
    return s.select("doc", pages.alias("pages"), F.substring(T.squash(F.regexp_replace(first, "^#+", "")), 1, 40).alias("first"))


@query("""select conv_id, turn, '[^' || turn || ']: ' || case when turn % 3 = 0 then 'lead' || chr(10) || '    - ' || role || chr(10) || '    - b' when turn % 3 = 1 then 'lead ● ' || role else text end || chr(10) || chr(10) as def,
'[Figure ' || turn || '] ' || role || ' [x](y)' as caption from conversations""")
def notes_and_captions(spark, sf_dir):
    """Footnotes with bullets as lists, and captions whose lead abuts the title."""
    c = table(spark, sf_dir, "conversations")
    body = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("lead ● "), "role", F.lit("●b ● "))).when(F.col("turn") % 3 == 1, F.concat(F.lit("lead ● "), "role")).otherwise(F.col("text"))
    return c.select("conv_id", "turn", M.footnote(F.col("turn"), body).alias("def"), M.glued_lead(F.concat(F.lit("[Figure "), F.col("turn").cast("string"), F.lit("]"), "role", F.lit(" [x](y)"))).alias("caption"))


@query("""with i as (select l_orderkey, l_linenumber, l_partkey, l_partkey % 4 as kind, l_suppkey % 3 as level, l_suppkey % 2 = 0 as quote from lineitem)
select l_orderkey, l_linenumber, l_partkey, case when quote then '> ' else '' end || repeat(case when quote then '   ' else '    ' end, case when kind = 2 then greatest(level, 1) else level end::int) ||
  case kind when 0 then '12. num ' || l_partkey when 1 then '- bullet ' || l_partkey when 2 then '- b. letter ' || l_partkey else '- **bold' || l_partkey || '**' end as line from i""")
def item_lines(spark, sf_dir):
    """Items as lines: numbers, bullets and letters at their depth, quoted or not."""
    l = table(spark, sf_dir, "lineitem")
    n, kind = F.col("l_partkey").cast("string"), F.col("l_partkey") % 4
    body = F.when(kind == 0, F.concat(F.lit("12)​ num "), n)).when(kind == 1, F.concat(F.lit("● bullet "), n)).when(kind == 2, F.concat(F.lit("b.letter "), n)).otherwise(F.concat(F.lit("**○ bold"), n, F.lit("**")))
    raw = F.when(kind == 2, F.concat(F.lit("b.​letter "), n)).otherwise(body)
    return l.select("l_orderkey", "l_linenumber", "l_partkey", M.list_item(body, F.col("l_suppkey") % 3, F.col("l_suppkey") % 2 == 0, raw).alias("line"))


_pagemark = f"""'<a class="pagemark" id="p-' || page || '" href="{BASE}/source.pdf#page=' || page || '" title="Page ' || page || ' of the source PDF" aria-label="Page ' || page || ' of the source PDF" data-page="p.' || page || '" target="_blank" rel="noopener"></a>'"""


@query(f"""with {card._page}, h as (select f.doc, f.page, case when page % 3 = 1 then '<h2 id="' || lower(regexp_replace(head, '[^a-z0-9 ]', '', 'g')).replace(' ', '-') || '">' || {_pagemark} || head || '</h2>' else '<p>' || {_pagemark} || '</p>' || chr(10) || '<p>' || array_to_string(c[1:3], ' ') || '</p>' end || chr(10) ||
'<p>' || c[4] || ' ' || c[5] || ' <strong>' || c[6] || ' ' || c[7] || '</strong> ' || c[8] || ' <a href="' || uri || '">' || c[9] || '</a> ' || c[10] || ' <span class="chip chip-' || case label when 'high' then 'red' else 'gray' end || '">' || label || '</span> ' || c[12] || '<sup><a href="#fn-' || page || '" id="fnref-' || page || '">' || page || '</a></sup></p>' || chr(10) ||
case when page % 2 = 0 then '<ul><li>' || item || '</li></ul>' else '<p>' || c[13] || ' ' || c[14] || '. Then ' || array_to_string(c[15:18], ' ') || '. ' || c[19] || ' ' || c[20] || '</p>' end || chr(10) || case when page % 4 = 2 then '<figure><div class="figure-card"><a href="figures/p' || page || '.png" class="figure-zoom"><img src="figures/p' || page || '.png" alt="' || c[21] || '" loading="lazy" decoding="async"></a></div></figure>' || chr(10) else '' end ||
'<p>' || c[21] || ' <a href="#s' || page || '">' || c[22] || ' ' || c[23] || '</a> ' || c[24] || '</p>' || chr(10) || '<aside class="note" id="fn-' || page || '">' || c[4] || ' ' || c[8] || ' note</aside>' as html from f
union all select doc, page, '<p>' || {_pagemark} || '</p>' || chr(10) || '<p>' || array_to_string(c, ' ') || '</p>' from p where len(c) < 24) select doc, md5(string_agg(html, chr(10) order by page)) as h from h group by 1""")
def rendered_sections(spark, sf_dir):
    """Whole sections as pages, by digest."""
    from ..functions import html

    return card.sections(spark, sf_dir).select("doc", F.md5(html.render(F.col("text"), BASE, {"high": "red"})).alias("h"))
