"""Sections built from documents, their page facts, and the checks of one against the other.

Every 24 words of a document are a page: a heading or a line, a paragraph with a bold run, a link, a chip and a footnote, a
list item or sentences, a figure, a jump, and the footnote. What is left over is a page of one line.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit, gates, mutate, projection
from .registry import query, table

WORDS = 24
COLORS = ["#aa0000", "#00aa00", "#0000aa"]
LABELS = ["high", "low", "medium"]
KINDS = list(mutate.INVARIANT)

_w = "select doc_id as doc, regexp_extract_all(text, '[a-z]{3,}') as w from documents"
_page = f"""d as materialized ({_w}), p as materialized (select doc, i + 1 as page, w[i * 24 + 1:i * 24 + 24] as c, len(w) // 24 as full, (len(w) + 23) // 24 as pages, doc // 12 as pick, doc % 12 as kind from (select *, unnest(range((len(w) + 23) // 24)) as i from d)),
f as materialized (select *, ['high', 'low', 'medium'][page % 3 + 1] as label, case when page % 5 = 0 then 'http' else 'https' end || '://site.test/' || c[10] as uri, doc % 9 + 1 || '.' || page || ' ' || c[1] || ' ' || c[2] || ' ' || c[3] as head,
  array_to_string(c[13:20], ' ') as item from p where len(c) = 24)"""


def pages(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.regexp_extract_all("text", F.lit("[a-z]{3,}"), 0).alias("w")).where("size(w) > 0")
    p = d.select("doc", F.posexplode(F.expr(f"transform(sequence(0, (size(w) - 1) div {WORDS}), i -> slice(w, i * {WORDS} + 1, {WORDS}))")).alias("page", "c"))
    p = p.withColumn("page", F.col("page").cast("bigint") + 1)
    label = F.element_at(F.array(*map(F.lit, ("high", "low", "medium"))), (F.col("page") % 3 + 1).cast("int"))
    return p.select("*", (F.size("c") == WORDS).alias("full"), label.alias("label"), F.concat(F.when(F.col("page") % 5 == 0, "http").otherwise("https"), F.lit("://site.test/"), F.get("c", F.lit(9))).alias("uri"))


def _text(*parts):
    """Words by number, other strings as they are, columns as columns."""
    return F.concat(*(F.get("c", F.lit(x - 1)) if isinstance(x, int) else F.lit(x) if isinstance(x, str) else x for x in parts))


def _run(a, b):
    return F.array_join(F.slice("c", a, b - a + 1), " ")


def _number():
    return F.expr("concat(doc % 9 + 1, '.', page, ' ')")


def _page_text():
    """The Markdown of a page of pages()."""
    page = F.col("page").cast("string")
    head = F.when(F.col("page") % 3 == 1, F.concat(F.lit("## "), _number(), _run(1, 3))).otherwise(_run(1, 3))
    first = _text(4, " ", 5, " **", 6, " ", 7, "** ", 8, " [", 9, "](", F.col("uri"), ") ", 10, " :chip[", F.col("label"), "] ", 12, "[^", page, "]")
    second = F.when(F.col("page") % 2 == 0, F.concat(F.lit("- "), _run(13, 20))).otherwise(_text(13, " ", 14, ". Then ", _run(15, 18), ". ", 19, " ", 20))
    figure = F.when(F.col("page") % 4 == 2, _text("![", 21, "](figures/p", page, ".png)"))
    last = [_text(21, " [", 22, " ", 23, "](#s", page, ") ", 24), _text("[^", page, "]: ", 4, " ", 8, " note")]
    marker = F.concat(F.lit("<!-- p."), page, F.lit(" -->"))
    whole = F.concat_ws("\n\n", marker, head, first, second, figure, *last)
    return F.when(F.col("full"), whole).otherwise(F.concat(marker, F.lit("\n\n"), F.array_join("c", " ")))


def _section(p):
    """The Markdown of a document, of its sorted pages (page, t, ...)."""
    header = F.concat(F.lit("<!-- source: source.pdf pages 1-"), F.size(p).cast("string"), F.lit(" -->\n\n"))
    return F.concat(header, F.array_join(F.col(f"{p}.t"), "\n\n"), F.lit("\n"))


def sections(spark, sf_dir):
    """Rows (doc, text): every document's Markdown."""
    p = pages(spark, sf_dir).select("doc", "page", _page_text().alias("t"))
    return p.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("page", "t"))).alias("p")).select("doc", _section("p").alias("text"))


def _span(line, seg, text, y, when, bold=False, size=11.0, zone="body"):
    kinds = {"line": (F.lit(line), "int"), "seg": (F.lit(seg), "int"), "text": (text, "string"), "bold": (F.lit(bold), "boolean"), "size": (F.lit(size), "double"), "color": (F.lit("#000000"), "string"), "zone": (F.lit(zone), "string"), "x0": (F.lit(72.0 + 60 * seg), "double"), "y0": (F.lit(float(y)), "double"), "y1": (F.lit(float(y + 12)), "double")}
    return F.when(when, F.struct(*(c.cast(k).alias(n) for n, (c, k) in kinds.items())))


def _spans():
    """The spans of a page of pages(), those that it lacks null."""
    full, head, even = F.col("full"), F.col("page") % 3 == 1, F.col("page") % 2 == 0
    return [
        _span(1, 0, F.array_join("c", " "), 20, ~full),
        _span(1, 0, _run(1, 3), 20, full & ~head),
        _span(1, 0, F.concat(_number(), _run(1, 2)), 20, full & head, True, 13.0),
        _span(2, 0, _text(3), 36, full & head, True, 13.0),
        _span(3, 0, _text(4, " ", 5, " "), 60, full),
        _span(3, 1, _text(6, " "), 60, full, True),
        _span(3, 2, _text(7), 60, full, True),
        _span(3, 3, _text(" ", 8), 60, full),
        _span(4, 0, _text(9, " ", 10, " ", F.col("label"), " ", 12), 80, full),
        _span(4, 1, F.col("page").cast("string"), 80, full, False, 7.0, "fnref"),
        _span(5, 0, F.concat(F.lit("●​"), _run(13, 17)), 100, full & even),
        _span(6, 0, _run(18, 20), 120, full & even),
        _span(5, 0, _text(13, " ", 14, ". Then ", _run(15, 18), ". ", 19, " ", 20), 100, full & ~even),
        _span(7, 0, _run(21, 24), 140, full),
    ]


def _links():
    """The links of a full page."""
    return F.array(F.struct(F.lit("uri").alias("kind"), F.when(F.col("page") % 5 == 0, F.concat(F.lit("site.test/"), _text(10))).otherwise(_text(9)).alias("anchor"), F.col("uri").alias("uri"), F.lit(None).cast("bigint").alias("dest_page")), F.struct(F.lit("goto").alias("kind"), F.concat(F.lit("("), _text(22, " ", 23), F.lit(")")).alias("anchor"), F.lit(None).cast("string").alias("uri"), F.col("page").alias("dest_page")))


def page_facts(spark, sf_dir):
    """The facts of the same pages as the checks' sources have them."""
    p = pages(spark, sf_dir)
    f = p.where("full")
    return {
        "spans": p.select("doc", "page", F.explode(F.array_compact(F.array(*_spans()))).alias("s")).select("doc", "page", "s.*"),
        "links": f.select("doc", "page", F.posexplode(_links()).alias("k", "l")).select("doc", "page", "k", "l.*", F.lit(False).alias("unresolvable"), F.lit("").alias("name")),
        "pills": f.select("doc", "page", F.col("label").alias("text"), F.element_at(F.array(*map(F.lit, COLORS)), (F.col("page") % 3 + 1).cast("int")).alias("color")),
        "notes": f.select("doc", "page", F.col("page").alias("n"), _text(4, " ", 8, " note").alias("text")),
        "figures": f.where("page % 4 = 2").select("doc", "page", F.concat(F.lit("p"), F.col("page").cast("string"), F.lit(".png")).alias("file")),
        "expected": p.select("doc", "page"),
        "starts": p.select("doc").distinct().withColumn("page", F.lit(1).cast("bigint")),
    }


def documents(spark, sf_dir):
    """Rows (doc, text, and the page facts by name, as arrays): sections and page_facts at one reading, put together once.

    Each page makes its own facts, with the page in them, so that nothing but whole pages is dealt out by document.
    """
    page, full = F.col("page"), F.col("full")
    on_page = lambda x: F.struct(page.alias("page"), *(x[n].alias(n) for n in ("line", "seg", "text", "bold", "size", "color", "zone", "x0", "y0", "y1")))
    link = lambda x, k: F.struct(page.alias("page"), k.alias("k"), *(x[n].alias(n) for n in ("kind", "anchor", "uri", "dest_page")), F.lit(False).alias("unresolvable"), F.lit("").alias("name"))
    color = F.element_at(F.array(*map(F.lit, COLORS)), (page % 3 + 1).cast("int"))
    one = lambda when, **of: F.when(when, F.array(F.struct(page.alias("page"), *(c.alias(n) for n, c in of.items())))).otherwise(F.array())
    facts = {
        "spans": F.transform(F.array_compact(F.array(*_spans())), on_page),
        "links": F.when(full, F.transform(_links(), link)).otherwise(F.array()),
        "pills": one(full, text=F.col("label"), color=color),
        "notes": one(full, n=page, text=_text(4, " ", 8, " note")),
        "figures": one(full & (page % 4 == 2)),
        "expected": one(F.lit(True)),
    }
    p = pages(spark, sf_dir).select("doc", "page", _page_text().alias("t"), *(c.alias(k) for k, c in facts.items()))
    p = p.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("page", "t", *facts))).alias("p"))
    start = F.array(F.struct(F.lit(1).cast("bigint").alias("page")))
    return p.select("doc", _section("p").alias("text"), *(F.flatten(F.col(f"p.{k}")).alias(k) for k in facts), start.alias("starts"))


def registry(spark):
    return spark.createDataFrame([(x,) for x in LABELS], "label string")


def mutants(spark, sf_dir, *kinds):
    """Rows (doc, kind, text): each document with one defect of the class of its number."""
    s = sections(spark, sf_dir).withColumn("kind", F.element_at(F.array(*map(F.lit, KINDS)), (F.col("doc") % len(KINDS) + 1).cast("int"))).withColumn("pick", F.expr(f"doc div {len(KINDS)}"))
    return mutate.mutate_all(s.where(F.col("kind").isin(*kinds)) if kinds else s, "doc", "text", "kind", "pick")


def checked(spark, sf_dir, *kinds):
    """The Markdown facts of mutants of some classes, and the page facts of their documents."""
    m = mutants(spark, sf_dir, *kinds)
    own = {k: v.join(m.select("doc"), "doc", "left_semi") for k, v in page_facts(spark, sf_dir).items()}
    return projection.project_all(m, "doc", "text"), own


@query(f"""with {_page} select doc, 'marker' as kind, page::bigint as page, page::varchar as text, null as target from p union all select doc, 'heading', page, head, null from f where page % 3 = 1 union all select doc, 'bold', page, c[6] || ' ' || c[7], null from f
union all select doc, 'link', page, c[9], uri from f union all select doc, 'link', page, c[22] || ' ' || c[23], '#s' || page from f union all select doc, 'chip', page, label, null from f union all select doc, 'fn_ref', page, page::varchar, null from f
union all select doc, 'fn_def', page, c[4] || ' ' || c[8] || ' note', page::varchar from f union all select doc, 'item', page, left(item, 80), null from f where page % 2 = 0 union all select doc, 'image', page, '![' || c[21] || '](figures/p' || page || '.png)', null from f where page % 4 = 2""")
def md_projection(spark, sf_dir):
    """What the passes find in every section, against what the sections were made of."""
    md = projection.project_all(sections(spark, sf_dir), "doc", "text")
    return md.where("kind not in ('token', 'block')").drop("ord")


@query(f"""with {_page}, t as (select doc, page, case when page % 3 = 1 then head else array_to_string(c[1:3], ' ') end || ' ' || array_to_string(c[4:10], ' ') || ' ' || label || ' ' || c[12] || ' ' ||
  case when page % 2 = 0 then item else c[13] || ' ' || c[14] || '. Then ' || array_to_string(c[15:18], ' ') || '. ' || c[19] || ' ' || c[20] end || ' ' || array_to_string(c[21:24], ' ') as t from f union all select doc, page, array_to_string(c, ' ') from p where len(c) < 24)
select doc, page::bigint as page, len(string_split(t, ' '))::bigint as n, md5(t) as h from t""")
def md_words(spark, sf_dir):
    """The words that the passes leave, by page."""
    md = gates.of_kind(projection.project_all(sections(spark, sf_dir), "doc", "text"), "token")
    words = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), " ")
    return md.groupBy("doc", "page").agg(F.count("*").alias("n"), F.md5(words).alias("h"))


def _gate(kind, where="true"):
    """SQL: the pages of each class's documents that have a place for its defect, and which is taken."""
    return f"{_page}, s as (select *, row_number() over (partition by doc order by page) - 1 as nth, count(*) over (partition by doc) as n from f where kind = {KINDS.index(kind)} and {where}), x as materialized (select * from s where nth = pick % n)"


@query(f"""with {_gate("drop-link")}, o as (select x.doc, f.page, f.uri, f.c, row_number() over (partition by x.doc order by f.page) as k from x join f on f.doc = x.doc and f.uri = x.uri)
select doc, page::bigint as page, case when uri like 'http://%' then 'minor' else 'major' end as severity, uri as missing, case when page % 5 = 0 then 'site.test/' || c[10] else c[9] end as anchor from o where k = 1""")
def gate_l1(spark, sf_dir):
    md, facts = checked(spark, sf_dir, "drop-link")
    return gates.l1(md, facts["links"]).select("doc", "page", "severity", F.col("detail")["missing"].alias("missing"), F.col("detail")["anchor"].alias("anchor"))


@query(f"""with {_page}, s as (select * from f where kind = 3) select doc, page::bigint as page, c[22] || ' ' || c[23] || ' gone' as anchor, page::varchar as "to" from s where page % 7 = 0""")
def gate_l1_anchors(spark, sf_dir):
    """Jumps whose anchors the Markdown's links lack: here those that say more than the links do."""
    md, facts = checked(spark, sf_dir, "drop-link")
    links = facts["links"].withColumn("anchor", F.when((F.col("kind") == "goto") & (F.col("page") % 7 == 0), F.concat(F.expr("rtrim(')', anchor)"), F.lit(" gone)."))).otherwise(F.col("anchor")))
    return gates.l1(md, links).where("detail['kind'] = 'goto'").select("doc", "page", F.col("detail")["anchor"].alias("anchor"), F.col("detail")["to"].alias("to"))


@query(f"""with {_page} select doc, (any_value(pick) % any_value(pages) + 1)::bigint as page, 'duplicate' as kind from p where kind = 10 group by doc""")
def gate_p1(spark, sf_dir):
    md, facts = checked(spark, sf_dir, "dup-marker")
    return gates.p1(md, facts["expected"], facts["starts"]).select("doc", "page", F.col("detail")["kind"].alias("kind"))


@query(f"""with {_gate("drop-image", "page % 4 = 2")} select doc, page::bigint as page, 'major' as severity, '1' as expected, '0' as found from x""")
def gate_f1(spark, sf_dir):
    md, facts = checked(spark, sf_dir, "drop-image")
    return gates.f1(md, facts["figures"]).select("doc", "page", "severity", F.col("detail")["expected"].alias("expected"), F.col("detail")["found"].alias("found"))


_bold_lost = """b as (select doc, page, c[6] || c[7] as k, page as "from" from f where kind = 11), m as (select b.doc, b.page, b.k from b left join x using (doc, page) where x.doc is null
  union all select doc, page, replace(head, ' ', '') from f where kind = 11 and page % 3 = 1),
  hay as (select x.doc, string_agg(m.k, '' order by m.page, length(m.k)) as hay, bool_or(m.k = x.c[6] || x.c[7]) as same from x left join m on m.doc = x.doc and m.page between x.page - 1 and x.page + 1 group by 1),
  lost as (select x.* from x join hay using (doc) where not coalesce(same, false) and not coalesce(contains(hay, c[6] || c[7]), false))"""


@query(f"""with {_gate("drop-bold")}, {_bold_lost} select doc, page::bigint as page, c[6] || ' ' || c[7] as text from lost""")
def gate_s1(spark, sf_dir):
    md, facts = checked(spark, sf_dir, "drop-bold")
    return gates.s1(md, facts["spans"], gates.table_zone(md)).select("doc", "page", F.col("detail")["text"].alias("text"))


@query(f"""with {_gate("flatten-chip")} select doc, page::bigint as page, label as text, '0' as have, '1' as want from x""")
def gate_s2(spark, sf_dir):
    md, facts = checked(spark, sf_dir, "flatten-chip")
    return gates.s2(md, facts["pills"], COLORS).select("doc", "page", *(F.col("detail")[k].alias(k) for k in ("text", "have", "want")))


@query(f"""with {_gate("flatten-chip")} select f.doc, f.page::bigint as page, f.label from f left join x using (doc, page) where f.kind = 4 and f.label = 'medium' and x.doc is null""")
def gate_s3(spark, sf_dir):
    md, _ = checked(spark, sf_dir, "flatten-chip")
    return gates.s3(md, registry(spark).where("label <> 'medium'")).select("doc", "page", F.col("detail")["label"].alias("label"))


@query(f"""with {_gate("item-to-paragraph", "page % 2 = 0")} select doc, page::bigint as page, '1' as marks, '0' as items, left('●​' || array_to_string(c[13:17], ' '), 60) as sample from x""")
def gate_st1(spark, sf_dir):
    md, facts = checked(spark, sf_dir, "item-to-paragraph")
    return gates.st1(md, gates.lines_of(facts["spans"]), gates.table_zone(md)).select("doc", "page", *(F.col("detail")[k].alias(k) for k in ("marks", "items", "sample")))


_at = lambda s, low, high: f"{low + 1} + len({s}[{low + 1}:{high}]) - strpos(reverse({s}[{low + 1}:{high}]), ' ')"
_torn = f"""r as (select *, trim(item[{_at("item", 10, 30)} + 1:]) as rest from x), k as (select *, left(replace(rest, ' ', ''), 24) as key from r),
  torn as (select k.* from k where len(key) >= 14 and not exists (select 1 from (select unnest([case when page % 3 = 1 then replace(left(head, len(head) - len(c[3]) - 1), ' ', '') else array_to_string(c[1:3], '') end, case when page % 3 = 1 then c[3] else '' end, array_to_string(c[4:8], ''),
  c[9] || c[10] || label || c[12], array_to_string(c[13:17], ''), array_to_string(c[18:20], ''), array_to_string(c[21:24], '')]) as line) where line <> '' and (starts_with(line, key) or (len(line) >= 6 and starts_with(key, line)))))"""
_item_sites = "page % 2 = 0 and len(item) between 30 and 300 and strpos(item[11:30], ' ') > 0"


@query(f"""with {_gate("split-item", _item_sites)}, {_torn} select doc, page::bigint as page, left(rest, 60) as text from torn""")
def gate_st2(spark, sf_dir):
    md, facts = checked(spark, sf_dir, "split-item")
    return gates.st2(md, gates.lines_of(facts["spans"]), gates.table_zone(md)).select("doc", "page", F.col("detail")["text"].alias("text"))


_head_sites = "page % 3 = 1 and len(head) between 12 and 90 and strpos(head[7:45], ' ') > 0"


@query(f"""with {_gate("split-heading", _head_sites)} select doc, page::bigint as page, left(head, 70) as text from x""")
def gate_st3(spark, sf_dir):
    md, facts = checked(spark, sf_dir, "split-heading")
    return gates.st3(md, gates.lines_of(facts["spans"]), gates.table_zone(md)).select("doc", "page", F.col("detail")["text"].alias("text"))


@query(f"""with {_gate("drop-fndef")} select doc, page::bigint as page, 'ref-without-def' as kind, page::varchar as n from x union all select doc, page, 'body-without-def', page::varchar from x""")
def gate_fn1(spark, sf_dir):
    md, facts = checked(spark, sf_dir, "drop-fndef")
    return gates.fn1(md, facts["spans"], facts["notes"]).select("doc", "page", F.col("detail")["kind"].alias("kind"), F.col("detail")["n"].alias("n"))


@query(f"""with {_page}, s as (select *, page % 4 = 3 and exists (select 1 from f n where n.doc = f.doc and n.page = f.page + 1) as tailed from f where kind = 9) select doc, page::bigint as page, 'minor' as severity, page::varchar as n, left(c[4] || ' ' || c[8] || ' note' || case when page % 5 = 0 then ' more' else '' end || case when tailed then ' tail' || page + 1 else '' end, 80) as source from s where page % 5 = 0 or tailed""")
def gate_fn1_bodies(spark, sf_dir):
    """Notes that say more than the Markdown's: of their own page, or by a tail on the next."""
    facts = page_facts(spark, sf_dir)
    md = projection.project_all(sections(spark, sf_dir).where("doc % 12 = 9"), "doc", "text")
    notes = facts["notes"].where("doc % 12 = 9")
    own = notes.where("page % 4 <> 0").withColumn("text", F.concat("text", F.when(F.col("page") % 5 == 0, " more").otherwise("")))
    tails = notes.where("page % 4 = 0").withColumn("n", F.lit(None).cast("bigint")).withColumn("text", F.concat(F.lit("tail"), F.col("page").cast("string")))
    rest = notes.where("page % 4 = 0").withColumn("text", F.concat("text", F.when(F.col("page") % 5 == 0, " more").otherwise("")))
    out = gates.fn1(md, facts["spans"].where("doc % 12 = 9"), own.unionByName(tails).unionByName(rest))
    return out.select("doc", "page", "severity", F.col("detail")["n"].alias("n"), F.col("detail")["source"].alias("source"))


_sentence = "page % 2 = 1 and len('hen ' || array_to_string(c[15:18], ' ')) between 20 and 180"


@query(f"""with {_gate("delete-sentence", _sentence)} select doc, page::bigint as page, 'delete' as op, array_to_string(list_sort(string_split('Then ' || array_to_string(c[15:18], ' ') || '.', ' ')), ' ') as missing, 'major' as severity from x""")
def gate_t1(spark, sf_dir):
    md, facts = checked(spark, sf_dir, "delete-sentence")
    out = gates.t1(md, facts["spans"])
    # A sentence next to an equal word may be cut out one word sooner or later; its words are the same bag.
    words = lambda c: F.array_join(F.array_sort(F.split(c, " ")), " ")
    return out.select("doc", "page", F.col("detail")["op"].alias("op"), words(F.col("detail")["missing"]).alias("missing"), "severity")


def _recall_sql():
    pair = lambda a, b: f"exists (select 1 from (select unnest(range({a}, {b})) as k) where regexp_full_match(c[k], '[a-z]{{4,12}}') and regexp_full_match(c[k + 1], '[a-z]{{4,12}}') and c[k] <> c[k + 1])"
    swaps = f"case when len(c) < 24 then {pair(2, 'len(c) - 1')} when page % 3 = 1 and {pair(1, 2)} then true when page % 2 = 0 then {pair(13, 19)} else {pair(15, 17)} end"
    sites = {"split-item": _item_sites, "item-to-paragraph": "page % 2 = 0", "split-heading": _head_sites, "drop-link": "true", "flatten-chip": "true", "delete-sentence": _sentence, "drop-image": "page % 4 = 2", "drop-fndef": "true", "drop-bold": "true"}
    rows = [f"select '{k}' as kind, count(distinct doc) as tried, count(distinct doc) as caught from f where kind = {KINDS.index(k)} and {w}" for k, w in sites.items() if k not in ("split-item", "drop-bold")]
    rows += ["select 'dup-marker', count(distinct doc), count(distinct doc) from p where kind = 10", f"select 'swap-words', count(distinct doc), count(distinct doc) from p where kind = 7 and {swaps}"]
    rows.append("select 'duplicate-paragraph', count(distinct doc), count(distinct doc) from p where kind = 6 and (len(c) = 24 or len(array_to_string(c, ' ')) >= 60)")
    rows.append(f"select 'drop-bold', (select count(*) from (with {_gate('drop-bold')} select * from x)), (select count(*) from (with {_gate('drop-bold')}, {_bold_lost} select * from lost))")
    rows.append(f"select 'split-item', (select count(*) from (with {_gate('split-item', _item_sites)} select * from x)), (select count(*) from (with {_gate('split-item', _item_sites)}, {_torn} select * from torn))")
    of = " ".join(f"when '{k}' then '{v}'" for k, v in mutate.INVARIANT.items())
    return f"with {_page}, r as ({' union all '.join(rows)}) select kind, case kind {of} end as invariant, tried::bigint as tried, caught::bigint as caught from r where tried > 0"


@query(_recall_sql())
def mutation_recall(spark, sf_dir):
    """Of each class of defects how many documents could have it, and for how many its check has a flag that the whole section has not."""
    number = F.col("doc") % len(KINDS)
    d = documents(spark, sf_dir).withColumn("kind", F.element_at(F.array(*map(F.lit, KINDS)), (number + 1).cast("int"))).withColumn("pick", F.expr(f"doc div {len(KINDS)}"))
    return audit.recall(audit.audit(d, COLORS, LABELS, ("kind",), mutate.mutated, ("kind", "pick")), mutate.INVARIANT)


@query(f"""select 0::bigint as n from region where false""")
def gate_clean(spark, sf_dir):
    """Sections as they were made have no flags at all."""
    return audit.audit(documents(spark, sf_dir), COLORS, LABELS).agg(F.sum(F.size("flags")).alias("n")).where("n > 0")
