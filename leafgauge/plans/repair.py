"""Repairs of HTML tables: one table for each order, one row for each of its lines, built by the same SQL on both sides."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import table_spans, tables
from ..shipping import parts
from .registry import query, table

_LINES = "select l_orderkey as tid, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) - 1 as r, l_partkey as a, l_suppkey as b, cast(l_quantity as int) as q, cast(floor(l_extendedprice) as bigint) as e from {lineitem}"


def _own_lines(spark, sf_dir):
    """Spark's relation of lines for _LINES, dealt out by order: what is built of them is much larger than the lines are."""
    n = parts(table(spark, sf_dir, "lineitem"))
    return f"(select /*+ repartition({n}, l_orderkey) */ * from parquet.`{sf_dir}/lineitem.parquet`)"


def _both(*cells):
    """The same cells, each (tag, attributes, text) in SQL, for DuckDB and for Spark."""
    duck = ", ".join(f"{{'tag': {t}, 'attrs': {a}, 'html': {h}}}" for t, a, h in cells)
    spark = ", ".join(f"named_struct('tag', {t}, 'attrs', {a}, 'html', {h})" for t, a, h in cells)
    return f"[{duck}]", f"array({spark})"


def _fixture(*cells, where="true"):
    """DuckDB's relation rows(tid, r, cells), and a function that gives Spark's tables (tid, html)."""
    duck, own = _both(*cells)
    sql = f"l as ({_LINES.format(lineitem='lineitem')}), rows as materialized (select tid, r, {duck} as cells from l where {where}), t as materialized (select tid, list(cells order by r) as rows from rows group by 1)"

    def html(spark, sf_dir):
        lines = spark.sql(f"select tid, r, {own} as cells from ({_LINES.format(lineitem=_own_lines(spark, sf_dir))}) where {where}")
        per = lines.groupBy("tid").agg(F.array_sort(F.collect_list(F.struct("r", "cells"))).alias("x"))
        return per.select("tid", tables.render(F.transform("x", lambda x: x["cells"])).alias("html"))

    return sql, html


#: DuckDB: the cells of rows(tid, r, cells), and of t2(tid, rows).
_OUT = "select tid, r::int as row, (unnest(range(len(cells))))::int as col, unnest(cells).tag as tag, unnest(cells).attrs as attrs, unnest(cells).html as cell"
_ROWS = "u as (select tid, unnest(rows) as cells, unnest(range(len(rows))) as r from t2)"


def _cells(df, rows):
    """Rows (tid, row, col, tag, attrs, cell) of repaired tables, parsed and put together again on the way."""
    df = df.select("tid", F.posexplode(tables.parse(tables.render(rows))).alias("row", "r"))
    return df.select("tid", "row", F.posexplode("r").alias("col", "c")).select("tid", "row", "col", "c.tag", "c.attrs", F.col("c.html").alias("cell"))


_plain = lambda h: f"trim(regexp_replace({h}, '<[^>]+>', '', 'g'))"
_key = lambda h: f"regexp_replace(translate(regexp_replace({h}, '<[^>]+>', '', 'g'), '‘’“”\"–—', repeat(chr(39), 5) || '--'), '\\s+', '', 'g')"
_numeric = lambda h: f"({_plain(h)} = '' or regexp_full_match({_plain(h)}, '[\\d.,%±()\\s/x×*+-]+'))"
_word = "case when a % 3 = 0 then cast(q as varchar(9)) else 'Item <b>' || a || '</b>' end"
_tag = lambda k: f"case when a % 5 = 0 or (a % 5 = 1 and {k} % 2 = 0) or (a % 5 = 3 and {k} > 0) then 'th' else 'td' end"

_sql, _html = _fixture((_tag(0), "''", "case when a % 4 = 0 then '' else 'Lead ' || b end"), (_tag(1), "' class=\"x\"'", _word), (_tag(2), "''", "cast(q as varchar(9))"), (_tag(3), "''", "e || '%'"))


@query(f"""with {_sql}, x as (select tid, r, cells, len(list_filter(cells, lambda c: c.tag = 'td')) as n_td, len(list_filter(cells, lambda c: {_numeric('c.html')})) as n from rows),
y as (select tid, r, case when n_td between 1 and 3 then [cells[1]] || list_transform(cells[2:], lambda c: {{'tag': 'td', 'attrs': c.attrs, 'html': c.html}}) when n_td = 0 and n >= 3 then list_transform(cells, lambda c: {{'tag': 'td', 'attrs': c.attrs, 'html': c.html}}) else cells end as cells from x) {_OUT} from y""")
def table_data_headers(spark, sf_dir):
    return _cells(d := _html(spark, sf_dir), tables.demote_headers(tables.parse(d.html)))


_sql2, _html2 = _fixture(("case when a % 3 > 0 then 'th' else 'td' end", "case when a % 7 = 0 then ' rowspan=\"2\"' else '' end", "case when b % 2 = 0 then ' ' else 'Lead ' || b end"), ("'td'", "''", "case when a % 5 = 0 then '' else '<i>' || q || '</i>' end"), ("'td'", "''", "case when a % 5 = 0 then '' else cast(e as varchar(12)) end"))


@query(f"""with {_sql2}, s as (select *, bool_or(cells[1].attrs <> '') over (partition by tid) as used, lead(cells) over (partition by tid order by r) as below from rows),
y as (select tid, r, case when used and cells[1].tag = 'th' and cells[1].attrs = '' and trim(cells[1].html) <> '' and trim(below[1].html) = '' and len(list_filter(below, lambda c: {_plain('c.html')} <> '')) > 0
  then [{{'tag': 'th', 'attrs': ' rowspan="2"', 'html': cells[1].html}}] || cells[2:] else cells end as cells from s) {_OUT} from y""")
def table_split_leads(spark, sf_dir):
    return _cells(d := _html2(spark, sf_dir), tables.promote_split_leads(tables.parse(d.html)))


_sql3, _html3 = _fixture(("case when a % 2 = 0 then 'th' else 'td' end", "case when a % 4 = 0 then ' rowspan=\"' || (a % 3 + 2) || '\"' else '' end", "case when b % 3 = 0 then '' else 'Lead ' || b end"), ("'td'", "''", "cast(q as varchar(9))"))


@query(f"""with recursive {_sql3}, w as (select tid, r, cells, case when cells[1].attrs <> '' then regexp_extract(cells[1].attrs, '(\\d+)', 1)::int end as span from rows),
f as (select tid, r, cells, 0 as before, case when span is not null then span - 1 else 0 end as covered from w where r = 0 union all
  select w.tid, w.r, w.cells, f.covered, case when f.covered > 0 then f.covered - 1 when w.span is not null then w.span - 1 else 0 end from f join w on w.tid = f.tid and w.r = f.r + 1),
y as (select tid, r, case when before > 0 and cells[1].attrs = '' and cells[1].html = '' then cells[2:] when before > 0 and cells[1].attrs = '' and cells[1].tag = 'th' then [{{'tag': 'td', 'attrs': '', 'html': cells[1].html}}] || cells[2:] else cells end as cells from f) {_OUT} from y""")
def table_covered_rows(spark, sf_dir):
    return _cells(d := _html3(spark, sf_dir), tables.settle_covered_rows(tables.parse(d.html)))


_sql4, _html4 = _fixture(("'td'", "''", "case when a % 2 = 0 then 'v &amp; ' || (q % 3) else (a % 5) || ' <b>v &amp;</b> ' || (q % 3) end"), ("'td'", "''", "cast(q % 4 as varchar(3))"))


@query(f"""with {_sql4}, s as (select tid, r, k as col, cells[k + 1].html as h from rows, (select unnest([0, 1]) as k)),
p as (select *, count(*) over (partition by tid, col) as n, replace(regexp_replace(h, '<[^>]+>', '', 'g'), '&amp;', '&') as p, lead(replace(regexp_replace(h, '<[^>]+>', '', 'g'), '&amp;', '&')) over (partition by tid, col order by r) as below from s),
g as (select *, replace(p, ' ', '') as a, replace(below, ' ', '') as b from p),
c as (select *, n >= 3 and b <> '' and len(a) > len(b) and ends_with(a, b) as cut from g)
select tid, r::int as row, col::int as col, 'td' as tag, '' as attrs, case when cut then replace((select p[1:min(i)] from (select unnest(range(1, len(p) + 1)) as i) where len(replace(p[1:i], ' ', '')) = len(a) - len(b)), '&', '&amp;') else h end as cell from c""")
def table_cascades(spark, sf_dir):
    return _cells(d := _html4(spark, sf_dir), tables.uncascade(tables.parse(d.html)))


_sql5, _html5 = _fixture(("case when a % 2 = 0 then 'th' else 'td' end", "''", "'<b>x ' || b || '</b> y <b>z</b>'"), ("'td'", "''", "case when a % 3 = 0 then '• one <br/> • two' when a % 3 = 1 then 'lead • only' else '<i>• a •b' || q end"), ("'td'", "''", "'<p> Q1. why? </p><p>Q2.' || case when a % 2 = 0 then ' so? Q3. ' else '' end || 'it</p>'"))


@query(f"""with {_sql5}, y as (select tid, r, [{{'tag': cells[1].tag, 'attrs': '', 'html': case when cells[1].tag = 'th' then replace(replace(cells[1].html, '<b>', ''), '</b>', '') else cells[1].html end}},
{{'tag': 'td', 'attrs': '', 'html': case when cells[2].html like '• one%' then '• one <br>• two' when cells[2].html like '<i>%' then '<i>• a<br>• b' || split_part(cells[2].html, '•b', 2) else cells[2].html end}},
{{'tag': 'td', 'attrs': '', 'html': replace(cells[3].html, 'so? Q3. ', 'so?</p><p>Q3. ')}}] as cells from rows) {_OUT} from y""")
def table_cell_texts(spark, sf_dir):
    """Bold taken from headers, bullets on lines of their own, questions in paragraphs."""
    d = _html5(spark, sf_dir)
    rows = tables.parse(d.html)
    for change in (tables.unbold_header, tables.break_bullets, tables.split_questions):
        rows = tables.every_cell(rows, change)
    return _cells(d, rows)


_sql6, _html6 = _fixture(("'td'", "''", "case when a % 3 = 0 then '' else 'Lead' || b end"), ("'td'", "case when a % 11 = 0 then ' colspan=\"2\"' else '' end", "case when a % 4 = 0 then '(and so on' when a % 4 = 1 then 'Ends. ' when a % 4 = 2 then '' else '<p>two</p>' end"), ("'td'", "''", "case when b % 2 = 0 then 'lower ' || q else 'Upper ' || q end"))
_torn = f"(cells[1].html = '' and cells[2].attrs = '' and (cells[2].html like '(%' or cells[2].html like '<p>%' or cells[3].html like 'lower%'))"


@query(f"""with {_sql6}, m as (select *, r > 0 and {_torn} as torn from rows), g as (select *, sum((not torn)::int) over (partition by tid order by r) - 1 as g from m),
x as (select tid, g, k as col, cells[k].attrs as attrs, trim(cells[k].html) as h, r, torn from g, (select unnest([1, 2, 3]) as k)), f as (select *, row_number() over (partition by tid, g, col order by r) as nth from x where not torn or h <> ''),
j as (select tid, g, col, any_value(attrs order by nth) as attrs, count(*) as n, arg_min(h, nth) as first, string_agg(case when nth > 1 and regexp_matches(regexp_replace(h, '<[^>]+>', '', 'g'), '^[a-z(]') then ' ' else '</p><p>' end || replace(replace(h, '<p>', ''), '</p>', ''), '' order by nth) as j from f group by 1, 2, 3),
raw as (select tid, g, k as col, cells[k].html as raw from g, (select unnest([1, 2, 3]) as k) where not torn)
select tid, g::int as row, (col - 1)::int as col, 'td' as tag, (select cells[j.col].attrs from g where g.tid = j.tid and g.g = j.g and not g.torn) as attrs, case when n = 1 then raw else substr(j, 5) || '</p>' end as cell from j join raw using (tid, g, col)""")
def table_torn_rows(spark, sf_dir):
    return _cells(d := _html6(spark, sf_dir), tables.join_torn_rows(tables.parse(d.html)))


_short = "case when a % 3 = 0 then 1 else 0 end"
_sql7, _html7 = _fixture(("'td'", "case when a % 4 = 0 then ' rowspan=\"' || (b % 2 + 2) || '\"' when a % 5 = 0 then ' colspan=\"2\"' else '' end", "'x' || b"), ("'td'", "''", "cast(q as varchar(9))"))


@query(f"""with recursive {_sql7}, w as (select tid, r, cells, case when cells[1].attrs like ' row%' then regexp_extract(cells[1].attrs, '(\\d+)', 1)::int end as span, case when cells[1].attrs like ' col%' then 3 else 2 end as w from rows),
v as (select *, max(w) over (partition by tid) as full from w),
f as (select tid, r, span, case when span is not null then span - 1 else 0 end as covered, case when span is not null then r else -1 end as top, false as short from v where r = 0 union all
  select v.tid, v.r, v.span, case when f.covered > 0 then f.covered - 1 when v.span is not null then v.span - 1 else 0 end, case when f.covered <= 0 and v.span is not null then v.r when f.covered > 0 or (v.w = v.full - 1 and f.top >= 0) then f.top else -1 end, f.covered <= 0 and v.span is null and v.w = v.full - 1 and f.top >= 0
  from f join v on v.tid = f.tid and v.r = f.r + 1),
more as (select tid, top as r, count(*) as n from f where short group by 1, 2)
select w.tid, w.r::int as row, k::int as col, 'td' as tag, case when k = 0 and n is not null then ' rowspan="' || (span + n) || '"' else cells[k + 1].attrs end as attrs, cells[k + 1].html as cell from w left join more using (tid, r), (select unnest([0, 1]) as k)""")
def table_short_rows(spark, sf_dir):
    return _cells(d := _html7(spark, sf_dir), tables.extend_spans(tables.parse(d.html)))


_sql8, _html8 = _fixture(("'td'", "''", "case when a % 3 = 0 then 'white' else 'Dark' || b end"), ("'td'", "''", "case when a % 2 = 0 then '' else 'w <b>' || q || '</b>' end"))


@query(f"""with {_sql8}, y as (select tid, r, case when r > 0 and cells[1].html = 'white' and (cells[2].html = '' or regexp_matches(cells[2].html, '<b>[12]?[05]<')) then list_transform(cells, lambda c: {{'tag': case when c.html = '' then 'td' else 'th' end, 'attrs': '', 'html': c.html}}) else cells end as cells from rows) {_OUT} from y""")
def table_white_headers(spark, sf_dir):
    white = F.array(*map(F.lit, ["white", *(f"w{k}" for k in (5, 10, 15, 20, 25, 0))]))
    return _cells(d := _html8(spark, sf_dir), tables.promote_white_headers(tables.parse(d.html), white))


_head = "case when r < 2 and b % 3 > 0 then 'Head ' || r else 'x' || a end"
_sql9, _html9 = _fixture(("'td'", "''", _head), ("'td'", "''", "case when r < 2 and b % 3 > 0 then ' h' else cast(q as varchar(9)) end"))


@query(f"""with {_sql9}, p as (select a.tid, a.rows as a, b.rows as b from t a join t b on b.tid = a.tid + 1 where a.tid % 2 = 0), k as (select *, list_transform(a, lambda r: regexp_replace(r[1].html || '|' || r[2].html, '\\s', '', 'g')) as ka, list_transform(b, lambda r: regexp_replace(r[1].html || '|' || r[2].html, '\\s', '', 'g')) as kb from p),
n as (select *, coalesce((select min(i) from (select unnest(range(len(kb))) as i) where ka[i + 1] is distinct from kb[i + 1]), len(b)) as again from k),
t2 as (select tid, a || list_transform(b[again + 1:], lambda r, i: case when i = 1 then [{{'tag': 'td', 'attrs': '', 'html': '<!-- p.' || tid + 1 || ' -->' || r[1].html}}] || r[2:] else r end) as rows from n), {_ROWS} {_OUT} from u""")
def table_pages_joined(spark, sf_dir):
    """Tables of even numbers with the next one as the page they go on on."""
    d = _html9(spark, sf_dir).withColumn("rows", tables.parse(F.col("html")))
    b = d.select((F.col("tid") - 1).alias("tid"), F.col("rows").alias("below"))
    both = d.where("tid % 2 = 0").join(b, "tid")
    return _cells(both, tables.join_tables(both.rows, both.below, both.tid + 1))


_sql10, _html10 = _fixture(("'td'", "''", "case when a % 5 = 0 then 'flat <p>block ' || b || '</p>' when a % 5 = 1 then '<p>One</p> <p>two</p><p>(three</p>' when a % 5 = 2 then 'no end <i>' || b || '</i>' when a % 5 = 3 then 'ends;' else '(goes on' end"), ("'td'", "''", "case when b % 3 = 0 then 'low' when b % 3 = 1 then 'Up' else '' end"))


@query(f"""with {_sql10}, s as (select tid, r, k as col, cells[k + 1].html as h from rows, (select unnest([0, 1]) as k)), b as (select *, {_plain('h')} as p, lead({_plain('h')}) over (partition by tid, col order by r) as below from s)
select tid, r::int as row, col::int as col, 'flat and block' as rule from b where h like 'flat%' union all select tid, r::int, col::int, 'inside a sentence' from b, range(2) where h like '<p>One%'
union all select tid, r::int, col::int, 'torn' from b where p <> '' and right(p, 1) not in ('.', '!', '?', ':', ';', '…', '"', '”', chr(39), ')', ']') and regexp_matches(below, '^[a-z(‘’]')""")
def table_seams(spark, sf_dir):
    d = _html10(spark, sf_dir)
    return d.select("tid", F.explode(tables.seam_flags(tables.parse(d.html))).alias("f")).select("tid", "f.row", "f.col", "f.rule")


@query("""select doc_id, regexp_replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), '> <', '><', 'g') as clean from (select doc_id, '<table>  <caption>c ' || doc_id || '</caption> <tr> <td>' || text || '</td></tr> </table> ' as text from documents)""")
def html_clean(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", tables.clean(F.concat(F.lit("<table>  <caption>c "), F.col("doc_id").cast("string"), F.lit("</caption> <tr> <td>"), "text", F.lit("</td></tr> </table> "))).alias("clean"))


@query("""select page_id, regexp_replace(regexp_replace(html, '(?s)<title>.*?</title>', '', 'g'), '(?s)<caption>.*?</caption>', '', 'g') as html from pages""")
def html_captions(spark, sf_dir):
    """Captions taken out; here the titles are made captions first."""
    p = table(spark, sf_dir, "pages")
    html = F.regexp_replace(F.regexp_replace("html", "<title>", "<caption>"), "</title>", "</caption>")
    return p.select("page_id", tables.without_caption(html).alias("html"))


@query("""with l as (select doc_id, unnest(string_split(text, chr(10))) as x, generate_subscripts(string_split(text, chr(10)), 1) as i from documents), m as (select doc_id, i, case when i % 3 = 0 then '5 ' else '' end || trim(x, ' ' || chr(9) || chr(13) || chr(10)) || case when i % 2 = 1 then '.' else '' end as x from l),
p as (select doc_id, i, trim(x) as x from m where trim(x) <> ''), g as (select *, lag(x) over (partition by doc_id order by i) as b from p)
select doc_id, string_agg(case when b is null or (right(b, 1) in ('.', '-') and x[1] between '0' and '9') then '' else ' ' end || x, '' order by i) as joined from g group by 1""")
def wrapped_cells(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    edge = lambda x: T.trim(x)
    parts = F.transform(F.split("text", "\n"), lambda x, i: F.concat(F.when((i + 1) % 3 == 0, "5 ").otherwise(""), edge(x), F.when((i + 1) % 2 == 1, ".").otherwise("")))
    out = d.select("doc_id", tables.join_wrapped(parts).alias("joined"))
    return out.where("joined <> ''")


@query(f"""with {_sql9} select tid, r::int as row, regexp_replace('|' || cells[1].html || '||' || cells[2].html || '|', '\\s+', '', 'g') as key, 2 as width from rows""")
def table_row_keys(spark, sf_dir):
    d = _html9(spark, sf_dir).select("tid", F.posexplode(tables.parse(F.col("html"))).alias("row", "r"))
    return d.select("tid", "row", tables.row_key(d.r).alias("key"), tables.width(d.r).alias("width"))


# Tables whose rows were damaged in a known way beside the spans of the page that they came from: repairs give the rows back.
_CELLS = "select tid, r, a, b, 'M' || a || ' row' || r as c0, q || '.' || (a % 10) || 'x' || r as c1, e || '%y' || r as c2, 'w' || b || 'z' || r as c3, a % 6 as damage, b % 4 = 0 as bold from ({lines})"


def _of(names, sql):
    """sql with those columns as fields of a lambda's v: worked out once, not in every place that names them."""
    return re.sub(rf"(?<!')\b({names})\b(?!')", r"v.\1", sql)


def _span(text, j, y, bold="false", zone="'body'"):
    return f"named_struct('text', {text}, 'x0', cast({100 + 150 * j} as double), 'y0', cast({y} as double), 'x1', cast({100 + 150 * j} + 6 * length({text}) as double), 'y1', cast({y} + 10 as double), 'bold', {bold}, 'zone', {zone})"


@query(f"""with l as ({_LINES.format(lineitem='lineitem')}), c as ({_CELLS.format(lines='select * from l')}), n as (select tid, sum(bold::int) / (4 * count(*))::double < 0.9 as signifies from c group by 1),
x as (select c.tid, r, [case when damage = 5 then c0 || '<sup>[^7]</sup>' else c0 end, case when bold and signifies then '<b>' || c1 || '</b>' else c1 end, c2, c3] as cells from c join n using (tid))
select tid, r::int as row, unnest(range(4))::int as col, unnest(cells) as cell from x""")
def table_rows_mended(spark, sf_dir):
    """Cells glued, parted at the wrong place, turned round or run together, and notes swallowed: as the page has them again."""
    c = spark.sql(_CELLS.format(lines=_LINES.format(lineitem=_own_lines(spark, sf_dir))))
    one = lambda x: f"named_struct('tag', 'td', 'attrs', '', 'html', {x})"
    cells = {0: ("c0", "c1", "c2", "c3"), 1: ("c0", "c1 || ' ' || c2", "''", "c3"), 2: ("c0", "left(c1, 2)", "substring(c1, 3) || ' ' || c2", "c3"), 3: ("c0", "c2", "c3", "c1"), 4: ("c0 || ' ' || c1", "c2", "c3", "''"), 5: ("c0 || '7'", "c1", "c2", "c3")}
    rows = "case damage " + " ".join(f"when {k} then array({', '.join(map(one, v))})" for k, v in cells.items()) + " end"
    spans = ["array(" + ", ".join([_span("c0", 0, "40 * r"), _span("c1", 1, "40 * r", "bold"), _span("c2", 2, "40 * r"), _span("c3", 3, "40 * r")]) + ")"]
    note = "named_struct('text', '7', 'x0', cast(101 + 6 * length(c0) as double), 'y0', cast(40 * r - 1 as double), 'x1', cast(105 + 6 * length(c0) as double), 'y1', cast(40 * r + 5 as double), 'bold', false, 'zone', 'fnref')"
    spans.append(f"if(damage = 5, array({note}), array())")
    per = c.groupBy("tid").agg(F.array_sort(F.collect_list(F.struct("r", "c0", "c1", "c2", "c3", "damage", "bold"))).alias("x"))
    each = lambda sql: F.expr(f"transform(x, v -> {_of('r|c[0-3]|damage|bold', sql)})")
    out = table_spans.repair_all(per.select("tid", each(rows).alias("rows"), F.flatten(each(f"concat({', '.join(spans)})")).alias("spans")))
    out = out.select("tid", F.posexplode("rows").alias("row", "r"))
    return out.select("tid", "row", F.posexplode("r").alias("col", "c")).select("tid", "row", "col", F.col("c.html").alias("cell"))


_TALL = "select tid, r, a, b, 'Lead' || a || ' of' || r as h, 'first line ' || a || ' of many words that stand in this long cell number' || r as t1, 'second line ' || b || ' with as many words as the first one has or more' as t2, 'third line after a gap ' || q || ' ends.' as t3, a % 4 as kind from ({lines}) where r = 0"


@query(f"""with l as ({_LINES.format(lineitem='lineitem')}), c as ({_TALL.format(lines='select * from l')}) select tid, case kind when 0 then '<b>' || h || '</b> ' || t2 when 1 then '<p>' || t1 || ' ' || t2 || '</p><p>' || t3 || '</p>' when 2 then h || ' ' || t2 else h || ' ' || t3 end as cell, case when kind = 3 then ' colspan="2"' else '' end as attrs, 1::bigint as n from c""")
def table_cells_mended(spark, sf_dir):
    """Tall cells: bold leads, paragraphs, words that were cut off, rows that were one, headers over two columns."""
    c = spark.sql(_TALL.format(lines=_LINES.format(lineitem=_own_lines(spark, sf_dir))))
    cell = lambda x: f"named_struct('tag', 'td', 'attrs', '', 'html', {x})"
    rows = f"""case kind when 0 then array(array({cell("h || ' ' || t2")})) when 1 then array(array({cell("t1 || ' ' || t2 || ' ' || t3")})) when 2 then if(b % 2 = 0, array(array({cell("h")})), array(array({cell("h")}), array({cell("t2")}))) else array(array({cell("h")}, {cell("t3")})) end"""
    spans = f"""case kind when 0 then array({_span("h", 0, 0, "true")}, {_span("t2", 0, 12)}) when 1 then array({_span("t1", 0, 0)}, {_span("t2", 0, 12)}, {_span("t3", 0, 40)}) when 2 then array({_span("h", 0, 0)}, {_span("t2", 0, 12)}) else array({_span("h || ' ' || t3", 0, 0)}) end"""
    each = lambda sql: F.get(F.expr(f"transform(array(struct(h, t1, t2, t3, kind, b)), v -> {_of('h|t[1-3]|kind|b', sql)})"), F.lit(0))
    out = table_spans.repair_all(c.select("tid", each(rows).alias("rows"), each(spans).alias("spans")))
    out = out.select("tid", F.explode("rows").alias("r")).select("tid", F.explode("r").alias("c"))
    return out.groupBy("tid").agg(F.first("c.html").alias("cell"), F.first("c.attrs").alias("attrs"), F.count("*").alias("n"))


_hard, _hard_html = _fixture(("'td'", "case when a % 4 = 0 then ' rowspan=\"2\"' when a % 5 = 0 then ' colspan=\"2\"' else '' end", "'x' || b"), ("'td'", "''", "case when a % 7 = 0 then '<!-- p.' || a || ' -->' else 'y' end"))


@query(f"""with {_hard}, c as (select tid, count(*)::bigint as tr, sum((cells[1].attrs like ' row%')::int)::bigint as rowspans, sum((cells[1].attrs like ' col%')::int)::bigint as colspans, sum((cells[2].html like '<!%')::int)::bigint as pages from rows group by 1) select *, row_number() over (order by pages desc, rowspans + colspans desc, tr desc, tid)::int as place from c qualify place <= 15""")
def hard_tables(spark, sf_dir):
    """The fifteen hardest tables: by pages inside, spans, then rows."""
    t = _hard_html(spark, sf_dir)
    n = lambda pattern: F.regexp_count("html", F.lit(pattern)).cast("bigint")
    c = t.select("tid", n("<tr>").alias("tr"), n("rowspan=").alias("rowspans"), n("colspan=").alias("colspans"), n(r"<!-- p\.\d+ -->").alias("pages"))
    best = c.orderBy(F.desc("pages"), F.desc(F.col("rowspans") + F.col("colspans")), F.desc("tr"), "tid").limit(15)  # a report: fifteen rows
    from pyspark.sql import Window

    return best.withColumn("place", F.row_number().over(Window.orderBy(F.desc("pages"), F.desc(F.col("rowspans") + F.col("colspans")), F.desc("tr"), "tid")))
