"""HTML tables as rows of cells, and the checks and repairs that work on cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# Fixed value: what a numeric cell looks like.
NUMERIC = r"^[\d.,%±()\s/x×*+-]+$"


def grid(df: DataFrame, html: str) -> DataFrame:
    """df with row, col (from 0), tag, span and cell for every table cell of html, html itself dropped."""
    rows = F.regexp_extract_all(html, F.lit(r"(?s)<tr[^>]*>(.*?)</tr>"), 1)
    out = df.select(*(c for c in df.columns if c != html), F.posexplode(rows).alias("row", "tr"))
    cells = F.regexp_extract_all("tr", F.lit(r"(?s)(<t[hd][^>]*>.*?</t[hd]>)"), 1)
    out = out.select("*", F.posexplode(cells).alias("col", "td")).drop("tr")
    span = F.regexp_extract("td", r'^<t[hd][^>]*colspan="(\d+)"', 1)
    return out.select("*", F.substring("td", 2, 2).alias("tag"), F.when(span == "", 1).otherwise(span.cast("int")).alias("span"), F.regexp_replace("td", r"(?s)^<t[hd][^>]*>|</t[hd]>$", "").alias("cell")).drop("td")


def numeric_rows(cells: DataFrame, by: list[str]) -> DataFrame:
    """Rows (by, row, n, numeric, majority): whether at least max(2, n // 2 + 1) of a row's cells look numeric; empty ones do."""
    ok = F.when((F.col("cell") == "") | F.col("cell").rlike(NUMERIC), 1).otherwise(0)
    per = cells.groupBy(*by, "row").agg(F.count("*").alias("n"), F.sum(ok).alias("numeric"))
    return per.withColumn("majority", F.col("numeric") >= F.greatest(F.lit(2), F.floor(F.col("n") / 2) + 1))


def row_html(cells: Column, tag: str = "td") -> Column:
    return F.concat(F.lit("<tr>"), F.array_join(F.transform(cells, lambda x: F.concat(F.lit(f"<{tag}>"), x, F.lit(f"</{tag}>"))), ""), F.lit("</tr>"))


# Tables as arrays of rows of cells, and the repairs of them. All are Column expressions: nothing leaves the JVM.
CELL = "struct<tag:string,attrs:string,html:string>"
ROWS = f"array<array<{CELL}>>"
LOWER_START = r"^[a-z(‘’]"
SEAM_END = r"[.!?:;…\"”')\]]$"


def cell(tag, attrs, html) -> Column:
    return F.struct(tag.alias("tag"), attrs.alias("attrs"), html.alias("html"))


def parse(html: Column) -> Column:
    """The cells of a table, by row."""
    cells = lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?s)<t[hd][^>]*>.*?</t[hd]>"), 0), lambda c: cell(F.substring(c, 2, 2), F.regexp_extract(c, r"^<t[hd]([^>]*)>", 1), F.regexp_extract(c, r"(?s)^<t[hd][^>]*>(.*)</t[hd]>$", 1)))
    return F.transform(F.regexp_extract_all(html, F.lit(r"(?s)<tr>.*?</tr>"), 0), cells)


def render(rows: Column) -> Column:
    one = lambda c: F.concat(F.lit("<"), c["tag"], c["attrs"], F.lit(">"), c["html"], F.lit("</"), c["tag"], F.lit(">"))
    return F.concat(F.lit("<table>"), F.array_join(F.transform(rows, lambda r: F.concat(F.lit("<tr>"), F.array_join(F.transform(r, one), ""), F.lit("</tr>"))), ""), F.lit("</table>"))


def plain(html: Column) -> Column:
    return T.trim(T.strip_tags(html))


def attribute(attrs: Column, name: str) -> Column:
    """A number among a cell's attributes, null if it isn't there."""
    return F.nullif(F.regexp_extract(attrs, f'{name}="(\\d+)"', 1), F.lit("")).cast("int")


def width(row: Column) -> Column:
    """Columns that a row's cells span."""
    return F.aggregate(row, F.lit(0), lambda n, c: n + F.coalesce(attribute(c["attrs"], "colspan"), F.lit(1)))


def _tagged(c: Column, tag) -> Column:
    return cell(tag if isinstance(tag, Column) else F.lit(tag), c["attrs"], c["html"])


def demote_headers(rows: Column) -> Column:
    """Header cells of data rows become data: in mixed rows all but a first one, in rows of headers all if most look numeric."""

    def one(row):
        has = lambda tag: F.exists(row, lambda c: c["tag"] == tag)
        numeric = F.size(F.filter(row, lambda c: (plain(c["html"]) == "") | plain(c["html"]).rlike(NUMERIC)))
        mixed = F.transform(row, lambda c, i: F.when(i > 0, _tagged(c, "td")).otherwise(c))
        data = F.transform(row, lambda c: _tagged(c, "td"))
        return F.when(has("td") & has("th"), mixed).when(has("th") & (numeric >= F.greatest(F.lit(2), F.floor(F.size(row) / 2) + 1)), data).otherwise(row)

    return F.transform(rows, one)


def promote_split_leads(rows: Column) -> Column:
    """A header lead above a row as wide that lacks its own gets rowspan 2, in tables that have such leads already."""
    used = lambda rows: F.exists(rows, lambda r: F.exists(r, lambda c: c["attrs"].contains('rowspan="2"')))

    def one(rows, row, i):
        below, lead = F.get(rows, i + 1), F.get(row, F.lit(0))
        bare = T.trim(F.get(below, F.lit(0))["html"]) == ""
        filled = F.exists(below, lambda c: plain(c["html"]) != "")
        ok = (lead["tag"] == "th") & ~lead["attrs"].contains("rowspan") & (T.trim(lead["html"]) != "") & (F.size(below) == F.size(row)) & bare & filled
        return F.when(F.coalesce(ok, F.lit(False)), F.concat(F.array(cell(lead["tag"], F.concat(F.lit(' rowspan="2"'), lead["attrs"]), lead["html"])), F.slice(row, 2, F.size(row)))).otherwise(row)

    return T.once(rows, lambda t: F.when(used(t), F.transform(t, lambda row, i: one(t, row, i))).otherwise(t))


def settle_covered_rows(rows: Column) -> Column:
    """Rows under a first cell that spans them lose an empty first cell of their own; a header there becomes data."""

    def step(acc, row):
        lead = F.get(row, F.lit(0))
        span = attribute(lead["attrs"], "rowspan")
        rest = F.slice(row, 2, F.size(row))
        bare = span.isNull() & (T.trim(lead["html"]) == "")
        fixed = F.when(bare, rest).when(span.isNull() & (lead["tag"] == "th"), F.concat(F.array(_tagged(lead, "td")), rest)).otherwise(row)
        opens = (acc["covered"] <= 0) & span.isNotNull()
        covered = F.when(opens, span - 1).when(acc["covered"] > 0, acc["covered"] - 1).otherwise(0)
        new = F.when((acc["covered"] > 0) & (F.size(row) > 0), fixed).otherwise(row)
        return F.struct(covered.cast("int").alias("covered"), F.concat(acc["rows"], F.array(new)).alias("rows"))

    return F.aggregate(rows, F.struct(F.lit(0).alias("covered"), F.array().cast(ROWS).alias("rows")), step, lambda a: a["rows"])


def escape(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def uncascade(rows: Column) -> Column:
    """Cells that end with all of the cell below are cut where that begins, in tables of three rows or more."""

    def cut(c, a, b):
        keep = F.length(a) - F.length(b)
        lead = F.call_function("regexp_extract", T.unescape(T.strip_tags(c["html"])), F.concat(F.lit(r"^(?:\s*\S){"), F.greatest(keep, F.lit(0)).cast("string"), F.lit("}")), F.lit(0))
        return F.when(F.coalesce((b != "") & (keep > 0) & a.endswith(b), F.lit(False)), cell(c["tag"], c["attrs"], escape(lead))).otherwise(c)

    keys = lambda rows: F.transform(rows, lambda r: F.transform(r, lambda c: T.cell_key(c["html"])))
    every = lambda rows, keys: F.transform(rows, lambda row, r: F.transform(row, lambda c, k: cut(c, F.get(F.get(keys, r), k), F.get(F.get(keys, r + 1), k))))
    return T.once(rows, lambda t: F.when(F.size(t) >= 3, T.once(keys(t), lambda k: every(t, k))).otherwise(t))


def every_cell(rows: Column, change) -> Column:
    """change(cell) is the new text of each cell."""
    return F.transform(rows, lambda r: F.transform(r, lambda c: cell(c["tag"], c["attrs"], change(c))))


def break_bullets(c: Column) -> Column:
    """A cell's text with each of several bullets on a line of its own."""
    lines = F.regexp_replace(T.trim(c["html"]), r"(?:<br\s*/?>)?\s*•\s*", "<br>• ")
    return F.when(F.regexp_count(c["html"], F.lit("•")) >= 2, F.regexp_replace(lines, r"^((?:<[^>]+>)*?)<br>", "$1")).otherwise(c["html"])


def unbold_header(c: Column) -> Column:
    return F.when(c["tag"] == "th", F.regexp_replace(c["html"], "</?b>", "")).otherwise(c["html"])


def split_questions(c: Column) -> Column:
    """Numbered questions inside a line begin a paragraph where a cell has two such paragraphs already."""
    return F.when(F.regexp_count(c["html"], F.lit(r"<p>\s*Q\d+\.")) >= 2, F.regexp_replace(c["html"], r"([?.!”’)\]])\s+(Q\d+\.\s)", "$1</p><p>$2")).otherwise(c["html"])


def promote_white_headers(rows: Column, white: Column) -> Column:
    """Rows after the first whose filled cells all stand in white become headers; white: keys of the white texts."""
    key = lambda c: T.cell_key(c["html"])
    filled = lambda r: F.filter(r, lambda c: plain(c["html"]) != "")
    ok = lambda r: (F.size(filled(r)) > 0) & F.forall(filled(r), lambda c: F.array_contains(white, key(c)))
    up = lambda r: F.transform(r, lambda c: F.when(plain(c["html"]) != "", _tagged(c, "th")).otherwise(c))
    return F.transform(rows, lambda r, i: F.when((i > 0) & ok(r), up(r)).otherwise(r))


def join_torn_rows(rows: Column) -> Column:
    """Rows that go on with the row above join it, cell by cell.

    Such a row is as wide, has no colspan, an empty first cell, and a cell that begins with a small letter, a bracket or
    a single quote. Both sides become paragraphs; those that flow on are one paragraph, others stand one after the other.
    """
    low = lambda c: (T.cell_key(c["html"]) != "") & plain(c["html"]).rlike(LOWER_START)

    def grown(p, c):
        cur, above = T.trim(c["html"]), F.regexp_replace(p["html"], r"(?U)\s+$", "")
        a = F.when(above.endswith("</p>"), above).otherwise(F.concat(F.lit("<p>"), above, F.lit("</p>")))
        b = F.when(cur.startswith("<p>"), cur).otherwise(F.concat(F.lit("<p>"), cur, F.lit("</p>")))
        both = F.when(plain(cur).rlike(LOWER_START), F.concat(F.substring(a, F.lit(1), F.length(a) - 4), F.lit(" "), F.substring(b, F.lit(4), F.length(b)))).otherwise(F.concat(a, b))
        return F.when(T.cell_key(c["html"]) == "", p).otherwise(cell(p["tag"], p["attrs"], both))

    def step(acc, row):
        above = F.element_at(acc, -1)
        rest = F.slice(row, 2, F.size(row))
        torn = (F.size(row) == F.size(above)) & (T.cell_key(F.get(row, F.lit(0))["html"]) == "") & F.exists(rest, low) & ~F.exists(row, lambda c: c["attrs"].contains("colspan"))
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.zip_with(above, row, grown)))
        return F.when((F.size(acc) > 0) & (F.size(row) > 0) & F.coalesce(torn, F.lit(False)), joined).otherwise(F.concat(acc, F.array(row)))

    return F.aggregate(rows, F.array().cast(ROWS), step)


def extend_spans(rows: Column) -> Column:
    """Rows one column short of the table that no first cell spans: the last first cell that spanned rows up to there spans them too."""
    start = F.struct(F.lit(0).alias("covered"), F.lit(-1).alias("at"), F.lit(0).alias("span"), F.array().cast(ROWS).alias("rows"))

    def step(full, acc, row):
        span = attribute(F.get(row, F.lit(0))["attrs"], "rowspan")
        n = F.size(acc["rows"])
        opens = (acc["covered"] <= 0) & span.isNotNull()
        short = (acc["covered"] <= 0) & span.isNull() & (width(row) == full - 1) & (acc["at"] >= 0)
        longer = lambda r: F.transform(r, lambda c, i: F.when(i == 0, cell(c["tag"], F.replace(c["attrs"], F.concat(F.lit('rowspan="'), acc["span"].cast("string"), F.lit('"')), F.concat(F.lit('rowspan="'), (acc["span"] + 1).cast("string"), F.lit('"'))), c["html"])).otherwise(c))
        before = F.when(short, F.transform(acc["rows"], lambda r, i: F.when(i == acc["at"], longer(r)).otherwise(r))).otherwise(acc["rows"])
        covered = F.when(opens, span - 1).when(acc["covered"] > 0, acc["covered"] - 1).otherwise(0)
        at = F.when(opens, n).when((acc["covered"] > 0) | short, acc["at"]).otherwise(-1)
        new = F.when(opens, span).when(short, acc["span"] + 1).otherwise(acc["span"])
        return F.struct(covered.cast("int").alias("covered"), at.cast("int").alias("at"), new.cast("int").alias("span"), F.concat(before, F.array(row)).alias("rows"))

    fold = lambda t, full: F.aggregate(t, start, lambda acc, row: step(full, acc, row), lambda a: a["rows"])
    return T.once(rows, lambda t: T.once(F.array_max(F.transform(t, width)), lambda full: fold(t, full)))


def row_key(row: Column) -> Column:
    """What rows are compared by: tags as bars, no blanks."""
    return F.regexp_replace(F.array_join(F.transform(row, lambda c: F.concat(F.lit("|"), T.strip_tags(c["html"], "|"), F.lit("|"))), ""), r"(?U)\s+", "")


def join_tables(above: Column, below: Column, page: Column) -> Column:
    """Rows of a table that goes on on a page, in one: null unless the columns agree; header rows that come again are dropped.

    The first row after the seam has the page's marker before its first cell's text.
    """
    n = lambda row: F.size(row)

    def joined(above, below, a, b):
        fits = (F.size(above) > 0) & (F.size(below) > 0) & ((n(F.get(below, F.lit(0))) == n(F.get(above, F.lit(0)))) | (n(F.get(below, F.lit(0))) == n(F.element_at(above, -1))))
        again = F.coalesce(F.array_min(F.filter(F.transform(b, lambda k, i: F.when(F.coalesce(F.get(a, i) == k, F.lit(False)), F.lit(None)).otherwise(i)), lambda x: x.isNotNull())), F.size(below))
        rest = F.slice(below, again + 1, F.size(below))
        marked = F.transform(rest, lambda r, i: F.when(i == 0, F.transform(r, lambda c, k: F.when(k == 0, cell(c["tag"], c["attrs"], F.concat(F.lit("<!-- p."), page.cast("string"), F.lit(" -->"), c["html"]))).otherwise(c))).otherwise(r))
        return F.when(fits, F.concat(above, marked))

    keys = lambda rows: F.transform(rows, row_key)
    whole = lambda x, y: T.once(keys(x), lambda a: T.once(keys(y), lambda b: joined(x, y, a, b)))
    return T.once(above, lambda x: T.once(below, lambda y: whole(x, y)))


def seam_flags(rows: Column) -> Column:
    """Flags (rule, row, col) of a table: a cell that mixes bare text and paragraphs, a paragraph that begins within a
    sentence, a cell without an end above one that goes on."""

    def of(rows, row, r):
        def one(c, k):
            below = plain(F.get(F.get(rows, r + 1), k)["html"])
            mix = c["html"].contains("<p>") & c["html"].rlike(r"^\s*[^<\s]")
            inside = F.regexp_count(c["html"], F.lit(r"</p>\s*<p>\s*[a-z(‘’]"))
            torn = (plain(c["html"]) != "") & ~plain(c["html"]).rlike(SEAM_END) & F.coalesce(below.rlike(LOWER_START), F.lit(False))
            flag = lambda rule: F.struct(F.lit(rule).alias("rule"), r.alias("row"), k.alias("col"))
            return F.concat(F.when(mix, F.array(flag("flat and block"))).otherwise(F.array()), F.array_repeat(flag("inside a sentence"), inside), F.when(torn, F.array(flag("torn"))).otherwise(F.array()))

        return F.flatten(F.transform(row, one))

    return T.once(rows, lambda t: F.flatten(F.transform(t, lambda row, r: of(t, row, r))))


def join_wrapped(parts: Column) -> Column:
    """Lines of a wrapped cell as one: a blank between them, but for a number after a full stop or hyphen."""

    def step(acc, x):
        x = T.trim(x)
        gap = F.when((acc == "") | (acc.rlike(r"[.-]$") & x.rlike(r"(?U)^\d")), "").otherwise(" ")
        return F.when(x == "", acc).otherwise(F.concat(acc, gap, x))

    return F.aggregate(parts, F.lit(""), step)


def clean(html: Column) -> Column:
    """Blanks made one, none between tags."""
    return T.trim(F.replace(F.regexp_replace(html, r"(?U)\s+", " "), F.lit("> <"), F.lit("><")))


def without_caption(html: Column) -> Column:
    return F.regexp_replace(html, r"(?s)<caption>.*?</caption>", "")
