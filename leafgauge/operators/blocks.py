"""Blocks of a document in order, and what turns them into text: markers, separators, fences, stitching, marks.

blocks: rows (doc, k, page, type, ...) with k the place in the document. Windows and folds go by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Characters that end a sentence at a page's foot, and what opens and closes each mark.
ENDS = r"[.!?:”\"’]$"
SYNTAX = {"bold": ("**", "**"), "italic": ("*", "*"), "code": ("`", "`"), "underline": ("<u>", "</u>"), "placeholder": ('<span class="ph">', "</span>")}


def _order() -> Window:
    return Window.partitionBy("doc").orderBy("k")


def page_markers(blocks: DataFrame, first: int = 1) -> DataFrame:
    """Rows (doc, k, page, place): where the page changes, before block k; inline where an item follows an item."""
    w = _order()
    inline = (F.col("type") == "item") & (F.lag("type").over(w) == "item")
    rows = blocks.withColumn("before", F.coalesce(F.lag("page").over(w), F.lit(first))).withColumn("place", F.when(F.coalesce(inline, F.lit(False)), "inline").otherwise("alone"))
    return rows.where("page <> before").select("doc", "k", "page", "place")


def separators(blocks: DataFrame) -> DataFrame:
    """Rows (doc, k, blank): whether a blank line stands before a block; items of one list stay together."""
    w = _order()
    together = (F.col("type") == "item") & (F.lag("type").over(w) == "item") & F.col("quote").eqNullSafe(F.lag("quote").over(w))
    return blocks.select("doc", "k", ((F.row_number().over(w) > 1) & ~F.coalesce(together, F.lit(False))).alias("blank"))


def transcripts(blocks: DataFrame, inside: Column) -> DataFrame:
    """Rows (doc, first, last): runs of blocks that belong into a transcript's fence."""
    rows = blocks.withColumn("_in", inside).withColumn("_new", F.when(F.col("_in") & F.coalesce(F.lag(inside).over(_order()), F.lit(False)), 0).otherwise(1))
    rows = rows.withColumn("_run", F.sum("_new").over(_order())).where("_in")
    return rows.groupBy("doc", "_run").agg(F.min("k").alias("first"), F.max("k").alias("last")).drop("_run")


def carried_quotes(blocks: DataFrame) -> DataFrame:
    """blocks in which an item is a quote only if the last paragraph before it, on whatever page, was one."""
    last = F.last(F.when(F.col("type") == "paragraph", F.col("quote")), ignorenulls=True).over(_order().rowsBetween(Window.unboundedPreceding, -1))
    return blocks.withColumn("quote", F.when(F.col("type") == "item", F.col("quote") & F.coalesce(last, F.lit(False))).otherwise(F.col("quote")))


def boxed_turns(blocks: DataFrame, label_only: Column) -> DataFrame:
    """Rows (doc, k, turn, role, how) of code blocks: those that follow a turn of a label only belong to it (absorbed); others
    take the role of the last turn before them (inherited), if there is one."""
    w = _order()
    rows = blocks.withColumn("_code", F.col("type") == "code").withColumn("_label", (F.col("type") == "turn") & label_only)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    head = F.last(F.when(~F.col("_code"), F.struct("k", F.col("_label").alias("label"))), ignorenulls=True).over(before)
    turn = F.last(F.when(F.col("type") == "turn", F.struct("k", "role")), ignorenulls=True).over(before)
    rows = rows.withColumn("_head", head).withColumn("_turn", turn).where("_code and _turn is not null")
    return rows.select("doc", "k", F.col("_turn.k").alias("turn"), F.col("_turn.role").alias("role"), F.when(F.col("_head.label"), "absorbed").otherwise("inherited").alias("how"))


def stitched(blocks: DataFrame) -> DataFrame:
    """Rows (doc, first, n, pages, type, text): blocks that a page break tore apart, joined.

    A block joins the chain before it if it is on the page after the chain's first block, the chain's last text doesn't end a
    sentence, and it goes on: a small letter, or a comma before it, in a paragraph, a turn of one role, or a caption's small
    print; or it hangs under a list item. Code joins code. The chain's head decides its page and type: a fold.
    """
    item = F.struct("k", "page", "type", "quote", "role", "text", "x0", "marker_x0", "size")
    kind = "struct<first:bigint,page:bigint,type:string,quote:boolean,role:string,tail:string,marker_x0:double,n:int,last_page:bigint,text:string>"

    def step(acc, b):
        c = F.element_at(acc, -1)
        open_ = (c["tail"] != "") & ~c["tail"].rlike(ENDS)
        low, comma = b["text"].rlike(r"(?U)^\p{Lower}"), c["tail"].rlike("[,;]$")
        prose = b["type"] == "paragraph"
        goes = (
            ((b["type"] == "code") & (c["type"] == "code"))
            | ((b["type"] == "turn") & (c["type"] == "turn") & b["role"].eqNullSafe(c["role"]) & open_ & (low | comma))
            | (prose & (c["type"] == "caption") & (b["size"] <= 9.5) & open_ & (low | comma))
            | (prose & (c["type"] == "paragraph") & open_ & (low | ((b["quote"] == c["quote"]) & comma)))
            | (prose & (c["type"] == "item") & open_ & (b["x0"] > c["marker_x0"] + 6))
        )
        joins = (F.size(acc) > 0) & F.coalesce((b["page"] == c["page"] + 1) & goes, F.lit(False))
        new = F.struct(b["k"].cast("bigint").alias("first"), b["page"].cast("bigint").alias("page"), b["type"].alias("type"), b["quote"].alias("quote"), b["role"].alias("role"), b["text"].alias("tail"), b["marker_x0"].cast("double").alias("marker_x0"), F.lit(1).alias("n"), b["page"].cast("bigint").alias("last_page"), b["text"].alias("text")).cast(kind)
        marker = F.when(b["page"] != c["last_page"], F.concat(F.lit("<!-- p."), b["page"].cast("string"), F.lit(" --> "))).otherwise(" ")
        grown = F.struct(c["first"], c["page"], c["type"], c["quote"], c["role"], b["text"].alias("tail"), c["marker_x0"], (c["n"] + 1).alias("n"), b["page"].cast("bigint").alias("last_page"), F.concat(c["text"], marker, b["text"]).alias("text")).cast(kind)
        return F.when(joins, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(grown))).otherwise(F.concat(acc, F.array(new)))

    per = blocks.groupBy("doc").agg(F.array_sort(F.collect_list(item)).alias("b"))
    out = per.select("doc", F.explode(F.aggregate("b", F.array().cast(f"array<{kind}>"), step)).alias("c"))
    return out.select("doc", "c.first", "c.n", (F.col("c.last_page") - F.col("c.page") + 1).alias("pages"), "c.type", "c.text")


def footnote_lines(lines: DataFrame, below: float, gap: float = 14) -> DataFrame:
    """Rows (page, place, note) of lines that belong to footnotes; note null: the tail of the page before's last.

    lines: rows (page, place, y0, y1, small, marker), marker the number that a small line begins with. A marker opens a note
    and a line that isn't small ends it. Small lines right above the first marker, low on the page, are a tail.
    """
    w = Window.partitionBy("page").orderBy("place")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    event = F.when(F.col("marker").isNotNull(), F.col("marker")).when(~F.col("small"), -1)
    rows = lines.withColumn("note", F.last(event, ignorenulls=True).over(so_far)).withColumn("first", F.min(F.when(F.col("marker").isNotNull(), F.col("place"))).over(Window.partitionBy("page")))
    far = F.lead("y0").over(w) - F.col("y1") > gap
    broken = (F.col("place") < F.col("first")) & (~F.col("small") | (F.col("y0") <= below) | far)
    up = Window.partitionBy("page").orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("breaks", F.sum(F.when(broken, 1).otherwise(0)).over(up))
    tail = (F.col("place") < F.col("first")) & (F.col("breaks") == 0)
    return rows.where(tail | (F.col("note") >= 0)).select("page", "place", F.when(F.col("note") >= 0, F.col("note")).alias("note"))


def turn_breaks(lines: DataFrame, by: list[str], order: str) -> DataFrame:
    """Rows (by, order) of lines that begin a paragraph inside a turn: after a gap, or after a short line that ends a sentence
    or is followed by a capital."""
    w = Window.partitionBy(*by).orderBy(order)
    lag = lambda c: F.lag(c).over(w)
    gap = F.col("y0") - lag("y1") > F.greatest(F.lit(4.0), 0.55 * (lag("y1") - lag("y0")))
    short = lag("x1") < F.max("x1").over(Window.partitionBy(*by)) - 50
    over = lag("text").rlike(r"[.!?:…\"”'\)\]]\s*$") | F.col("text").rlike(r"(?U)^\s*\p{Lu}")
    return lines.withColumn("_new", F.coalesce(gap | (short & over), F.lit(False))).where("_new").select(*by, order)


def wrap_fits(lines: DataFrame, by: list[str], order: str) -> DataFrame:
    """Rows (by, order, fits): whether a line's first word would not have had room on the line above, in blocks of two lines or more."""
    w = Window.partitionBy(*by).orderBy(order)
    right = F.max("x1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    width = F.lag((F.col("x1") - F.col("x0")) / F.greatest(F.length("text"), F.lit(1))).over(w)
    word = F.length(F.regexp_extract("text", r"^\s*(\S*)", 1))
    fits = (right - F.lag("x1").over(w) < (word + 1) * width) & (F.row_number().over(w) > 2)
    return lines.select(*by, order, F.coalesce(fits, F.lit(False)).alias("fits"))


def spliced(lines: Column, at: Column, page: Column) -> Column:
    """A block's lines as text, with the marker of the page that line `at` (from 0) begins inline before it."""
    head = F.trim(F.array_join(F.slice(lines, 1, at), " "))
    tail = F.trim(F.array_join(F.slice(lines, at + 1, F.greatest(F.size(lines) - at, F.lit(0))), " "))
    return F.when(at.isNull(), F.trim(F.array_join(lines, " "))).otherwise(F.concat(head, F.lit("<!-- p."), page.cast("string"), F.lit(" --> "), tail))


def marked(text: Column, marks: Column, literal: bool = False) -> Column:
    """text with its marks (kind, a, b, data) written out; kinds: those of SYNTAX, link and fnref.

    Emphasis that straddles a link's edge is cut there. What is put in goes in from the end of the text on, by place, phase,
    the mark's other end and rank, so that marks nest. literal: stars and ticks outside code are escaped; a bracket that
    would open a tag always is.
    """
    emphasis = ("bold", "italic", "underline")
    links = F.filter(marks, lambda m: m["kind"] == "link")
    edges = F.flatten(F.transform(links, lambda l: F.array(l["a"], l["b"])))
    mark = lambda kind, a, b, data: F.struct(kind.alias("kind"), a.cast("int").alias("a"), b.cast("int").alias("b"), data.alias("data"))

    def pieces(m):
        inside = F.filter(edges, lambda e: (e > m["a"]) & (e < m["b"]))
        cuts = F.array_sort(F.array_distinct(F.concat(F.array(m["a"], m["b"]), inside)))
        parts = F.transform(F.slice(cuts, 1, F.size(cuts) - 1), lambda c, i: mark(m["kind"], c, F.get(cuts, i + 1), m["data"]))

        def tight(p):
            piece = F.substring(text, p["a"] + 1, p["b"] - p["a"])
            a = p["a"] + F.length(piece) - F.length(F.regexp_replace(piece, r"^\s+", ""))
            return mark(p["kind"], a, p["b"] - F.length(piece) + F.length(F.regexp_replace(piece, r"\s+$", "")), p["data"])

        return F.when(m["kind"].isin(*emphasis), F.filter(F.transform(parts, tight), lambda p: p["b"] > p["a"])).otherwise(F.array(mark(m["kind"], m["a"], m["b"], m["data"])))

    fixed = F.flatten(F.transform(marks, pieces))
    op = lambda pos, phase, tie, rank, cut, put: F.struct((-pos).cast("double").alias("pos"), F.lit(phase).cast("double").alias("phase"), tie.cast("int").alias("tie"), rank.cast("int").alias("rank"), cut.cast("int").alias("cut"), put.alias("put"))
    zero = F.lit(0)

    def ops(m):
        outer = m["kind"].isin("placeholder", "underline")
        opens = F.create_map(*(F.lit(x) for k, (o, _) in SYNTAX.items() for x in (k, o)))
        closes = F.create_map(*(F.lit(x) for k, (_, c) in SYNTAX.items() for x in (k, c)))
        note = F.array(op(m["a"], 0, zero, zero, m["b"] - m["a"], F.concat(F.lit("[^"), m["data"], F.lit("]"))))
        link = F.array(op(m["a"], 1, m["b"], F.lit(1), zero, F.lit("[")), op(m["b"], 2, m["a"], zero, zero, F.concat(F.lit("]("), m["data"], F.lit(")"))))
        other = F.array(op(m["a"], 1, m["b"], F.when(outer, 2).otherwise(0), zero, opens[m["kind"]]), op(m["b"], 2, m["a"], F.when(outer, -1).otherwise(1), zero, closes[m["kind"]]))
        return F.when(m["kind"] == "fnref", note).when(m["kind"] == "link", link).otherwise(other)

    places = F.when(F.length(text) > 0, F.sequence(F.lit(0), F.length(text) - 1)).otherwise(F.array().cast("array<int>"))
    char = lambda i: F.substring(text, i + 1, F.lit(1))
    within = lambda i, *kinds: F.exists(fixed, lambda m: m["kind"].isin(*kinds) & (m["a"] <= i) & (i < m["b"]))
    tag = F.filter(places, lambda i: (char(i) == "<") & char(i + 1).rlike("^[A-Za-z/]") & ~within(i, "code"))
    stars = F.filter(places, lambda i: char(i).isin("*", "`") & ~within(i, "fnref", "code")) if literal else F.array().cast("array<int>")
    escapes = F.transform(F.concat(tag, stars), lambda i: op(i, 0.5, zero, zero, zero, F.lit("\\")))
    every = F.array_sort(F.concat(F.flatten(F.transform(fixed, ops)), escapes))
    return F.aggregate(every, text, lambda t, o: F.concat(F.substring(t, F.lit(1), (-o["pos"]).cast("int")), o["put"], F.substring(t, (-o["pos"]).cast("int") + o["cut"] + 1, F.length(t))))


def code_box(lines: Column) -> Column:
    """A box of code: each line (text, marks), bold and placeholders as tags, all else escaped; bold that goes on is one run."""

    def one(l):
        ins = F.flatten(F.transform(l["marks"], lambda m: F.array(F.struct((-m["a"]).alias("pos"), F.lit(0).alias("last"), F.when(m["kind"] == "bold", "\x01B").otherwise("\x01P").alias("put")), F.struct((-m["b"]).alias("pos"), F.lit(1).alias("last"), F.when(m["kind"] == "bold", "\x02B").otherwise("\x02P").alias("put")))))
        t = F.aggregate(F.array_sort(ins), l["text"], lambda t, o: F.concat(F.substring(t, F.lit(1), -o["pos"]), o["put"], F.substring(t, -o["pos"] + 1, F.length(t))))
        for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\x01B", "<b>"), ("\x02B", "</b>"), ("\x01P", '<span class="ph">'), ("\x02P", "</span>")):
            t = F.replace(t, F.lit(a), F.lit(b))
        return t

    return F.concat(F.lit("<pre>"), F.replace(F.array_join(F.transform(lines, one), "\n"), F.lit("</b>\n<b>"), F.lit("\n")), F.lit("</pre>"))


def distinct_figures(figures: DataFrame) -> DataFrame:
    """figures (page, k, x0, y0, x1, y1, digest) without those drawn again: over more than 0.8 of the smaller area of one kept
    before them on the page, with the same bytes. Whether one is kept hangs on those before it: a fold over a page's figures."""
    item = F.struct("k", "x0", "y0", "x1", "y1", "digest")
    per = figures.groupBy("page").agg(F.array_sort(F.collect_list(item)).alias("f"))
    none = F.slice("f", 1, 0)
    area = lambda r: (r["x1"] - r["x0"]) * (r["y1"] - r["y0"])
    both = lambda r, s: F.greatest(F.lit(0.0), F.least(r["x1"], s["x1"]) - F.greatest(r["x0"], s["x0"])) * F.greatest(F.lit(0.0), F.least(r["y1"], s["y1"]) - F.greatest(r["y0"], s["y0"]))
    again = lambda acc, r: F.exists(acc, lambda s: (s["digest"] == r["digest"]) & (F.least(area(r), area(s)) > 0) & (both(r, s) > 0.8 * F.least(area(r), area(s))))
    return per.select("page", F.explode(F.aggregate("f", none, lambda acc, r: F.when(again(acc, r), acc).otherwise(F.concat(acc, F.array(r))))).alias("f")).select("page", "f.*")


def link_targets(links: DataFrame, heads: DataFrame) -> DataFrame:
    """links (doc, id, text, near) with slug: of the heading whose number the text names, of several the first; else near."""
    number = F.coalesce(F.nullif(F.regexp_extract("text", r"(?:Section|§)\s*(\d+(?:\.\d+)*)", 1), F.lit("")), F.nullif(F.regexp_extract(F.trim("text"), r"^(\d+(?:\.\d+)+)\.?$", 1), F.lit("")))
    first = heads.groupBy("doc", "number").agg(F.min_by("slug", "ord").alias("named"))
    return links.withColumn("number", number).join(first, ["doc", "number"], "left").select("doc", "id", F.coalesce("named", "near").alias("slug"))


def composites(spans: DataFrame, by: list[str], order: str, key: str, most: int = 6) -> DataFrame:
    """Rows (by, key, first, n): the keys of every run of up to `most` spans that follow each other."""
    w = Window.partitionBy(*by).orderBy(order)
    rows = spans.withColumn("_keys", F.collect_list(key).over(w.rowsBetween(0, most - 1)))
    rows = rows.select(*by, F.col(order).alias("first"), "_keys", F.explode(F.expr("sequence(1, size(_keys))")).alias("n"))
    return rows.select(*by, F.array_join(F.slice("_keys", F.lit(1), F.col("n")), "").alias(key), "first", "n")


def stacked_marks(marks: Column, text: Column) -> Column:
    """Marks (a, b, x0, y0, x1, y1), sorted, in which one that goes on below, with blanks only between, is part of the one above."""
    kind = "array<struct<a:int,b:int,x0:double,y0:double,x1:double,y1:double>>"

    def step(acc, m):
        p = F.element_at(acc, -1)
        bare = F.trim(F.substring(text, p["b"] + 1, m["a"] - p["b"])) == ""
        below = (m["y0"] >= p["y1"] - 3) & (F.least(p["x1"], m["x1"]) > F.greatest(p["x0"], m["x0"]))
        grown = F.struct(p["a"].alias("a"), m["b"].alias("b"), p["x0"].alias("x0"), p["y0"].alias("y0"), p["x1"].alias("x1"), p["y1"].alias("y1"))
        joins = (F.size(acc) > 0) & F.coalesce(bare & below, F.lit(False))
        return F.when(joins, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(grown))).otherwise(F.concat(acc, F.array(m))).cast(kind)

    return F.aggregate(marks.cast(kind), F.array().cast(kind), step)
