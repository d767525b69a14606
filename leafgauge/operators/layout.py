"""Spans, lines and drawings of pages: facts, range joins by page, and folds over a page's lines.

Rectangles are columns x0, y0, x1, y1. Joins go by page first, so a page's few spans meet its few drawings only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import geometry

# List marks, numbered headings, caption leads, invisible characters.
LIST_MARK = r"^([●•◦▪‣○]|\d{1,2}[.)]|[a-z][.)])​"
HEAD = r"^(\d+(?:\.\d+)*)\s+\S"
CAPTION = r"^\[(Figure|Table|Transcript)\b"
INVISIBLE = "­​‌‍⁠﻿"


def span_facts(spans: DataFrame, height: float) -> DataFrame:
    """Spans that show something, with zone, hex, styles of their flags and font, and kind: the sort of line they would begin."""
    text = F.col("text")
    shown = F.translate(text, INVISIBLE, "")
    lead = F.regexp_replace(text, r"(?U)^\s+", "")
    kind = F.when(F.regexp_replace(shown, r"(?U)\s+", "") == "", "invisible").when(lead.rlike(LIST_MARK), "list").when(lead.rlike(CAPTION), "caption").when(text.rlike(HEAD), "head").otherwise("text")
    bit = lambda n: F.col("flags").bitwiseAND(F.lit(n)) != 0
    return spans.where(text.rlike(r"(?U)\S")).withColumns({
        "zone": geometry.zone(text, F.col("y1"), F.lit(height), F.col("flags")),
        "hex": F.concat(F.lit("#"), F.lower(F.lpad(F.hex("color"), 6, "0"))),
        "bold": bit(16) | F.col("font").contains("Bold"),
        "italic": bit(2),
        "mono": F.col("font").contains("Mono"),
        "kind": kind,
    })


def census_class(w: Column, h: Column) -> Column:
    return F.when((h <= 2.5) | (w <= 2.5), "rule").when((h > 6) & (h < 30) & (w > 20) & (w < 420), "pill").otherwise("box")


def lines(spans: DataFrame, gap: float = 1.0) -> DataFrame:
    """Rows (page, line, place, text, x0, y0, x1, y1, size, bold, colors, mono): spans of a line joined, a blank where they stand apart.

    place: the line's number on the page in reading order, by rounded top (halves to the even side), then left edge.
    """
    w = Window.partitionBy("page", "line").orderBy("seg")
    apart = F.coalesce(F.col("x0") - F.lag("x1").over(w) > gap, F.lit(False))
    parts = spans.withColumn("piece", F.concat(F.when(apart, " ").otherwise(""), "text"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg", "piece"))), lambda p: p["piece"]), "")
    n = F.length("text")
    out = parts.groupBy("page", "line").agg(
        text.alias("text"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.max("size").alias("size"), F.bool_and("bold").alias("bold"),
        F.array_sort(F.collect_set("color")).alias("colors"), (F.sum(F.when(F.col("font").contains("Mono"), n).otherwise(0)) / F.sum(n) >= 0.5).alias("mono"), F.min_by("bold", "seg").alias("lead_bold"),
    )
    return out.withColumn("place", F.row_number().over(Window.partitionBy("page").orderBy(F.bround("y0"), "x0", "line")))


def _sides(inner: DataFrame, outer: DataFrame, outer_cols: list[str]) -> DataFrame:
    """Each row of inner beside every row of outer on its page, outer's columns with o_ before them."""
    o = outer.select("page", *(F.col(c).alias(f"o_{c}") for c in ("id", "x0", "y0", "x1", "y1", *outer_cols)))
    return inner.join(o, "page")


def holds(slack: float) -> Column:
    return F.expr(f"x0 >= o_x0 - {slack} and y0 >= o_y0 - {slack} and x1 <= o_x1 + {slack} and y1 <= o_y1 + {slack}")


MEETS = "x0 < o_x1 and o_x0 < x1 and y0 < o_y1 and o_y0 < y1"


def in_pill(spans: DataFrame, pills: DataFrame, slack: float = 2.5) -> DataFrame:
    """Rows (page, id, pill, color): the first pill that holds each span."""
    found = _sides(spans, pills, ["color"]).where(holds(slack))
    return found.groupBy("page", "id").agg(F.min(F.struct("o_id", "o_color")).alias("p")).select("page", "id", F.col("p.o_id").alias("pill"), F.col("p.o_color").alias("color"))


def pill_ranges(spans: DataFrame, pills: DataFrame) -> DataFrame:
    """Rows (page, id, pill, start, end): which characters of a span a pill covers that it isn't inside of.

    The pill's edges give an estimate; a bracketed piece near it is taken whole, else whole words; blanks at the ends go.
    """
    r = _sides(spans, pills, []).where(~holds(2.5) & F.expr("least(y1, o_y1) - greatest(y0, o_y0) > 0.6 * (o_y1 - o_y0) and least(x1, o_x1) - greatest(x0, o_x0) > 2"))
    r = r.withColumn("n", F.length("text")).withColumn("w", F.expr("(x1 - x0) / greatest(1, n)"))
    r = r.withColumn("a", F.expr("greatest(0, cast((o_x0 - x0) / w as int))")).withColumn("b", F.expr("least(n, cast((o_x1 - x0) / w + 0.5 as int))"))
    seek = lambda mark, low, high: F.expr(f"if({high} > {low}, locate('{mark}', substring(text, 1, {high}), {low} + 1) - 1, -1)")
    r = r.withColumn("lb", seek("[", "greatest(0, a - 4)", "least(n, a + 4)"))
    near = seek("]", "greatest(lb + 1, b - 4)", "least(n, b + 5)")
    after = seek("]", "(lb + 1)", "least(n, greatest(b + 4, lb + 40))")
    r = r.withColumn("rb", F.when(F.col("lb") < 0, -1).when(near >= 0, near).otherwise(after))
    pair = F.expr("lb >= 0 and rb > lb")
    start = F.when(pair, F.col("lb")).otherwise(F.expr("a - length(regexp_extract(substring(text, 1, a), '(\\\\S*)$', 1))"))
    end = F.when(pair, F.col("rb") + 1).otherwise(F.expr("b + length(regexp_extract(substring(text, b + 1), '^(\\\\S*)', 1))"))
    r = r.withColumn("s", start).withColumn("e", end).withColumn("piece", F.expr("substring(text, s + 1, e - s)"))
    r = r.withColumn("start", F.expr("s + length(piece) - length(ltrim(piece))")).withColumn("end", F.expr("e - length(piece) + length(rtrim(piece))"))
    return r.where("end > start").select("page", "id", F.col("o_id").alias("pill"), "start", "end")


def in_link(spans: DataFrame, links: DataFrame) -> DataFrame:
    """Rows (page, id, link): the first link whose band holds a span's middle and more than half of its width."""
    on = F.expr("(y0 + y1) / 2 between o_y0 - 1 and o_y1 + 1 and (least(x1, o_x1) - greatest(x0, o_x0)) / greatest(x1 - x0, 0.1) > 0.5")
    return _sides(spans, links, []).where(on).groupBy("page", "id").agg(F.min("o_id").alias("link"))


def underlined(spans: DataFrame, rules: DataFrame, links: DataFrame) -> DataFrame:
    """Rows (page, id, rule, start, end): the words of a span, outside links, whose middles a rule close below it covers."""
    linked = _sides(spans, links, []).where("(y0 + y1) / 2 between o_y0 and o_y1 and least(x1, o_x1) - greatest(x0, o_x0) > 0.5 * (x1 - x0)").select("page", "id").distinct()
    free = spans.where("length(trim(text)) > 1").join(linked, ["page", "id"], "left_anti")
    r = _sides(free, rules, []).where("o_y0 between y1 - 2.5 and y1 + 5 and least(x1, o_x1) - greatest(x0, o_x0) > 2")
    r = r.withColumn("w", F.expr("(x1 - x0) / length(text)"))
    pieces = F.split("text", " ")
    before = F.aggregate(pieces, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + F.length(x) + 1)))
    r = r.withColumn("k", F.explode(F.arrays_zip(pieces.alias("word"), before.alias("at")))).where("k.word <> ''")
    mid = F.expr("x0 + w * (k.at + k.at + length(k.word)) / 2")
    r = r.where((mid >= F.expr("greatest(x0, o_x0) - 1")) & (mid <= F.expr("least(x1, o_x1) + 1")))
    r = r.groupBy("page", "id", "o_id").agg(F.min("k.at").alias("start"), F.max(F.struct(F.col("k.at").alias("at"), F.col("k.word").alias("word"))).alias("l"))
    bare = F.length(F.regexp_replace("l.word", r"[.,;:]+$", ""))
    return r.select("page", "id", F.col("o_id").alias("rule"), "start", (F.col("l.at") + bare).alias("end")).where("end > start")


def outside(rows: DataFrame, tables: DataFrame, slack: float = 3) -> DataFrame:
    """Rows whose middle lies in no table."""
    t = tables.select("page", *(F.col(c).alias(f"o_{c}") for c in ("x0", "y0", "x1", "y1")))
    inside = [rows.page == t.page, F.expr(f"(x0 + x1) / 2 between o_x0 - {slack} and o_x1 + {slack}"), F.expr(f"(y0 + y1) / 2 between o_y0 - {slack} and o_y1 + {slack}")]
    return rows.join(t, inside, "left_anti")


def meeting(rows: DataFrame, rects: DataFrame) -> DataFrame:
    """Rows that some rectangle of their page overlaps."""
    t = rects.select("page", *(F.col(c).alias(f"o_{c}") for c in ("x0", "y0", "x1", "y1")))
    return rows.join(t, [rows.page == t.page, F.expr(MEETS)], "left_semi")


def box_roles(rows: DataFrame, boxes: DataFrame, roles: dict[str, str], key: list[str]) -> DataFrame:
    """rows with role, of the smallest box with a known colour that holds them, and in_transcript: whether any holding box is one."""
    names = F.create_map(*(F.lit(x) for kv in roles.items() for x in kv))
    found = _sides(rows.select("page", *key, "x0", "y0", "x1", "y1"), boxes, ["color"]).where(holds(4)).withColumn("role", names[F.col("o_color")])
    area = F.struct(((F.col("o_x1") - F.col("o_x0")) * (F.col("o_y1") - F.col("o_y0"))).alias("a"), "o_id")
    per = found.groupBy("page", *key).agg(F.min_by("role", F.when(F.col("role").isNotNull(), area)).alias("role"), F.max(F.col("role") == "transcript").alias("in_transcript"))
    return rows.join(per, ["page", *key], "left").withColumn("in_transcript", F.coalesce("in_transcript", F.lit(False)))


def line_class(grey: str, in_figure: Column) -> Column:
    """The sort of block a line (with role) belongs to; the first rule that fits decides."""
    number = F.regexp_extract("text", HEAD, 1)
    lead = F.regexp_replace("text", r"(?U)^\s+", "")
    only_grey = F.expr(f"colors = array('{grey}')")
    return (
        F.when((F.col("size") >= 12.6) | (only_grey & (number != "")), "heading").when((F.regexp_count(number, F.lit(r"\.")) >= 2) & F.col("bold"), "heading").when(F.col("role").isin("turn", "code"), F.col("role"))
        .when(F.col("role") == "transcript", F.when(F.array_contains("colors", grey), "commentary").otherwise("turn")).when(lead.rlike(CAPTION) | ((F.col("size") <= 9.5) & in_figure), "caption").when(lead.rlike(LIST_MARK) | lead.rlike("^[●•◦▪‣○]"), "item").otherwise("prose")
    )


def chip_only(spans: DataFrame, chips: DataFrame) -> DataFrame:
    """Rows (page, line) of lines whose wordy spans all lie in chips, one at least."""
    wordy = spans.where(F.col("text").rlike(r"(?U)\w"))
    held = in_pill(wordy, chips).select("page", "id", F.lit(True).alias("held"))
    return wordy.join(held, ["page", "id"], "left").groupBy("page", "line").agg(F.bool_and(F.coalesce("held", F.lit(False))).alias("ok")).where("ok").drop("ok")


def paragraphs(rows: DataFrame, quote_at: float = 112) -> DataFrame:
    """Rows (page, block, first, last, quote, text): a page's lines in reading order as paragraphs.

    A line goes on with the paragraph if the gap is small for the line above, unless it begins bold after a short line that
    ends a sentence, the line above is a short one all in bold, or it is a quote and the paragraph isn't. How short a line is
    hangs on the widest line of the paragraph so far, so this is a fold over the page.
    """
    line = F.struct("place", "text", "x0", "y0", "x1", "y1", "bold", "lead_bold")
    cur = "struct<first:int,last:int,quote:boolean,right:double,text:string,y0:double,y1:double,x1:double,bold:boolean,tail:string>"

    def step(acc, l):
        c = F.element_at(acc, -1)
        quote = l["x0"] >= quote_at
        right = F.greatest(c["right"], l["x1"])
        short = c["x1"] < right - 40
        lead = l["lead_bold"] & c["tail"].rlike(r'[.!?:”"]\s*$') & short
        label = c["bold"] & short & ~l["lead_bold"]
        same = (l["y0"] - c["y1"] < F.greatest(F.lit(4.0), 0.55 * (c["y1"] - c["y0"]))) & ~lead & ~label & (c["quote"] == quote)
        new = lambda first, text, edge: F.struct(first.alias("first"), l["place"].alias("last"), quote.alias("quote"), edge.alias("right"), text.alias("text"), l["y0"].alias("y0"), l["y1"].alias("y1"), l["x1"].alias("x1"), l["bold"].alias("bold"), l["text"].alias("tail")).cast(cur)
        grown = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(new(c["first"], F.concat_ws(" ", c["text"], l["text"]), right)))
        return F.when((F.size(acc) > 0) & F.coalesce(same, F.lit(False)), grown).otherwise(F.concat(acc, F.array(new(l["place"], l["text"], l["x1"]))))

    per = rows.groupBy("page").agg(F.array_sort(F.collect_list(line)).alias("l"))
    out = per.select("page", F.posexplode(F.aggregate("l", F.array().cast(f"array<{cur}>"), step)).alias("block", "b"))
    return out.select("page", "block", "b.first", "b.last", "b.quote", "b.text")


def column_chains(spans: DataFrame, reach: float = 2, gap: float = 9) -> DataFrame:
    """Rows (page, x, first, n): runs of two spans or more, one below the other, whose left edges belong together.

    A left edge joins the first cluster, by its first edge, that is at most `reach` away: a fold over a page's edges.
    """
    edges = spans.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("line", "seg", "x0"))).alias("e"))
    none = F.array().cast("array<double>")
    keys = F.aggregate("e", none, lambda acc, s: F.when(F.exists(acc, lambda k: F.abs(k - s["x0"]) <= reach), acc).otherwise(F.concat(acc, F.array(s["x0"]))))
    rows = spans.join(edges.select("page", keys.alias("keys")), "page").withColumn("x", F.get(F.filter("keys", lambda k: F.abs(k - F.col("x0")) <= reach), F.lit(0)))
    w = Window.partitionBy("page", "x").orderBy("y0", "id")
    rows = rows.withColumn("new", F.when(F.col("y0") - F.lag("y1").over(w) < gap, 0).otherwise(1)).withColumn("run", F.sum("new").over(w))
    return rows.groupBy("page", "x", "run").agg(F.min_by("id", F.struct("y0", "id")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("run")


def image_files(images: DataFrame) -> DataFrame:
    """Rows (page, num, file, mask): images by page, numbered, each with the soft mask that the next row holds for it."""
    w = Window.partitionBy("page").orderBy("num")
    rows = images.withColumn("next", F.lead(F.struct("type", "object", "num")).over(w)).where("type = 'image'")
    mask = F.when((F.col("next.type") == "smask") & (F.col("next.object") == F.col("object")), F.col("next.num"))
    k = F.row_number().over(w)
    return rows.select("page", "num", F.concat(F.lit("p"), F.lpad(F.col("page").cast("string"), 3, "0"), F.lit("-"), k.cast("string"), F.lit(".png")).alias("file"), mask.alias("mask"))


def nth_of_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """rows with nth: which occurrence of its key each is, so that equal keys on two sides pair up in order."""
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def assembled(rows: DataFrame) -> DataFrame:
    """Rows (page, block, first, last, type, role, quote, text): a page's classed lines in reading order as blocks.

    rows: lines with class, role and quote. Headings go on while they are close and of one size, captions while the lines are
    close and small or of their size, turns and boxes while the role stays and no label in bold begins another; an item
    goes on with lines that hang under it, or that begin at its mark while its sentence is open; the rest are paragraphs (see
    paragraphs). What a line joins hangs on the block so far: a fold over the page.
    """
    line = F.struct("place", "text", "x0", "y0", "x1", "y1", "size", "bold", "lead_bold", "class", "role", "quote")
    cur = "struct<first:int,last:int,type:string,role:string,quote:boolean,right:double,text:string,x0:double,y0:double,y1:double,x1:double,size:double,bold:boolean,tail:string>"

    def step(acc, l):
        c = F.element_at(acc, -1)
        gap, near = l["y0"] - c["y1"], F.abs(l["size"] - c["size"]) < 0.6
        right = F.greatest(c["right"], l["x1"])
        short = c["x1"] < right - 40
        lead = l["lead_bold"] & c["tail"].rlike(r'[.!?:”"]\s*$') & short
        label = c["bold"] & short & ~l["lead_bold"]
        prose = l["class"] == "prose"
        open_ = ~c["tail"].rlike(r"[.!?;:”\"’]\s*$") | l["text"].rlike(r"(?U)^\s*\p{Lower}")
        boxed = l["class"].isin("turn", "commentary", "code")
        same = (
            ((l["class"] == "heading") & (c["type"] == "heading") & (gap < 10) & near)
            | (boxed & (l["class"] == c["type"]) & ~((l["class"] == "turn") & (~l["role"].eqNullSafe(c["role"]) | l["lead_bold"])))
            | (prose & (c["type"] == "caption") & ((l["size"] <= 9.5) | near) & (gap < 8))
            | (prose & (c["type"] == "item") & (gap < 8) & ((l["x0"] > c["x0"] + 6) | ((F.abs(l["x0"] - c["x0"]) <= 2) & open_)))
            | (prose & (c["type"] == "paragraph") & (gap < F.greatest(F.lit(4.0), 0.55 * (c["y1"] - c["y0"]))) & ~lead & ~label & (c["quote"] == l["quote"]))
        )
        kind = F.when(prose, "paragraph").otherwise(l["class"])
        joins = (F.size(acc) > 0) & F.coalesce(same, F.lit(False))
        own = lambda mine, theirs: F.when(joins, mine).otherwise(theirs)
        # A block's size and left edge are those of its first line; heights and ends those of its last.
        new = F.struct(
            own(c["first"], l["place"]).alias("first"), l["place"].alias("last"), own(c["type"], kind).alias("type"), own(c["role"], l["role"]).alias("role"), own(c["quote"], l["quote"]).alias("quote"), own(right, l["x1"]).alias("right"),
            own(F.concat_ws(" ", c["text"], l["text"]), l["text"]).alias("text"), own(c["x0"], l["x0"]).alias("x0"), l["y0"].alias("y0"), l["y1"].alias("y1"), l["x1"].alias("x1"), own(c["size"], l["size"]).alias("size"), l["bold"].alias("bold"), l["text"].alias("tail"),
        ).cast(cur)
        return F.concat(F.slice(acc, 1, F.size(acc) - F.when(joins, 1).otherwise(0)), F.array(new))

    per = rows.groupBy("page").agg(F.array_sort(F.collect_list(line)).alias("l"))
    out = per.select("page", F.posexplode(F.aggregate("l", F.array().cast(f"array<{cur}>"), step)).alias("block", "b"))
    return out.select("page", "block", "b.first", "b.last", "b.type", "b.role", "b.quote", "b.text")
