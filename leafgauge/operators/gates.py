"""Checks of Markdown facts against page facts. Each gives flags (doc, invariant, page, severity, detail), detail a map of strings.

md: rows (doc, ord, kind, page, text, target) of projection.project_all. Page facts: spans (doc, page, line, seg, text, bold,
size, color, zone, x0, y0, y1), links (doc, page, k, kind, anchor, uri, dest_page, unresolvable, name), pills (doc, page,
text, color), notes (doc, page, n, text; n null: the tail of the page before's last), figures (doc, page, file).
All state is kept by document and page, so documents are independent of each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from . import bags, islands, sequence

# List marks of the page layout, numbered headings, characters trimmed off anchors and bold runs.
LIST_MARK = r"^([●•◦▪‣○]|\d{1,2}[.)]|[a-z][.)])​"
NUMBERED = r"^(\d+(?:\.\d+)*)\s+\S"
ANCHOR_EDGES, RUN_EDGES = "'\"().,;:§[] ", ".,;: "
BODY_COLOR, HEAD_COLOR, HEAD_SIZE, BOLD_SIZE = "#000000", "#666666", 12.6, 12.5


def key(c: Column) -> Column:
    return T.squash(T.normalize(c))


def _edged(c: Column, chars: str) -> Column:
    return F.trim(c, F.lit(chars))


def flag(invariant: str, severity, **detail) -> list[Column]:
    """The columns of a flag; detail by name, as strings."""
    pairs = [x for k, v in sorted(detail.items()) for x in (F.lit(k), v.cast("string") if isinstance(v, Column) else F.lit(v))]
    severity = severity if isinstance(severity, Column) else F.lit(severity)
    return ["doc", F.lit(invariant).alias("invariant"), F.col("page").cast("bigint").alias("page"), severity.alias("severity"), F.create_map(*pairs).cast("map<string,string>").alias("detail")]


def of_kind(md: DataFrame, *kinds: str) -> DataFrame:
    return md.where(F.col("kind").isin(*kinds))


def around(rows: DataFrame) -> DataFrame:
    """Every row on its own page and on the pages next to it."""
    return rows.withColumn("from", F.col("page")).withColumn("page", F.explode(F.expr("sequence(page - 1, page + 1)")))


def table_zone(md: DataFrame) -> DataFrame:
    """Rows (doc, page): pages with tables, and those next to them."""
    return around(of_kind(md, "table_page").select("doc", "page")).select("doc", "page").distinct()


def lines_of(spans: DataFrame) -> DataFrame:
    """Rows (doc, page, line, text, y0, y1, size, bold, colors) of the body's lines."""
    parts = F.array_sort(F.collect_list(F.struct("x0", "seg", "text")))
    per = spans.where("zone = 'body'").groupBy("doc", "page", "line")
    return per.agg(F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"), F.min("y0").alias("y0"), F.max("y1").alias("y1"), F.max("size").alias("size"), F.bool_and("bold").alias("bold"), F.array_sort(F.collect_set("color")).alias("colors"))


def t1(md: DataFrame, spans: DataFrame) -> DataFrame:
    """Words of the pages and of the Markdown, in order; short differences, and those next to tables, are minor."""
    there = lines_of(spans).select("doc", "page", "line", T.tokens(T.normalize(F.col("text"))).alias("w")).where("size(w) > 0")
    in_order = lambda *c: F.sort_array(F.collect_list(F.struct(*c)))
    a = there.groupBy("doc").agg(in_order("page", "line", "w").alias("x"))
    a = a.select("doc", F.flatten("x.w").alias("a_w"), F.flatten(F.transform("x", lambda x: F.array_repeat(x["page"], F.size(x["w"])))).alias("a"))
    b = of_kind(md, "token").groupBy("doc").agg(in_order("ord", "text").alias("x")).select("doc", F.col("x.text").alias("b_w"))
    none, nowhere = F.array().cast("array<string>"), F.array().cast("array<bigint>")
    both = a.join(b, "doc", "full").select("doc", F.coalesce("a_w", none).alias("a"), F.coalesce("b_w", none).alias("b"), F.coalesce(F.col("a"), nowhere).alias("pages"))
    # Equal texts have no differences; only the others leave the JVM.
    both = both.where("a <> b")
    ops = sequence.word_flags(both, "doc").join(table_zone(md).withColumn("zone", F.lit("table")), ["doc", "page"], "left")
    severity = F.when(F.col("zone").isNull(), bags.severity(F.col("n"))).otherwise("minor")
    return ops.select(*flag("T1", severity, op=F.col("op"), missing=F.substring("missing", 1, 160), extra=F.substring("extra", 1, 160), n=F.col("n"), at=F.col("at_a")))


def displaced(flags: DataFrame) -> DataFrame:
    """Inserted and deleted words that are the same, at most two pages apart, are one minor flag: moved, not lost."""
    op = F.when(F.col("invariant") == "T1", F.col("detail")["op"])
    moved = F.when(op == "insert", F.col("detail")["extra"]).when(op == "delete", F.col("detail")["missing"])
    nth = F.row_number().over(Window.partitionBy("doc", op, moved).orderBy("page", F.col("detail")["at"].cast("bigint")))
    rows = flags.withColumn("op", F.when(op.isin("insert", "delete"), op)).withColumn("moved", moved).withColumn("nth", F.when(F.col("op").isNotNull(), nth))
    two = Window.partitionBy("doc", "moved", "nth")
    of = lambda what: F.max(F.when(F.col("op") == what, F.col("page"))).over(two)
    rows = rows.withColumn("to", of("insert")).withColumn("away", of("delete"))
    pair = F.coalesce(F.col("op").isNotNull() & (F.abs(F.col("to") - F.col("away")) <= 2), F.lit(False))
    detail = F.create_map(F.lit("op"), F.lit("displaced"), F.lit("text"), F.substring("moved", 1, 120), F.lit("from_page"), F.col("away").cast("string"))
    rows = rows.where(~(pair & (F.col("op") == "delete")))
    return rows.select("doc", "invariant", "page", F.when(pair, "minor").otherwise(F.col("severity")).alias("severity"), F.when(pair, detail).otherwise(F.col("detail")).alias("detail"))


def l1(md: DataFrame, links: DataFrame) -> DataFrame:
    """Links of the pages that the Markdown has too seldom (by count), and anchors of jumps that none of its links contains."""
    bare = lambda c: F.regexp_replace(c, "/+$", "")
    there = of_kind(md, "link")
    n = there.groupBy("doc", bare(F.col("target")).alias("missing")).agg(F.count("*").alias("n"))
    uris = links.where("kind = 'uri'").withColumn("missing", bare(F.col("uri")))
    each = Window.partitionBy("doc", "missing")
    uris = uris.withColumn("nth", F.row_number().over(each.orderBy("page", "k"))).withColumn("of", F.count("*").over(each)).join(n, ["doc", "missing"], "left")
    uris = uris.where(F.col("nth") <= F.col("of") - F.coalesce("n", F.lit(0)))
    anchor = bare(T.trim(F.col("anchor")))
    auto = F.col("missing").startswith("http://") & F.col("missing").contains(anchor)
    lost = uris.select(*flag("L1", F.when(auto, "minor").otherwise("major"), kind=F.when(auto, "auto-link").otherwise("uri"), missing=F.col("missing"), anchor=F.substring("anchor", 1, 80)))
    shown = there.groupBy("doc").agg(F.array_join(F.collect_list(T.normalize(F.col("text"))), " | ").alias("shown"))
    jumps = links.where("kind = 'goto'").withColumn("anchor", _edged(T.normalize(F.col("anchor")), ANCHOR_EDGES)).where("length(anchor) >= 3")
    jumps = jumps.join(shown, "doc", "left").where(~F.coalesce(F.col("shown").contains(F.col("anchor")), F.lit(False)))
    dead = F.coalesce("unresolvable", F.lit(False))
    kind = F.when(dead, "unresolvable").otherwise("goto")
    return lost.unionByName(jumps.select(*flag("L1", F.when(dead, "minor").otherwise("major"), kind=kind, anchor=F.substring("anchor", 1, 80), to=F.coalesce(F.when(dead, F.col("name")).otherwise(F.col("dest_page").cast("string")), F.lit("")))))


def p1(md: DataFrame, expected: DataFrame, starts: DataFrame) -> DataFrame:
    """Expected pages (doc, page) without a marker, and markers met again; a section's first page counts as marked."""
    seen = of_kind(md, "marker")
    again = bags.repeated(seen, ["doc", "page"], ["ord"]).select(*flag("P1", "major", kind="duplicate", nth=F.col("nth")))
    lost = bags.missing(expected, seen.select("doc", "page").union(starts.select("doc", "page")), ["doc", "page"])
    return again.unionByName(lost.select(*flag("P1", "major", kind="missing-marker")))


def f1(md: DataFrame, figures: DataFrame) -> DataFrame:
    """Figures by page; omitted ones that the Markdown declares count as there, the cover page has none."""
    out = bags.compare_counts(figures.where("page <> 1").select("doc", "page"), of_kind(md, "image", "fig_skip").select("doc", "page"), ["doc"], "page")
    return out.select(*flag("F1", F.col("severity"), expected=F.col("n_src"), found=F.col("n_out")))


def bold_runs(spans: DataFrame) -> DataFrame:
    """Rows (doc, page, text): neighbouring bold spans of one line as one run, body-sized and in the body's colour."""
    w = Window.partitionBy("doc", "page").orderBy("line", "seg")
    ok = F.expr(f"zone = 'body' and bold and color = '{BODY_COLOR}' and size < {BOLD_SIZE}")
    rows = spans.withColumn("ok", ok)
    same = F.lag("ok").over(w) & (F.lag("line").over(w) == F.col("line"))
    rows = rows.withColumn("new", F.when(F.col("ok") & F.coalesce(same, F.lit(False)), 0).otherwise(1)).withColumn("run", F.sum("new").over(w)).where("ok")
    parts = F.array_sort(F.collect_list(F.struct("line", "seg", "text")))
    return rows.groupBy("doc", "page", "run").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text")).drop("run")


def s1(md: DataFrame, spans: DataFrame, skip: DataFrame) -> DataFrame:
    """Bold runs that the Markdown's emphasis lacks, by count on the page or around it; one that is there once in other pieces is fine."""
    want = bold_runs(spans).join(skip, ["doc", "page"], "left_anti").withColumn("key", key(_edged(F.col("text"), RUN_EDGES))).where("length(key) >= 6")
    want = want.groupBy("doc", "page", "key").agg(F.count("*").alias("n"), F.min("text").alias("text"))
    shown = of_kind(md, "bold", "heading", "turn_label")
    near = around(shown.withColumn("key", key(_edged(F.col("text"), RUN_EDGES))).select("doc", "page", "key"))
    have = near.groupBy("doc", "page", "key").agg(F.count("*").alias("have"))
    parts = F.array_sort(F.collect_list(F.struct("from", "ord", "key")))
    hay = around(shown.select("doc", "page", "ord", key(F.col("text")).alias("key"))).groupBy("doc", "page").agg(F.array_join(F.transform(parts, lambda p: p["key"]), "").alias("hay"))
    lost = want.join(have, ["doc", "page", "key"], "left").where(F.coalesce("have", F.lit(0)) < F.col("n")).join(hay, ["doc", "page"], "left")
    lost = lost.where(~((F.col("n") == 1) & F.coalesce(F.col("hay").contains(F.col("key")), F.lit(False))))
    return lost.select(*flag("S1", "major", kind="bold-run-missing", text=F.substring("text", 1, 80)))


def s2(md: DataFrame, pills: DataFrame, colors: list[str]) -> DataFrame:
    """Chips that a page shows too seldom, and the pages around it don't make up for."""
    want = pills.where(F.col("color").isin(colors)).select("doc", "page", key(F.col("text")).alias("label"))
    have = of_kind(md, "chip").select("doc", "page", key(F.col("text")).alias("label"))
    out = bags.window_deficit(want, have, ["doc", "label"], "page")
    return out.select(*flag("S2", "major", kind="chip-missing", text=F.substring("label", 1, 60), have=F.col("n_out"), want=F.col("n_src")))


def s3(md: DataFrame, registry: DataFrame) -> DataFrame:
    """Chips whose label the registry (label) lacks."""
    lost = of_kind(md, "chip").join(registry.select(F.col("label").alias("text")), "text", "left_anti")
    return lost.select(*flag("S3", "major", kind="label-not-in-registry", label=F.substring("text", 1, 60)))


def st1(md: DataFrame, lines: DataFrame, skip: DataFrame) -> DataFrame:
    """Pages with more list marks than items, which the pages around don't make up for."""
    marks = lines.where(F.regexp_replace("text", r"(?U)^\s+", "").rlike(LIST_MARK))
    first = marks.groupBy("doc", "page").agg(F.min_by("text", "line").alias("sample"))
    out = bags.window_deficit(marks.select("doc", "page"), of_kind(md, "item").select("doc", "page"), ["doc"], "page")
    out = out.join(first, ["doc", "page"]).join(skip, ["doc", "page"], "left_anti")
    return out.select(*flag("ST1", "major", kind="items-missing", marks=F.col("n_src"), items=F.col("n_out"), sample=F.substring("sample", 1, 60)))


def st2(md: DataFrame, lines: DataFrame, skip: DataFrame) -> DataFrame:
    """Blocks that begin in the middle of a line of the page."""
    blocks = of_kind(md, "block").withColumn("key", F.substring(key(F.col("text")), 1, 24)).where("length(key) >= 14").join(skip, ["doc", "page"], "left_anti")
    squashed = lines.select("doc", "page", "line", key(F.col("text")).alias("sq"))
    parts = F.array_sort(F.collect_list(F.struct("line", "sq")))
    per = squashed.groupBy("doc", "page").agg(F.transform(parts, lambda p: p["sq"]).alias("starts"))
    begins = F.expr("exists(starts, s -> s <> '' and (startswith(s, key) or (length(s) >= 6 and startswith(key, s))))")
    torn = blocks.join(per, ["doc", "page"]).where(~begins & F.array_join("starts", "").contains(F.col("key")))
    return torn.select(*flag("ST2", "major", kind="block-starts-mid-line", text=F.substring("text", 1, 60)))


def heading_groups(lines: DataFrame) -> DataFrame:
    """Rows (doc, page, text): heading lines of a page, those that hug the one above joined with it.

    A line is a heading by its size, by its colour and number, or by a long number in bold; one without a number that has the
    looks of the heading close above goes on with it. Whether a line counts hangs on the group so far: a fold over the page.
    """
    number = F.regexp_extract("text", NUMBERED, 1)
    grey = F.expr(f"colors = array('{HEAD_COLOR}')")
    head = (F.col("size") >= HEAD_SIZE) | (grey & (number != "")) | (F.col("bold") & (F.regexp_count(number, F.lit(r"\.")) >= 2))
    per = lines.withColumn("head", head).withColumn("grey", grey).groupBy("doc", "page").agg(F.array_sort(F.collect_list(F.struct("line", "text", "y0", "y1", "size", "bold", "grey", "head", "colors"))).alias("l"))
    cur = "struct<text:string,y1:double,size:double,bold:boolean,colors:array<string>>"

    def step(acc, x):
        c = acc["cur"]
        alike = c.isNotNull() & (F.abs(x["size"] - c["size"]) < 0.6)
        on = x["head"] | F.coalesce(alike & (x["y0"] - c["y1"] < 6) & (x["colors"] == c["colors"]) & (x["bold"] == c["bold"]) & (x["grey"] | c["bold"]), F.lit(False))
        joins = on & F.coalesce(alike & (x["y0"] - c["y1"] < 10), F.lit(False))
        grown = F.struct(F.concat(c["text"], F.lit(" "), x["text"]).alias("text"), x["y1"].cast("double").alias("y1"), c["size"].alias("size"), c["bold"].alias("bold"), c["colors"].alias("colors"))
        fresh = F.struct(x["text"].alias("text"), x["y1"].cast("double").alias("y1"), x["size"].cast("double").alias("size"), x["bold"].alias("bold"), x["colors"].alias("colors"))
        done = F.when(joins | c.isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(c["text"])))
        return F.struct(done.alias("done"), F.when(joins, grown).when(on, fresh).otherwise(F.lit(None)).cast(cur).alias("cur"))

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast(cur).alias("cur"))
    end = lambda a: F.when(a["cur"].isNull(), a["done"]).otherwise(F.concat(a["done"], F.array(a["cur"]["text"])))
    return per.select("doc", "page", F.posexplode(F.aggregate("l", start, step, end)).alias("nth", "text"))


def st3(md: DataFrame, lines: DataFrame, skip: DataFrame) -> DataFrame:
    """Headings of the pages that no heading on the page or next to it equals."""
    groups = heading_groups(lines).withColumn("key", key(F.col("text"))).where("length(key) >= 4").join(skip, ["doc", "page"], "left_anti")
    heads = around(of_kind(md, "heading").select("doc", "page", key(F.col("text")).alias("key"))).select("doc", "page", "key")
    return groups.join(heads, ["doc", "page", "key"], "left_anti").select(*flag("ST3", "major", kind="heading-split-or-missing", text=F.substring("text", 1, 70)))


def fn1(md: DataFrame, spans: DataFrame, notes: DataFrame) -> DataFrame:
    """Footnotes: how many references, references without a note, and notes that lack or differ; a tail goes to the last note before."""
    refs, defs = of_kind(md, "fn_ref"), of_kind(md, "fn_def")
    n = spans.where("zone = 'fnref'").groupBy("doc").agg(F.count("*").alias("n_src")).join(refs.groupBy("doc").agg(F.count("*").alias("n_out")), "doc", "full").na.fill(0).where("n_src <> n_out")
    counts = n.withColumn("page", F.lit(0)).select(*flag("FN1", "major", kind="reference-count", refs=F.col("n_src"), found=F.col("n_out")))
    lost = refs.join(defs.select("doc", F.col("target").alias("text")), ["doc", "text"], "left_anti").select(*flag("FN1", "major", kind="ref-without-def", n=F.col("text")))
    w = Window.partitionBy("doc").orderBy("page", F.col("n").isNotNull(), "n").rowsBetween(Window.unboundedPreceding, 0)
    whole = notes.withColumn("n", F.max("n").over(w)).where("n is not null").groupBy("doc", "n")
    parts = F.array_sort(F.collect_list(F.struct("page", "text")))
    whole = whole.agg(F.array_join(F.transform(parts, lambda p: p["text"]), " ").alias("body"), F.min("page").alias("page"))
    made = defs.groupBy("doc", F.col("target").cast("bigint").alias("n")).agg(F.min("text").alias("made"), F.count("*").alias("times"))
    both = whole.join(made, ["doc", "n"], "left").where("times is null or times = 1")
    stars = lambda c: F.replace(key(c), F.lit("*"), F.lit(""))
    none = both.where("made is null").select(*flag("FN1", "major", kind="body-without-def", n=F.col("n")))
    other = both.where(stars(F.col("made")) != stars(F.col("body"))).select(*flag("FN1", "minor", kind="body-text-mismatch", n=F.col("n"), source=F.substring("body", 1, 80), found=F.substring("made", 1, 80)))
    return counts.unionByName(lost).unionByName(none).unionByName(other)


def collect(md: DataFrame, facts: dict[str, DataFrame], colors: list[str], registry: DataFrame) -> DataFrame:
    """All checks' flags; facts: spans, links, pills, notes, figures, expected, starts."""
    lines, skip = lines_of(facts["spans"]), table_zone(md)
    checks = [
        displaced(t1(md, facts["spans"])), l1(md, facts["links"]), p1(md, facts["expected"], facts["starts"]), f1(md, facts["figures"]), s1(md, facts["spans"], skip),
        s2(md, facts["pills"], colors), s3(md, registry), st1(md, lines, skip), st2(md, lines, skip), st3(md, lines, skip), fn1(md, facts["spans"], facts["notes"]),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def canonical(detail: Column) -> Column:
    """A detail as JSON with sorted names: equal details give equal strings."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(detail))))


def new_flags(flags: DataFrame, baseline: DataFrame) -> DataFrame:
    """Flags that the baseline lacks, by document, invariant and detail."""
    a = flags.withColumn("_key", canonical(F.col("detail")))
    b = baseline.select("doc", "invariant", canonical(F.col("detail")).alias("_key"))
    return a.join(b, ["doc", "invariant", "_key"], "left_anti").drop("_key")
