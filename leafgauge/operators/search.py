"""Search records, ranked search, card indexes, and what pages make of figures and footnotes in tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import markdown as M


def records(pages: DataFrame, url: str, html: str) -> DataFrame:
    """pages with url, title and content of each stretch of their article that begins at a heading with an id, html dropped.

    What stands before the first such heading is a record under the page's own title; empty stretches give none.
    """
    own = [c for c in pages.columns if c not in (url, html)]
    rows = pages.withColumn("_title", M.page_text(F.regexp_extract(html, r"(?s)<h1[^>]*>(.*?)</h1>", 1)))
    article = F.regexp_extract(html, r'(?s)<article class="article"[^>]*>(.*?)</article>', 1)
    rows = rows.select(*own, url, "_title", F.explode(F.split(article, r'(?=<h[2-6][^>]*\bid=")')).alias("_part"))
    head = r'(?s)^<h([2-6])[^>]*\bid="([^"]+)"[^>]*>(.*?)</h\1>'
    anchor = F.regexp_extract("_part", head, 2)
    title = F.when(anchor != "", M.page_text(F.regexp_extract("_part", head, 3))).otherwise(F.col("_title"))
    rows = rows.select(*own, F.when(anchor != "", F.concat(url, F.lit("#"), anchor)).otherwise(F.col(url)).alias(url), title.alias("title"), M.page_text(F.regexp_replace("_part", head, "")).alias("_body"))
    content = F.when(F.col("_body") != "", F.concat("title", F.lit(". "), "_body")).otherwise(F.col("title"))
    return rows.where("title <> '' or _body <> ''").select(*own, url, "title", content.alias("content"))


def ranked(docs: DataFrame, id_col: str, queries: DataFrame, query_col: str, k: int) -> DataFrame:
    """Rows (query_col, id_col, score, rank): documents that hold all of a query's words, the k best.

    docs: id_col and words, an array; queries: distinct rows (query_col, word). A word counts by its part of the document and
    by how few documents hold it. Documents' words are narrowed to the queries' before they are counted.
    """
    asked = queries.select("word").distinct()
    words = docs.select(id_col, F.size("words").alias("n"), F.explode("words").alias("word")).join(asked, "word", "left_semi")
    tf = words.groupBy(id_col, "n", "word").agg(F.count("*").alias("tf"))
    df = tf.groupBy("word").agg(F.count("*").alias("df"))
    every = docs.agg(F.count("*").alias("every"))
    need = queries.groupBy(query_col).agg(F.count("*").alias("need"))
    hit = queries.join(tf, "word").join(df, "word").join(F.broadcast(every))  # one row
    gain = F.col("tf") * F.log(1 + F.col("every") / F.col("df"))
    hit = hit.groupBy(query_col, id_col, "n").agg(F.count("*").alias("have"), F.sum(gain).alias("gain")).join(need, query_col).where("have = need")
    hit = hit.select(query_col, id_col, F.round(F.col("gain") / F.col("n"), 6).alias("score"))
    order = Window.partitionBy(query_col).orderBy(F.desc("score"), id_col)
    return hit.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


#: Characters of passages that go to every task at once; more go in several blocks.
BLOCK = 1 << 20


def containing(docs: DataFrame, doc_col: str, passages: DataFrame, item_col: str) -> DataFrame:
    """Rows (item_col, doc_col): which passages (item_col, key) stand in which documents (doc_col, key), keys being texts
    without blanks. Passages are broadcast in blocks of bounded size; no document leaves its place, however short a passage.
    """
    size = passages.agg(F.coalesce(F.sum(F.length("key") + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-int(size) // BLOCK))
    per = passages.groupBy(F.pmod(F.xxhash64(item_col), F.lit(blocks)).cast("int").alias("_block")).agg(F.collect_list(F.struct(item_col, F.col("key").alias("_key"))).alias("_all"))
    rows = docs.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(F.broadcast(per), "_block")  # rows of BLOCK characters or so
    hit = F.filter("_all", lambda p: F.col("key").contains(p["_key"]))
    return rows.select(doc_col, F.explode(hit).alias("p")).select(f"p.{item_col}", doc_col)


def index_line(title: Column, link: Column, vendor: Column, date: Column, description: Column) -> Column:
    words = F.trim(F.regexp_replace(description, r"\s+", " "))
    return F.concat(F.lit("- ["), title, F.lit("]("), link, F.lit("): "), vendor, F.lit(", "), date, F.lit(". "), words)


def card_index(cards: DataFrame) -> DataFrame:
    """Rows (vendor, cards, index) of rows (vendor, date, card, line): each vendor's lines, the newest first."""
    order = F.array_sort(F.collect_list(F.struct((-F.unix_micros(F.col("date").cast("timestamp"))).alias("d"), "card", "line")))
    return cards.groupBy("vendor").agg(F.count("*").alias("cards"), F.concat(F.lit("# Cards\n\n"), F.array_join(F.transform(order, lambda x: x["line"]), "\n"), F.lit("\n")).alias("index"))


def figures(blocks: DataFrame, by: str, order: str) -> DataFrame:
    """Rows (by, first, images, captioned): runs of image blocks; one that has a caption ends its run."""
    w = Window.partitionBy(by).orderBy(order)
    goes_on = (F.col("kind") == "image") & (F.lag("kind").over(w) == "image") & ~F.lag("captioned").over(w)
    rows = blocks.withColumn("_new", F.when(goes_on, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(w)).where("kind = 'image'")
    return rows.groupBy(by, "_run").agg(F.min(order).alias("first"), F.count("*").alias("images"), F.bool_or("captioned").alias("captioned")).drop("_run")


def with_table_notes(lines: DataFrame, by: str, order: str, line: str) -> DataFrame:
    """lines in which references inside tables are links, and hidden references follow the first table that alone has them."""
    tabular = F.col(line).rlike("<t[dh][ >]")
    refs = lines.select(by, order, tabular.alias("tab"), F.explode(F.regexp_extract_all(line, F.lit(r"\[\^(\d+)\](?!:)"), 1)).alias("ref"))
    per = refs.groupBy(by, "ref").agg(F.bool_or(~F.col("tab")).alias("prose"), F.min(F.when(F.col("tab"), F.col(order))).alias(order)).where("not prose")
    shims = per.groupBy(by, order).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.col("ref").cast("int"))), lambda n: F.concat(F.lit("[^"), n.cast("string"), F.lit("]"))), "").alias("_refs"))
    link = F.regexp_replace(line, r"\[\^(\d+)\]", '<sup class="fn-html"><a href="#user-content-fn-$1">$1</a></sup>')
    shim = F.coalesce(F.concat(F.lit('\n\n<span class="fnref-shim">'), F.col("_refs"), F.lit("</span>\n")), F.lit(""))
    return lines.join(shims, [by, order], "left").withColumn(line, F.concat(F.when(tabular, link).otherwise(F.col(line)), shim)).drop("_refs")
