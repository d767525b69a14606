"""Readers of what other programs extracted: page records, tables with their boxes, accepted flags, cards' descriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tables

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"
#: A page record; boxes are arrays of four numbers, from the page's top left.
SPAN = "struct<text:string,size:double,bold:boolean,italic:boolean,color:string,font:string,bbox:array<double>,flags:int,line:int,block:int,zone:string>"
LINK = "struct<anchor:string,uri:string,dest_page:int,dest_y:double,unresolvable:boolean,name:string,rects:array<array<double>>>"
DRAWING = "struct<bbox:array<double>,color:string,text:string>"
RECORD = f"struct<spans:array<{SPAN}>,links:struct<uri:array<{LINK}>,goto:array<{LINK}>>,pills:array<{DRAWING}>,boxes:array<{DRAWING}>,rules:array<{DRAWING}>,footnotes:map<string,string>,image_rects:array<array<double>>,n_raster_images:int>"


def _box(c: str) -> list[Column]:
    return [F.get(c, F.lit(k)).alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1"))]


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """Rows (page, record) of a JSON array of page records, page from 1; a page whose record is null has no facts."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", f"array<{RECORD}>").alias("r"))
    return whole.select(F.posexplode("r").alias("page", "record")).withColumn("page", F.col("page") + 1)


def page_spans(records: DataFrame) -> DataFrame:
    """Rows (page, seg, text, ..., x0, y0, x1, y1) of every span, in order."""
    s = records.select("page", F.posexplode("record.spans").alias("seg", "s")).select("page", "seg", "s.*")
    return s.select("*", *_box("bbox")).drop("bbox")


def page_links(records: DataFrame) -> DataFrame:
    """Rows (page, kind, k, anchor, uri, dest_page, dest_y, unresolvable, name, rects): links out, then links inside."""
    of = lambda kind: records.select("page", F.lit(kind).alias("kind"), F.posexplode(f"record.links.{kind}").alias("k", "l")).select("page", "kind", "k", "l.*")
    return of("uri").unionByName(of("goto"))


def page_drawings(records: DataFrame) -> DataFrame:
    """Rows (page, class, k, color, text, x0, y0, x1, y1) of pills, boxes and rules."""
    out = None
    for kind in ("pill", "box", "rule"):
        name = {"box": "boxes"}.get(kind, f"{kind}s")
        d = records.select("page", F.lit(kind).alias("class"), F.posexplode(f"record.{name}").alias("k", "d")).select("page", "class", "k", "d.color", "d.text", *_box("d.bbox"))
        out = d if out is None else out.unionByName(d)
    return out


def page_notes(records: DataFrame) -> DataFrame:
    """Rows (page, n, text) of footnotes; n null for the tail of the page before's last."""
    rows = records.select("page", F.explode("record.footnotes").alias("key", "text"))
    return rows.select("page", F.expr("try_cast(key as bigint)").alias("n"), "text")


def page_tables(spark: SparkSession, path: str) -> DataFrame:
    """Rows (page, k, x0, y0, x1, y1, html) of a JSON object of tables by page, blanks between tags gone."""
    whole = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,array<struct<bbox:array<double>,html:string>>>")).alias("page", "t"))
    rows = whole.select(F.col("page").cast("int").alias("page"), F.posexplode("t").alias("k", "t")).select("page", "k", *_box("t.bbox"), F.col("t.html").alias("html"))
    return rows.withColumn("html", tables.clean(F.col("html")))


def from_bottom(rows: DataFrame, height: Column) -> DataFrame:
    """Boxes measured from a page's bottom left, y1 the lower edge, measured from its top left; to a tenth."""
    one = lambda c: F.round(c, 1)
    return rows.withColumns({"x0": one(F.col("x0")), "x1": one(F.col("x1")), "y0": one(height - F.greatest("y0", "y1")), "y1": one(height - F.least("y0", "y1"))})


def accepted(spark: SparkSession, path: str) -> DataFrame:
    """Rows (invariant, page) of a JSON array of accepted flags, as bags.accepted_out takes them."""
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "array<struct<invariant:string,page:bigint>>")).alias("a"))
    return rows.select("a.invariant", "a.page").distinct()


def cards(spark: SparkSession, root: str) -> DataFrame:
    """Rows (vendor, slug, title, release_date, source_url, description) of root/vendor/slug/meta.yaml, the newest first."""
    files = spark.read.text(f"{root}/*/*/meta.yaml", wholetext=True).select("value", F.split(F.col("_metadata.file_path"), "/").alias("p"))
    field = lambda name: F.nullif(F.regexp_extract("value", rf"(?m)^{name}:\s*[\"']?(.*?)[\"']?\s*$", 1), F.lit(""))
    at = lambda k: F.element_at("p", k)
    out = files.select(at(-3).alias("vendor"), at(-2).alias("slug"), *(field(n).alias(n) for n in ("title", "release_date", "source_url", "description")))
    return out.orderBy(F.desc("release_date"), "vendor", "slug")


def built_pages(spark: SparkSession, root: str) -> DataFrame:
    """Rows (url, html) of root/vendor/slug/index.html; other files of the folder are not looked at."""
    files = spark.read.text(f"{root}/*/*/index.html", wholetext=True).select(F.col("value").alias("html"), F.split(F.col("_metadata.file_path"), "/").alias("p"))
    return files.select(F.concat(F.lit("/"), F.element_at("p", -3), F.lit("/"), F.element_at("p", -2), F.lit("/")).alias("url"), "html")


def distinct_neighbours(figures: DataFrame, files: DataFrame) -> DataFrame:
    """figures (page, k, file) without those whose bytes equal the figure's before them on the page; files: (file, content).

    A figure without a file is told by its name.
    """
    from pyspark.sql import Window

    digest = F.coalesce(F.sha2("content", 256), F.col("file"))
    rows = figures.join(files, "file", "left").withColumn("digest", digest)
    before = F.lag("digest").over(Window.partitionBy("page").orderBy("k"))
    return rows.withColumn("again", before.eqNullSafe(F.col("digest"))).where("not again").select("page", "k", "file")
