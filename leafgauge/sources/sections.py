"""Readers of a card's files: Markdown sections, figure maps, image lists, chip registries, PNG sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T


def read_sections(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (file, page_start, page_end, text) of a folder's .md files; pages come from `pages A-B` near their start, else null."""
    files = spark.read.text(f"{folder}/*.md", wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))
    return _with_pages(files)


def _with_pages(files: DataFrame) -> DataFrame:
    page = lambda k: F.expr("try_cast(nullif(%s, '') as int)" % f"regexp_extract(left(text, 200), 'pages (\\\\d+)-(\\\\d+)', {k})")
    return files.select("file", page(1).alias("page_start"), page(2).alias("page_end"), "text")


def figures_map(spark: SparkSession, path: str) -> DataFrame:
    """Rows (page, k, file) of a JSON object that maps pages to lists of files."""
    m = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("page", "files"))
    return m.select(F.col("page").cast("int").alias("page"), F.posexplode("files").alias("k", "file"))


#: Fields of an image list, in order.
IMAGE_FIELDS = ("page int", "num int", "type string", "width int", "height int", "color string", "comp int", "bpc int", "enc string", "interp string", "object string", "gen string", "xppi int", "yppi int", "size string", "ratio string")


def image_list(spark: SparkSession, path: str) -> DataFrame:
    """Rows of IMAGE_FIELDS of a fixed list of images: two lines of headings, then 16 fields or more to a line."""
    f = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).select(f.alias("f")).where(F.size("f") >= 16).where(F.get("f", F.lit(0)).rlike(r"^\d+$"))
    return rows.select(*(F.get("f", F.lit(k)).cast(x.split()[1]).alias(x.split()[0]) for k, x in enumerate(IMAGE_FIELDS)))


def sections_at(spark: SparkSession, repository: str, ref: str, folder: str) -> DataFrame:
    """read_sections of a folder as a commit of a git repository has it: one git call for each file, on the driver.

    A card has a few dozen files; their texts become a frame at once.
    """
    import subprocess

    git = lambda *a: subprocess.run(["git", "-C", repository, *a], capture_output=True, text=True, check=True).stdout
    names = sorted(n for n in git("ls-tree", "-r", "--name-only", ref, "--", folder).split("\n") if n.endswith(".md"))
    files = spark.createDataFrame([(n.rpartition("/")[2], git("show", f"{ref}:{n}")) for n in names], "file string, text string")
    return _with_pages(files)


def first_headings(sections: DataFrame) -> DataFrame:
    """Rows (file, heading): the first heading of each section as it is compared, 40 characters at most; null without one."""
    line = F.get(F.filter(F.split("text", "\n"), lambda x: x.startswith("#")), F.lit(0))
    return sections.select("file", F.substring(T.squash(F.regexp_replace(line, "^#+", "")), 1, 40).alias("heading"))


def table_pages(sections: DataFrame, reach: int = 4000) -> DataFrame:
    """Rows (file, page) of pages on which a table begins: that of the last marker in the text just before it."""
    pieces = sections.select("file", F.posexplode(F.split("text", "(?=<table)")).alias("k", "piece"))
    marks = pieces.withColumn("text", F.right("piece", F.lit(reach))).withColumn("m", F.regexp_extract_all("text", F.lit(r"<!-- p\.(\d+) -->"), 1))
    w = Window.partitionBy("file").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.size("m") > 0, F.element_at("m", F.size("m"))), ignorenulls=True).over(w)
    return marks.withColumn("page", last.cast("int")).where("startswith(piece, '<table') and page is not null").select("file", "page").distinct()


def chip_registry(spark: SparkSession, path: str) -> DataFrame:
    """Rows (hex, label) of the block `chips:` of a manifest; of labels with one colour the last holds."""
    block = F.regexp_extract("value", r"(?m)^chips:\n((?:  .+\n?)+)", 1)
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split(block, "\n")).alias("k", "line"))
    pattern = r'^  (.+?):\s+"(#[0-9a-fA-F]+)"'
    found = lines.select("k", F.regexp_extract("line", pattern, 1).alias("label"), F.regexp_extract("line", pattern, 2).alias("hex")).where("hex <> ''")
    return found.groupBy("hex").agg(F.max_by("label", "k").alias("label"))


def png_size(content: Column) -> Column:
    """Width and height in a PNG file's header."""
    at = lambda k: F.conv(F.hex(F.substring(content, k, 4)), 16, 10).cast("int")
    return F.struct(at(17).alias("width"), at(21).alias("height"))
