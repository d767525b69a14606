"""Writers of sections, flags, slices, records and reports. Spark writes each in parts, a card or page to a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import bags, facts, gates


def section_texts(blocks: DataFrame) -> DataFrame:
    """Rows (section, text) of rows (section, k, page, text): a section's blocks under a line that names its pages."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("k", "text"))), lambda x: x["text"])
    head = F.format_string("<!-- source: source.pdf pages %03d-%03d -->\n\n", F.min("page").cast("int"), F.max("page").cast("int"))
    return blocks.groupBy("section").agg(F.concat(head, F.array_join(parts, "\n")).alias("text"))


def write_sections(blocks: DataFrame, folder: str) -> None:
    """One folder for each section, its text in one file."""
    section_texts(blocks).write.mode("overwrite").partitionBy("section").text(folder)


def write_slices(sections: DataFrame, folder: str) -> None:
    """sections (section, text): what stands on each page, one folder for each page, in the order of section and place."""
    slices = facts.page_slices(sections.select("section", "text"), "text").where("page is not null")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("section", "ord", "slice"))), lambda x: F.trim(x["slice"]))
    text = slices.groupBy("page").agg(F.array_join(parts, "\n\n").alias("text"))
    text.write.mode("overwrite").partitionBy("page").text(folder)


def write_flags(flags: DataFrame, folder: str) -> None:
    """Flags as JSON, one to a line, details with sorted names; those of one invariant in one folder."""
    rows = flags.withColumn("detail", gates.canonical(F.col("detail")))
    rows.write.mode("overwrite").partitionBy("invariant").json(folder)


def write_facts(frame: DataFrame, folder: str) -> DataFrame:
    """A cache: frame written as Parquet by page, and what is read back, so that later runs prune by page."""
    frame.write.mode("overwrite").partitionBy("page").parquet(folder)
    return frame.sparkSession.read.parquet(folder)


def write_json(frame: DataFrame, folder: str) -> None:
    """Recall by class, a census, search records: rows as JSON, one to a line."""
    frame.write.mode("overwrite").json(folder)


def write_texts(frame: DataFrame, key: str, text: str, folder: str) -> None:
    """Portable Markdown, indexes: one folder for each key, its text in one file."""
    frame.select(key, text).write.mode("overwrite").partitionBy(key).text(folder)


def figures_map(images: DataFrame) -> DataFrame:
    """Rows (page, files) of layout.image_files: each page's files in order, as a figure map lists them."""
    return images.groupBy("page").agg(F.transform(F.array_sort(F.collect_list(F.struct("num", "file"))), lambda x: x["file"]).alias("files"))


def report(flags: DataFrame, samples: int = 3) -> DataFrame:
    """Rows (invariant, severity, n, samples): how many flags, and the first details of each, for people to read."""
    n = bags.summary(flags)
    first = bags.first_of_each(flags.withColumn("text", gates.canonical(F.col("detail"))), ["invariant", "severity"], ["doc", "page", "text"], samples)
    some = first.groupBy("invariant", "severity").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "page", "text"))), lambda x: F.concat(F.lit("p."), x["page"].cast("string"), F.lit(" "), x["text"])).alias("samples"))
    return n.join(some, ["invariant", "severity"]).orderBy("invariant", "severity")
