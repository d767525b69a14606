"""Facts of Markdown sections: pages between markers, marked-up pieces, quotes; mutations that checks must notice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MARKER = r"<!-- p\.(\d+) -->"
#: Up to eight characters at a line's start, not all blank, and the marker after them.
SNAP = r"(?m)^(?=[ \t]*[^\s<])([^\n<]{1,8})(<!-- p\.\d+ -->)"
#: What a piece of each kind looks like in one line; the first group is its text.
KINDS = {
    "image": r"!\[[^\]]*\]\(([^)\s]+)\)",
    "link": r"(?:^|[^!])\[([^\]]+)\]\([^)\s]+\)",
    "chip": r":chip\[([^\]]+)\]",
    "bold": r"\*\*([^*\n]+)\*\*",
    "fn_ref": r"\[\^(\d+)\](?:[^:]|$)",
    "fn_def": r"^\[\^(\d+)\]:",
    "heading": r"^#{1,6}\s+(.+)$",
}


def page_slices(df: DataFrame, text: str, first: Column | None = None) -> DataFrame:
    """df with ord, page and slice for each stretch between page markers, text dropped; before any marker the page is `first`.

    Empty stretches give no row; a null text gives none.
    """
    # A marker right after a line's beginning, such as a list mark, belongs before it.
    df = df.withColumn(text, F.regexp_replace(text, SNAP, "$2$1"))
    pages = F.transform(F.regexp_extract_all(text, F.lit(MARKER), 1), lambda x: x.cast("int"))
    pages = F.concat(F.array((first if first is not None else F.lit(None)).cast("int")), pages)
    out = df.select(*(c for c in df.columns if c != text), F.posexplode(F.arrays_zip(pages.alias("page"), F.split(text, MARKER).alias("slice"))).alias("ord", "s"))
    return out.select("*", F.col("s.page").alias("page"), F.col("s.slice").alias("slice")).drop("s").where("slice <> ''")


def line_facts(df: DataFrame, line: str) -> DataFrame:
    """df with kind and fact for every marked-up piece of line, in one pass; line dropped."""

    def of(kind, pattern):
        return F.transform(F.regexp_extract_all(line, F.lit(pattern), 1), lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("fact")))

    out = df.select(*(c for c in df.columns if c != line), F.explode(F.concat(*(of(k, p) for k, p in KINDS.items()))).alias("f"))
    return out.select("*", "f.kind", "f.fact").drop("f")


def quote_gaps(lines: DataFrame, by: list[str], order: str, line: str) -> DataFrame:
    """lines in which blank ones between two quoted lines are made quoted too, whatever number of blanks lies between."""
    w = Window.partitionBy(*by).orderBy(order)
    quoted = F.when(F.col(line) != "", F.col(line).startswith(">"))
    before = F.last(quoted, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(quoted, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    return lines.withColumn(line, F.when((F.col(line) == "") & before & after, ">").otherwise(F.col(line)))


def swapped(words: Column, k: Column) -> Column:
    """words with those at k and k + 1 (from 0) in each other's place; k is at most two less than their number."""
    n = F.size(words)
    return F.concat(F.slice(words, 1, k), F.array(F.get(words, k + 1), F.get(words, k)), F.slice(words, k + 3, n))


def dropped(words: Column, k: Column, m: int) -> Column:
    """words without the m from k on."""
    return F.concat(F.slice(words, 1, k), F.slice(words, k + m + 1, F.size(words)))


def doubled(words: Column, k: Column, m: int) -> Column:
    """words with the m from k on twice."""
    return F.concat(F.slice(words, 1, k + m), F.slice(words, k + 1, F.lit(m)), F.slice(words, k + m + 1, F.size(words)))
