"""Site-relative line dedup (operator 10), in DataFrame functions only.

A line is boilerplate of a host if more than a given part of the host's pages contain it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: What stands between two runs of a page's text: scripts, styles, comments and tags.
MARKUP = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>"
EDGES = r"^[\s]+|[\s]+$"


def page_lines(html):
    """The non-blank runs of text between tags, trimmed, in order."""
    runs = F.split(F.regexp_replace(html, MARKUP, "\n"), "\n")
    return F.filter(F.transform(runs, lambda x: F.regexp_replace(x, EDGES, "")), lambda x: x != "")


def host(url):
    """Lower-case host of a URL; '' where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1)), F.lit(""))


#: Bytes of all hosts' boilerplate hashes up to which they are broadcast; beyond it rows are joined by host.
BROADCAST = 16 << 20


def drop_frequent_lines(rows: DataFrame, ratio: float = 0.3, least: int = 5, host_col: str = "host", lines_col: str = "lines", kept_col: str = "kept") -> DataFrame:
    """The rows with kept_col: the lines left of each, in order. Other columns stay as they are, whatever their names; one named kept_col is replaced.

    A line goes from a host's pages if at least `least` of them, and more than ratio of them, contain it (compared trimmed;
    blank and null lines are never dropped). Each row is a page of its own, repeated ones too. Null lines: kept is null, though
    the row counts as a page; null hosts are one host with ''. An empty table gives no rows. Every line is counted on all
    pages; the set of lines that a host loses has at most its mean number of lines per page, divided by ratio. Where the
    sets of all hosts are small, as measured, no page leaves its place; else pages meet them in a merge join, whose
    large hosts are split.
    """
    key = lambda x: F.md5(F.regexp_replace(x, EDGES, ""))
    rows = rows.select(F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("row"))
    host, lines = F.coalesce(F.col("row")[host_col], F.lit("")), F.col("row")[lines_col]
    total = rows.groupBy(host.alias("host")).agg(F.count("*").alias("pages"))
    blank = F.md5(F.lit(""))
    count = rows.select(host.alias("host"), F.explode(F.array_distinct(F.transform(lines, key))).alias("m")).where(F.col("m") != blank).groupBy("host", "m").agg(F.count("*").alias("n"))
    often = count.where(F.col("n") >= least).join(total, "host").where(F.col("n") > F.lit(ratio) * F.col("pages"))
    often = cut(often.groupBy("host").agg(F.collect_set("m").alias("gone")), small=True)
    size = often.agg(F.sum(F.lit(64) + F.octet_length("host") + 48 * F.size("gone"))).first()[0] or 0
    out = rows.withColumn("host", host).join(F.broadcast(often) if size <= BROADCAST else often.hint("merge"), "host", "left")
    left = F.when(F.col("gone").isNull(), lines).otherwise(F.filter(lines, lambda x: F.coalesce(~F.array_contains("gone", key(x)), F.lit(True))))
    fields = [f for f in rows.schema["row"].dataType.names if f != kept_col]
    # Named only afterwards: a column called like one of ours would be taken for it.
    return out.select("row", left.alias("left")).select(*(F.col("row")[f].alias(f) for f in fields), F.col("left").alias(kept_col))


def dedup_pages(pages: DataFrame, ratio: float = 0.3, least: int = 5, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (id_col, host, lines, kept), one for each page; null html has no lines, a null URL the host ''. Repeated pages are
    pages like others; an empty table gives no rows. Other columns are not looked at."""
    lines = F.coalesce(page_lines(F.col(html_col)), F.array().cast("array<string>"))
    return drop_frequent_lines(pages.select(F.col(id_col).alias(id_col), host(F.col(url_col)).alias("host"), lines.alias("lines")), ratio, least)
