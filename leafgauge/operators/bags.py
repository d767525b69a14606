"""Comparisons of what a source has with what an output shows: bags, sets, neighbourhoods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bag_deficit(source: DataFrame, output: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (*keys, n_src, n_out, deficit): keys the output shows fewer times than the source."""
    a = source.groupBy(*keys).agg(F.count("*").alias("n_src"))
    b = output.groupBy(*keys).agg(F.count("*").alias("n_out"))
    both = a.join(b, keys, "left").withColumn("n_out", F.coalesce("n_out", F.lit(0)))
    return both.withColumn("deficit", F.col("n_src") - F.col("n_out")).where("deficit > 0")


def left_out(source: DataFrame, kept: Column, keys: list[str]) -> DataFrame:
    """Rows (*keys, n): how many more times the source has keys than those of its rows that are kept; one pass, no second side."""
    n = F.count("*") - F.count(F.when(kept, 1))
    return source.groupBy(*keys).agg(n.alias("n")).where("n > 0")


def missing(expected: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    return expected.select(*keys).distinct().join(seen, keys, "left_anti")


def repeated(seen: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The second and later rows of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return seen.withColumn("nth", F.row_number().over(w)).where("nth > 1")


def near_sum(value: Column, page: str, by: list[str], reach: int = 1) -> Column:
    """Sum over pages at most `reach` away, by page number: absent pages count as nothing."""
    return F.sum(value).over(Window.partitionBy(*by).orderBy(page).rangeBetween(-reach, reach))


def compare_counts(source: DataFrame, output: DataFrame, by: list[str], page: str) -> DataFrame:
    """Flags (by, page, n_src, n_out, severity): pages whose counts differ; minor if the pages around agree together."""
    keys = [*by, page]
    both = source.groupBy(*keys).agg(F.count("*").alias("n_src")).join(output.groupBy(*keys).agg(F.count("*").alias("n_out")), keys, "full")
    both = both.na.fill(0, ["n_src", "n_out"])
    both = both.withColumn("a", near_sum(F.col("n_src"), page, by)).withColumn("b", near_sum(F.col("n_out"), page, by))
    return both.where("n_src <> n_out").select(*keys, "n_src", "n_out", F.when(F.col("a") == F.col("b"), "minor").otherwise("major").alias("severity"))


def window_deficit(source: DataFrame, output: DataFrame, keys: list[str], page: str) -> DataFrame:
    """Rows (*keys, page, n_src, n_out): what a page shows too seldom, and the pages next to it don't make up for."""
    at = [*keys, page]
    both = source.groupBy(*at).agg(F.count("*").alias("n_src")).join(output.groupBy(*at).agg(F.count("*").alias("n_out")), at, "full").na.fill(0, ["n_src", "n_out"])
    both = both.withColumn("a", near_sum(F.col("n_src"), page, keys)).withColumn("b", near_sum(F.col("n_out"), page, keys))
    return both.where("n_out < n_src and b < a").drop("a", "b")


def footnote_flags(refs: DataFrame, defs: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (*keys, kind): references without a definition, definitions without a reference, and those made twice."""
    several = defs.groupBy(*keys).count().where("count > 1").select(*keys, F.lit("twice").alias("kind"))
    lost = missing(refs, defs, keys).withColumn("kind", F.lit("undefined"))
    return lost.unionByName(missing(defs, refs, keys).withColumn("kind", F.lit("unused"))).unionByName(several)


def severity(n: Column, at_least: int = 3) -> Column:
    return F.when(n >= at_least, "major").otherwise("minor")


def auto_link(uri: Column, anchor: Column) -> Column:
    """Whether a link is one that the writing program made of plain text by itself: http, and the text is part of it."""
    bare = F.regexp_replace(F.trim(anchor), "/+$", "")
    return uri.startswith("http://") & uri.contains(bare)


def unterminated(text: Column) -> Column:
    """Whether a text doesn't end like a sentence."""
    return ~text.rlike("[.!?:”\"’]$")


def pair_up(left: DataFrame, right: DataFrame, key: str, page: str, reach: int = 2) -> DataFrame:
    """k-th left row with the k-th right row of the same key, if their pages are at most `reach` apart."""
    w = Window.partitionBy(key).orderBy(page)
    a = left.select(key, F.col(page).alias("page_a"), F.row_number().over(w).alias("k"))
    b = right.select(key, F.col(page).alias("page_b"), F.row_number().over(w).alias("k"))
    return a.join(b, [key, "k"]).where(F.abs(F.col("page_a") - F.col("page_b")) <= reach)


def accepted_out(flags: DataFrame, accepted: DataFrame) -> DataFrame:
    """Flags without the majors that are accepted for an invariant and page."""
    a = accepted.select("invariant", "page").withColumn("severity", F.lit("major"))
    return flags.join(a, ["invariant", "page", "severity"], "left_anti")


def summary(flags: DataFrame) -> DataFrame:
    return flags.groupBy("invariant", "severity").agg(F.count("*").alias("n"))


def first_of_each(flags: DataFrame, by: list[str], order: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return flags.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= k)
