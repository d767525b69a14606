"""Connected components of a graph held as a DataFrame of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


#: Links of a partition at least: small graphs don't travel in thousands of small files.
ROWS = 50_000


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) of every node of links (a, b); component: the smallest node reached.

    Alternating stars: each node hangs its larger neighbours, then its smaller ones, on the smallest
    neighbour it sees, until nothing changes. Every round is joins and minima over links, never a
    group in one task, and is cut into the checkpoint folder. Loops and repeats do no harm; rows with
    a null end are no links; no links give no rows.
    """

    def state(e):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), small=True)
    before = state(e)
    while before[0]:
        e = e.coalesce(int(before[0]) // ROWS + 1)
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        e = e.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.u", "x.v")
        e = cut(e.where("u <> v").distinct(), int(before[0]) // ROWS + 1)
        now = state(e)
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
