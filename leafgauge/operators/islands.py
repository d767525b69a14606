"""Runs, intervals, as-of lookups and order-dependent folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def runs(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """df with island: the number of the run of equal values each row is in, from 1."""
    w = Window.partitionBy(*by).orderBy(*order)
    change = F.when(F.col(value).eqNullSafe(F.lag(value).over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return df.withColumn("_c", change).withColumn("island", F.sum("_c").over(w).cast("bigint")).drop("_c")


def merge_intervals(df: DataFrame, by: list[str], start: str, end: str, slack: int = 0) -> DataFrame:
    """Rows (by, start, end, n): overlapping or touching intervals (at most slack apart) made one."""
    w = Window.partitionBy(*by).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumn("_new", F.when(F.col(start) <= reach + slack, 0).otherwise(1)).withColumn("_i", F.sum("_new").over(w))
    return df.groupBy(*by, "_i").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n")).drop("_i")


def last_known(value: Column, by: list[str], order: list[str]) -> Column:
    """The last non-null value at or before each row."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return F.last(value, ignorenulls=True).over(w)


def as_of(facts: DataFrame, marks: DataFrame, by: list[str], at: str, value: str) -> DataFrame:
    """facts with value of the last mark at or before them: a union and one window, no range join."""
    both = facts.withColumn("_mark", F.lit(None).cast(marks.schema[value].dataType)).withColumn("_kind", F.lit(1))
    m = marks.select(*by, at, F.col(value).alias("_mark")).withColumn("_kind", F.lit(0))
    both = both.unionByName(m, allowMissingColumns=True)
    return both.withColumn(value, last_known(F.col("_mark"), by, [at, "_kind"])).where("_kind = 1").drop("_mark", "_kind")


def heading_of(dests: DataFrame, heads: DataFrame, by: list[str], below: float = 8) -> DataFrame:
    """dests (by, page, y, ...) with head: the last heading (by, page, y, head) of the page at most `below` under y.

    Failing that the first of the page; on a page without any, the last of the pages before. One union and two windows.
    """
    d = dests.withColumn("_y", F.col("y") + below).withColumn("_kind", F.lit(1)).withColumn("_h", F.lit(None).cast(f"struct<page:{heads.schema['page'].dataType.simpleString()},head:{heads.schema['head'].dataType.simpleString()}>"))
    h = heads.select(*by, "page", F.col("y").cast(d.schema["_y"].dataType).alias("_y"), F.struct("page", "head").alias("_h")).withColumn("_kind", F.lit(0))
    both = d.unionByName(h, allowMissingColumns=True)
    first = F.min_by("_h", F.when(F.col("_h").isNotNull(), F.struct("_y", "_h.head"))).over(Window.partitionBy(*by, "page"))
    both = both.withColumn("_last", last_known(F.col("_h"), by, ["page", "_y", "_kind", "_h.head"])).withColumn("_first", first).where("_kind = 1")
    head = F.when(F.col("_last.page") == F.col("page"), F.col("_last.head")).otherwise(F.coalesce("_first.head", "_last.head"))
    return both.withColumn("head", head).drop("_y", "_kind", "_h", "_last", "_first")


def most_common(df: DataFrame, by: list[str], value: str, order: str) -> DataFrame:
    """Rows (by, value, n): the commonest value, of equally common ones that which came first."""
    n = df.groupBy(*by, value).agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    return n.groupBy(*by).agg(F.max_by(F.struct(value, "n"), F.struct("n", -F.col("_first"))).alias("m")).select(*by, "m.*")


def tiers(values: Column, gap: float = 4) -> Column:
    """Of a sorted array, the values that start a tier: more than gap above the start of the tier before."""
    none = F.array().cast("array<double>")
    return F.aggregate(values, none, lambda acc, x: F.when((F.size(acc) > 0) & (x - F.element_at(acc, -1) <= gap), acc).otherwise(F.concat(acc, F.array(x.cast("double")))))


def spaced(tops: Column, height: float) -> Column:
    """Notes pushed down so that each lies height below the one before: top = max(top, previous + height)."""
    none = F.array().cast("array<double>")
    return F.aggregate(tops, none, lambda acc, x: F.concat(acc, F.array(F.when(F.size(acc) > 0, F.greatest(x.cast("double"), F.element_at(acc, -1) + height)).otherwise(x.cast("double")))))


def outermost(intervals: Column) -> Column:
    """Of half-open intervals those that begin at or after the end of the last one kept, longest first at one start."""
    order = F.array_sort(F.transform(intervals, lambda i: F.struct(i["start"].alias("start"), (-i["end"]).alias("back"))))
    none = F.array().cast("array<struct<start:int,back:int>>")
    kept = F.aggregate(order, none, lambda acc, x: F.when((F.size(acc) > 0) & (x["start"] < -F.element_at(acc, -1)["back"]), acc).otherwise(F.concat(acc, F.array(x))))
    return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), (-x["back"]).alias("end")))


def visual_rows(fragments: DataFrame, by: list[str], share: float = 0.5, look_back: int = 4) -> DataFrame:
    """Rows (by, row, x0, y0, x1, y1, n): fragments (x0, y0, x1, y1) gathered to visual rows.

    In reading order each joins one of the last rows that it overlaps vertically by more than share of the lesser
    height, the latest first; the row grows by it. The state is the rows so far, so this is a fold over a page.
    """
    box = "struct<x0:double,y0:double,x1:double,y1:double,n:int>"
    order = F.array_sort(F.collect_list(F.struct("y0", "x0", "y1", "x1")))

    def step(acc, f):
        n = F.size(acc)
        at = F.lit(0)
        for back in range(look_back, 0, -1):
            r = F.get(acc, n - back)
            overlap = F.least(r["y1"], f["y1"]) - F.greatest(r["y0"], f["y0"])
            at = F.when(F.coalesce(overlap / F.least(r["y1"] - r["y0"], f["y1"] - f["y0"]) > share, F.lit(False)), n - back + 1).otherwise(at)
        new = F.struct(f["x0"].alias("x0"), f["y0"].alias("y0"), f["x1"].alias("x1"), f["y1"].alias("y1"), F.lit(1).alias("n"))
        grown = F.transform(acc, lambda r, i: F.when(i + 1 == at, F.struct(F.least(r["x0"], f["x0"]).alias("x0"), F.least(r["y0"], f["y0"]).alias("y0"), F.greatest(r["x1"], f["x1"]).alias("x1"), F.greatest(r["y1"], f["y1"]).alias("y1"), (r["n"] + 1).alias("n"))).otherwise(r))
        return F.when(at > 0, grown).otherwise(F.concat(acc, F.array(new))).cast(f"array<{box}>")

    rows = fragments.groupBy(*by).agg(order.alias("f")).withColumn("r", F.aggregate("f", F.array().cast(f"array<{box}>"), step))
    return rows.select(*by, F.posexplode("r").alias("row", "b")).select(*by, "row", "b.*")
