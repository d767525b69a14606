"""Page geometry: classes of drawings, zones of spans, containment and nearest-left joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def drawing_class(w: Column, h: Column, stroke_only: Column, has_text: Column) -> Column:
    """rule, box or pill of a drawing, null for none; the order of the tests matters."""
    line = (h <= 2.5) & w.between(8, 250)
    fill = F.when(((h >= 30) & (w >= 100)) | ((h >= 12) & (w >= 250)), "box").when((h > 6) & (h < 30) & (w > 9) & (w < 250) & has_text, "pill").when(line, "rule")
    return F.when(stroke_only, F.when(line, "rule")).otherwise(fill)


def zone(text: Column, y1: Column, height: Column, flags: Column, bottom: float = 45) -> Column:
    """pagenum, fnref or body of a span; the superscript bit is the first."""
    digits = text.rlike(r"^\d+$")
    return F.when((y1 > height - bottom) & digits, "pagenum").when((flags.bitwiseAND(F.lit(1)) != 0) & digits, "fnref").otherwise("body")


def contains(o: str, i: str, slack: float = 2) -> Column:
    """Whether box o (columns o_x0 ...) holds box i, with slack."""
    c = lambda p, k: F.col(f"{p}_{k}")
    return (c(i, "x0") >= c(o, "x0") - slack) & (c(i, "y0") >= c(o, "y0") - slack) & (c(i, "x1") <= c(o, "x1") + slack) & (c(i, "y1") <= c(o, "y1") + slack)


def overlaps(a: str, b: str) -> Column:
    c = lambda p, k: F.col(f"{p}_{k}")
    return (c(a, "x0") < c(b, "x1")) & (c(b, "x0") < c(a, "x1")) & (c(a, "y0") < c(b, "y1")) & (c(b, "y0") < c(a, "y1"))


def smallest_holder(inner: DataFrame, outer: DataFrame, by: list[str], inner_id: str, outer_id: str, slack: float = 4) -> DataFrame:
    """Of each inner box (i_x0 ...) the smallest outer box (o_x0 ...) of its page that holds it, ties to the smaller id."""
    area = (F.col("o_x1") - F.col("o_x0")) * (F.col("o_y1") - F.col("o_y0"))
    w = Window.partitionBy(*by, inner_id).orderBy(area, outer_id)
    found = inner.join(outer, by).where(contains("o", "i", slack)).withColumn("_n", F.row_number().over(w))
    return found.where("_n = 1").select(*by, inner_id, outer_id)


def nearest_left(refs: DataFrame, spans: DataFrame, by: list[str], ref_id: str) -> DataFrame:
    """Of each reference (i_x0 ...) the span (o_x0 ..., text) on its line that ends last at or before it."""
    found = refs.join(spans, by).where((F.col("o_y0") < F.col("i_y1")) & (F.col("i_y0") < F.col("o_y1")) & (F.col("o_x1") <= F.col("i_x0") + 2))
    return found.groupBy(*by, ref_id).agg(F.max_by("text", F.struct("o_x1", "text")).alias("anchor"))
