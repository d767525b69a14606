"""Mixing sources to target weights by a low-discrepancy schedule (operator 8), in DataFrame functions only.

Golden-ratio points run through the sources' cumulative targets and so deal slots to sources, each near its
share in every stretch of the schedule. The k-th slot of a source takes the k-th block of its shuffled texts,
laid end to end and cut into blocks of equal words; after the last block the texts begin again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_WORD, cut

#: Words of a block; cells in which points look their source up; slots and hash prefixes numbered apart.
BLOCK, CELLS, CHUNK, PREFIX = 512, 4096, 65536, 3
#: 2^31 times the golden ratio's fraction, made odd, and 2^31: points are i * GOLDEN mod TURN.
GOLDEN, TURN = 1327217885, 1 << 31


def sized(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: str = "mix") -> DataFrame:
    """Rows (id, source, size, h): words of each text and its place in the shuffle; null texts have size 0."""
    size = F.coalesce(F.regexp_count(text_col, F.lit(SPACE_WORD)), F.lit(0)).cast("bigint")
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("h"))


def targets(rows: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """Rows (source, si, source_size, target): sources by code point, null last, weigh the weights in turn.

    Targets share the sum of all sizes; none is above most times its source's size, and what is over goes to
    the others by weight. With x words for each unit of weight, a source gets min(most * size, weight * x); x is
    found from the sums of those that are full at it, in order of most * size / weight. One row for each source: no rows
    for an empty table; without any word every target is 0.
    """
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    per = per.withColumn("si", F.row_number().over(order).cast("bigint") - 1)
    per = per.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.pmod("si", F.lit(len(weights))) + 1).cast("int")).cast("bigint"))
    per = per.withColumn("full", F.col("source_size") * most).withColumn("r", F.col("full") / F.col("w"))
    every = Window.partitionBy()
    before = Window.orderBy("r", "si").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    per = per.withColumn("x", (F.sum("source_size").over(every) - F.coalesce(F.sum("full").over(before), zero)) / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), zero)))
    x = F.min_by(F.when(F.col("r") >= F.col("x"), F.col("x")), F.when(F.col("r") >= F.col("x"), F.struct("r", "si"))).over(every)
    return per.withColumn("target", F.coalesce(F.least(F.col("full").cast("double"), F.col("w") * x), F.col("full").cast("double"))).select("source", "si", "source_size", "target")


def _quotas(shares: DataFrame, block: int) -> DataFrame:
    """Of each source: words it gives (quota), its blocks (nb), blocks taken (q) and words of a cut last one (last)."""
    q = shares.withColumn("quota", F.least(F.round("target").cast("bigint"), F.col("source_size") * 3)).where("source_size > 0 and quota > 0")
    q = q.withColumn("rest", F.expr("quota % source_size")).withColumn("nb", F.expr(f"(source_size + {block - 1}) div {block}"))
    q = q.withColumn("q", F.expr(f"(quota div source_size) * nb + (rest + {block - 1}) div {block}"))
    return q.withColumn("last", F.expr(f"if(rest % {block} = 0 or rest = 0, null, rest % {block})"))


def schedule(shares: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows (slot, si, k, block, epoch, cut): which block of which source each slot takes; cut: only so many words of it.

    Slots are 0, 1, ...; shares are targets(): an empty table, or sources without words, get no slots.
    """
    quotas = _quotas(shares, block)
    n = quotas.agg(F.coalesce(F.sum("q"), F.lit(0))).first()[0]
    order = Window.orderBy("si")
    all_q = F.sum("q").over(Window.partitionBy())
    spans = quotas.select("si", "q", "nb", "last", (F.coalesce(F.sum("q").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) / all_q).alias("lo"), (F.sum("q").over(order) / all_q).alias("hi"))
    cells = spans.select("si", "lo", "hi", F.explode(F.expr(f"sequence(cast(floor(lo * {CELLS}) as int), cast(least(floor(hi * {CELLS}), {CELLS - 1}) as int))")).alias("cell"))
    slots = shares.sparkSession.range(n).select(F.col("id").alias("slot"), F.expr(f"((id % {TURN}) * {GOLDEN} % {TURN}) / {TURN}.0D").alias("u")).withColumn("cell", F.expr(f"cast(floor(u * {CELLS}) as int)"))
    dealt = slots.join(cells, "cell").where("u >= lo and u < hi").select("slot", "si", F.expr(f"slot div {CHUNK}").alias("chunk"))
    per = dealt.groupBy("si", "chunk").agg(F.count("*").alias("c"))
    before = F.sum("c").over(Window.partitionBy("si").orderBy("chunk")) - F.col("c")
    per = per.select("si", "chunk", before.alias("before"), "c")
    ranked = dealt.join(per, ["si", "chunk"]).withColumn("k", F.col("before") + F.row_number().over(Window.partitionBy("si", "chunk").orderBy("slot")) - 1).select("slot", "si", "k")
    # Where the points gave a source a few slots less than it has blocks, the rest stand at the end.
    counts = per.groupBy("si").agg(F.sum("c").alias("m"))
    late = quotas.join(counts, "si", "left").select("si", "q", F.coalesce("m", F.lit(0)).alias("m")).where("m < q").select("si", F.explode(F.expr("sequence(m, q - 1)")).alias("k"))
    late = late.select((F.lit(n) + F.row_number().over(Window.orderBy("k", "si")) - 1).cast("bigint").alias("slot"), "si", "k")
    out = ranked.union(late).join(quotas.select("si", "q", "nb", "last"), "si").where("k < q")
    return out.select("slot", "si", "k", F.expr("k % nb").alias("block"), F.expr("k div nb").alias("epoch"), F.expr("if(k = q - 1, last, null)").alias("cut"))


def laid_out(rows: DataFrame, shares: DataFrame) -> DataFrame:
    """Rows (row, id, source, size, si, source_size, target, start): where each text lies in its source's shuffled texts.

    A source's texts are numbered apart for each prefix of their hash, so no source is one task. An empty table gives no rows.
    """
    rows = rows.join(shares, rows.source.eqNullSafe(shares.source)).drop(shares.source).withColumn("p", F.substring("h", 1, PREFIX))
    per = rows.groupBy("si", "p").agg(F.sum("size").alias("c"))
    per = per.select("si", "p", (F.sum("c").over(Window.partitionBy("si").orderBy("p")) - F.col("c")).alias("before"))
    inside = Window.partitionBy("si", "p").orderBy("h", "id", "size", "row").rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(per, ["si", "p"]).withColumn("start", F.col("before") + F.sum("size").over(inside) - F.col("size")).drop("p", "h", "before")


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), block: int = BLOCK, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Rows (id_col, size, source_size, target, taken, first_slot, n_slots), one for each row of docs: words of it that the
    mix takes, the first slot of the schedule that takes some of them, and how many do.

    Null texts, and texts without words, have size 0 and give nothing: no slot, first_slot null. Null sources are a source
    of their own, the last. Null ids and repeated rows are rows like others; equal places in the shuffle are told apart by
    id, then size. Without any word all targets are 0. An empty table gives no rows. Other columns are not looked at.
    Reruns agree.
    """
    rows = cut(sized(docs, id_col, source_col, text_col).withColumn("row", F.monotonically_increasing_id()))
    shares = cut(targets(rows, weights))
    slots = schedule(shares, block)
    whole = F.col("cut").isNull()
    used = slots.groupBy("si", "block").agg(F.count(F.when(whole, 1)).alias("whole"), F.min(F.when(whole, F.col("slot"))).alias("at"), F.coalesce(F.max("cut"), F.lit(0)).alias("cut"), F.min(F.when(~whole, F.col("slot"))).alias("cut_at"))
    laid = laid_out(rows, shares)
    parts = laid.withColumn("block", F.explode_outer(F.expr(f"if(size > 0, sequence(start div {block}, (start + size - 1) div {block}), null)")))
    parts = parts.join(used, ["si", "block"], "left")
    inside = F.expr(f"least(start + size, (block + 1) * {block}) - greatest(start, block * {block})")
    head = F.expr(f"greatest(0, least(start + size, block * {block} + cut) - greatest(start, block * {block}))")
    parts = parts.select("row", "id", "size", "source_size", "target", (inside * F.col("whole") + head).alias("w"), F.least("at", F.when(head > 0, F.col("cut_at"))).alias("at"), (F.col("whole") + (head > 0).cast("bigint")).alias("c"))
    out = parts.groupBy("row", F.col("id").alias(id_col), "size", "source_size", "target").agg(*(F.coalesce(F.sum(x), F.lit(0)).cast("bigint").alias(y) for x, y in (("w", "taken"), ("c", "n_slots"))), F.min("at").alias("first_slot"))
    return out.select(id_col, "size", "source_size", "target", "taken", "first_slot", "n_slots")
