"""Exact top-k inner products by norm buckets (operator 5).

Vectors lie in buckets by length, longest first. What the longest bucket gives a query bounds its k-th score from
below; divided by the query's length and a bucket's longest it is the bucket's local cosine threshold. Above 1
the bucket is skipped: a block of queries is sent only the buckets that reach the threshold of one of them. A high
threshold is used on coordinates: only vectors whose coordinates, where the query's is largest, may have that cosine are
verified; a low one on lengths. Survivors get their exact product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrow import small_batches
from .common import cut, spread
from .vectors import finite

#: Vectors of a bucket, and queries of a block; the local threshold from which coordinates are tested, and how many of them.
BUCKET, QUERIES, COORDINATES_FROM, COORDINATES = 4096, 2048, 0.6, 3
#: Whole numbers beyond these, of components and of scores, count as these.
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def _packed(rows: DataFrame, size: int, scale: float) -> DataFrame:
    """Rows (at, longest, ids, x, kind): runs of vectors in order of length, longest first; whole numbers as binary of a kind."""

    def work(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, ids, xs, k = TaskContext.get().partitionId(), [], [], 0

        def packed():
            nonlocal k
            with np.errstate(over="ignore"):
                i, x = np.array(ids, np.int64), np.floor(np.array(xs, float).reshape(len(ids), -1) * scale).clip(LOW, HIGH)
            most = np.abs(x).max(initial=0)
            kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"
            row = [part << 32 | k, float(np.sqrt((x**2).sum(axis=1).max())), i.tobytes(), x.astype(kind).tobytes(), kind]
            k += 1
            ids.clear()
            xs.clear()
            kinds = [pa.int64(), pa.float64(), pa.binary(), pa.binary(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, kinds, strict=True)], ["at", "longest", "ids", "x", "kind"])

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(i)
                xs.append(v)
                if len(ids) == size:
                    yield packed()
        if ids:
            yield packed()

    small_batches(rows)
    rows = rows.withColumn("length", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, F.desc("length"), "id").sortWithinPartitions(F.desc("length"), "id").select("id", "v")
    return dealt.mapInArrow(work, "at bigint, longest double, ids binary, x binary, kind string")


def _integers(x):
    """Whole numbers of any size, for products beyond 2^53."""
    import numpy as np

    return np.array([int(v) for v in x.ravel()], object).reshape(x.shape)


def _products(pairs: DataFrame, k: int, only_bound: bool) -> DataFrame:
    """pairs (qids, q, qkind, bounds, ids, x, kind): rows (query_id, vec_id, score) that reach the bound, k at most for each
    query and bucket; only_bound: rows (qids, bounds, reach), each query's k-th score in the bucket, -inf where it has fewer,
    and the length that a vector needs to reach the bound of any of them."""

    def work(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for qb, q, qkind, bounds, ib, x, kind in zip(*(batch.column(c).to_pylist() for c in range(7)), strict=True):
                qids, ids = np.frombuffer(qb, np.int64), np.frombuffer(ib, np.int64)
                q, x = np.frombuffer(q, qkind).reshape(len(qids), -1), np.frombuffer(x, kind).reshape(len(ids), -1)
                qf, xf = q.astype(float), x.astype(float)
                exact = q.shape[1] * np.abs(qf).max(initial=0) * np.abs(xf).max(initial=0) < 2**53
                qs, xs = (qf, xf) if exact else (_integers(q), _integers(x))
                length, qlength = np.sqrt((xf**2).sum(axis=1)), np.sqrt((qf**2).sum(axis=1))
                longest = length.max(initial=0)
                bound = np.frombuffer(bounds, float) if bounds else np.full(len(qids), -np.inf)
                out_q, out_i, out_s, kth = [], [], [], np.full(len(qids), -np.inf)
                piece, at = None, 0
                for r in range(len(qids)):
                    need, most = bound[r], qlength[r] * length
                    top = qlength[r] * longest
                    local = need / top if top > 0 else (-np.inf if need <= 0 else np.inf)
                    if local > 1 + 1e-9:
                        continue
                    if local >= COORDINATES_FROM:
                        # A vector within an angle of q is within it of q's own angle to each axis.
                        unit = qf[r] / qlength[r]
                        angle = np.arccos(np.clip(need / np.maximum(most, 1e-300), -1, 1)) + 1e-6
                        ok = most >= need * (1 - 1e-12) - 1e-9
                        for f in np.argsort(-np.abs(unit))[:COORDINATES]:
                            u = np.clip(xf[:, f] / np.maximum(length, 1e-300), -1, 1)
                            ok &= np.abs(np.arccos(u) - np.arccos(np.clip(unit[f], -1, 1))) <= angle
                        c = np.flatnonzero(ok)
                        s = xs[c] @ qs[r]
                    else:
                        if piece is None or r >= at + 256:
                            piece, at = qs[r : r + 256] @ xs.T, r
                        c = np.flatnonzero(most >= need * (1 - 1e-12) - 1e-9) if need > 0 else np.arange(len(ids))
                        s = piece[r - at, c]
                    keep = (ids[c] != qids[r]) & (s >= need)
                    c, s = c[keep], s[keep]
                    if not exact:
                        s = np.array([max(LOW, min(HIGH, v)) for v in s], object)
                        order = np.array(sorted(range(len(c)), key=lambda j: (-s[j], ids[c][j]))[:k], int)
                    else:
                        if len(s) > 4 * k:  # ties of the k-th stay
                            some = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
                            c, s = c[some], s[some]
                        order = np.lexsort((ids[c], -s))[:k]
                    if only_bound:
                        if len(order) == k:
                            kth[r] = float(s[order[-1]]) if exact else np.nextafter(np.nextafter(float(s[order[-1]]), -np.inf), -np.inf)
                        continue
                    out_q += [qids[r]] * len(order)
                    out_i += ids[c[order]].tolist()
                    out_s += [int(v) for v in s[order]]
                if only_bound:
                    reach = np.where(kth > 0, kth / np.maximum(qlength, 1e-300), -np.inf).min(initial=np.inf)
                    yield pa.RecordBatch.from_arrays([pa.array([qb], pa.binary()), pa.array([kth.tobytes()], pa.binary()), pa.array([float(reach) * (1 - 1e-9)])], ["qids", "bounds", "reach"])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (out_q, out_i, out_s)], ["query_id", "vec_id", "score"])

    columns = ("qids", "q", "qkind", "bounds", "ids", "x", "kind")
    return pairs.select(*columns).mapInArrow(work, "qids binary, bounds binary, reach double" if only_bound else "query_id bigint, vec_id bigint, score bigint")


def top_products(vectors: DataFrame, k: int = 20, every: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): of each row whose id every divides, the k largest integer products with others.

    Components become floor(scale * x); components and scores beyond 64-bit whole numbers count as the largest or smallest
    one. Ties go to the smaller id; all candidates come if there are fewer than k. Null vectors and ids, and vectors with
    null or non-finite components, take no part; vectors need one length. Zero vectors do take part. Of repeated ids each row
    counts, but no row meets its own id. An empty table gives no rows. Other columns are not looked at.
    """
    rows = finite(vectors, id_col, vector_col)
    buckets = cut(_packed(rows, BUCKET, scale))
    order = cut(buckets.select("at", "longest").withColumn("b", F.row_number().over(Window.orderBy(F.desc("longest"), "at")) - 1))
    if order.isEmpty():
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    first = buckets.join(order.where("b = 0").select("at"), "at", "left_semi").select("ids", "x", "kind")
    blocks = cut(_packed(rows.where(F.col("id") % every == 0), QUERIES, scale).select(F.col("at").alias("qb"), F.col("ids").alias("qids"), F.col("x").alias("q"), F.col("kind").alias("qkind")))
    # One bucket, of at most BUCKET vectors, goes to all query blocks.
    bounds = _products(blocks.withColumn("bounds", F.lit(None).cast("binary")).withColumn("b", F.lit(0)).join(F.broadcast(first.withColumn("b", F.lit(0))), "b"), k, True)
    blocks = cut(blocks.join(bounds, "qids"))
    # How many buckets reach each block: one row for each block and bucket in one order.
    ends = blocks.select("qb", F.col("reach").alias("x")).union(order.select(F.lit(None).cast("bigint"), "longest"))
    longer = Window.orderBy(F.desc("x"), F.col("qb").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    ends = ends.withColumn("n", F.count(F.when(F.col("qb").isNull(), 1)).over(longer)).where("qb is not null and n > 0")
    pairs = ends.select("qb", F.explode(F.expr("sequence(0, cast(n as int) - 1)")).alias("b")).join(order.select("b", "at"), "b")
    pairs = spread(pairs.join(blocks, "qb").join(buckets.select("at", "ids", "x", "kind"), "at"), "qb", "b")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = _products(pairs, k, False).withColumn("rank", F.row_number().over(best))
    return found.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
