"""Approximate nearest neighbours: NN-descent and greedy graph search (operator 2).

Equal vectors are one node. Largest inner product is turned into nearness by one more coordinate, which gives all vectors
one length about the table's middle. A node's first neighbours come from sorting nodes by the signs of random
projections. Each round then joins every node's neighbours, both ways, with their vectors, compares those pairs of which
one is new there, and offers each the nearer ones, until few neighbours change. Queries walk the graph from their own
node, from the longest nodes and from some others: in each step the best nodes not yet looked at are joined with their
neighbours, both ways, until the best ones have all been looked at.

Codes of 16 bits lead the search; scores are exact, in double precision, on the vectors themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrow import small_batches
from .common import cut, spread
from .vectors import finite

#: Neighbours of a node, and of those that have it as neighbour how many are looked at; orders that start the graph.
NEIGHBOURS, REVERSE, ORDERS, RUN = 32, 24, 4, 128
#: Rounds at most, and the part of all neighbours that must change for one more; offers of a group to a member.
ROUNDS, CHANGED, OFFERS = 12, 0.002, 16
#: Best nodes a walk keeps (at least 4 k), looks at in a step, and steps at most; longest, and other, nodes that all walks know.
BEAM, LOOKS, STEPS, STARTS = 192, 48, 60, 128
#: Nodes to a file of the graph at least, beyond a few files.
PART, FEW = 1000, 12
NEAR = "array<struct<d:double,w:bigint,fresh:boolean>>"


def _partials(nodes: DataFrame, work, schema: str) -> list:
    """What work makes of each partition's vectors: one row of each, so as many as there are partitions."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        got = [work(np.array(rows, float)) for batch in batches if (rows := batch.column(0).to_pylist())]
        if got:
            low, high = np.min([g[0] for g in got], axis=0), np.max([g[1] for g in got], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array([low.tolist()]), pa.array([high.tolist()])], ["low", "high"])

    small_batches(nodes)
    return nodes.select("v").mapInArrow(run, schema).collect()


class _Coder:
    """Vectors about the table's middle, scaled to at most 1, and lengthened to one length, as 16-bit codes."""

    def __init__(self, nodes: DataFrame):
        import numpy as np

        got = _partials(nodes, lambda x: (x.min(axis=0), x.max(axis=0)), "low array<double>, high array<double>")
        low, high = np.min([r["low"] for r in got], axis=0), np.max([r["high"] for r in got], axis=0)
        self.middle = low / 2 + high / 2
        self.span = max(float(np.max(high / 2 - low / 2)), 1e-300)
        middle, span = self.middle, self.span

        def squares(x):
            s = (((x - middle) / span) ** 2).sum(axis=1, keepdims=True)
            return s.min(axis=0), s.max(axis=0)

        got = _partials(nodes, squares, "low array<double>, high array<double>")
        self.most = max(r["high"][0] for r in got)
        self.scale = 32767 / max(1.0, (self.most - min(r["low"][0] for r in got)) ** 0.5)

    def codes(self, x):
        """16-bit codes of rows of vectors, and their squared lengths about the middle."""
        import numpy as np

        y = (x - self.middle) / self.span
        square = (y**2).sum(axis=1)
        y = np.hstack([y, np.sqrt(np.maximum(0, self.most - square))[:, None]])
        return np.rint(y * self.scale).clip(-32767, 32767).astype("<i2"), square


def _coded(nodes: DataFrame, coder: _Coder) -> DataFrame:
    """Rows (id, code, far, key0...): codes, squared lengths, and one sort key for each order."""

    def work(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            rows = batch.column(1).to_pylist()
            codes, far, keys = [], [], [[] for _ in range(ORDERS)]
            if rows:
                x, far = coder.codes(np.array(rows, float))
                codes = [c.tobytes() for c in x]
                rng = np.random.default_rng(11)
                y = x[:, :-1].astype(float)
                keys = [((y @ rng.standard_normal((y.shape[1], 20)) > 0) @ (1 << np.arange(19, -1, -1))).tolist() for _ in range(ORDERS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.binary()), pa.array(far, pa.float64()), *(pa.array(c, pa.int64()) for c in keys)], ["id", "code", "far", *(f"key{o}" for o in range(ORDERS))])

    small_batches(nodes)
    return nodes.select("id", "v").mapInArrow(work, "id bigint, code binary, far double, " + ", ".join(f"key{o} bigint" for o in range(ORDERS)))


def _apart(x):
    """Squared distances between rows of codes; whole numbers, so the same wherever they are computed. Infinite to itself."""
    import numpy as np

    x = x.astype(float)
    s = (x**2).sum(axis=1)
    d = s[:, None] + s[None, :] - 2 * (x @ x.T)
    np.fill_diagonal(d, np.inf)
    return d


def _nearest_of(d, most: int):
    """(i, j) of the finite entries among the least `most` of each row of d."""
    import numpy as np

    most = min(most, d.shape[1] - 1)
    top = np.argpartition(d, most - 1, axis=1)[:, :most] if most < d.shape[1] - 1 else np.argsort(d, axis=1)[:, :most]
    i, j = np.repeat(np.arange(len(d)), most), top.ravel()
    ok = np.isfinite(d[i, j])
    return i[ok], j[ok]


def _started(coded: DataFrame) -> DataFrame:
    """Edges (u, w, d) among runs of nodes that follow each other in one of the orders."""

    def work(batches):
        import numpy as np
        import pyarrow as pa

        ids, codes, out = [], [], []

        def run():
            x, i = np.frombuffer(b"".join(codes), "<i2").reshape(len(codes), -1), np.array(ids, np.int64)
            d = _apart(x)
            a, b = _nearest_of(d, NEIGHBOURS // 2)
            out.append((i[a], i[b], d[a, b]))
            ids.clear()
            codes.clear()

        def handed():
            got = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in got], ["u", "w", "d"])

        for batch in batches:
            for i, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(i)
                codes.append(c)
                if len(ids) == RUN:
                    run()
            yield handed()
        if len(ids) > 1:
            run()
            yield handed()

    n = int(coded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = [coded.select("id", "code", F.col(f"key{o}").alias("key")).repartitionByRange(n, "key", "id").sortWithinPartitions("key", "id").select("id", "code").mapInArrow(work, "u bigint, w bigint, d double") for o in range(ORDERS)]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def _best(edges: DataFrame) -> DataFrame:
    """Rows (u, near): each node's nearest neighbours. Of a hub's many offers each task hands on the nearest only."""
    once = edges.groupBy("u", "w").agg(F.min("d").alias("d"), F.min("fresh").alias("fresh"))
    order = Window.partitionBy("u").orderBy("d", "w")
    top = once.withColumn("n", F.row_number().over(order)).where(F.col("n") <= NEIGHBOURS)
    return top.groupBy("u").agg(F.array_sort(F.collect_list(F.struct("d", "w", "fresh"))).cast(NEAR).alias("near"))


def _back(graph: DataFrame) -> DataFrame:
    """Rows (v, id, fresh): of the nodes that have v as neighbour, REVERSE by hash."""
    there = graph.select(F.col("u").alias("id"), F.explode("near").alias("e")).select(F.col("e.w").alias("v"), "id", "e.fresh")
    there = there.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy(F.xxhash64("id", "v"))))
    return there.where(F.col("n") <= REVERSE).drop("n")


def _offers(graph: DataFrame, coded: DataFrame) -> DataFrame:
    """Edges (u, w, d) between neighbours of a common node, at least one new there, that are nearer than u's farthest."""

    def work(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            lists, out = batch.column(0), []
            rows, ends = lists.flatten(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]) if len(lists) else [0]
            if len(rows):
                ids, worst, fresh = (rows.field(c).to_numpy(zero_copy_only=False) for c in (0, 2, 3))
                x = np.frombuffer(b"".join(rows.field(1).to_pylist()), "<i2").reshape(len(ids), -1)
                for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                    if b - a < 2 or not fresh[a:b].any():
                        continue
                    i, k = np.unique(ids[a:b], return_index=True)
                    k += a
                    new = np.isin(i, ids[a:b][fresh[a:b]])
                    if len(i) < 2:
                        continue
                    d = _apart(x[k])
                    d[(d >= worst[k][:, None]) | ~(new[:, None] | new[None, :])] = np.inf
                    p, q = _nearest_of(d, OFFERS)
                    out.append((i[p], i[q], d[p, q]))
            got = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in got], ["u", "w", "d"])

    worst = F.when(F.size("near") < NEIGHBOURS, float("inf")).otherwise(F.element_at("near", -1)["d"])
    held = graph.select(F.col("u").alias("id"), worst.alias("worst")).join(coded.select("id", "code"), "id")
    there = graph.select(F.col("u").alias("v"), F.explode("near").alias("e")).select("v", F.col("e.w").alias("id"), "e.fresh")
    both = there.union(_back(graph).select("v", "id", "fresh")).join(held, "id")
    groups = both.groupBy("v").agg(F.collect_list(F.struct("id", "code", "worst", "fresh")).alias("g")).select("g")
    return groups.mapInArrow(work, "u bigint, w bigint, d double")


def _descended(coded: DataFrame, parts: int) -> DataFrame:
    """Rows (u, near) after rounds of NN-descent."""
    graph = cut(_best(_started(coded).withColumn("fresh", F.lit(True))), parts)
    every = graph.agg(F.sum(F.size("near"))).first()[0] or 0
    for _ in range(ROUNDS):
        known = graph.select("u", F.explode("near").alias("e")).select("u", "e.w", "e.d", F.lit(False).alias("fresh"))
        graph = cut(_best(known.union(_offers(graph, coded).withColumn("fresh", F.lit(True)))), parts)
        if (graph.agg(F.sum(F.size(F.filter("near", lambda e: e["fresh"])))).first()[0] or 0) <= CHANGED * every:
            break
    return graph


def _searched(queries: DataFrame, graph: DataFrame, coded: DataFrame, beam: int, parts: int) -> DataFrame:
    """Rows (q, node): the best nodes at the end of each query's walk. queries: (q, v), q the node to start at."""
    starts = coded.orderBy(F.desc("far"), "id").limit(STARTS).union(coded.orderBy(F.xxhash64("id"), "id").limit(STARTS)).select("id", "code").distinct().collect()
    start_ids, start_codes = [r["id"] for r in starts], [bytes(r["code"]) for r in starts]

    def merged(batches):
        """(q, qv, beam, new): the beam with new nodes in it; what was looked at last is seen."""
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            n = batch.num_rows
            lists = [batch.column(c).to_pylist() for c in (2, 3)]
            qs, out = [np.frombuffer(x, np.float64) for x in batch.column(1).to_pylist()], []
            for q, old, new in zip(qs, *lists, strict=True):
                looked = {x["w"] for x in [x for x in old if not x["seen"]][:LOOKS]}
                rows = [(x["s"], x["w"], x["seen"] or x["w"] in looked) for x in old]
                if new:
                    x = np.frombuffer(b"".join(r["code"] for r in new), "<i2").reshape(len(new), -1)[:, :-1]
                    rows += [(float(s), r["w"], False) for s, r in zip(x @ q, new, strict=True)]
                out.append([{"s": s, "w": w, "seen": seen} for s, w, seen in sorted(rows, key=lambda r: (-r[0], r[1]))[:beam]])
            kind = pa.list_(pa.struct([("s", pa.float64()), ("w", pa.int64()), ("seen", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, kind)] if n else [batch.column(0), batch.column(1), pa.array([], kind)], ["q", "qv", "beam"])

    def started(batches):
        import numpy as np
        import pyarrow as pa

        known = np.frombuffer(b"".join(start_codes), "<i2").reshape(len(start_codes), -1)[:, :-1].astype(float)
        for batch in batches:
            qs, beams = [], []
            for q, v, code in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                v = np.array(v, float)
                v = v / (np.abs(v).max() or 1)
                found = dict(zip(start_ids, (known @ v).tolist(), strict=True))
                found[q] = float(np.frombuffer(code, "<i2")[:-1].astype(float) @ v)
                qs.append(v.tobytes())
                beams.append([{"s": s, "w": w, "seen": False} for w, s in sorted(found.items(), key=lambda x: (-x[1], x[0]))[:beam]])
                if q not in (x["w"] for x in beams[-1]):
                    beams[-1][-1] = {"s": found[q], "w": q, "seen": False}
            kind = pa.list_(pa.struct([("s", pa.float64()), ("w", pa.int64()), ("seen", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(qs, pa.binary()), pa.array(beams, kind)], ["q", "qv", "beam"])

    schema = "q bigint, qv binary, beam array<struct<s:double,w:bigint,seen:boolean>>"
    back = _back(graph).groupBy(F.col("v").alias("u")).agg(F.collect_list("id").alias("back"))
    none = F.array().cast("array<bigint>")
    adjacent = cut(graph.join(back, "u", "left").select("u", F.array_union(F.col("near.w"), F.coalesce("back", none)).alias("to")), parts)
    codes = coded.select(F.col("id").alias("w"), "code")
    walks = cut(spread(queries.join(coded.select(F.col("id").alias("q"), "code"), "q").select("q", "v", "code"), "q").mapInArrow(started, schema), parts)
    for _ in range(STEPS):
        unseen = F.filter("beam", lambda x: ~x["seen"])
        open_ = walks.where(F.size(unseen) > 0)
        fresh = open_.select("q", F.explode(F.slice(unseen, 1, LOOKS)).alias("x")).select("q", F.col("x.w").alias("u"))
        reach = fresh.join(adjacent, "u").groupBy("q").agg(F.array_distinct(F.flatten(F.collect_list("to"))).alias("to"))
        new = reach.join(walks.select("q", F.col("beam.w").alias("known")), "q").select("q", F.explode(F.array_except("to", "known")).alias("w"))
        new = new.join(codes, "w").groupBy("q").agg(F.collect_list(F.struct("w", "code")).alias("new"))
        walks = cut(walks.join(new, "q", "left").select("q", "qv", "beam", "new").mapInArrow(merged, schema), parts)
        if walks.where(F.size(unseen) > 0).isEmpty():
            break
    return walks.select("q", F.explode("beam").alias("x")).select("q", F.col("x.w").alias("node"))


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): of each row whose id every divides, the k largest inner products found.

    Ties go to the smaller id; scores are exact. Null and zero vectors, null ids, and vectors with null or non-finite
    components take no part; vectors need one length. Rows that repeat id and vector count once; of an id's several vectors
    the best product counts, as query and as candidate; none meets its own id. An empty table gives no rows. A node keeps as
    many ids as an answer can hold, the smallest. Recall against brute force is measured in the tests and the README, not
    promised.
    """
    rows = finite(vectors, id_col, vector_col).where(F.exists("v", lambda x: x != 0)).withColumn("h", F.xxhash64("v"))
    rows = cut(rows.dropDuplicates(["id", "h", "v"]).withColumn("row", F.monotonically_increasing_id()))
    parts = rows.count() // PART + FEW
    if parts == FEW and rows.isEmpty():
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    members = rows.withColumn("n", F.row_number().over(Window.partitionBy("h", "v").orderBy("id"))).where(F.col("n") <= k + 1)
    members = cut(members.withColumn("node", F.min("row").over(Window.partitionBy("h", "v"))), parts)
    nodes = members.where("n = 1").select(F.col("node").alias("id"), "v", "h")
    coded = cut(spread(_coded(nodes, _Coder(nodes)), "id"), parts)
    graph = _descended(coded, parts)
    asked = rows.where(F.col("id") % every == 0).select(F.col("id").alias("query_id"), "v", "h")
    asked = cut(asked.join(nodes.select(F.col("id").alias("q"), F.col("v").alias("nv"), "h"), "h").where("v = nv").select("query_id", "q"), parts)
    qv = nodes.select(F.col("id").alias("q"), F.col("v").alias("qv"))
    beam = max(BEAM, 4 * k)
    walked = _searched(asked.select("q").distinct().join(qv.withColumnRenamed("qv", "v"), "q"), graph, coded, beam, parts)
    pairs = walked.join(nodes.select(F.col("id").alias("node"), "v"), "node").join(qv, "q")
    product = F.aggregate(F.zip_with("qv", "v", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    scores = pairs.select("q", "node", product.alias("score"))
    found = asked.join(scores, "q").join(members.select("node", F.col("id").alias("vec_id")), "node").where("vec_id <> query_id")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return found.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
