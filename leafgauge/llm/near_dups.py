"""MinHash near-duplicates by an LSH forest (operator 7).

Every text's word-shingle set gets one long MinHash signature. Each tree of the forest sorts the texts by
signature values of its own, read in order; its regions are the texts whose first two values agree, so that a
pair at the least similarity shares a region in some tree but for about one in 10^5.

Texts with equal sets are one node from the start. A first pass walks each tree's sorted order: a node's
candidates are the neighbours that share the longest prefix with it, so the walk is linear however large a region
is; the better ones are confirmed on full sets and joined. The second pass takes the regions that still hold
several components, and weighs all pairs of different components there by their 4-bit sketches; what may reach the
similarity is confirmed. Where such a region is too large it is dealt out several times, each time by further
values of its own, so that the pairs one deal parts meet in another. Rows of a region's commonest component meet
only the others. So no group of copies is ever expanded into its pairs: where both of a pair have many neighbours
left, their sets are sent to the region and confirmed there, and only links that join components leave it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import small_batches
from .common import cut, spread
from .components import components

#: Signature values; trees and the values each reads; prefix lengths a region may have.
VALUES, TREES, READS, DEPTHS = 256, 12, 20, (2, 5, 10)
#: Neighbours to each side in a tree's sorted order that the first pass weighs, and rows of the order held at once.
WALK, HELD = 32, 4096
#: Rows of a region compared in one block, and blocks from which a region is read to a longer prefix.
BLOCK, BLOCKS = 2048, 16
#: Times a region read to a longer prefix is dealt out; a pair at 0.8 is then missed less than once in 10^4 at any depth.
SPLITS = 5
#: An estimated similarity lies below the true one by this much about once in 10^4 pairs.
MARGIN = 0.1
#: Documents to a file of what is kept between steps at least, beyond a few files.
PART, FEW = 20_000, 12
#: Neighbours in other components up to which a node's pairs leave their region unconfirmed.
PARTNERS = 16


def signatures(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, n, h1, h2, sketch, keys): set size, set hash, 4-bit sketch, region keys by tree."""

    def work(batches):
        import numpy as np
        import pyarrow as pa

        from .shingles import shingle_sets

        rng = np.random.default_rng(7)
        a = (rng.integers(0, 1 << 31, VALUES, dtype=np.uint64) * 2 + 1).astype(np.uint32)[:, None]
        b = rng.integers(0, 1 << 32, VALUES, dtype=np.uint64).astype(np.uint32)[:, None]
        for batch in batches:
            rows = {x: [] for x in ("n", "h1", "h2", "sketch", "keys")}
            texts = [(t or b"").lower() for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for s in shingle_sets(texts, k):
                rows["n"].append(len(s))
                h = int(np.bitwise_xor.reduce(s)) if len(s) else 0
                rows["h1"].append(h - (1 << 64) if h >> 63 else h)
                h = int((s * (s >> np.uint64(32) | np.uint64(1))).sum(dtype=np.uint64)) if len(s) else 0
                rows["h2"].append(h - (1 << 64) if h >> 63 else h)
                x = (s >> np.uint64(32)).astype(np.uint32)
                sig = np.full(VALUES, 0xFFFFFFFF, np.uint32)
                for i in range(0, len(x), 2048):
                    np.minimum(sig, (x[None, i : i + 2048] * a + b).min(axis=1), out=sig)
                four = (sig ^ (sig >> np.uint32(11)) ^ (sig >> np.uint32(19))).astype(np.uint8) & 15
                rows["sketch"].append((four[::2] << 4 | four[1::2]).tobytes())
                keys = np.full(TREES, 1, np.uint64)
                of_tree = sig[: TREES * READS].reshape(TREES, READS).astype(np.uint64)
                for d in range(DEPTHS[0]):
                    keys = (keys ^ of_tree[:, d]) * np.uint64(0x9E3779B97F4A7C15)
                    keys ^= keys >> np.uint64(32)
                rows["keys"].append(keys.view(np.int64).tolist())
            kinds = {"n": pa.int64(), "h1": pa.int64(), "h2": pa.int64(), "sketch": pa.binary(), "keys": pa.list_(pa.int64())}
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, kinds[c]) for c, v in rows.items())], ["id", *rows])

    small_batches(docs)
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("t")).mapInArrow(work, "id bigint, n bigint, h1 bigint, h2 bigint, sketch binary, keys array<bigint>")


def _reads() -> list[list[list[int]]]:
    """By depth and path (the tree, then the deals that led there) the signature values read: those read least so far, none twice on a path."""
    import numpy as np

    rng, used = np.random.default_rng(13), np.zeros(VALUES)
    out = [[list(range(t * READS, t * READS + DEPTHS[0])) for t in range(TREES)]]
    used[np.ravel(out[0])] += 1
    above = out[0]
    for d in range(1, len(DEPTHS)):
        level = []
        for path in range(TREES * SPLITS**d):
            order = np.lexsort((rng.random(VALUES), used))
            level.append([int(v) for v in order if int(v) not in above[path // SPLITS]][: DEPTHS[d] - DEPTHS[d - 1]])
            used[level[-1]] += 1
        above = [above[path // SPLITS] + x for path, x in enumerate(level)]
        out.append(level)
    return out


def _keyed(nodes: DataFrame, several: str) -> DataFrame:
    """Rows (tree, region, count, id) of the nodes in regions that have several distinct values of a column."""
    keys = nodes.select("id", several if several != "id" else F.col("id").alias("_"), F.posexplode("keys").alias("tree", "region"))
    of = "_" if several == "id" else several
    per = keys.groupBy("tree", "region").agg(F.count("*").alias("count"), F.min(of).alias("lo"), F.max(of).alias("hi")).where("lo < hi").select("tree", "region", "count")
    return keys.select("tree", "region", "id").join(per.hint("merge"), ["tree", "region"]).select("tree", "region", "count", "id")


def _regions(nodes: DataFrame, parts: int | None = None) -> tuple[DataFrame, bool]:
    """Rows (tree, region, bi, bj, b, id, n, comp, sketch) of nodes dealt to the regions that hold several components; whether
    any has a longer prefix.

    A region of more than BLOCK rows is cut into blocks, its commonest component apart, and each pair of blocks that may
    hold links meets once; one of more than BLOCKS blocks is dealt out SPLITS times by longer prefixes first, as far as
    DEPTHS goes, if that leaves fewer pairs.
    """
    light = cut(_keyed(nodes, "comp"), parts)
    rows = light.drop("count").join(nodes.drop("keys").hint("merge"), "id").withColumn("nb", F.lit(1)).withColumn("deep", F.lit(True)).withColumn("path", F.col("tree"))
    deeper, reads = False, _reads()
    for d in range(len(DEPTHS)):
        sizes = rows.where("deep").groupBy("tree", "region").count() if d else light.select("tree", "region", "count").distinct()
        large = cut(sizes.where(F.col("count") > BLOCK), parts)
        if large.isEmpty():
            break
        larger = large.where(F.col("count") > BLOCK * BLOCKS) if d + 1 < len(DEPTHS) else large.limit(0)
        split = None
        if not larger.isEmpty():
            # Equal values have equal 4-bit values, so reading those parts no pair that the values would not.
            table = ", ".join(f"array({', '.join(str(v + 1) for v in x)})" for x in reads[d + 1])
            paths = F.expr(f"transform(sequence(0, {SPLITS - 1}), c -> path * {SPLITS} + c)")
            key = F.expr(f"xxhash64(region, next, transform(element_at(array({table}), next + 1), v -> substring(hex(sketch), v, 1)))")
            below = rows.where("deep").join(larger.select("tree", "region"), ["tree", "region"], "left_semi").withColumn("next", F.explode(paths)).select("tree", "region", key.alias("below"))
            square = F.col("count").cast("double") * F.col("count")
            cost = below.groupBy("tree", "region", "below").count().groupBy("tree", "region").agg(F.sum(square).alias("cost"))
            split = cut(larger.join(cost, ["tree", "region"]).where(F.col("cost") < square).select("tree", "region", F.lit(True).alias("deep2")), parts)
        large = large.select("tree", "region", F.ceil(F.col("count") / BLOCK).cast("int").alias("nb2"))
        large = large.join(split, ["tree", "region"], "left") if split is not None else large.withColumn("deep2", F.lit(False))
        rows = rows.join(large, ["tree", "region"], "left").withColumn("deep", F.col("deep") & F.coalesce("deep2", F.lit(False)))
        rows = rows.withColumn("nb", F.when(F.col("deep"), 1).otherwise(F.coalesce("nb2", "nb"))).drop("nb2", "deep2")
        if split is None or split.isEmpty():
            break
        deeper = True
        rows = rows.withColumn("next", F.explode(F.when(F.col("deep"), paths).otherwise(F.array("path"))))
        rows = rows.withColumn("region", F.when(F.col("deep"), key).otherwise(F.col("region"))).withColumn("path", F.col("next")).drop("next")
    # Blocks of the commonest component first; they meet no block of their own kind.
    per = rows.where("nb > 1").groupBy("tree", "region", "comp").count().groupBy("tree", "region")
    per = per.agg(F.max_by("comp", F.struct("count", "comp")).alias("most"), F.max("count").alias("x"), F.sum("count").alias("all"))
    per = per.select("tree", "region", "most", F.expr(f"ceil(x / {BLOCK})").cast("int").alias("nx"), F.expr(f"ceil((all - x) / {BLOCK})").cast("int").alias("no"))
    rows = rows.join(per, ["tree", "region"], "left")
    hashed = F.xxhash64("id", "tree")
    first = F.expr("comp <=> most")
    block = F.when(F.col("nx").isNull(), 0).when(first, F.expr("cast(pmod(xxhash64(id, tree), nx) as int)")).otherwise(F.col("nx") + F.pmod(hashed, F.greatest("no", F.lit(1))).cast("int"))
    others = F.when(F.col("nx").isNull(), F.array(F.lit(0))).when(F.col("no") == 0, F.array().cast("array<int>")).when(first, F.expr("sequence(nx, nx + greatest(no, 1) - 1)")).otherwise(F.expr("sequence(0, nx + greatest(no, 1) - 1)"))
    rows = rows.withColumn("b", block).withColumn("o", F.explode(others))
    rows = rows.select("tree", "region", F.least("b", "o").alias("bi"), F.greatest("b", "o").alias("bj"), "b", "id", "n", "comp", "sketch", *(c for c in nodes.columns if c == "base"))
    return rows, deeper


REGION = ("tree", "region", "bi", "bj")


def _by_region(rows: DataFrame, region, schema: str) -> DataFrame:
    """Run region(key, rows) over the rows of every region; rows are tuples in the frame's order after its key."""

    def work(batches):
        import pyarrow as pa

        key, held, out = None, [], []

        def handed():
            columns = list(zip(*out, strict=True)) or [()] * len(kinds)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], kinds)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(batch.num_columns)), strict=True):
                if row[:4] != key:
                    if len(held) > 1:
                        out += region(key, held)
                    key, held = row[:4], []
                    if len(out) > 10_000:
                        yield handed()
                held.append(row[4:])
        if len(held) > 1:
            out += region(key, held)
        yield handed()

    kinds = [x.split()[0] for x in schema.split(", ")]
    return spread(rows, *REGION).sortWithinPartitions(*REGION).mapInArrow(work, schema)


class _Region:
    """The distinct rows (b, id, n, comp, sketch, *more) of a region as arrays."""

    def __init__(self, key, rows, percent):
        import numpy as np

        self.key, self.percent = key, percent
        self.rows = sorted({r[1]: r for r in rows}.values(), key=lambda r: r[1])
        self.ids = [r[1] for r in self.rows]
        self.block, self.n, self.comp = (np.array([r[c] for r in self.rows], np.int64) for c in (0, 2, 3))
        self.sketch = np.frombuffer(b"".join(r[4] for r in self.rows), np.uint8).reshape(len(self.rows), -1)
        self.same = np.array([(x >> 4 == 0) + (x & 15 == 0) for x in range(256)], np.uint8)
        self.least = VALUES * (1 / 16 + 15 / 16 * (percent / 100 - MARGIN))

    def before(self, i: int, base):
        """Rows before i in other components that may be near it; base: skip what an earlier tree compares."""
        import numpy as np

        may = 100 * np.minimum(self.n[:i], self.n[i]) >= self.percent * np.maximum(self.n[:i], self.n[i])
        if self.key[2] != self.key[3]:
            may &= self.block[:i] != self.block[i]
        may &= self.comp[:i] != self.comp[i]
        js = np.flatnonzero(may)
        if len(js) and self.key[0]:
            js = js[~(base[js, : self.key[0]] == base[i, : self.key[0]]).any(axis=1)]
        score = self.same[self.sketch[js] ^ self.sketch[i]].sum(axis=1) if len(js) else js
        return js[score >= self.least]


def _walked(nodes: DataFrame, percent: int) -> DataFrame:
    """Rows (a, b): each node's best neighbour in a tree's sorted order, a < b; (a, a) for what may have further neighbours."""

    def work(batches):
        import numpy as np
        import pyarrow as pa

        same = np.array([(x >> 4 == 0) + (x & 15 == 0) for x in range(256)], np.uint8)
        least = VALUES * (1 / 16 + 15 / 16 * (percent / 100 - MARGIN))

        def weighed(rows, new, whole):
            """Pairs of what is held of one region's order, the first `new` rows having been weighed before."""
            ids, n = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
            sketch = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(len(rows), -1)
            best, partner = np.zeros(len(rows), np.int64), np.arange(len(rows))
            for o in range(1, min(WALK, len(rows) - 1) + 1):
                lo = max(0, new - o)
                x, y = np.arange(lo, len(rows) - o), np.arange(lo + o, len(rows))
                ok = (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])) & (ids[x] != ids[y])
                x, y = x[ok], y[ok]
                score = same[sketch[x] ^ sketch[y]].sum(axis=1)
                for i, j in ((x, y), (y, x)):
                    up = (score >= least) & (score > best[i])
                    best[i[up]], partner[i[up]] = score[up], j[up]
            has = np.flatnonzero(best)
            a, b = ids[has], ids[partner[has]]
            alone = ids[has] if whole else ids
            return [np.minimum(a, b), alone], [np.maximum(a, b), alone]

        left, right, size, key, rows, new = [], [], 0, None, [], 0

        def handed():
            a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (left, right))
            pairs = np.unique(np.stack([a, b], axis=1), axis=0)
            left.clear()
            right.clear()
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        def done():
            nonlocal size
            if len(rows) > new and len(rows) > 1:
                a, b = weighed(rows, new, rows[0][3] <= WALK + 1)
                left.extend(a)
                right.extend(b)
                size += len(rows)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(6)), strict=True):
                if row[:2] != key:
                    done()
                    key, rows, new = row[:2], [], 0
                elif len(rows) >= HELD:
                    done()
                    rows, new = rows[-WALK:], WALK
                rows.append(row[2:])
            if size > 100_000:
                yield handed()
                size = 0
        done()
        yield handed()

    rows = _keyed(nodes, "id").join(nodes.select("id", "n", "sketch").hint("merge"), "id")
    # A tree's values stand side by side in the sketch, two to a byte: read in order they sort its texts.
    order = F.expr(f"substring(sketch, {READS // 2} * tree + 1, {READS // 2})")
    depth = F.expr(f"if(count > {BLOCK}, cast(ceil(log2(count / {BLOCK}) / 2) as int), 0)")
    rows = rows.select("tree", "region", "count", order.alias("order"), depth.alias("depth"), "id", "n", "sketch")
    rows = rows.withColumn("deal", F.xxhash64(F.expr("substring(order, 2, depth)"))).select("tree", "region", "order", "deal", "id", "n", "sketch", "count")
    rows = spread(rows, "tree", "region", "deal").sortWithinPartitions("tree", "region", "order", "id").select("tree", "region", "id", "n", "sketch", "count")
    return rows.mapInArrow(work, "a bigint, b bigint").distinct()


def _across(regions: DataFrame, percent: int) -> DataFrame:
    """Neighbours in different components: rows (a, b), or (id, null, region) for those with many, to be confirmed there."""

    def region(key, rows):
        import numpy as np

        r = _Region(key, rows, percent)
        if (r.comp == r.comp[0]).all():
            return
        base = np.array([x[5] for x in r.rows], np.int64) if r.rows[0][5] is not None else np.empty((len(r.ids), 0), np.int64)
        near = [(i, r.before(i, base)) for i in range(1, len(r.ids))]
        count = np.zeros(len(r.ids), np.int64)
        for i, js in near:
            count[js] += 1
            count[i] += len(js)
        many = count > PARTNERS
        for i, js in near:
            for j in js[~(many[js] & many[i])].tolist():
                yield r.ids[j], r.ids[i], None, None, None, None, None
        for i in np.flatnonzero(many).tolist():
            yield r.ids[i], None, *key, int(r.block[i])

    return _by_region(regions, region, "a bigint, b bigint, tree bigint, region bigint, bi bigint, bj bigint, block bigint")


def _joined_there(rows: DataFrame, k: int, percent: int) -> DataFrame:
    """Confirmed links (a, b) within regions whose rows carry their texts: those that join two components, no others."""

    def region(key, rows):
        import numpy as np

        from .shingles import enough, shingle_set, unpack

        r = _Region(key, rows, percent)
        base = np.array([x[5] for x in r.rows], np.int64) if r.rows[0][5] is not None else np.empty((len(r.ids), 0), np.int64)
        sets = [shingle_set(unpack(x[6]), k) for x in r.rows]
        top = {c: c for c in r.comp.tolist()}

        def of(c):
            while top[c] != c:
                top[c] = c = top[top[c]]
            return c

        for i in range(1, len(r.ids)):
            for j in r.before(i, base).tolist():
                x, y = of(int(r.comp[i])), of(int(r.comp[j]))
                if x != y and enough(sets[i], sets[j], percent):
                    top[max(x, y)] = min(x, y)
                    yield r.ids[j], r.ids[i]

    return _by_region(rows, region, "a bigint, b bigint").distinct()


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""

    def work(batches):
        import numpy as np
        import pyarrow as pa

        from .shingles import enough, shingle_set, unpack

        known: dict = {}

        def of(i, z):
            if i not in known:
                if len(known) > 300:
                    known.clear()
                known[i] = shingle_set(unpack(z), k)
            return known[i]

        for batch in batches:
            a, b, za, zb = (batch.column(c).to_pylist() for c in range(4))
            keep = np.array([enough(of(i, x), of(j, y), percent) for i, j, x, y in zip(a, b, za, zb, strict=True)], bool)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))

    right = texts.select(F.col("id").alias("b"), F.col("z").alias("zb"))
    left = texts.select(F.col("id").alias("a"), F.col("z").alias("za"))
    joined = pairs.join(right.hint("merge"), "b").join(left.hint("merge"), "a").select("a", "b", "za", "zb")
    return joined.mapInArrow(work, "a bigint, b bigint").distinct()


def _packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, z): the compressed lower-case text."""

    def work(batches):
        import pyarrow as pa

        from .shingles import pack

        for batch in batches:
            z = [pack((t or "").encode("utf-8", "surrogatepass").lower()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(z, pa.binary())], ["id", "z"])

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("t")).mapInArrow(work, "id bigint, z binary")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id_col, n_shingles, component_id, kept), one for each row of docs.

    Two documents are linked if 100 * |A and B| >= percent * |A or B| of their sets of k-word shingles (words parted
    by ASCII white space, A-Z lower-cased; a shorter text is one shingle). component_id is the smallest id reachable,
    kept says that it is the row's own. Null, empty and blank texts have no shingles and no links: they stay. Rows with
    equal ids count as one document. A null id has component null and stays. An empty table gives no rows. Other
    columns are not looked at.
    """
    sets = cut(signatures(docs, k, id_col, text_col))
    parts = sets.count() // PART + FEW
    full = sets.where("n > 0 and id is not null")
    least = full.groupBy("h1", "h2").agg(F.min("id").alias("rep"))
    of_doc = cut(full.select("id", "n", "h1", "h2").join(least.hint("merge"), ["h1", "h2"]).select("id", "n", "rep"), parts)
    nodes = full.join(least.select(F.col("rep").alias("id"), "h1", "h2").hint("merge"), ["id", "h1", "h2"], "left_semi").select("id", "n", "sketch", "keys")
    nodes = cut(nodes.withColumn("comp", F.col("id")), parts)

    found = cut(_walked(nodes, percent), parts)
    near = found.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = cut(_packed(docs, id_col, text_col).join(near.hint("merge"), "id", "left_semi").dropDuplicates(["id"]), 10 * parts)
    pairs = found.where("a < b")
    links = cut(_confirmed(pairs, texts, k, percent), parts)
    first = components(links).withColumnRenamed("node", "id")
    again = nodes.drop("comp").join(near.hint("merge"), "id", "left_semi").join(first.hint("merge"), "id", "left")
    again = cut(again.withColumn("comp", F.coalesce("component", "id")).drop("component"), parts)
    # Two nodes of equal base keys have met in that tree, unless it was read to longer prefixes there.
    rows, deep = _regions(again.withColumn("base", F.slice("keys", 1, TREES)), parts)
    across = cut(_across(rows.withColumn("base", F.lit(None).cast("array<bigint>")) if deep else rows, percent))
    more = across.where("b is not null").select("a", "b").distinct().join(pairs.hint("merge"), ["a", "b"], "left_anti")
    many = across.where("b is null").select(F.col("a").alias("id"), *REGION, F.col("block").alias("b"))
    base = F.lit(None).cast("array<bigint>") if deep else F.slice("keys", 1, TREES)
    many = many.join(again.select("id", "n", "comp", "sketch", base.alias("base")).hint("merge"), "id").join(texts.hint("merge"), "id").select(*REGION, "b", "id", "n", "comp", "sketch", "base", "z")
    links = links.union(cut(_confirmed(more, texts, k, percent).union(_joined_there(many, k, percent)), parts))
    # Rows of one id that have different texts hang together.
    several = of_doc.groupBy("id").agg(F.min("rep").alias("m"), F.max("rep").alias("x")).where("m < x")
    same = of_doc.join(several, "id").select(F.col("rep").alias("a"), F.col("m").alias("b"))
    whole = components(links.union(same)).withColumnRenamed("node", "rep")
    linked = of_doc.join(whole.hint("merge"), "rep", "left").select("id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
    rest = sets.where("n = 0 or id is null").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    out = linked.union(rest)
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
