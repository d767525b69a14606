"""Substring dedup with automata of repeated phrases (operator 4).

1. Candidates: two equal windows of words hold equal shorter word runs, so also the same least run hash.
   Each text gives the least hashes of its windows (about every fifth run); those met in two texts recur.
2. Confirmation: windows whose least hash recurs are grouped by their own hash; the smallest id in which
   one starts owns it, and every other text that has it is to be read against the owner.
3. Automata: owners are dealt into shards of bounded length. A shard's task compiles one Aho-Corasick automaton of
   its owners' recurring passages and streams through it, whole, every text that is to be read against them.
   A shard that many texts need is compiled in several tasks, each of which gets a part of the texts.
4. The places found are removed from the texts.

Steps 1 and 2 only rule texts out and never lose an occurrence; what is removed is what automata find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import small_batches
from .common import cut, spread

#: Words of the runs whose least hash stands for a window.
RUN = 6
#: Words of owners per automaton, and characters streamed through one in a task.
SHARD_WORDS, STREAM_CHARS = 250_000, 24_000_000
#: Letters that spell a word in an automaton.
LETTERS = 3


class _Batch:
    """Word hashes of a batch of raw texts in one array, and for each window start inside a text its text's place."""

    def __init__(self, texts: list, window: int):
        import numpy as np

        from .shingles import hashed_words

        self.window = window
        self.words, sizes = hashed_words(texts)
        n = max(0, len(self.words) - window + 1)
        self.of = np.repeat(np.arange(len(texts)), sizes)[:n]
        last = np.repeat(np.cumsum(sizes), sizes)[:n]
        self.inside = np.arange(n) + window <= last

    def least(self):
        """Least hash of the runs in each window."""
        import numpy as np

        from .shingles import grams

        run = min(RUN, self.window)
        h, span, have = grams(self.words, run), self.window - run + 1, 1
        while have < span:  # minima of ever longer stretches
            step = min(have, span - have)
            h, have = np.minimum(h[: len(h) - step], h[step:]), have + step
        return h if len(self.inside) else np.empty(0, np.uint64)

    def hashes(self):
        from .shingles import grams

        return grams(self.words, self.window)


def _scan(texts: DataFrame, window: int) -> DataFrame:
    """Rows (h, id): the least hashes of each text's windows, once for each stretch of windows."""

    def work(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            b = _Batch(batch.column(1).cast(pa.binary()).to_pylist(), window)
            h = b.least()
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (b.of[1:] != b.of[:-1])
            keep = new & b.inside
            yield pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64)), batch.column(0).take(pa.array(b.of[keep]))], ["h", "id"])

    return texts.mapInArrow(work, "h bigint, id bigint")


def _windows(found: DataFrame, window: int) -> DataFrame:
    """Rows (h, id): hashes of the windows whose least hash recurs."""

    def work(batches):
        import numpy as np
        import pyarrow as pa

        from .shingles import unpack

        for batch in batches:
            b = _Batch([unpack(z) for z in batch.column(1).to_pylist()], window)
            keep = b.inside & np.isin(b.least(), batch.column(2).flatten().to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(b.hashes()[keep].view(np.int64)), batch.column(0).take(pa.array(b.of[keep]))], ["h", "id"])

    return found.select("id", "z", "recur").mapInArrow(work, "h bigint, id bigint")


def _recurring(rows: DataFrame, owners: bool) -> DataFrame:
    """Of rows (h, id), those whose h has several ids; owners: also the owner, null for rows that are the owner's own.

    Each h then has one row without an owner, that of its smallest id, and rows (id, owner) without h above it.

    Each partition is read in order of (h, id), so nothing is held but the last row.
    """

    def work(batches):
        import numpy as np
        import pyarrow as pa

        h0, own0, id0 = None, None, None
        for batch in batches:
            h, i = (batch.column(c).to_numpy() for c in range(2))
            if not len(h):
                continue
            new = np.ones(len(h), bool)
            new[1:] = h[1:] != h[:-1]
            new[0] = h0 is None or h[0] != h0
            start = np.maximum.accumulate(np.where(new, np.arange(len(h)), -1))
            owner = np.where(start >= 0, i[start], i[0] if own0 is None else own0)
            other = i != owner
            before = np.empty(len(h), np.int64)
            before[1:] = i[:-1]
            before[0] = i[0] if id0 is None else id0
            first = other & ~new & (before == owner)
            h0, own0, id0 = h[-1], owner[-1], i[-1]
            if owners:
                both = np.unique(np.stack([i[other], owner[other]]), axis=1)
                mine = pa.array(owner[first])
                ids = pa.concat_arrays([pa.array(both[0]), mine])
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([pa.nulls(both.shape[1], pa.int64()), pa.array(h[first])]), ids, pa.concat_arrays([pa.array(both[1]), pa.nulls(len(mine), pa.int64())])], ["h", "id", "owner"])
            else:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([h[other], h[first]])), pa.array(np.concatenate([i[other], owner[first]]))], ["h", "id"])

    small_batches(rows)
    return spread(rows, "h").sortWithinPartitions("h", "id").mapInArrow(work, "h bigint, id bigint" + ", owner bigint" * owners)


def _packed(texts: DataFrame) -> DataFrame:
    def work(batches):
        import pyarrow as pa

        from .shingles import pack

        for batch in batches:
            z = [pack((t or "").encode("utf-8", "surrogatepass")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(z, pa.binary())], ["id", "key", "z"])

    return texts.mapInArrow(work, "id bigint, key bigint, z binary")


class _Spelling(dict):
    """Word -> its letters, for the words of the texts given; for any other word U+0000 in each place.

    Letters are few, since an automaton's node looks through all that may follow, and those of a word's first,
    second and third place differ, so that words are met as wholes.
    """

    def __init__(self, texts):
        words = dict.fromkeys(w for words in texts for w in words)
        base = 2
        while base**LETTERS < len(words):
            base += 1
        super().__init__((w, "".join([chr(1 + d * base + k // base**d % base) for d in range(LETTERS)])) for k, w in enumerate(words))

    def __missing__(self, word):
        return "\0" * LETTERS

    def __call__(self, words: list) -> str:
        return "".join(map(self.__getitem__, words))


def _agree(x: str, i: int, y: str, j: int, have: int, most: int) -> int:
    """How many characters from x[i] and y[j] on agree, have at least and most at most."""
    step = 8
    while step and have < most:
        s = min(step, most - have)
        if x[i + have : i + have + s] == y[j + have : j + have + s]:
            have, step = have + s, min(2 * step, 4096)
        else:
            step = s // 2
    return have


class _Automaton:
    """Aho-Corasick automaton over words, of every block of half a window's words in the recurring passages of owners.

    Any window inside a passage holds a whole block, so each occurrence of a window is met at a block and is then
    followed to both sides as far as the words agree.
    """

    def __init__(self, owners: list, window: int):
        import ahocorasick

        #: Lengths and places are of letters.
        self.window, self.block = window * LETTERS, (window + 1) // 2 * LETTERS
        self.spelt = _Spelling(words for _, words, _ in owners)
        #: Of each passage the owner, the owner's spelt words, and the passage's place in them.
        self.passages = []
        places: dict = {}
        for owner, words, runs in sorted(owners, key=lambda o: o[0]):
            seq = self.spelt(words)
            for a, b in ((a * LETTERS, b * LETTERS) for a, b in runs):
                for k in range(a, b - self.block + 1, self.block):
                    places.setdefault(seq[k : k + self.block], []).append((len(self.passages), k))
                self.passages.append((owner, seq, a, b))
        self.automaton = ahocorasick.Automaton()
        for block, where in places.items():
            self.automaton.add_word(block, where)
        self.automaton.make_automaton()

    def places(self, i: int, words: list) -> list:
        """Half-open ranges of words of text i that lie in windows of owners with smaller ids."""
        if not len(self.automaton):
            return []
        seq = self.spelt(words)
        n, block, passages = len(seq), self.block, self.passages
        lacks, reach, out = self.window - block, {}, []
        for end, where in self.automaton.iter(seq):
            e = end + 1
            at = e - block
            for p, k in where:
                owner, own, low, high = passages[p]
                if owner >= i:
                    break
                c, r = k + block, 0
                # Most blocks agree by chance: the words that a window lacks are compared first.
                most = min(n - e, high - c)
                few = min(most, lacks)
                while r < few and seq[e + r] == own[c + r]:
                    r += 1
                if r < lacks:
                    r -= r % LETTERS
                    x = lacks - r
                    if k - x < low or at < x or seq[at - x : at] != own[k - x : k]:
                        continue
                if reach.get((p, at - k), -1) > end:
                    continue
                if r == few < most:
                    r = _agree(seq, e, own, c, r, most)
                    r -= r % LETTERS
                reach[p, at - k] = e + r
                x, most = 0, min(at, k - low)
                while x < most and seq[at - x - 1] == own[k - x - 1]:
                    x += 1
                x -= x % LETTERS
                out.append(((at - x) // LETTERS, (e + r) // LETTERS))
        merged: list = []
        for a, b in sorted(out):
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        return merged


def _streamed(rows: DataFrame, window: int) -> DataFrame:
    """Rows (id, key, starts, ends): the places in each text of windows that start in a text with a smaller id.

    rows: (shard, part, kind, id, key, z, own), kind 0 owners with hashes of the windows they own and 1 the texts to read.
    """

    def work(batches):
        import numpy as np
        import pyarrow as pa

        from .shingles import unpack

        at, owners, automaton, out = None, [], None, []

        def runs(text, own):
            # Of a window that recurs inside its owner the first place is enough.
            h, k = np.unique(_Batch([text], window).hashes(), return_index=True)
            k = np.sort(k[np.isin(h, np.array(own, np.int64).view(np.uint64))])
            cuts = np.flatnonzero(np.diff(k) > 1)
            return [(int(x), int(y) + window) for x, y in zip(k[[0, *(cuts + 1)]], k[[*cuts, -1]], strict=True)] if len(k) else []

        def handed():
            columns = list(zip(*out, strict=True)) or [()] * 4
            out.clear()
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:2]), *(pa.array(c, pa.list_(pa.int32())) for c in columns[2:])], ["id", "key", "starts", "ends"])

        for batch in batches:
            for shard, part, kind, i, key, z, own in zip(*(batch.column(c).to_pylist() for c in range(7)), strict=True):
                if (shard, part) != at:
                    at, owners, automaton = (shard, part), [], None
                text = unpack(z)
                words = text.split()
                if kind == 0:
                    owners.append((i, words, runs(text, own)))
                    continue
                if automaton is None:
                    automaton, owners = _Automaton(owners, window), []
                if found := automaton.places(i, words):
                    out.append((i, key, [x[0] for x in found], [x[1] for x in found]))
                if len(out) > 2000:
                    yield handed()
        yield handed()

    keys = ("shard", "part")
    return spread(rows, *keys).sortWithinPartitions(*keys, "kind", "id").mapInArrow(work, "id bigint, key bigint, starts array<int>, ends array<int>")


def repeated_spans(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows (id, key, spans) of texts with words to remove, and rows (id, key, z) that hold those texts, compressed.

    key: a hash of the text, so that rows of equal ids and different texts stay apart. spans: sorted half-open word ranges.
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("t"), F.xxhash64(text_col).alias("key")).where("id is not null")
    small_batches(texts)
    recur = _recurring(_scan(texts, window), False).groupBy("id").agg(F.collect_list("h").alias("recur"))
    found = _packed(texts).join(recur.hint("merge"), "id").dropDuplicates(["id", "key"])
    found = cut(found.withColumn("chars", F.length("z")))
    of = _recurring(_windows(found, window), True).groupBy("id").agg(F.collect_list("h").alias("own"), F.collect_set("owner").alias("reads"))
    of = cut(of)
    owned = of.select("id", F.explode("reads").alias("owner"))
    owners = of.where("size(own) > 0").select("id", "own").join(found.drop("recur"), "id")
    held = owners.agg(F.coalesce(F.sum("chars"), F.lit(0))).first()[0]
    shards = max(1, round(held / 3 / SHARD_WORDS))  # about 3 compressed characters are a word
    owners = owners.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    needs = cut(owned.select("id", F.pmod(F.xxhash64("owner"), F.lit(shards)).cast("int").alias("shard")).distinct())
    parts = needs.join(found.select("id", "chars"), "id").groupBy("shard").agg(F.ceil(F.sum("chars") / (STREAM_CHARS / 3)).cast("int").alias("parts"))
    parts = cut(parts)
    reads = needs.join(parts, "shard").join(found.drop("recur"), "id")
    reads = reads.select("shard", F.pmod(F.xxhash64("id", "shard"), "parts").cast("int").alias("part"), F.lit(1).alias("kind"), "id", "key", "z", F.lit(None).cast("array<bigint>").alias("own"))
    owners = owners.join(parts, "shard").select("shard", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), F.lit(0).alias("kind"), "id", "key", "z", "own")
    spans = _streamed(owners.union(reads), window)
    spans = spans.select("id", "key", F.explode(F.arrays_zip("starts", "ends")).alias("s")).groupBy("id", "key").agg(F.array_sort(F.collect_list("s")).alias("spans"))
    return spans, found.select("id", "key", "z")


def _left(with_text: bool):
    """Remove spans from packed texts."""

    def work(batches):
        import hashlib

        import pyarrow as pa

        from .shingles import unpack

        for batch in batches:
            shas, gone, texts = [], [], []
            for z, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                words, kept, at, n = unpack(z).split(), [], 0, 0
                for s in spans:
                    a, b = max(at, s["starts"]), max(at, s["ends"])
                    kept += words[at:a]
                    n += b - a
                    at = b
                kept += words[at:]
                text = b" ".join(kept)
                shas.append(hashlib.sha256(text).hexdigest())
                gone.append(n)
                texts.append(text.decode("utf-8", "surrogatepass") if with_text else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(gone, pa.int64()), pa.array(shas, pa.string()), pa.array(texts, pa.string())], ["id", "key", "n_removed", "sha2", "left"])

    return work


def _whole(with_text: bool):
    """Count and digest texts as they are."""

    def work(batches):
        import hashlib

        import pyarrow as pa

        from .shingles import words_of

        for batch in batches:
            words = [words_of(t, False) for t in batch.column(1).to_pylist()]
            texts = [b" ".join(w) for w in words]
            shas = [hashlib.sha256(x).hexdigest() for x in texts]
            kept = [x.decode("utf-8", "surrogatepass") if with_text else None for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([len(w) for w in words], pa.int64()), pa.array(shas, pa.string()), pa.array(kept, pa.string())], ["id", "key", "n_words", "sha", "all"])

    return work


def remove_repeats(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Rows (id_col, n_words, n_removed, kept_sha256), one for each row of docs; with_text: also kept, the words left.

    A window is so many consecutive words (parted by ASCII white space, unchanged) of one text. Each word is removed
    that a window covers whose words also start in a text with a smaller id; windows are judged on the input. Kept words
    are joined by one space. Null texts have no words. Texts shorter than a window are kept whole. Of rows with equal ids,
    none counts as the smaller. Rows with a null id are kept whole. Other columns are not looked at.
    """
    spans, packed = repeated_spans(docs, window, id_col, text_col)
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("t"), F.xxhash64(text_col).alias("key"))
    every = source.mapInArrow(_whole(with_text), "id bigint, key bigint, n_words bigint, sha string, all string")
    changed = packed.join(spans.hint("merge"), ["id", "key"]).select("id", "key", "z", "spans")
    changed = changed.mapInArrow(_left(with_text), "id bigint, key bigint, n_removed bigint, sha2 string, left string")
    out = every.join(changed, ["id", "key"], "left")
    cols = [F.col("id").alias(id_col), "n_words", F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"), F.coalesce("sha2", "sha").alias("kept_sha256")]
    return out.select(*cols, *([F.coalesce("left", "all").alias("kept")] if with_text else []))
