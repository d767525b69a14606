"""Ordered differences of two word sequences; no built-in function aligns sequences.

Common ends are cut off first and the rest is parted at words that both sides have once, in the same order, so only short
stretches between such anchors are compared word by word.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import shipped


def _anchors(a: list, b: list) -> list[tuple[int, int]]:
    """Places (in a, in b) of words that each side has once, the longest run of them that goes up on both sides."""
    from bisect import bisect_left

    once_a, once_b = Counter(a), Counter(b)
    at = {w: j for j, w in enumerate(b) if once_b[w] == 1}
    pairs = [(i, at[w]) for i, w in enumerate(a) if once_a[w] == 1 and w in at]
    tails, last, back = [], [], []
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(tails, j)
        back.append(last[p - 1] if p else -1)
        tails[p : p + 1], last[p : p + 1] = [j], [k]
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def differences(a: list, b: list) -> list[tuple[str, int, int, int, int]]:
    """(op, a0, a1, b0, b1) of what changes a into b, in order, neighbouring changes as one: delete, insert or replace."""
    import difflib

    low, high = 0, 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    x, y = a[low : len(a) - high], b[low : len(b) - high]
    found, i, j = [], 0, 0
    for p, q in [*_anchors(x, y), (len(x), len(y))]:
        if (p, q) != (i, j):
            m = difflib.SequenceMatcher(None, x[i:p], y[j:q], autojunk=False)
            found += [(i + a0, i + a1, j + b0, j + b1) for op, a0, a1, b0, b1 in m.get_opcodes() if op != "equal"]
        i, j = p + 1, q + 1
    out: list = []
    for a0, a1, b0, b1 in found:
        if out and out[-1][1] == a0 and out[-1][3] == b0:
            out[-1] = (out[-1][0], a1, out[-1][2], b1)
        else:
            out.append((a0, a1, b0, b1))
    kind = lambda da, db: "replace" if da and db else "delete" if da else "insert"
    return [(kind(a1 - a0, b1 - b0), low + a0, low + a1, low + b0, low + b1) for a0, a1, b0, b1 in out]


def word_flags(pairs: DataFrame, key: str) -> DataFrame:
    """Rows (key, op, page, at_a, at_b, n, missing, extra) of what changes a into b.

    pairs: key, an integer, and a and b, arrays of words, and pages, of a's words. A difference is on the page of the word
    of a where it begins, after the last word on that word's.
    """

    def work(batches):
        import pyarrow as pa

        names = (key, "op", "page", "at_a", "at_b", "n", "missing", "extra")
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        for batch in batches:
            out = []
            for i, a, b, pages in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                for op, a0, a1, b0, b1 in differences(a, b):
                    page = (pages[a0] if a0 < len(pages) else pages[-1]) if pages else 0
                    out.append((i, op, page, a0, b0, max(a1 - a0, b1 - b0), " ".join(a[a0:a1]), " ".join(b[b0:b1])))
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(names))

    rows = pairs.select(F.col(key).cast("bigint").alias(key), "a", "b", F.col("pages").cast("array<bigint>").alias("pages"))
    return shipped(rows).mapInArrow(work, f"{key} bigint, op string, page bigint, at_a bigint, at_b bigint, n bigint, missing string, extra string")


def word_ops(pairs: DataFrame, key: str) -> DataFrame:
    """Rows (key, op, at_a, at_b, n, text) of what changes a into b; key is an integer, a and b arrays of words."""
    ops = word_flags(pairs.withColumn("pages", F.array().cast("array<bigint>")), key)
    return ops.select(key, "op", "at_a", "at_b", "n", F.when(F.col("op") == "insert", F.col("extra")).otherwise(F.col("missing")).alias("text"))
