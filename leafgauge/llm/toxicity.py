"""Toxicity severity by cumulative-link ordinal regression on sparse text features (operator 3).

Grades: 0 for documents labelled clean; labelled toxic ones are graded 1, 2 and 3 by terciles of how dense
their evidence is, that is words and word beginnings far commoner in toxic than in clean training texts. The training
texts are two halves, and each is graded by what is commoner in the other, so that no text is evidence for its own grade.
One weight vector is shared by all thresholds: P(grade >= k) = sigmoid(w.x - b_k), b_1 <= b_2 <= b_3.
Features are such words and beginnings, counted by log(1 + n) over the whole text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import by_rows
from .common import cut

GRADES = 4
#: Letters of a word beginning; labelled documents a model is fitted on, and features it has, at most.
STEM, SAMPLE, FEATURES = 5, 20_000, 4096


def _counts(text: str | None) -> dict:
    """Of a whole text: its words' and word beginnings' counts (beginnings end in *)."""
    import collections

    import regex

    words = collections.Counter(regex.findall(r"\p{L}+", (text or "").lower()))
    out = dict(words)
    for w, n in words.items():
        if len(w) > STEM:
            out[w[:STEM] + "*"] = out.get(w[:STEM] + "*", 0) + n
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> dict:
    """Fit on at most `sample` labelled documents, those of least hashed id. Returns weights by feature, and thresholds.

    Labels that are null, and labelled ids without a text, don't count; of several labels of an id the greatest does, and of several texts the
    last in order.
    Without both toxic and clean documents the model finds every text clean.
    """
    import numpy as np

    some = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias("id")).agg((F.max(label_col) > 0).cast("bigint").alias("y"))
    some = cut(some.orderBy(F.xxhash64("id"), "id").limit(sample))
    # At most `sample` labelled ids are broadcast, and as many texts written.
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("t")).join(F.broadcast(some), "id")
    texts = cut(texts.groupBy("id").agg(F.max(F.concat(F.col("y").cast("string"), F.coalesce("t", F.lit("")))).alias("t")), small=True)

    def features(batch):
        got = [(t[0] == "1", _counts(t[1:])) for t in batch]
        return {"toxic": [int(y) for y, _ in got], "words": [" ".join(c) for _, c in got], "counts": [list(c.values()) for _, c in got]}

    seen = cut(by_rows(texts, "id", "t", features, {"toxic": "bigint", "words": "string", "counts": "array<bigint>"}))
    sizes = {r["toxic"]: r["n"] for r in seen.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return {"weights": {}, "cuts": [1.0] * (GRADES - 1)}
    half = F.pmod(F.xxhash64("id", F.lit("half")), F.lit(2))
    in_half = {(r["half"], r["toxic"]): r["n"] for r in seen.groupBy(half.alias("half"), "toxic").agg(F.count("*").alias("n")).collect()}
    per = seen.select("toxic", half.alias("half"), F.explode(F.split("words", " ")).alias("f")).where("f <> ''").groupBy("f").agg(F.sum("toxic").alias("a"), F.count("*").alias("n"), F.sum(F.expr("half * toxic")).alias("a1"), F.sum("half").alias("n1"))
    per = per.withColumn("b", F.col("n") - F.col("a")).where(f"a >= {max(3, n1 // 1000)}")
    per = per.withColumn("lift", F.log((F.col("a") + 0.5) / (n1 + 1)) - F.log((F.col("b") + 0.5) / (n0 + 1))).where("lift > 2.0")
    chosen = per.orderBy(F.desc(F.col("lift") * F.sqrt("a")), "f").limit(FEATURES).collect()
    index = {r["f"]: k for k, r in enumerate(chosen)}
    a = np.array([[r["a"] - r["a1"], r["a1"]] for r in chosen], float).reshape(-1, 2)
    b = np.array([[r["n"] - r["n1"], r["n1"]] for r in chosen], float).reshape(-1, 2) - a
    toxic, clean = (np.array([in_half.get((h, y), 0) for h in (0, 1)], float) for y in (1, 0))
    # By half what is commoner in the other one.
    lift = np.maximum(0, np.log((a + 0.5) / (toxic + 1)) - np.log((b + 0.5) / (clean + 1)))[:, ::-1]

    def rows(batch):
        found = []
        for t in batch:
            c = _counts(t[1:])
            found.append({k: c[f] for f, k in index.items() if f in c} if len(index) < len(c) else {index[f]: n for f, n in c.items() if f in index})
        return {"y": [int(t[0] == "1") for t in batch], "k": [list(x) for x in found], "n": [list(x.values()) for x in found], "words": [len(t) for t in batch]}

    # Bounded by the sample and by FEATURES.
    data = by_rows(texts, "id", "t", rows, {"y": "bigint", "k": "array<bigint>", "n": "array<bigint>", "words": "bigint"}).withColumn("half", half).sort("id").collect()
    y = np.array([r["y"] for r in data])
    r_of = np.repeat(np.arange(len(data)), [len(r["k"]) for r in data])
    k_of = np.array([k for r in data for k in r["k"]], int)
    v_of = np.log1p(np.array([n for r in data for n in r["n"]], float))
    half_of = np.array([r["half"] for r in data], int)[r_of]
    density = np.bincount(r_of, v_of * lift[k_of, half_of] if len(k_of) else None, len(data)) / np.log1p([r["words"] for r in data])
    grade = np.zeros(len(data), int)
    grade[y == 1] = 1 + np.searchsorted(np.quantile(density[y == 1], [1 / 3, 2 / 3]), density[y == 1])
    w, b = np.zeros(len(index)), np.array([1.0, 2.0, 3.0])[: GRADES - 1]
    at_least = (grade[:, None] >= np.arange(1, GRADES)).astype(float)
    each = np.where(y == 1, 0.5 / n1, 0.5 / n0)
    mw, vw, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)
    for step in range(1, 401):  # Adam on the thresholds' log loss, with a small penalty on weights
        score = np.bincount(r_of, v_of * w[k_of] if len(k_of) else None, len(data))
        off = (1 / (1 + np.exp(np.clip(b - score[:, None], -30, 30))) - at_least) * each[:, None]
        gw = np.bincount(k_of, v_of * off.sum(axis=1)[r_of], len(w)) + 1e-5 * w
        gb = -off.sum(axis=0)
        mw, vw, mb, vb = 0.9 * mw + 0.1 * gw, 0.999 * vw + 0.001 * gw**2, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb**2
        w = w - 0.1 * mw / (1 - 0.9**step) / (np.sqrt(vw / (1 - 0.999**step)) + 1e-8)
        b = np.maximum.accumulate(b - 0.1 * mb / (1 - 0.9**step) / (np.sqrt(vb / (1 - 0.999**step)) + 1e-8))
    return {"weights": {f: float(w[k]) for f, k in index.items()}, "cuts": [float(x) for x in b]}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id_col, severity, p_toxic, grade): expected grade, P(grade >= 1), and the likeliest grade, of each whole text.

    Null and empty texts have no evidence. Each input row gives one row; null ids stay null.
    """
    weights, cuts = model["weights"], model["cuts"]

    def run(texts):
        import math

        out = {"severity": [], "p_toxic": [], "grade": []}
        for t in texts:
            s = sum(weights[f] * math.log1p(n) for f, n in _counts(t).items() if f in weights) if weights else 0.0
            p = [1 / (1 + math.exp(min(30, max(-30, b - s)))) for b in cuts] if weights else [0.0] * len(cuts)
            each = [a - b for a, b in zip([1.0, *p], [*p, 0.0], strict=True)]
            out["severity"].append(sum(p))
            out["p_toxic"].append(p[0])
            out["grade"].append(each.index(max(each)))
        return out

    return by_rows(docs, id_col, text_col, run, {"severity": "double", "p_toxic": "double", "grade": "int"})


def severity(docs: DataFrame, labels: DataFrame, reject: float = 0.5, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """score() of a model fitted here, and toxic: P(grade >= 1) of at least `reject`."""
    out = score(docs, fit(docs, labels, id_col, text_col, label_col, sample), id_col, text_col)
    return out.withColumn("toxic", F.col("p_toxic") >= reject)
