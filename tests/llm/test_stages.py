"""Each stage of the pipeline against plain code, and on nulls, empty tables, repeated rows and clashing columns."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from leafgauge.llm import components, mixing, queries, stages, toxicity

BASE = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = ["_copy", "_times", "_id", "_size", "gone", "pages", "d", "i", "t", "row", "host", "lines", "kept", "copy", "times", "id", "h", "a.b"]
ODD = [(1, None, "en", "a", 0), (2, "", None, None, 0), (3, "x\ny", "en", "a", 3), (3, "x\ny", "en", "a", 3), (None, "one two three four five six", "en", "b", 27), (5, " \n\t ", "en", "c", 4), (6, "w" * 100_000, "en", "b", 100_000)]
LABELS = "/root/testdata/sf0.001"


def frame(spark, rows):
    out = spark.createDataFrame(rows, BASE)
    return out.select("*", *(F.lit(f"{c}!").alias(c) for c in CLASHING))


@pytest.mark.parametrize("k", range(4))
def test_other_columns_and_odd_rows_stay(spark, k):
    stage = corpus_pipeline.STAGES[k][1]
    docs = frame(spark, ODD)
    out = stage(spark, docs, LABELS)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    rows = [r.asDict() for r in out.collect()]
    assert all(r[c] == f"{c}!" for r in rows for c in CLASHING)
    if stage is stages.mix_sources:
        assert Counter(r["doc_id"] for r in rows)[1] == 1 and max(Counter(r["doc_id"] for r in rows if r["doc_id"] != 3).values()) <= 3
    else:
        assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in ODD)
    assert stage(spark, frame(spark, []), LABELS).count() == 0


def test_encoding(spark):
    t = Tokenizer.from_file(queries.WORD_BPE)
    got = {r["doc_id"]: r for r in stages.encode(spark, frame(spark, ODD), LABELS).collect()}
    for i, text, *_ in ODD:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want = (len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == want
    assert stages.encode(spark, frame(spark, []), LABELS).count() == 0


def test_toxic_go(spark):
    docs = spark.read.parquet(f"{LABELS}/documents.parquet")
    out = {r["doc_id"] for r in toxicity.severity(docs, spark.read.parquet(f"{LABELS}/labels.parquet")).where("toxic").collect()}
    left = {r["doc_id"] for r in stages.drop_toxic(spark, docs, LABELS).collect()}
    every = {r["doc_id"] for r in docs.collect()}
    assert out and left == every - out


def test_severity_against_its_formula(spark):
    import math

    model = {"weights": {"vile": 2.0, "awful": 1.5, "awful*": 0.0}, "cuts": [1.0, 2.0, 3.5]}
    rows = [(0, None), (1, ""), (2, "Vile"), (3, "vile vile awful"), (4, "calm")]
    got = {r["doc_id"]: r for r in toxicity.score(spark.createDataFrame(rows, "doc_id bigint, text string"), model).collect()}
    for i, s in ((0, 0), (1, 0), (2, 2 * math.log(2)), (3, 2 * math.log(3) + 1.5 * math.log(2)), (4, 0)):
        p = [1 / (1 + math.exp(c - s)) for c in model["cuts"]]
        each = [a - b for a, b in zip([1, *p], [*p, 0], strict=True)]
        assert got[i]["severity"] == pytest.approx(sum(p)) and got[i]["p_toxic"] == pytest.approx(p[0]) and got[i]["grade"] == each.index(max(each))


@pytest.mark.parametrize("limit", [16 << 20, -1])
def test_lines_go(spark, monkeypatch, limit):
    monkeypatch.setattr(stages.lines, "BROADCAST", limit)
    rng, pool = random.Random(2), [f"line {i}" for i in range(30)]
    rows = [(i, "\n".join(rng.choice(pool[: 5 + 10 * (i % 3)]) + " " * rng.randrange(2) for _ in range(rng.randrange(6))), "en", "abc"[i % 3], 0) for i in range(60)]
    rows += [(100, None, "en", "a", 7), (101, "", "en", None, 0)]
    pages, holds = Counter(r[3] or "" for r in rows), defaultdict(set)
    for i, text, _, source, _ in rows:
        for x in (text or "").split("\n"):
            holds[source or "", x.strip()].add(i)
    gone = {k for k, v in holds.items() if k[1] and len(v) >= stages.LINE_LEAST and len(v) > stages.LINE_RATIO * pages[k[0]]}
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in stages.drop_lines(spark, frame(spark, rows), LABELS).collect()}
    assert gone and got[100] == (None, 7)
    for i, text, _, source, _ in rows:
        if text is not None:
            left = "\n".join(x for x in text.split("\n") if (source or "", x.strip()) not in gone)
            assert got[i] == (left, len(left))


def test_near_copies_go(spark):
    rng = random.Random(5)
    base = [[str(rng.randrange(10**6)) for _ in range(80)] for _ in range(6)]
    rows = []
    for i in range(60):
        w = list(base[i % 6])
        for _ in range(rng.randrange(4)):
            w[rng.randrange(80)] = f"edit{i}"
        rows.append((i, " ".join(w), "en", "a", 0))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(76)} for i, t, *_ in rows}
    top = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    top[i] = top[j] = min(top[i], top[j])
    assert {r["doc_id"] for r in stages.drop_near_copies(spark, frame(spark, rows), LABELS).collect()} == {i for i in top if top[i] == i}


def shared(sizes, weights=(5, 2, 1), most=3):
    """Targets by filling up again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = float(sum(sizes.values())), set(order), {s: 0.0 for s in order}
    while open_:
        x = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * x >= most * sizes[s]}
        if not full:
            return out | {s: weight[s] * x for s in open_}
        for s in full:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ -= full
    return out


def mixed_rows(seed):
    rng = random.Random(seed)
    return [(i, " ".join("w" * rng.randrange(0, 60)), "en", rng.choice(["a", "a", "a", "b", "c", "d", None]), 0) for i in range(120)]


@pytest.mark.parametrize("seed", [1, 2])
def test_targets(spark, seed):
    rows = mixed_rows(seed)
    sizes = Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += len(text.split())
    got = {r["source"]: r["target"] for r in mixing.targets(mixing.sized(frame(spark, rows))).collect()}
    assert got == pytest.approx(shared(sizes))


@pytest.mark.parametrize("seed", [1, 2])
def test_slots_follow_the_points(spark, seed):
    block, rows = 16, mixed_rows(seed)
    shares = mixing.targets(mixing.sized(frame(spark, rows)))
    per = sorted((r for r in shares.collect() if r["source_size"] and round(r["target"])), key=lambda r: r["si"])
    q, nb, last = {}, {}, {}
    for r in per:
        words = min(round(r["target"]), 3 * r["source_size"])
        nb[r["si"]] = -(-r["source_size"] // block)
        rest = words % r["source_size"]
        q[r["si"]], last[r["si"]] = words // r["source_size"] * nb[r["si"]] + -(-rest // block), rest % block
    n, dealt, want = sum(q.values()), Counter(), []
    for slot in range(n):
        u, low = slot * mixing.GOLDEN % mixing.TURN / mixing.TURN, 0
        for s, c in q.items():
            if low / n <= u < (low + c) / n:
                if dealt[s] < c:
                    want.append((slot, s, dealt[s]))
                dealt[s] += 1
            low += c
    late = sorted((k, s) for s, c in q.items() for k in range(dealt[s], c))
    want += [(n + i, s, k) for i, (k, s) in enumerate(late)]
    got = mixing.schedule(shares, block).collect()
    assert sorted((r["slot"], r["si"], r["k"]) for r in got) == sorted(want)
    # Every stretch of the schedule has each source near its share.
    for s, c in q.items():
        assert all(abs(sum(x[1] == s for x in want if x[0] < m) - c * m / n) <= 5 for m in range(0, n, 7))
    taken = defaultdict(list)
    for r in got:
        assert (r["block"], r["epoch"]) == (r["k"] % nb[r["si"]], r["k"] // nb[r["si"]])
        taken[r["si"], r["block"]].append((r["slot"], r["cut"]))
    laid = mixing.laid_out(mixing.sized(frame(spark, rows)).withColumn("row", F.monotonically_increasing_id()), shares).collect()
    out = {r["doc_id"]: r for r in mixing.mix(frame(spark, rows), block=block).collect()}
    for r in laid:
        seen, words = [], 0
        for b in range(r["start"] // block, (r["start"] + r["size"] - 1) // block + 1 if r["size"] else 0):
            for slot, cut in taken[r["si"], b]:
                w = min(r["start"] + r["size"], b * block + (block if cut is None else cut)) - max(r["start"], b * block)
                if w > 0:
                    seen.append(slot)
                    words += w
        x = out[r["id"]]
        assert (x["taken"], x["first_slot"], x["n_slots"]) == (words, min(seen, default=None), len(seen)) and words <= 3 * r["size"]


def test_mix(spark):
    rows = mixed_rows(3)
    want = {r["doc_id"]: 1 if not r["size"] else int(r["taken"] / r["size"] + 0.5) for r in mixing.mix(frame(spark, rows)).collect()}
    got = Counter(r["doc_id"] for r in stages.mix_sources(spark, frame(spark, rows), LABELS).collect())
    assert got == Counter({i: n for i, n in want.items() if n})


def test_components(spark):
    rng = random.Random(7)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000), (5, None)]
    top = {i: i for x in links[:-2] for i in x}
    for _ in range(80):
        for a, b in links[:-2]:
            top[a] = top[b] = min(top[a], top[b])
    linked = {i for a, b in links[:-2] if a != b for i in (a, b)}
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: top[i] for i in linked}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
