"""Nulls, empty tables and texts, repeated rows and clashing columns, for every operator; brute force on small tables."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafgauge.llm import ann, bpe, exact_search, licences, lines, mixing, near_dups, queries, substrings, token_counts, toxicity

DOCS = "doc_id bigint, text string, source string, n bigint, id bigint, size bigint, h string, keys string"
TEXTS = [(1, None, "a"), (2, "", None), (3, "x", "a"), (3, "x", "a"), (None, "one two three four five six", "b"), (5, "All Rights Reserved. CC BY 4.0", "b"), (6, "w " * 5000, "a"), (7, " \n\t ", "c")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "h", "k") for r in rows], DOCS)


OPERATORS = {
    "licences": lambda d: licences.scan(d),
    "substrings": lambda d: substrings.remove_repeats(d),
    "bpe": lambda d: bpe.digests(bpe.encode_decode(d, queries.WORD_BPE)),
    "near": lambda d: near_dups.near_duplicates(d),
    "mix": lambda d: mixing.mix(d),
    "counts": lambda d: token_counts.token_counts(d, queries.PIECE_BPE),
    "toxic": lambda d: toxicity.severity(d, d.select("doc_id", F.lit(0).alias("toxic"))),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_row(spark, name):
    assert OPERATORS[name](frame(spark, TEXTS)).count() == len(TEXTS)
    assert OPERATORS[name](frame(spark, [])).count() == 0


def test_base_licences(spark):
    r = {x["doc_id"]: x for x in licences.scan(frame(spark, TEXTS)).collect()}[5]
    assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["score"]) == (7, 2, 0, 3, "cc-by,reserved", 1.0)


def test_pages(spark):
    rows = [(i, "http://H.example/x", f"<p>nav</p><b>own {i}</b>") for i in range(6)] + [(7, None, None)]
    got = {r["page_id"]: r["kept"] for r in lines.dedup_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[3] == ["own 3"] and got[7] == []


def test_repeats_against_brute_force(spark):
    rng = random.Random(3)
    passage = [rng.choice("abcdef") + str(rng.randrange(9)) for _ in range(20)]
    docs = [(i, " ".join([str(rng.random()) for _ in range(5)] + passage[rng.randrange(4) : 13 + rng.randrange(8)] + ["z"] * rng.randrange(30)), "s") for i in range(30)]
    first = {}
    for i, t, _ in docs:
        w = t.split()
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    got = {r["doc_id"]: r for r in substrings.remove_repeats(frame(spark, docs)).collect()}
    for i, t, _ in docs:
        w = t.split()
        gone = {k + j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(13)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        assert got[i]["n_removed"] == len(gone) and got[i]["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


@pytest.mark.parametrize("block", [2048, 6])
def test_near_against_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK", block)
    rng = random.Random(5)
    base = [[str(rng.randrange(10**6)) for _ in range(60)] for _ in range(4)]
    docs = []
    for i in range(80):
        w = list(base[i % 4])
        for _ in range(rng.randrange(5)):
            w[rng.randrange(60)] = "edit"
        docs.append((i, " ".join(w), "s"))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(56)} for i, t, _ in docs}
    top = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                if len(sets[i] & sets[j]) * 100 >= 80 * len(sets[i] | sets[j]):
                    top[i] = top[j] = min(top[i], top[j])
    got = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(frame(spark, docs)).collect()}
    assert got == top


def test_near_where_regions_deepen(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK", 2)
    monkeypatch.setattr(near_dups, "BLOCKS", 2)
    rng = random.Random(6)
    template, docs = [str(rng.randrange(10**6)) for _ in range(88)], []
    for i in range(100):
        w = template + [str(rng.randrange(10**6)) for _ in range(12)]
        docs.append((2 * i, " ".join(w), "s"))
        for at in (10 + rng.randrange(20), 50 + rng.randrange(20)):
            w[at] = f"edit{i}"
        docs.append((2 * i + 1, " ".join(w), "s"))
    nodes = near_dups.signatures(frame(spark, docs), 5, "doc_id", "text").withColumn("comp", F.col("id"))
    assert near_dups._regions(nodes)[1]
    got = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(frame(spark, docs)).collect()}
    assert got == {i: i // 2 * 2 for i in range(200)}


def test_near_misses_at_every_depth():
    """Pairs at 0.8 whose every region is read as deep as DEPTHS goes: signature values agree at random."""
    rng, reads, missed, tried = np.random.default_rng(8), near_dups._reads(), [0, 0, 0], 400_000
    for _ in range(tried // 20_000):
        agree = rng.random((near_dups.VALUES, 20_000)) < 0.8
        for depth in range(3):
            met = np.ones((1, 20_000), bool)
            for d in range(depth, -1, -1):
                here = np.array([agree[x].all(axis=0) for x in reads[d]])
                met = here & (met if d == depth else met.reshape(len(here), near_dups.SPLITS, -1).any(axis=1))
            missed[depth] += int((~met.any(axis=0)).sum())
    assert max(missed) < 1e-4 * tried, missed


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")


def test_exact_search_with_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(200)] + [(200, None), (201, [None] * 8), (202, [float("nan")] * 8), (203, [0.0] * 8), (204, [1.0] * 8), (205, [1.0] * 8)]
    x = {i: np.floor(64 * np.array(v, np.float32).astype(float)).astype(int) for i, v in rows if v and None not in v and v[0] == v[0]}
    got = {}
    for r in exact_search.top_products(vectors(spark, rows)).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    for q in (q for q in x if q % 20 == 0):
        want = sorted(((int(x[q] @ x[i]), -i) for i in x if i != q), reverse=True)[:20]
        assert [got[q][k] for k in range(1, 21)] == [(-i, s) for s, i in want]
    assert exact_search.top_products(vectors(spark, [])).count() == 0


def test_exact_search_on_sparse_vectors(spark):
    rng = np.random.default_rng(9)
    q = np.array([0.7, 0.5, 0.4, 0.3, 0.1, 0, 0, 0])
    off = rng.normal(size=(40, 8))
    off -= (off @ q)[:, None] * q
    near = 1.05 * (0.6 * q + 0.8 * off / np.linalg.norm(off, axis=1)[:, None])
    sparse = rng.random((40, 8)) < 0.3
    sparse = sparse / np.sqrt(np.maximum(1, sparse.sum(axis=1)))[:, None]
    x = 10 * np.vstack([q, near, np.eye(8), np.eye(8), np.eye(8)[:, ::-1], sparse])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    x = np.floor(64 * x.astype(np.float32).astype(float)).astype(int)
    got = {}
    for r in exact_search.top_products(vectors(spark, rows)).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    for a in range(0, len(x), 20):
        want = sorted(((int(x[a] @ x[i]), -i) for i in range(len(x)) if i != a), reverse=True)[:20]
        assert [got[a][k] for k in range(1, 21)] == [(-i, s) for s, i in want]


def test_graph_search_recall(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(600)] + [(600 + i, [1.0] * 8) for i in range(30)] + [(700, None), (701, [0.0] * 8)]
    x = {i: np.array(v, np.float32).astype(float) for i, v in rows if v and any(v)}
    got = {}
    for r in ann.nearest(vectors(spark, rows)).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    asked = [q for q in x if q % 20 == 0]
    hits = sum(len(got[q] & {i for _, i in sorted((-float(x[q] @ x[i]), i) for i in x if i != q)[:20]}) for q in asked)
    assert hits >= 0.9 * 20 * len(asked)
    assert ann.nearest(vectors(spark, [])).count() == 0


def test_toxic_held_out(spark):
    rng = random.Random(1)
    docs = [(i, " ".join(["word" + str(rng.randrange(300)) for _ in range(60)] + ["awful", "vile"] * (i % 5 == 0)), "s") for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(200)], "doc_id bigint, toxic int")
    out = {r["doc_id"]: r["toxic"] for r in toxicity.severity(frame(spark, docs), labels).collect()}
    assert sum(out[i] == (i % 5 == 0) for i in range(200, 400)) >= 195


LONG = [(1, "w" * 2_000_000, "a"), (2, " ".join(f"w{i % 977}" for i in range(200_000)), "b"), (3, "\n".join(["line"] * 100_000), "a")]


@pytest.mark.parametrize("name", OPERATORS)
def test_very_long_texts(spark, name):
    assert OPERATORS[name](frame(spark, LONG)).count() == len(LONG)


def test_pages_without_rows_hosts_or_text(spark):
    schema = "page_id bigint, url string, html string, host string, lines string, kept string, gone string, pages string, row string"
    assert lines.dedup_pages(spark.createDataFrame([], schema)).count() == 0
    rows = [(i, None, "<p>x</p>" + ("<i>y</i>" if i else ""), "h", "l", "k", "g", "p", "r") for i in range(9)] + [(0, "no url", "", "h", "l", "k", "g", "p", "r")] * 2
    got = lines.dedup_pages(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 11 and {r["host"] for r in got} == {""} and all(r["kept"] == [] for r in got)


def test_lines_keep_columns_of_any_name(spark):
    rows = spark.createDataFrame([("h", ["a", None, " "], 1, 2, 3), (None, None, 1, 2, 3)], "host string, lines array<string>, gone int, pages int, kept int")
    out = lines.drop_frequent_lines(rows)
    assert sorted(out.columns) == sorted(rows.columns)
    got = {r["host"]: (r["kept"], r["gone"], r["pages"]) for r in out.collect()}
    assert got == {"h": (["a", None, " "], 1, 2), None: (None, 1, 2)}
