"""Recall of the graph search on kinds of tables, and both searches on repeated ids and large components, against brute force."""

import numpy as np
import pytest

from leafgauge.llm import ann, exact_search


def table(spark, rows, kind="float"):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in rows], f"vec_id bigint, embedding array<{kind}>")


def recall(spark, rows, k=20):
    x = {}
    for i, v in rows:
        x.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    got = {}
    for r in ann.nearest(table(spark, rows)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for q in (q for q in x if q % 20 == 0):
        score = {i: max(float(a @ b) for a in x[q] for b in vs) for i, vs in x.items() if i != q}
        want = sorted(score, key=lambda i: (-score[i], i))[:k]
        # Of equal products any is as near.
        least = score[want[-1]] if want else 0
        mine = sorted(got.get(q, []))
        assert [r for r, _, _ in mine] == list(range(1, len(mine) + 1)) and len({i for _, i, _ in mine}) == len(mine)
        assert all(s == pytest.approx(score[i], rel=1e-12) for _, i, s in mine)
        assert [(-s, i) for _, i, s in mine] == sorted((-s, i) for _, i, s in mine)
        hits += sum(score[i] >= least - 1e-12 * abs(least) for _, i, _ in mine)
        total += len(want)
    return hits / max(1, total)


def kinds():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(50, 32))
    yield "few", rng.normal(size=(30, 16))
    yield "tight clusters", centres[np.arange(2000) % 50] + 0.01 * rng.normal(size=(2000, 32))
    yield "very tight clusters", centres[np.arange(2000) % 50] + 0.001 * rng.normal(size=(2000, 32))
    yield "one cluster", rng.normal(size=32) + 0.001 * rng.normal(size=(1000, 32))
    yield "log-normal lengths", rng.normal(size=(2000, 32)) * np.exp(rng.normal(size=(2000, 1)))
    unit = rng.normal(size=(3000, 64))
    yield "unit", unit / np.linalg.norm(unit, axis=1)[:, None]
    yield "repeated", np.repeat(rng.normal(size=(40, 8)), 30, axis=0)
    yield "large components", np.stack([np.full(40, 3e38), np.arange(40.0)], axis=1)


@pytest.mark.parametrize("name,x", list(kinds()), ids=lambda v: v if isinstance(v, str) else "")
def test_graph_search_recall(spark, name, x):
    got = recall(spark, list(enumerate(x)))
    print(f"recall of {name}: {got:.3f}")
    assert got >= 0.95


def test_graph_search_with_repeated_ids(spark):
    rows = [(0, [1.0, 2.0])] * 30 + [(i, [1.0, 2.0]) for i in range(1, 10)]
    assert recall(spark, rows) == 1
    rows = [(i % 25, [float(i % 7), float(i % 11) + 1]) for i in range(100)]
    assert recall(spark, rows) == 1


def test_graph_search_without_usable_rows(spark):
    rows = [(0, None), (20, [0.0, 0.0]), (40, [float("nan"), 1.0]), (60, [float("inf"), 1.0]), (None, [1.0, 1.0])]
    assert ann.nearest(table(spark, rows)).count() == 0
    assert ann.nearest(table(spark, [(20, [1.0, 0.0])])).count() == 0
    assert ann.nearest(table(spark, []).selectExpr("*", "1 as id", "2 as v", "3 as h", "4 as row")).count() == 0


@pytest.mark.parametrize("bucket", [4096, 16])
def test_exact_search_on_all_kinds(spark, monkeypatch, bucket):
    monkeypatch.setattr(exact_search, "BUCKET", bucket)
    monkeypatch.setattr(exact_search, "QUERIES", 3 if bucket == 16 else 2048)
    rng = np.random.default_rng(6)
    x = np.vstack([rng.normal(size=(60, 4)) * np.exp(rng.normal(size=(60, 1))), np.eye(4) * 1e20, -np.eye(4) * 3e16, [[1e300] * 4, [-1e300] * 4, [1e308, 1e308, 0, 0]], rng.integers(-3, 3, size=(60, 4)), np.zeros((3, 4)), rng.normal(size=(20, 4)) * 1e9])
    rows = [*enumerate(x), (20, x[3]), (7, x[0]), (None, x[1])]
    low, high = -(1 << 63), (1 << 63) - 1
    whole = [(i, [int(min(max(c, -(2.0**63)), 2.0**63)) for c in np.floor(64 * np.minimum(np.abs(v), 1e306) * np.sign(v))]) for i, v in rows if i is not None]
    want = {}
    for q, a in whole:
        if q % 20 == 0:
            want.setdefault(q, []).append(sorted((-max(low, min(high, sum(s * t for s, t in zip(a, b, strict=True)))), i) for i, b in whole if i != q))
    got = {}
    for r in exact_search.top_products(table(spark, rows, "double")).collect():
        got.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    for q, lists in want.items():
        if len(lists) == 1:
            assert sorted(got[q]) == lists[0][:20], q
