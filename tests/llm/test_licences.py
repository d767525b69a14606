"""Licence scans: every template beside every other, at any frequency, and against plain code."""

import random

from leafgauge.llm import licences

WORDS = [w for _, p, _ in licences.TEMPLATES for w in p.split()]


def labels(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["doc_id"]: (r["labels"].split(",") if r["labels"] else [], r["score"]) for r in licences.scan(rows).collect()}


def plain(text):
    w, found, best = text.lower().split(), set(), 0.0
    for label, passage, key in licences.TEMPLATES:
        p, k = passage.split(), key.split()
        at = next(i for i in range(len(p)) if p[i : i + len(k)] == k)
        for i in range(len(w)):
            if w[i : i + len(k)] == k:
                cover = sum(0 <= i - at + j < len(w) and w[i - at + j] == x for j, x in enumerate(p)) / len(p)
                if cover >= 0.5:
                    found.add(label)
                    best = max(best, cover)
    based = {label for phrase, label in licences.BASE if f" {phrase} " in f" {' '.join(w)} "}
    return sorted(found | based), 1.0 if based else best


def test_all_templates_in_one_text(spark):
    every = " filler ".join(p for _, p, _ in licences.TEMPLATES)
    # Extra texts turn the words' order by frequency over.
    texts = [every, *(p for _, p, _ in licences.TEMPLATES), *["software license public version"] * 60, *["mozilla isc noncommercial unencumbered"] * 90, None, ""]
    got = labels(spark, texts)
    wanted = sorted({label for label, _, _ in licences.TEMPLATES} | {label for _, label in licences.BASE if label != "reserved"})
    assert got[0] == (wanted, 1.0)
    for i, (label, _, _) in enumerate(licences.TEMPLATES):
        assert label in got[i + 1][0]
    assert got[len(texts) - 1] == got[len(texts) - 2] == ([], 0.0)


def test_against_plain_code(spark):
    rng, texts = random.Random(4), []
    for _ in range(150):
        w = [rng.choice(WORDS) for _ in range(rng.randrange(8))]
        for _ in range(rng.randrange(1, 4)):
            p = rng.choice(licences.TEMPLATES)[1].split()
            p = p[rng.randrange(4) : len(p) - rng.randrange(4)]
            w += [rng.choice(WORDS) if rng.random() < 0.1 else x for x in p] + [rng.choice(WORDS) for _ in range(rng.randrange(5))]
        texts.append(" ".join(w))
    got = labels(spark, texts)
    assert [got[i] for i in range(len(texts))] == [plain(t) for t in texts]
