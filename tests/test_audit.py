"""The checks in one pass give what those over separate tables give."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from leafgauge.functions import text as T
from leafgauge.operators import audit, gates, mutate, projection
from leafgauge.plans import card

PLACE = "/root/testdata/sf0.001"
PIECES = (
    "\n\n<table><tr><td>{w} **{w}**<sup>3</sup></td></tr></table>\n\n", "\n\n- {w} {w} {w}\n", "\n\n## 1.{n} {w} {w}\n\n", "\n\n<!-- p.{n} -->\n\n", " **{w} {w} {w}** ", " :chip[{w}] ", " [{w}](http://site.test/{w}/) ",
    "\n\n![{w}](figures/p{n}.png)\n\n", "\n\n[^{n}]: {w} * {w}\n\n", " [^{n}] ", "\n\n:::turn{{label=\"{w}\"}}\n\n", "\n\n{w} {w} {w} {w} {w}\n\n", " é- {w} é́- {w} ﬁ​{w} “{w}” ● {w} \x1c {w}²- {w} ", "\n\n<!-- figure p{n}-1.png skipped: {w} -->\n\n", "\n\n|--|\n\n",
)


def odd(row, r):
    """A document with odd pieces in its text and odd changes to its page facts."""
    d = row.asDict(recursive=True)
    words = d["text"].split()
    piece = lambda: r.choice(PIECES).format(w=r.choice(words), n=r.randrange(1, 9))
    for _ in range(r.randrange(6)):
        at = r.randrange(len(d["text"]) + 1)
        d["text"] = d["text"][:at] + piece() + d["text"][at + r.choice((0, 0, 9, 90)) :]
    text = lambda s: r.choice((s, f"{s}-  x", f"●​{s}", f"a.​{s}", f"é- {s}", f"1.2.3 {s}", f" {s}　", f"{s}/ ", "", f"ﬃ‘{s}", f"{s}\x1d{s}", f"{s} ●{s}"))
    change = {
        "spans": lambda x: r.choice(({"text": text(x["text"])}, {"bold": not x["bold"]}, {"bold": None}, {"size": 13.0}, {"size": None}, {"color": "#666666"}, {"zone": "fnref"}, {"zone": "head"}, {"x0": -x["x0"]}, {"y0": x["y0"] + 8}, {"page": x["page"] + 1})),
        "links": lambda x: r.choice(({"uri": f"{x['uri']}//"}, {"uri": None}, {"anchor": text(x["anchor"])}, {"anchor": None}, {"unresolvable": True}, {"unresolvable": None, "dest_page": None}, {"kind": "goto"})),
        "pills": lambda x: r.choice(({"text": text(x["text"])}, {"text": None}, {"color": "#123456"}, {"page": x["page"] + 1})),
        "notes": lambda x: r.choice(({"n": None}, {"text": text(x["text"])}, {"text": None}, {"n": x["n"] + 3}, {"page": x["page"] + 1})),
        "figures": lambda x: {"page": x["page"] + r.choice((-1, 1))},
        "expected": lambda x: {"page": x["page"] + 1},
    }
    for k, new in change.items():
        xs = [x for x in d[k] if r.random() > 0.05]
        d[k] = [{**x, **new(x)} if r.random() < 0.1 else x for x in xs] + [x for x in xs if r.random() < 0.03 and k != "spans"]
    # A line's spans have numbers of their own.
    d["spans"] = list({(x["page"], x["line"], x["seg"]): x for x in d["spans"]}.values())
    return d


def tables(d):
    return {k: d.select("doc", F.explode(k).alias("x")).select("doc", "x.*") for k in audit.FACTS}


def flags(df):
    return Counter((r["doc"], r["invariant"], r["page"], r["severity"], tuple(sorted(r["detail"].items()))) for r in df.collect())


@pytest.fixture(scope="module")
def documents(spark):
    return card.documents(spark, PLACE).where("doc % 3 = 0").localCheckpoint()


def test_documents_have_the_sections_and_the_facts(spark, documents):
    rows = lambda df, c: Counter(map(str, df.select(*c).collect()))
    assert rows(documents, ["doc", "text"]) == rows(card.sections(spark, PLACE).where("doc % 3 = 0"), ["doc", "text"])
    facts = card.page_facts(spark, PLACE)
    for k, t in tables(documents).items():
        assert rows(t, t.columns) == rows(facts[k].where("doc % 3 = 0"), t.columns)


def test_odd_documents_get_the_same_flags(spark, documents):
    r = random.Random(7)
    rows = [odd(x, r) for x in documents.where("size(expected) < 40").collect()]
    d = spark.createDataFrame([tuple(x[c] for c in documents.columns) for x in rows], documents.schema.simpleString()).localCheckpoint()
    labels = card.LABELS[:2]
    want = flags(gates.collect(projection.project_all(d, "doc", "text"), tables(d), card.COLORS, spark.createDataFrame([(x,) for x in labels], "label string")))
    got = flags(audit.flags_of(audit.audit(d, card.COLORS, labels)))
    assert {x[1] for x in want} == {"T1", "L1", "P1", "F1", "S1", "S2", "S3", "ST1", "ST2", "ST3", "FN1"}
    assert any(dict(x[4]).get("op") == "displaced" for x in want) and sum(want.values()) > 1000
    assert got == want


def test_changed_texts_get_their_new_flags_only(spark, documents):
    d = documents.withColumn("kind", F.element_at(F.array(*map(F.lit, card.KINDS)), (F.col("doc") % 11 + 1).cast("int"))).withColumn("pick", F.col("doc"))
    d = d.withColumn("spans", F.expr("filter(spans, x -> x.page <> 2)")).withColumn("text", F.when(F.col("doc") != 9, F.col("text"))).localCheckpoint()
    one = lambda df: {x["doc"]: [(f["invariant"], f["page"], f["severity"], f["detail"]) for f in x["flags"]] for x in df.collect()}
    m = {x["doc"]: t for x in d.collect() if x["text"] is not None and (t := mutate.mutated(x["text"], x["kind"], x["pick"])) is not None}
    old = one(audit.audit(d, card.COLORS, card.LABELS))
    new = one(audit.audit(spark.createDataFrame([(*x[:1], m[x["doc"]], *x[2:]) for x in d.collect() if x["doc"] in m], d.schema.simpleString()), card.COLORS, card.LABELS))
    got = one(audit.audit(d, card.COLORS, card.LABELS, ("kind",), mutate.mutated, ("kind", "pick")))
    assert got == {i: [f for f in fs if (f[0], f[3]) not in [(o[0], o[3]) for o in old[i]]] for i, fs in new.items()} and 9 not in got and any(old.values())


@pytest.mark.parametrize("s", ["a-  b", "é- b", "²- b", "é- b", "Ⓐ- b", "_- b", "- b", "a-\x1cb", "a- b", "x\x1cy z\x85w", "●a ‣●b ●", "ﬀ﻿- a", "­", "‘x’ a‑b", "a- B a- b- c", ""])
def test_keys_are_those_of_the_columns(spark, s):
    row = spark.range(1).select(T.normalize(F.lit(s)).alias("n"), T.tokens(F.lit(s)).alias("t"), gates.key(F.lit(s)).alias("k")).first()
    assert (audit.normal(s), audit.words(s), audit.key(s)) == (row["n"], row["t"], row["k"])


@pytest.mark.parametrize("name", ["gate_clean", "mutation_recall"])
def test_all_checks_are_one_pass(spark, name):
    plan = getattr(card, name)(spark, PLACE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 2 and "Join" not in plan and "Window" not in plan and plan.count("FileScan") == 1
