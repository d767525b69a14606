"""Readers and writers, through files."""

import json
import subprocess

from pyspark.sql import functions as F

from leafgauge import sinks
from leafgauge.sources import pages, sections

RECORD = {
    "spans": [{"text": "a", "size": 11, "bold": True, "color": "#000000", "font": "X", "bbox": [1, 2, 3, 4], "flags": 16, "line": 0, "block": 0, "zone": "body"}],
    "links": {"uri": [{"anchor": "u", "uri": "http://x/", "rects": [[0, 0, 1, 1]]}], "goto": [{"anchor": "g", "dest_page": 2, "dest_y": 5.0}]},
    "pills": [{"bbox": [0, 0, 5, 5], "color": "#aa0000", "text": "High"}], "boxes": [], "rules": [{"bbox": [0, 9, 5, 9], "color": "#000000"}],
    "footnotes": {"1": "one", "cont": "tail"}, "image_rects": [], "n_raster_images": 0,
}


def test_page_records(spark, tmp_path):
    (tmp_path / "o.json").write_text(json.dumps([RECORD, RECORD]))
    r = pages.page_records(spark, str(tmp_path / "o.json"))
    s = pages.page_spans(r).collect()
    assert [(x["page"], x["text"], x["x1"], x["bold"]) for x in s] == [(1, "a", 3.0, True), (2, "a", 3.0, True)]
    assert sorted((x["page"], x["kind"], x["anchor"]) for x in pages.page_links(r).collect()) == [(1, "goto", "g"), (1, "uri", "u"), (2, "goto", "g"), (2, "uri", "u")]
    assert sorted((x["class"], x["color"]) for x in pages.page_drawings(r).where("page = 1").collect()) == [("pill", "#aa0000"), ("rule", "#000000")]
    assert sorted((x["n"] or 0, x["text"]) for x in pages.page_notes(r).where("page = 1").collect()) == [(0, "tail"), (1, "one")]


def test_tables_and_accepted(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"7": [{"bbox": [1, 90.04, 2, 20], "html": "<table> <tr> <td>a  b</td></tr></table>"}]}))
    t = pages.page_tables(spark, str(tmp_path / "t.json"))
    assert t.first()["html"] == "<table><tr><td>a b</td></tr></table>"
    f = pages.from_bottom(t, F.lit(100.0)).first()
    assert (f["page"], f["y0"], f["y1"]) == (7, 10.0, 80.0)
    (tmp_path / "a.json").write_text(json.dumps([{"invariant": "T1", "page": 3, "why": "x"}, {"invariant": "T1", "page": 3}]))
    assert [tuple(r) for r in pages.accepted(spark, str(tmp_path / "a.json")).collect()] == [("T1", 3)]


def test_cards_and_pages(spark, tmp_path):
    for vendor, date in (("a", "2024-01-02"), ("b", "2025-01-02")):
        d = tmp_path / "cards" / vendor / "x"
        d.mkdir(parents=True)
        (d / "meta.yaml").write_text(f'title: "Card {vendor}"\nrelease_date: {date}\nmodels:\n  - m\n')
        (d / "index.html").write_text("<h1>t</h1>")
    got = pages.cards(spark, str(tmp_path / "cards")).collect()
    assert [(r["vendor"], r["slug"], r["title"], r["description"]) for r in got] == [("b", "x", "Card b", None), ("a", "x", "Card a", None)]
    assert sorted(r["url"] for r in pages.built_pages(spark, str(tmp_path / "cards")).collect()) == ["/a/x/", "/b/x/"]


def test_sections_of_a_commit(spark, tmp_path):
    git = lambda *a: subprocess.run(["git", "-C", str(tmp_path), "-c", "user.name=t", "-c", "user.email=t@t", *a], check=True, capture_output=True)
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "01.md").write_text("<!-- source: source.pdf pages 003-009 -->\n# First *one*\n<!-- p.4 -->\nx <table><tr></tr></table> <table></table>\n")
    git("init", "-q")
    git("add", "-A")
    git("commit", "-qm", "x")
    (tmp_path / "s" / "01.md").write_text("changed")
    got = sections.sections_at(spark, str(tmp_path), "HEAD", "s")
    assert [(r["file"], r["page_start"], r["page_end"]) for r in got.collect()] == [("01.md", 3, 9)]
    assert sections.first_headings(got).first()["heading"] == "First*one*"
    assert [tuple(r) for r in sections.table_pages(got).collect()] == [("01.md", 4)]
    assert sections.read_sections(spark, str(tmp_path / "s")).first()["text"] == "changed"


def test_figures_drawn_twice(spark):
    figures = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (2, 0, "d"), (2, 1, "e")], "page int, k int, file string")
    files = spark.createDataFrame([("a", b"x"), ("b", b"x"), ("c", b"y")], "file string, content binary")
    assert sorted(r["file"] for r in pages.distinct_neighbours(figures, files).collect()) == ["a", "c", "d", "e"]


def test_writers(spark, tmp_path):
    blocks = spark.createDataFrame([("s1", 2, 4, "two"), ("s1", 1, 3, "one"), ("s2", 1, 5, "x")], "section string, k int, page int, text string")
    sinks.write_sections(blocks, str(tmp_path / "sections"))
    assert next((tmp_path / "sections" / "section=s1").glob("*.txt")).read_text() == "<!-- source: source.pdf pages 003-004 -->\n\none\ntwo\n"
    texts = spark.createDataFrame([("s1", "a<!-- p.1 -->b<!-- p.2 -->c"), ("s2", "<!-- p.2 -->d")], "section string, text string")
    sinks.write_slices(texts, str(tmp_path / "slices"))
    assert next((tmp_path / "slices" / "page=2").glob("*.txt")).read_text() == "c\n\nd\n"
    flags = spark.createDataFrame([(1, "L1", 2, "major", {"b": "x", "a": "y"}), (1, "L1", 3, "major", {"a": "z"})], "doc bigint, invariant string, page bigint, severity string, detail map<string,string>")
    sinks.write_flags(flags, str(tmp_path / "flags"))
    back = spark.read.json(str(tmp_path / "flags"))
    assert sorted(r["detail"] for r in back.collect()) == ['{"a":"y","b":"x"}', '{"a":"z"}']
    got = sinks.report(flags, 1).collect()
    assert [(r["invariant"], r["n"], r["samples"]) for r in got] == [("L1", 2, ['p.2 {"a":"y","b":"x"}'])]
    assert sinks.write_facts(blocks, str(tmp_path / "facts")).where("page = 3").count() == 1
    sinks.write_json(blocks, str(tmp_path / "json"))
    sinks.write_texts(texts, "section", "text", str(tmp_path / "texts"))
    assert spark.read.json(str(tmp_path / "json")).count() == 3 and next((tmp_path / "texts" / "section=s2").glob("*.txt")).read_text() == "<!-- p.2 -->d\n"
    images = spark.createDataFrame([(1, 2, "b"), (1, 1, "a")], "page int, num int, file string")
    assert sinks.figures_map(images).first()["files"] == ["a", "b"]
