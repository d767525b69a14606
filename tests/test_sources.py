import json
import struct

from pyspark.sql import functions as F

from leafgauge.sources import sections


def test_sections_and_figures(spark, tmp_path):
    (tmp_path / "a.md").write_text("<!-- source: s.pdf pages 015-035 -->\n# One\n")
    (tmp_path / "b.md").write_text("no header")
    got = {r["file"]: (r["page_start"], r["page_end"]) for r in sections.read_sections(spark, str(tmp_path)).collect()}
    assert got == {"a.md": (15, 35), "b.md": (None, None)}
    (tmp_path / "f.json").write_text(json.dumps({"3": ["x.png", "y.png"], "9": ["z.png"]}, indent=1))
    assert sorted(map(tuple, sections.figures_map(spark, str(tmp_path / "f.json")).collect())) == [(3, 0, "x.png"), (3, 1, "y.png"), (9, 0, "z.png")]


def test_lists_and_registry(spark, tmp_path):
    (tmp_path / "l.txt").write_text("page num type\n-----\n   4   0 image 640 480 rgb 3 8 image no 12 0 72 72 1K 2%\n")
    assert [tuple(r) for r in sections.image_list(spark, str(tmp_path / "l.txt")).collect()] == [(4, 0, "image", 640, 480, "rgb", 3, 8, "image", "no", "12", "0", 72, 72, "1K", "2%")]
    (tmp_path / "m.yaml").write_text('x: 1\nchips:\n  One: "#aabbcc"\n  Two: "#aabbcc"\n  Three: "#000000"\ny: 2\n')
    assert {tuple(r) for r in sections.chip_registry(spark, str(tmp_path / "m.yaml")).collect()} == {("#aabbcc", "Two"), ("#000000", "Three")}


def test_png_header(spark):
    png = b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", 640, 48)
    row = spark.createDataFrame([(bytearray(png),)], "c binary").select(sections.png_size(F.col("c")).alias("s")).first()["s"]
    assert (row["width"], row["height"]) == (640, 48)
