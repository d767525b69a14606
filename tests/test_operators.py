import pytest
from pyspark.sql import functions as F

from leafgauge.functions import text as T
from leafgauge.operators import bags, islands


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


def test_hyphens(spark):
    assert one(spark, T.join_wraps(F.lit("self- verify"), False)) == "selfverify"
    assert one(spark, T.join_wraps(F.lit("self- verify"), True)) == "self-verify"
    assert one(spark, T.join_wraps(F.lit("single- and two"), False)) == "single- and two"
    assert one(spark, T.normalize(F.lit("self-  made éﬁ​“q”"))) == 'self-made éfi"q"'


def test_slash_is_stripped_by_the_bag_query(spark):
    rows = spark.createDataFrame([(1, "u"), (1, "u"), (2, "v")], "page int, uri string")
    out = bags.bag_deficit(rows, rows.limit(1), ["page", "uri"]).collect()
    assert sum(r["deficit"] for r in out) == 2


@pytest.mark.parametrize(("xs", "want"), [([72, 75, 78, 90, 93], [72, 78, 90]), ([], []), ([5], [5])])
def test_tiers_chain_to_their_start(spark, xs, want):
    assert one(spark, islands.tiers(F.array(*map(F.lit, xs)).cast("array<double>"))) == want


def test_notes_are_pushed_down(spark):
    assert one(spark, islands.spaced(F.array(*map(F.lit, [10, 12, 40])), 19)) == [10, 29, 48]


def test_outermost(spark):
    xs = F.array(*(F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in [(0, 5), (1, 3), (5, 9), (0, 2)]))
    assert [(r["start"], r["end"]) for r in one(spark, islands.outermost(xs))] == [(0, 5), (5, 9)]


def test_visual_rows(spark):
    rows = spark.createDataFrame([(1, 0.0, 0.0, 5.0, 10.0), (1, 6.0, 2.0, 9.0, 11.0), (1, 0.0, 20.0, 4.0, 30.0)], "page int, x0 double, y0 double, x1 double, y1 double")
    got = sorted((r["row"], r["n"], r["x1"]) for r in islands.visual_rows(rows, ["page"]).collect())
    assert got == [(0, 2, 9.0), (1, 1, 4.0)]


def test_near_sum_goes_by_page_number(spark):
    rows = spark.createDataFrame([(1, 1), (2, 2), (4, 4)], "page int, n int").withColumn("g", F.lit(1))
    got = [r["s"] for r in rows.withColumn("s", bags.near_sum(F.col("n"), "page", ["g"])).orderBy("page").collect()]
    assert got == [3, 3, 4]


def test_smart_quotes(spark):
    assert one(spark, T.smart_quotes(F.lit("\"a\" ('b') '90s it's"))) == "“a” (‘b’) ’90s it’s"


def test_slices_snap_to_the_line(spark):
    from leafgauge.operators import facts

    md = "a<!-- p.1 -->b\n- <!-- p.2 -->item\nlong line before<!-- p.3 -->c\n   <!-- p.4 -->d"
    got = facts.page_slices(spark.createDataFrame([(md,)], "md string"), "md").orderBy("ord").collect()
    assert [(r["page"], r["slice"]) for r in got] == [(1, "ab\n"), (2, "- item\nlong line before"), (3, "c\n   "), (4, "d")]


def test_quotes_in_pages(spark):
    html = '<p>"a" <b>it</b>\'s "<i>b</i>"</p>"c" <pre>"d"</pre>"'
    assert one(spark, T.smart_quotes_html(F.lit(html))) == "<p>“a” <b>it</b>’s “<i>b</i>”</p>“c” <pre>\"d\"</pre>”"


def test_every_entity(spark):
    assert one(spark, T.decoded(F.lit("&amp;&eacute;&#65;&nbsp;&zwj;x"))) == "&éA\xa0‍x" and one(spark, T.decoded(F.lit("plain"))) == "plain"
