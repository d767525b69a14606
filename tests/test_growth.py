"""Work that must not grow faster than its input: large single values, which took quadratic time before."""

import time

from pyspark.sql import functions as F

from leafgauge.functions import text as T
from leafgauge.operators import bags, table_spans, tables


def test_once_evaluates_a_value_once_and_large_tables_end(spark):
    rows = "".join(f"<tr><td>a{i} b{i + 1}</td><td>x</td></tr>" for i in range(3000))
    began = time.time()
    for change in (tables.uncascade, tables.promote_split_leads):
        html = spark.createDataFrame([(f'<table><tr><th rowspan="2">h</th><td>y</td></tr>{rows}</table>',)], "h string")
        assert html.select(F.size(change(tables.parse(F.col("h")))).alias("n")).collect()[0]["n"] == 3001
    assert time.time() - began < 60


def test_repairs_of_a_long_table_end():
    spans = [table_spans.Span(f"{j}w{r}", 100.0 + 150 * j, 40.0 * r, 130.0 + 150 * j, 40.0 * r + 10, False, "body") for r in range(1500) for j in range(3)]
    rows = [[table_spans.Cell("td", "", x) for x in (f"0w{r} 1w{r}", "", f"2w{r}")] for r in range(1500)]
    began = time.time()
    got = table_spans.repaired(rows, spans)
    assert [[c.html for c in r] for r in got] == [[f"{j}w{r}" for j in range(3)] for r in range(1500)]
    assert time.time() - began < 30


def test_quotes_of_a_page_of_many_pieces(spark):
    page = '<p>"a" <b>\'b\'</b> it\'s</p>'
    one = spark.createDataFrame([(page * 500,), (page,), ("",), (None,)], "h string").select(T.smart_quotes_html(F.col("h")).alias("q")).collect()
    assert one[0]["q"] == one[1]["q"] * 500 and one[1]["q"] == "<p>“a” <b>‘b’</b> it’s</p>"
    assert one[2]["q"] == "" and one[3]["q"] is None


def test_left_out_counts_in_one_pass(spark):
    rows = spark.createDataFrame([(1, "a", True), (1, "a", False), (1, "b", True), (2, "a", False), (2, None, False)], "d int, t string, kept boolean")
    got = bags.left_out(rows, F.col("kept"), ["d", "t"])
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [(1, "a", 1), (2, "a", 1), (2, None, 1)]))
    assert "Union" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_facts_come_in_bounded_batches(spark):
    from leafgauge.operators import projection

    md = projection.project_all(spark.createDataFrame([(i, f"<!-- p.{i} -->\n\nword {i}") for i in range(30)] + [(30, None)], "d int, t string"), "d", "t")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
    assert md.where("kind = 'token'").count() == 60 and md.where("d = 30").count() == 0


def test_intervals_are_dealt_out_by_size_and_not_gathered_to_few_tasks(spark):
    from leafgauge.plans import catalog

    assert catalog.interval_merge(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= 16
