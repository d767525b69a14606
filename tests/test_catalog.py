import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from parity import same

from leafgauge.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_and_sql_agree(spark, name):
    same(spark, catalog.QUERIES[name], catalog.SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_query_runs(spark, name):
    assert catalog.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0


def test_visual_rows_of_every_page(spark):
    place, want = "/root/testdata/sf0.001", []
    pages = {}
    for r in catalog.spans(spark, place).where("y1 > y0").collect():
        pages.setdefault(r["page"], []).append(tuple(float(r[k]) for k in ("y0", "x0", "y1", "x1")))
    for page, fragments in pages.items():
        rows = []
        for y0, x0, y1, x1 in sorted(fragments):
            for r in rows[:-5:-1]:
                if (min(r[3], y1) - max(r[1], y0)) / min(r[3] - r[1], y1 - y0) > 0.5:
                    r[:] = [min(r[0], x0), min(r[1], y0), max(r[2], x1), max(r[3], y1), r[4] + 1]
                    break
            else:
                rows.append([x0, y0, x1, y1, 1])
        want += [(page, i, *r) for i, r in enumerate(rows)]
    got = catalog.visual_rows(spark, place).select("page", "row", "x0", "y0", "x1", "y1", "n").collect()
    assert len(pages) > 50 and sorted(map(tuple, got)) == sorted(want)


def test_entry_needs_no_session():
    import subprocess

    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"], cwd=Path(__file__).parents[1], capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
