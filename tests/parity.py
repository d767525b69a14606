"""Compare a query with its SQL in DuckDB, as sorted rows."""

import math
from pathlib import Path

import duckdb
import pandas as pd

PLACE = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if v is pd.NaT:
        return None
    return pd.Timestamp(v).isoformat() if hasattr(v, "isoformat") else v


def same(spark, query, sql, place=PLACE):
    c = duckdb.connect()
    for p in Path(place).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    df = query(spark, place)
    names = sorted(df.columns)
    r = c.execute(sql)
    theirs = [x[0] for x in r.description]
    assert sorted(theirs) == names
    at = [theirs.index(x) for x in names]
    want = sorted((tuple(plain(row[i]) for i in at) for row in r.fetchall()), key=str)
    got = sorted((tuple(plain(row[x]) for x in names) for row in df.collect()), key=str)
    assert got == want
