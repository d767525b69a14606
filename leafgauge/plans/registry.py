"""Where queries and their SQL are kept."""

from __future__ import annotations

QUERIES, SQL = {}, {}


def query(sql: str | None):
    """Register a query (spark, sf_dir) under its name, with DuckDB SQL that gives the same rows where SQL can."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
