"""What both vector searches share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def finite(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows (id, v array<double>) whose id and vector are there and hold no null, NaN or infinite component."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where("id is not null and v is not null").where(~bad)
