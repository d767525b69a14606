"""Arrow plumbing: one Python function over the texts of bounded batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship

#: Rows that a Python worker holds at once, and characters after which a batch is handed on.
ROWS, CHARS = 1000, 4_000_000


def small_batches(df: DataFrame) -> DataFrame:
    """Let Spark hand Python workers at most ROWS rows at once."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS))
    return df


def by_rows(df: DataFrame, id_col: str, text_col: str, run: Callable, out: dict[str, str]) -> DataFrame:
    """Rows (id_col, *out): run gets a list of texts (null: None) and returns a list for each name of out."""
    df = small_batches(df).select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    kind = df.schema["i"].dataType
    schema = T.StructType([T.StructField("i", kind), *T._parse_datatype_string(", ".join(f"{k} {v}" for k, v in out.items())).fields])

    def work(batches):
        import pyarrow as pa

        types = {"binary": pa.binary(), "string": pa.string(), "bigint": pa.int64(), "double": pa.float64(), "int": pa.int32(), "array<bigint>": pa.list_(pa.int64())}
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            a = 0
            while a < len(texts):
                b, size = a, 0
                while b < len(texts) and size <= CHARS:
                    size += len(texts[b] or "")
                    b += 1
                got = run(texts[a:b])
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), *(pa.array(got[k], types[v]) for k, v in out.items())], ["i", *out])
                a = b

    return df.mapInArrow(work, schema).withColumnRenamed("i", id_col)
