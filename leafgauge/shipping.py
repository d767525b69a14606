"""Hand the package and bounded work to the executors, which need not have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame


#: Rows that a Python worker holds at once, and MB of rows that a task gets.
ROWS, TASK_MB = 1000, 32


def parts(df: DataFrame) -> int:
    """Partitions for heavy work on df: as many as its size asks for, and enough for every core even where df is small."""
    spark = df.sparkSession
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")), size // (TASK_MB << 20) + 1)


def shipped(df: DataFrame) -> DataFrame:
    """df, after its session's executors got this package, once for each application, and at most ROWS rows at once."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS))
    context = df.sparkSession.sparkContext
    if not getattr(context, "_leafgauge_shipped", False):
        top = Path(__file__).resolve().parent
        place = Path(tempfile.mkdtemp(prefix="package-"), f"{top.name}.zip")
        with zipfile.ZipFile(place, "w") as z:
            for p in sorted(top.rglob("*.py")):
                z.write(p, p.relative_to(top.parent))
        context.addPyFile(str(place))
        context._leafgauge_shipped = True
    return df
