"""Helpers that several operators share."""

from __future__ import annotations

import gc
import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: ASCII white space, which parts words in the contracts: space and U+0009 to U+000D.
SPACE_WORD = "[^\\x20\\x09-\\x0D]+"
#: Upper and lower case A-Z for ``translate``; other letters are left alone.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir; where none is set, a temporary one, on local masters only."""
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    context = spark.sparkContext._jsc.sc()
    if context.getCheckpointDir().isEmpty():
        if not place and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(place or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir().get()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors, once for each application; they need not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_leafgauge_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    place = Path(tempfile.mkdtemp(prefix="package-"), f"{top.name}.zip")
    with zipfile.ZipFile(place, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    context.addPyFile(str(place))
    context._leafgauge_shipped = True


#: Shuffle partitions to a file of a small frame.
SMALL = 8


def cut(df: DataFrame, parts: int | None = None, small: bool = False) -> DataFrame:
    """Compute df once into the shared checkpoint folder; later reads survive lost executors and repeat no work.

    parts: write at most so many files; small: a file for every SMALL of the session's shuffle partitions, for frames that
    are small beside the shuffle they come from and would be thousands of tiny files. What only the cut
    lineage needed, shuffle files above all, goes when the driver's collector sees that it is gone, so it is asked to look.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if small:
        parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // SMALL)
    out = (df.coalesce(parts) if parts else df).checkpoint(eager=True)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal out by keys into as many partitions as the session asks for."""
    ship(df.sparkSession)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)
