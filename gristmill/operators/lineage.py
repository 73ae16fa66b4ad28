"""Cutting the lineage of loops, in the folder that driver and executors share, and keeping long expressions apart."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder serves in local mode, as in tests, alone."""
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isEmpty():
        given = spark.conf.get("spark.checkpoint.dir", None)
        if not given and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(given or tempfile.mkdtemp(prefix="spark-"))
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
    return held.get()


def new_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder."""
    return f"{_shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder, once, and read from there: it survives lost executors.

    Loops ``drop`` what no plan reads any more; what a returned frame reads stays in the folder.
    """
    spark = df.sparkSession
    path = new_path(spark, "cut")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_at = path
    return out


def drop(*frames: DataFrame) -> None:
    """Deletes tables that ``cut`` wrote and that no plan reads any more."""
    for df in frames:
        at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._cut_at)
        at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to several partitions a core, which stay apart however few their bytes are: for groups that
    are much work, not much data."""
    spark = df.sparkSession
    parts = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(parts, *keys)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with further columns, each computed once however often what is built on them names them.

    They pass through a one-row inner table, into which the optimizer copies no expression and pushes no filter; long
    ladders would multiply otherwise.
    """
    made = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.select("*", made.alias("_once")).select(*df.columns, *[F.col("_once")[n].alias(n) for n in columns])
