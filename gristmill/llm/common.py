"""Helpers shared by the corpus operators."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; works for any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session (``spark.checkpoint.dir``), as a URI.

    Where none is given, a temporary one is set in local mode, as in tests; on a cluster that is an error, since executors
    don't share local folders.
    """
    given = spark.conf.get("spark.checkpoint.dir", None)
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isEmpty():
        if not given and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(given or tempfile.mkdtemp(prefix="spark-"))
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
    return held.get()


_WRITTEN: list[str] = []


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; ``clean_up`` deletes it."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def clean_up(spark: SparkSession) -> None:
    """Deletes all that the corpus operators have written to the shared folder in this process.

    Results of operators that haven't been written elsewhere can't be read after that.
    """
    while _WRITTEN:
        _delete(spark, _WRITTEN.pop())


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def durable(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read from there: it survives lost executors and cuts the lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def columns_not_in(df: DataFrame, *wanted: str) -> list[str]:
    """Names like ``wanted`` that clash with no column of ``df`` (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def _rank(round_no: int, col: str) -> Column:
    return F.col(col) if round_no < 2 else F.xxhash64(F.lit(round_no), F.col(col))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder. It survives lost executors, and cuts both lineage and what the
    optimizer has gathered about the plan, which ``checkpoint`` keeps and loops multiply."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Deletes tables that ``stored`` wrote and that no plan reads any more; others are left alone."""
    for df in tables:
        if path := getattr(df, "_stored_at", None):
            _delete(df.sparkSession, path)
            if path in _WRITTEN:
                _WRITTEN.remove(path)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph: ``edges`` (a, b: bigint) to rows (id, component).

    ``component`` is the smallest id of the component. In each round every vertex hooks on to its first neighbour and
    the edges are contracted: first is the smallest id at the start, which settles stars at once, and later a
    pseudo-random order drawn anew each round, so that the rounds stay logarithmic for long chains too. Only aggregates
    with map-side combining and equi-joins on vertex ids are used; nothing is collected. Null ends and loops are
    ignored; an empty table gives an empty result.
    """
    start = live = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    hooks: list[DataFrame] = []
    while not live.isEmpty():
        both = live.union(live.select("b", "a"))
        first = F.min(F.struct(_rank(len(hooks), "b").alias("r"), F.col("b").alias("v")))
        hook = both.groupBy("a").agg(first.alias("m")).select(F.col("a").alias("label"), F.when(F.col("m.r") < _rank(len(hooks), "a"), F.col("m.v")).otherwise(F.col("a")).alias("to"))
        hooks.append(stored(hook, "hooks"))
        at = lambda end, to: hooks[-1].select(F.col("label").alias(end), F.col("to").alias(to))
        moved = live.join(at("a", "x"), "a").join(at("b", "y"), "b").select("x", "y")
        contracted = stored(moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        discard(live)
        live = contracted
    if not hooks:
        return start.select(F.col("a").alias("id"), F.col("b").alias("component"))
    label = hooks[0].select(F.col("label").alias("id"), F.col("to").alias("label"))
    for hook in hooks[1:]:
        label = label.join(hook, "label", "left").select("id", F.coalesce("to", "label").alias("label"))
    label = stored(label, "labels")
    discard(live, *hooks)
    return label.join(label.groupBy("label").agg(F.min("id").alias("component")), "label").select("id", "component")
