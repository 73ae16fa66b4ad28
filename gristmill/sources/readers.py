"""Readers and writers of batches, ledgers and pools."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gristmill.operators import dedup


def read_envelopes(spark: SparkSession, paths: str | Sequence[str], schema: StructType, field: str = "articles") -> DataFrame:
    """Rows of JSON files that hold a bare list or an object with a list in ``field``; other files give no rows."""
    ddl = schema.simpleString()
    text = spark.read.text(paths, wholetext=True)
    bare = F.from_json("value", f"array<{ddl}>")
    inside = F.from_json("value", f"struct<{field}:array<{ddl}>>")[field]
    rows = F.when(F.ltrim("value").startswith("["), bare).otherwise(inside)
    return text.select(F.col("_metadata.file_path").alias("file"), F.posexplode(rows).alias("pos", "row")).select("file", "pos", "row.*")


def read_ledger(spark: SparkSession, path: str, schema: StructType, key: str | None = None) -> DataFrame:
    """Lines of a JSON-lines ledger; broken lines are left out. With ``key``, the last line of each key, by file and place
    in it; lines without key are left out then."""
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"), "value")
    rows = text.select("_file", "_block", "_line", F.from_json("value", schema.simpleString(), {"mode": "PERMISSIVE"}).alias("r"), F.try_parse_json("value").isNotNull().alias("_ok")).where("_ok and r is not null")
    if key is None:
        return rows.select("r.*")
    row = F.struct("_file", "_block", "_line", "r")
    last = rows.where(F.col("r")[key].isNotNull() & (F.col("r")[key].cast("string") != "")).groupBy(F.col("r")[key].alias("_key")).agg(F.max(row).alias("m"))
    return last.select("m.r.*")


def seen_or_bootstrap(df: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """Rows that the ledger of seen keys lacks, as ``newly_discovered``; all rows as ``bootstrap_seen`` where it is empty.

    Adds ``freshness``. Whether the ledger is empty is one row that is joined, not a decision of the driver.
    """
    known = ledger.select(key).where(F.col(key).isNotNull()).distinct()
    empty = known.agg((F.count(F.lit(1)) == 0).alias("_bootstrap"))  # one row
    fresh = df.join(known, key, "left_anti").crossJoin(F.broadcast(empty))
    return fresh.withColumn("freshness", F.when(F.col("_bootstrap"), "bootstrap_seen").otherwise("newly_discovered")).drop("_bootstrap")


def read_days(spark: SparkSession, main: str, fallback: str, start: str, end: str, archived: str | None = None) -> DataFrame:
    """Partitions ``dt`` from ``start`` to ``end`` of the table ``main``, and of ``fallback`` for days that it lacks.

    Adds ``_file_date``, the partition's day. Rows for which the condition ``archived`` holds are left out.
    """
    between = F.col("dt").between(F.lit(start), F.lit(end))
    first, second = spark.read.parquet(main).where(between), spark.read.parquet(fallback).where(between)
    out = first.unionByName(second.join(first.select("dt").distinct(), "dt", "left_anti"), allowMissingColumns=True)
    out = out.withColumn("_file_date", F.col("dt").cast("date"))
    return out.where(~F.coalesce(F.expr(archived), F.lit(False))) if archived else out


def first_level(levels: Sequence[DataFrame], key: str) -> DataFrame:
    """Rows of the first of several tables that has the key, from the finest level to the coarsest; adds ``level``."""
    out = None
    for k, df in enumerate(levels):
        df = df.withColumn("level", F.lit(k))
        out = df if out is None else out.unionByName(df.join(out.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)
    if out is None:
        raise ValueError("no levels")
    return out


def candidates(sources: Sequence[tuple[str, DataFrame]], known: DataFrame, key: str, order: str, exempt: Sequence[str] = ()) -> DataFrame:
    """First row of each key over several sources in order of priority, without keys that are known already; rows of the
    ``exempt`` sources may be known. Adds ``source_file`` and ``priority``."""
    rows = dedup.union_sources(sources)
    rows = dedup.first_wins(rows, F.col(key), ["priority", order])
    free = F.col("source_file").isin(*exempt) if exempt else F.lit(False)
    return rows.where(free).unionByName(rows.where(~free).join(known.select(key).distinct(), key, "left_anti").select(*rows.columns))


def write_outcomes(df: DataFrame, path: str, outcomes: Sequence[str], outcome: str = "outcome") -> None:
    """One Parquet table for each outcome under ``path``; the rows are computed once, as partitions of one write."""
    df.where(F.col(outcome).isin(*outcomes)).write.partitionBy(outcome).mode("overwrite").parquet(path)


def markdown(df: DataFrame, title: str, section: str, order: Sequence[str], line: str) -> DataFrame:
    """A report as one text a section: heading and bullet lines in order. Sections are top-k reports of bounded size."""
    held = df.groupBy(section).agg(F.array_sort(F.collect_list(F.struct(*order, F.col(line).alias("_line")))).alias("_rows"))
    body = F.array_join(F.transform("_rows", lambda r: F.concat(F.lit("- "), r["_line"])), "\n")
    return held.select(section, F.concat(F.lit(f"# {title}\n\n## "), section, F.lit("\n"), body, F.lit("\n")).alias("text"))


def write_pools(df: DataFrame, path: str, pool: str = "final_pool", day: str = "dt") -> None:
    """Pools as partitions of one table; a day's pools are replaced as a whole."""
    df.write.partitionBy(day, pool).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def append_ledger(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def resume(df: DataFrame, checkpoint: DataFrame, key: str) -> DataFrame:
    """Rows that the checkpoint (key, ...) doesn't hold yet."""
    return df.join(checkpoint.select(key).distinct(), key, "left_anti")


def resume_status(written: DataFrame, expected: DataFrame, day: str, since: datetime) -> DataFrame:
    """For each ``day`` of ``expected`` (day, rows) whether what is ``written`` (read from files) of it can be kept.

    Returns day, rows, valid (as many rows as expected, and some), fresh (all its files were written at ``since`` or
    later) and resume (both). Counts and the files' times come from one pass; a day without rows is neither.
    """
    at = F.col("_metadata.file_modification_time")
    held = written.groupBy(F.col(day).alias("_day")).agg(F.count(F.lit(1)).alias("_held"), F.min(at).alias("_oldest"))
    out = expected.join(held, expected[day].eqNullSafe(F.col("_day")), "left")
    n = F.coalesce("_held", F.lit(0))
    valid, fresh = (n > 0) & (n == F.col("rows")), F.coalesce(F.col("_oldest") >= F.lit(since), F.lit(False))
    return out.select(day, n.alias("rows"), valid.alias("valid"), fresh.alias("fresh"), (valid & fresh).alias("resume"))
