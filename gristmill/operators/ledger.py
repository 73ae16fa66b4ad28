"""Keyed ledgers: latest state, novelty fold over a batch, rebuild from a log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(log: DataFrame, key: str, seq: str) -> DataFrame:
    """The last row of each key by ``seq``, by an aggregate with map-side combining."""
    row = F.struct(F.col(seq), *[F.col(c) for c in log.columns if c not in (key, seq)])
    found = log.groupBy(key).agg(F.max(row).alias("_last"))
    return found.select(key, *[F.col("_last")[c].alias(c) for c in log.columns if c != key])


def novelty(rows: DataFrame, key: str, seq: str, day: str, fact: str, freshness: str | None = None, near_days: int = 3, stale_days: int = 7) -> DataFrame:
    """Each row against those of its key before it, the ones of its own batch included.

    Adds first_day, last_day (of the row before), gap_days, changed (another fact than the row before), fact_first_day
    and fact_seen (of the run of equal facts), report_count, last_reported, status and eligibility:

    * the first row of a key is ``new_today``; on the first day a changed fact is ``updated_today``, and both are core;
    * later a changed fact is ``updated_today`` (core, reported again); what ``freshness`` calls a republished old fact,
      and what was seen less than ``near_days`` ago, is ``repeated`` (reference); what was seen less than ``stale_days``
      ago is ``ongoing`` (tracking); the rest is ``background`` (archive).
    """
    w = Window.partitionBy(key).orderBy(seq)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.withColumn("first_day", F.min(day).over(so_far)).withColumn("last_day", F.lag(day).over(w))
    out = out.withColumn("gap_days", F.datediff(day, "last_day")).withColumn("changed", ~F.col(fact).eqNullSafe(F.lag(fact).over(w)))
    out = out.withColumn("_first", F.col("last_day").isNull()).withColumn("_again", ~F.col("_first") & F.col("changed"))
    reported = (F.col("first_day") == F.col(day)) | F.col("_again")
    out = out.withColumn("report_count", 1 + F.count_if(F.col("_again") & (F.col("first_day") != F.col(day))).over(so_far))
    out = out.withColumn("last_reported", F.max(F.when(reported, F.col(day))).over(so_far))
    out = out.withColumn("_run", F.count_if("_again").over(so_far))
    of_run = Window.partitionBy(key, "_run").orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = out.withColumn("fact_first_day", F.min(day).over(of_run)).withColumn("fact_seen", F.count(F.lit(1)).over(of_run))
    old = F.coalesce(F.col(freshness) == "republished_old_fact", F.lit(False)) if freshness else F.lit(False)
    status = (
        F.when(F.col("_first"), "new_today")
        .when(F.col("first_day") == F.col(day), F.when(F.col("changed"), "updated_today").otherwise("new_today"))
        .when(F.col("changed"), "updated_today")
        .when(old | (F.col("gap_days") < near_days), "repeated")
        .when(F.col("gap_days") < stale_days, "ongoing")
        .otherwise("background")
    )
    return out.withColumn("status", status).withColumn("eligibility", eligibility(F.col("status"))).drop("_first", "_again", "_run")


def rebuild(log: DataFrame, key: str, day: str, count: str, values: list[str]) -> DataFrame:
    """One row a key: first and last day, highest count, and the latest value of each other column that isn't empty."""
    filled = lambda c: (F.col(c).isNotNull()) & (F.col(c).cast("string") != "")
    last = [F.max(F.when(filled(c), F.struct(F.col(day), F.col(c)))).getField(c).alias(c) for c in values]
    return log.groupBy(key).agg(F.min(day).alias("first_seen"), F.max(day).alias("last_seen"), F.max(count).alias(count), *last)


def eligibility(status: Column) -> Column:
    return F.when(status.isin("new_today", "updated_today"), "core").when(status == "repeated", "reference").when(status == "ongoing", "tracking").otherwise("archive")


def as_of_join(left: DataFrame, right: DataFrame, key: str, at: str, since: str, columns: list[str]) -> DataFrame:
    """``left`` with the values of the latest ``right`` row of its key with ``since`` <= ``at`` (null without one).

    Both sides are merged into one ordered stream a key and carried forward by a running window, so no pair of rows is
    formed and the cost is that of one sort.
    """
    a = left.withColumn("_t", F.col(at)).withColumn("_side", F.lit(1)).withColumn("_v", F.lit(None).cast(right.select(F.struct(*columns)).schema[0].dataType))
    b = right.select(F.col(key), F.col(since).alias("_t"), F.lit(0).alias("_side"), F.struct(*columns).alias("_v"))
    w = Window.partitionBy(key).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = a.unionByName(b, allowMissingColumns=True).withColumn("_v", F.last("_v", ignorenulls=True).over(w))
    return both.where("_side = 1").select(*left.columns, *[F.col("_v")[c].alias(c) for c in columns])
