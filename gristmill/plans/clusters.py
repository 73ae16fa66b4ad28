"""Queries of clusters that are found row by row, in order of score."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import text as X
from gristmill.functions import times as T
from gristmill.operators import clusters, lineage
from gristmill.operators.lineage import once
from gristmill.plans.events import scored_events
from gristmill.plans.ladders import event_rows
from gristmill.plans.registry import query, table

_PLATFORMS, _COMPANIES, _ACTIONS = ("the", "und", "les", "oui"), ("ver", "que", "lle"), ("ation", "ung", "mente")


def cluster_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events to report, in order of score, with their keys of a period: title and fact are sentences of their article."""
    scored = scored_events(table(spark, sf_dir, "events")).where("priority <> 'ARCHIVE'").select("event_id", "weighted")
    told = event_rows(spark, sf_dir).join(scored, "event_id")
    said = F.concat(X.nz(F.col("title")), X.nz(F.col("fact")))
    told = once(told, platforms=X.keyword_hits(F.col("text"), _PLATFORMS), companies=X.keyword_hits(F.col("text"), _COMPANIES), actions=X.keyword_hits(said, _ACTIONS))
    place = (F.lit(1_000_000) - F.round(F.col("weighted") * 1000)).cast("long") * F.lit(1 << 40) + F.col("event_id")
    return told.select(
        "event_id",
        "ts",
        "weighted",
        "source_name",
        place.alias("place"),
        T.period_id(F.to_date("ts"), "weekly").alias("period"),
        X.period_key(F.col("platforms"), F.col("companies"), F.concat_ws(":", "kind", F.col("user_id") % 50), F.col("actions")).alias("key"),
        X.period_fact_hash(F.col("fact"), F.col("title")).alias("fact"),
        F.array_union("platforms", "companies").alias("entities"),
        "actions",
        X.period_text(F.coalesce(F.nullif(F.col("title"), F.lit("")), F.col("fact"))).alias("title"),
    )


@query()
def q_first_fit_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of a week's events by key, fact, entities with an action, or title, numbered by their best score."""
    met = lineage.cut(clusters.first_fit_clusters(cluster_rows(spark, sf_dir), "period"))
    best = met.groupBy("period", "founder").agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count(F.lit(1)).alias("events"), F.count_distinct("source_name").alias("sources"), F.max("weighted").alias("best"))
    numbered = clusters.number_rows(best, ["period"], [F.col("best").desc(), F.col("founder")])
    name = F.concat(F.lit("PC_"), F.date_format("first_seen", "yyyyMM"), F.lit("_"), F.lpad(F.col("number").cast("string"), 4, "0"))
    return met.join(numbered.select("period", "founder", "events", "sources", "first_seen", "last_seen", name.alias("cluster")), ["period", "founder"]).select("event_id", "period", "founder", "cluster", "events", "sources", "first_seen", "last_seen")
