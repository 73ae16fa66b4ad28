"""Queries of windows, calendars and periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.operators import intervals
from gristmill.plans.registry import query, table

#: Parameter: first and last day of campaigns; they overlap, and one passes the new year.
CALENDAR = {"spring": (3, 1, 5, 31), "summer": (5, 20, 6, 20), "autumn": (8, 15, 11, 11), "double": (11, 1, 11, 11), "new_year": (12, 15, 2, 10)}
_CALENDAR = ", ".join(f"('{n}', {', '.join(map(str, w))})" for n, w in CALENDAR.items())


@query(f"""WITH y AS (SELECT CAST(unnest(generate_series(min(year(o_orderdate)) - 1, max(year(o_orderdate)))) AS INTEGER) AS year FROM orders),
w AS (SELECT name, year, make_date(year, m1, d1) AS opens, make_date(year + CAST((m2, d2) < (m1, d1) AS INTEGER), m2, d2) AS closes FROM y CROSS JOIN (VALUES {_CALENDAR}) c(name, m1, d1, m2, d2))
SELECT name AS campaign, year, o_orderstatus AS kind, count(*) AS orders, min(o_orderkey) AS first_order, max(o_orderkey) AS last_order FROM w JOIN orders ON CAST(o_orderdate AS DATE) BETWEEN opens AND closes GROUP BY ALL""")
def q_campaign_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by the campaigns in whose windows they fall, for every year of the table."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    years = orders.agg(F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("b")).where("a is not null").select(F.explode(F.sequence(F.col("a") - 1, F.col("b"))).alias("year"))
    met = intervals.interval_join(orders, intervals.calendar_windows(years, CALENDAR), "o_orderdate", "opens", "closes", 86_400)
    return met.groupBy(F.col("name").alias("campaign"), "year", F.col("o_orderstatus").alias("kind")).agg(F.count(F.lit(1)).alias("orders"), F.min("o_orderkey").alias("first_order"), F.max("o_orderkey").alias("last_order"))


@query("""SELECT e.event_id, e.event_type, count(*) AS open_windows, min(w.event_id) AS first_window, max(w.event_id) AS last_window FROM events e JOIN events w ON w.event_type = 'error'
AND epoch_us(e.ts) >= epoch_us(w.ts) AND epoch_us(e.ts) < epoch_us(w.ts) + CAST(round(w.value * 60000000) AS BIGINT) WHERE e.event_type <> 'error' GROUP BY ALL""")
def q_open_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events inside windows that errors open, each for as many minutes as its value."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    opened = F.unix_micros(F.col("ts").cast("timestamp"))
    windows = events.where("event_type = 'error'").select(F.col("event_id").alias("window_id"), F.col("ts").alias("opens"), F.timestamp_micros(opened + F.round(F.col("value") * 60_000_000).cast("long")).alias("closes"))
    met = intervals.stabbed(events.where("event_type <> 'error'").select("event_id", "ts", "event_type"), windows, "ts", "opens", "closes", "window_id")
    return met.groupBy("event_id", "event_type").agg(F.sum("windows").alias("open_windows"), F.min("first_name").alias("first_window"), F.max("last_name").alias("last_window"))


_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


@query(f"""WITH e AS (SELECT event_id, CASE WHEN {_K} % 5 <> 0 THEN ts END AS time, CASE WHEN {_K} % 10 <> 0 THEN CAST(ts AS DATE) END AS file_date FROM events), t AS (SELECT event_id, coalesce(time, CAST(file_date AS TIMESTAMP)) AS moment, CASE WHEN time IS NOT NULL THEN 'event' WHEN file_date IS NOT NULL THEN 'file_date' ELSE 'unknown' END AS time_source FROM e)
SELECT time_source, count(*) AS events, min(event_id) AS first_id, max(event_id) AS last_id FROM t WHERE moment IS NULL OR moment >= TIMESTAMP '2024-01-08' AND moment < TIMESTAMP '2024-01-15' GROUP BY ALL""")
def q_period_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a week; a fifth has no time of its own, and half of those no file date either."""
    k = F.get_json_object("props", "$.k").cast("int")
    rows = table(spark, sf_dir, "events").select("event_id", F.when(k % 5 != 0, F.col("ts")).alias("time"), F.when(k % 10 != 0, F.to_date("ts")).alias("file_date"))
    kept = intervals.within_period(rows, "time", "file_date", F.lit("2024-01-08"), F.lit("2024-01-15"))
    return kept.groupBy("time_source").agg(F.count(F.lit(1)).alias("events"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query("""WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS rows FROM events WHERE event_type = 'purchase' AND value > 60 GROUP BY 1), s AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE event_type = 'error' AND value > 120),
j AS (SELECT day, coalesce(rows, 0) AS n, coalesce(rows >= 2, false) AS good, s.day IS NOT NULL AS held FROM (SELECT CAST(unnest(generate_series(DATE '2023-12-25', DATE '2024-02-04', INTERVAL 1 DAY)) AS DATE) AS day) LEFT JOIN d USING (day) LEFT JOIN s USING (day)),
c AS (SELECT count(*) AS expected_days, count(*) FILTER (good) AS healthy_days, count(*) FILTER (NOT good AND NOT held AND n > 0) AS degraded_days, count(*) FILTER (NOT good AND NOT held AND n = 0) AS missing_days, count(*) FILTER (NOT good AND held) AS exempt_days, array_to_string(coalesce(list(CAST(day AS VARCHAR) ORDER BY day) FILTER (NOT good AND NOT held AND n = 0), []), ' ') AS missing_dates FROM j)
SELECT *, round(healthy_days / expected_days, 4) AS coverage_ratio, round((healthy_days + degraded_days) / expected_days, 4) AS raw_ratio, CASE WHEN (healthy_days + degraded_days) / expected_days >= 0.85 THEN 'normal' WHEN (healthy_days + degraded_days) / expected_days >= 0.7 THEN 'degraded' ELSE 'failing' END AS status FROM c""")
def q_coverage_exemptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage by days of large purchases; days with a very large error count as stopped on purpose."""
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    days = events.where("event_type = 'purchase' and value > 60").groupBy("day").agg(F.count(F.lit(1)).alias("rows"))
    out = intervals.coverage_with_exemptions(days, events.where("event_type = 'error' and value > 120"), "2023-12-25", "2024-02-04", 2)
    return out.withColumn("missing_dates", F.array_join("missing_dates", " "))
