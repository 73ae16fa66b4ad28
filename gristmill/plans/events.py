"""Queries over events: windows, gates, ledgers, scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import times as T
from gristmill.operators import ledger, reports, scoring
from gristmill.plans.registry import query, table

AS_OF = "2024-01-31 00:00:00"
_AGE = f"CAST(floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(ts)) / 86400000000.0) AS BIGINT)"


@query(f"""SELECT event_type, CASE WHEN ts IS NULL THEN 'unknown_time' WHEN ts > TIMESTAMP '{AS_OF}' THEN 'in_window' WHEN {_AGE} <= 2 THEN 'in_window' WHEN {_AGE} <= 7 THEN 'near_window' ELSE 'old' END AS time_status, count(*) AS rows FROM events GROUP BY ALL""")
def q_time_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = T.time_status(F.col("ts"), F.lit(AS_OF).cast("timestamp"))
    return table(spark, sf_dir, "events").groupBy("event_type", status.alias("time_status")).agg(F.count(F.lit(1)).alias("rows"))


@query("SELECT CAST(ts + INTERVAL 25 HOUR AS DATE) AS day, event_type, count(*) AS rows, count(DISTINCT user_id) AS users FROM events GROUP BY ALL")
def q_offset_daily_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(T.daily_window(F.col("ts")).alias("day"), "event_type").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("user_id").alias("users"))


@query("""WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS rows FROM events WHERE event_type = 'error' GROUP BY 1), s AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS day),
j AS (SELECT count(*) AS expected_days, count(*) FILTER (coalesce(rows, 0) >= 5) AS healthy_days, count(*) FILTER (rows > 0 AND rows < 5) AS degraded_days, count(*) FILTER (rows IS NULL) AS missing_days FROM s LEFT JOIN d USING (day))
SELECT *, healthy_days / expected_days AS coverage_ratio, CASE WHEN healthy_days / expected_days >= 0.9 THEN 'normal' WHEN healthy_days / expected_days >= 0.7 THEN 'partial' ELSE 'insufficient' END AS status FROM j""")
def q_period_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").where("event_type = 'error'").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    return reports.coverage(days, "2024-01-01", "2024-01-31", 5)


_SCORES = """SELECT event_id, user_id, ts, event_type, value, CASE event_type WHEN 'purchase' THEN 5 WHEN 'signup' THEN 4 WHEN 'error' THEN 3 ELSE 1 END AS importance,
  CASE WHEN value >= 100 THEN 5 WHEN value >= 50 THEN 4 WHEN value >= 20 THEN 3 WHEN value >= 5 THEN 2 ELSE 1 END AS richness,
  CASE WHEN ts >= TIMESTAMP '2024-01-30' THEN 5 WHEN ts >= TIMESTAMP '2024-01-28' THEN 4 WHEN ts >= TIMESTAMP '2024-01-24' THEN 3 ELSE 1 END AS recency FROM events"""
_WEIGHTED = f"SELECT *, (importance * 500 + richness * 300 + recency * 200) / 1000.0 AS weighted FROM ({_SCORES})"
_PRIORITY = f"SELECT *, CASE WHEN weighted >= 4.3 THEN 'P0' WHEN weighted >= 3.6 THEN 'P1' WHEN weighted >= 2.8 THEN 'P2' ELSE 'ARCHIVE' END AS priority FROM ({_WEIGHTED})"


def scored_events(events: DataFrame) -> DataFrame:
    """Dimensions, weighted score and priority of events."""
    value, ts = F.col("value"), F.col("ts")
    out = (
        events.withColumn("importance", scoring.lookup(F.col("event_type"), {"purchase": 5, "signup": 4, "error": 3}, 1))
        .withColumn("richness", F.when(value >= 100, 5).when(value >= 50, 4).when(value >= 20, 3).when(value >= 5, 2).otherwise(1))
        .withColumn("recency", F.when(ts >= "2024-01-30", 5).when(ts >= "2024-01-28", 4).when(ts >= "2024-01-24", 3).otherwise(1))
    )
    weighted = scoring.weighted_sum({k: F.col(k) for k in ("importance", "richness", "recency")}, {"importance": 0.5, "richness": 0.3, "recency": 0.2})
    out = out.withColumn("weighted", weighted)
    return out.withColumn("priority", F.when(F.col("weighted") >= 4.3, "P0").when(F.col("weighted") >= 3.6, "P1").when(F.col("weighted") >= 2.8, "P2").otherwise("ARCHIVE"))


@query(f"SELECT event_id, CAST(weighted AS DOUBLE) AS weighted, priority FROM ({_PRIORITY})")
def q_weighted_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_events(table(spark, sf_dir, "events")).select("event_id", "weighted", "priority")


@query(f"""SELECT event_id, CASE WHEN value IS NULL OR user_id % 17 = 0 THEN 'ARCHIVE' WHEN priority IN ('P0', 'P1') AND (event_type = 'error' OR value < 5) THEN 'P2' ELSE priority END AS capped,
  concat_ws('|', CASE WHEN event_type = 'error' THEN 'background' END, CASE WHEN value < 5 THEN 'thin' END, CASE WHEN value IS NULL OR user_id % 17 = 0 THEN 'blocked' END) AS reasons FROM ({_PRIORITY})""")
def q_downgrade_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["P0", "P1", "P2", "ARCHIVE"]
    blocked = F.col("value").isNull() | (F.col("user_id") % 17 == 0)
    level, reasons = scoring.cap(F.col("priority"), order, [(F.col("event_type") == "error", "P2", "background"), (F.col("value") < 5, "P2", "thin"), (blocked, "ARCHIVE", "blocked")])
    return scored_events(table(spark, sf_dir, "events")).select("event_id", level.alias("capped"), F.array_join(reasons, "|").alias("reasons"))


@query(f"SELECT event_type, priority, count(*) AS rows, CAST(max(weighted) AS DOUBLE) AS best FROM ({_PRIORITY}) GROUP BY ALL")
def q_score_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_events(table(spark, sf_dir, "events")).groupBy("event_type", "priority").agg(F.count(F.lit(1)).alias("rows"), F.max("weighted").alias("best"))


@query(f"SELECT event_id, priority FROM ({_PRIORITY}) ORDER BY CASE priority WHEN 'P0' THEN 0 WHEN 'P1' THEN 1 WHEN 'P2' THEN 2 ELSE 3 END, weighted DESC, importance DESC, ts DESC, event_id LIMIT 100")
def q_top_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = scoring.lookup(F.col("priority"), {"P0": 0, "P1": 1, "P2": 2}, 3)
    s = scored_events(table(spark, sf_dir, "events"))
    return s.orderBy(rank, F.col("weighted").desc(), F.col("importance").desc(), F.col("ts").desc(), "event_id").limit(100).select("event_id", "priority")


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1")
def q_ledger_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.struct("user_id", "event_type").alias("key"), "event_id", "value")
    return ledger.latest(rows, "key", "event_id").select("key.user_id", "key.event_type", "event_id", "value")


_NOVELTY = """WITH e AS (SELECT event_id, user_id || ':' || event_type AS key, CAST(ts AS DATE) AS day, CAST(props->>'$.k' AS BIGINT) % 2 AS fact, CASE WHEN CAST(props->>'$.k' AS BIGINT) % 9 = 0 THEN 'republished_old_fact' END AS freshness FROM events),
w AS (SELECT *, min(day) OVER (PARTITION BY key ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS first_day, lag(day) OVER (PARTITION BY key ORDER BY event_id) AS last_day, fact IS DISTINCT FROM lag(fact) OVER (PARTITION BY key ORDER BY event_id) AS changed FROM e),
x AS (SELECT *, last_day IS NOT NULL AND changed AS again, date_diff('day', last_day, day) AS gap FROM w),
y AS (SELECT *, 1 + count(*) FILTER (again AND first_day <> day) OVER (PARTITION BY key ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS report_count, max(CASE WHEN first_day = day OR again THEN day END) OVER (PARTITION BY key ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS last_reported,
  count(*) FILTER (again) OVER (PARTITION BY key ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM x),
z AS (SELECT *, min(day) OVER (PARTITION BY key, run ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS fact_first_day, row_number() OVER (PARTITION BY key, run ORDER BY event_id) AS fact_seen,
  CASE WHEN last_day IS NULL THEN 'new_today' WHEN first_day = day THEN CASE WHEN changed THEN 'updated_today' ELSE 'new_today' END WHEN changed THEN 'updated_today' WHEN freshness IS NOT NULL OR gap < 3 THEN 'repeated' WHEN gap < 7 THEN 'ongoing' ELSE 'background' END AS status FROM y)
SELECT event_id, key, status, CASE WHEN status IN ('new_today', 'updated_today') THEN 'core' WHEN status = 'repeated' THEN 'reference' WHEN status = 'ongoing' THEN 'tracking' ELSE 'archive' END AS eligibility, report_count, last_reported, fact_first_day, fact_seen, CAST(gap AS INTEGER) AS gap_days FROM z"""


def novelties(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    rows = table(spark, sf_dir, "events").select("event_id", F.concat_ws(":", "user_id", "event_type").alias("key"), F.to_date("ts").alias("day"), (k % 2).alias("fact"), F.when(k % 9 == 0, "republished_old_fact").alias("freshness"))
    return ledger.novelty(rows, "key", "event_id", "day", "fact", "freshness")


@query(_NOVELTY)
def q_novelty_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return novelties(spark, sf_dir).select("event_id", "key", "status", "eligibility", "report_count", "last_reported", "fact_first_day", "fact_seen", "gap_days")


@query(f"SELECT status, eligibility, count(*) AS rows, max(report_count) AS most_reports FROM ({_NOVELTY}) GROUP BY ALL")
def q_novelty_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return novelties(spark, sf_dir).groupBy("status", "eligibility").agg(F.count(F.lit(1)).alias("rows"), F.max("report_count").alias("most_reports"))


@query("""SELECT user_id, min(CAST(ts AS DATE)) AS first_seen, max(CAST(ts AS DATE)) AS last_seen, max(event_id) AS event_id,
  (max({'d': CAST(ts AS DATE), 'v': event_type}) FILTER (event_type <> '')).v AS event_type FROM events GROUP BY user_id""")
def q_ledger_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), "event_id", "event_type")
    return ledger.rebuild(log, "user_id", "day", "event_id", ["event_type"])


_MONTH = {"click": 1800, "view": 2400, "signup": 2050, "error": 1300}


@query("""WITH s AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS day), q(event_type, quota) AS (VALUES ('click', 1800), ('view', 2400), ('signup', 2050), ('error', 1300)),
n AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL)
SELECT event_type, day, used, CASE WHEN used * 31 >= 15 * quota * day(day) / 10 THEN 'critical' WHEN used * 31 >= 12 * quota * day(day) / 10 THEN 'high' WHEN used * 31 >= quota * day(day) THEN 'warn' ELSE 'ok' END AS status
FROM (SELECT event_type, quota, s.day, CAST(sum(coalesce(n, 0)) OVER (PARTITION BY event_type ORDER BY s.day) AS BIGINT) AS used FROM s CROSS JOIN q LEFT JOIN n USING (day, event_type))""")
def q_quota_tracker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month-to-date use of each type on a spine of days, against its quota to date (1.0, 1.2 and 1.5 of it)."""
    from pyspark.sql import Window

    spine = spark.createDataFrame(list(_MONTH.items()), "event_type string, quota long").withColumn("day", F.explode(F.sequence(F.lit("2024-01-01").cast("date"), F.lit("2024-01-31").cast("date"))))
    daily = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    month = Window.partitionBy("event_type").orderBy("day")
    used = spine.join(daily, ["event_type", "day"], "left").withColumn("used", F.sum(F.coalesce("n", F.lit(0))).over(month))
    pace, due = F.col("used") * 310, F.col("quota") * F.dayofmonth("day")
    return used.select("event_type", "day", "used", F.when(pace >= 15 * due, "critical").when(pace >= 12 * due, "high").when(pace >= 10 * due, "warn").otherwise("ok").alias("status"))


@query("""SELECT CAST(props->>'$.k' AS BIGINT) % 10 AS step, count(*) AS runs, count(*) FILTER (event_type = 'error') AS errors, CASE WHEN count(*) FILTER (event_type = 'error') = 0 THEN 'ok' WHEN CAST(props->>'$.k' AS BIGINT) % 10 < 3 THEN 'critical' ELSE 'warning' END AS level FROM events GROUP BY 1""".replace("CAST(props->>'$.k' AS BIGINT) % 10 < 3", "any_value(CAST(props->>'$.k' AS BIGINT) % 10) < 3"))
def q_manifest_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = F.get_json_object("props", "$.k").cast("long") % 10
    s = table(spark, sf_dir, "events").groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("runs"), F.count_if(F.col("event_type") == "error").alias("errors"))
    return s.withColumn("level", F.when(F.col("errors") == 0, "ok").when(F.col("step") < 3, "critical").otherwise("warning"))


@query("""WITH e AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events))
SELECT user_id, min(ts) AS started, count(*) AS rows FROM e GROUP BY user_id, session""")
def q_session_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "events").groupBy("user_id", F.session_window("ts", "6 hours")).agg(F.count(F.lit(1)).alias("rows"))
    return s.select("user_id", F.col("session_window.start").alias("started"), "rows")


@query("""WITH r AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'signup'), x AS (SELECT user_id, ts, arg_max(value, event_id) AS v FROM r GROUP BY user_id, ts)
SELECT l.event_id, x.v AS signup_value FROM (SELECT * FROM events WHERE event_type = 'purchase') l ASOF LEFT JOIN x ON l.user_id = x.user_id AND l.ts >= x.ts""")
def q_as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    right = events.where("event_type = 'signup'").groupBy("user_id", F.col("ts").alias("since")).agg(F.max_by("value", "event_id").alias("signup_value"))
    left = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return ledger.as_of_join(left, right, "user_id", "ts", "since", ["signup_value"]).select("event_id", "signup_value")
