"""Queries of periodic synthesis: clusters by period, trends, quotas, routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gristmill.functions import times as T
from gristmill.operators import dedup, reports
from gristmill.plans.events import _PRIORITY, scored_events
from gristmill.plans.registry import query, table

_CLUSTERS = f"""SELECT strftime(ts, '%G-W%V') AS period, event_type, CAST(user_id % 50 AS BIGINT) AS topic, count(*) AS n, count(DISTINCT CAST(ts AS DATE)) AS days, min(CAST(ts AS DATE)) AS first_day, max(CAST(ts AS DATE)) AS last_day,
  CAST(max(weighted) AS DOUBLE) AS best, count(DISTINCT user_id) AS users FROM ({_PRIORITY}) WHERE priority <> 'ARCHIVE' GROUP BY ALL"""


def clusters(events: DataFrame) -> DataFrame:
    """Events of a week, type and topic as one cluster."""
    s = scored_events(events).where("priority <> 'ARCHIVE'")
    day = F.to_date("ts")
    return s.groupBy(T.period_id(day, "weekly").alias("period"), "event_type", (F.col("user_id") % 50).alias("topic")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(day).alias("days"), F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.max("weighted").alias("best"), F.count_distinct("user_id").alias("users")
    )


@query(_CLUSTERS)
def q_period_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(table(spark, sf_dir, "events"))


@query(f"""SELECT period, event_type, topic, n, before, CASE WHEN before IS NULL THEN CASE WHEN days >= 3 AND users >= 3 THEN 'emerging' ELSE 'unclear' END WHEN before > 0 AND n >= before * 1.5 AND days >= 3 AND users >= 3 THEN 'accelerating' WHEN before >= 3 AND n <= before * 0.5 THEN 'weakening'
 WHEN before > 0 AND abs(n - before) <= greatest(1.0, before * 0.2) THEN 'stable' ELSE 'unclear' END AS direction FROM (SELECT *, lag(n) OVER (PARTITION BY event_type, topic ORDER BY period) AS before FROM ({_CLUSTERS}))""")
def q_period_over_period_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = F.lag("n").over(Window.partitionBy("event_type", "topic").orderBy("period"))
    c = clusters(table(spark, sf_dir, "events")).withColumn("before", before)
    return c.select("period", "event_type", "topic", "n", "before", reports.trend(F.col("n"), F.col("before"), F.col("days"), F.col("users")).alias("direction"))


@query(f"""WITH c AS (SELECT *, event_type || '-' || topic || '-' || period AS id FROM ({_CLUSTERS})), a AS (SELECT id, 1 AS layer FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY best DESC, id) AS g FROM c) WHERE g <= 1
 UNION ALL SELECT id, 2 FROM (SELECT id FROM c WHERE event_type = 'error' ORDER BY best DESC, id LIMIT 10) UNION ALL SELECT id, 3 FROM (SELECT id FROM c WHERE period = '2024-W05' ORDER BY best DESC, id LIMIT 10) UNION ALL SELECT id, 4 FROM c),
l AS (SELECT id, min(layer) AS layer FROM a GROUP BY id) SELECT id, CAST(layer AS INTEGER) AS layer FROM l JOIN c USING (id) ORDER BY layer, best DESC, id LIMIT 80""")
def q_quota_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = clusters(table(spark, sf_dir, "events")).withColumn("id", F.concat_ws("-", "event_type", "topic", "period"))
    return reports.quota(c, "id", "best", "topic", 1, {"event_type": ("error", 10), "period": ("2024-W05", 10)}, 80).select("id", "layer")


@query(f"""SELECT chapter, id, CAST(rn AS INTEGER) AS rank FROM (SELECT chapter, id, row_number() OVER (PARTITION BY chapter ORDER BY best DESC, id) AS rn FROM (SELECT *, event_type || '-' || topic || '-' || period AS id FROM ({_CLUSTERS})) c
JOIN (VALUES ('risk', 'error'), ('growth', 'signup'), ('growth', 'purchase'), ('traffic', 'view'), ('traffic', 'click')) m(chapter, event_type) USING (event_type)) WHERE rn <= 30""")
def q_chapter_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    chapters = spark.createDataFrame([("risk", "error"), ("growth", "signup"), ("growth", "purchase"), ("traffic", "view"), ("traffic", "click")], "chapter string, event_type string")
    c = clusters(table(spark, sf_dir, "events")).withColumn("id", F.concat_ws("-", "event_type", "topic", "period"))
    return reports.top_per_group(c.join(chapters, "event_type"), ["chapter"], [F.col("best").desc(), F.col("id")], 30).select("chapter", "id", "rank")


@query("""SELECT CAST(ts AS DATE) AS day, strftime(ts, '%G-W%V') AS week, strftime(ts, '%Y-%m') AS month, CAST(date_trunc('week', ts) AS DATE) AS week_start, CAST(date_trunc('month', ts) + INTERVAL 1 MONTH AS DATE) AS month_end,
  concat_ws('|', CASE WHEN isodow(ts) = 1 THEN 'weekly' END, CASE WHEN day(ts) = 1 THEN 'monthly' END, CASE WHEN day(ts) = 1 AND month(ts) = 1 THEN 'yearly' END) AS due, count(*) AS rows FROM events GROUP BY ALL""")
def q_period_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    d = F.col("day")
    return e.select("day", T.period_id(d, "weekly").alias("week"), T.period_id(d, "monthly").alias("month"), T.period_start(d, "weekly").alias("week_start"), T.period_end(d, "monthly").alias("month_end"), F.array_join(T.due_periods(d), "|").alias("due"), "rows")


@query("""SELECT o_orderkey AS claim, CAST(floor(o_totalprice) AS BIGINT) AS number FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND abs(floor(o_totalprice) - floor(l_extendedprice)) * 100 <= abs(floor(l_extendedprice)) * 10)""")
def q_numeric_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of orders, as claims, that no line of the order bears out within a tenth."""
    number = lambda c: F.floor(c).alias("number")
    claims = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("claim"), F.lit("price").alias("unit"), number("o_totalprice"))
    known = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("claim"), F.lit("price").alias("unit"), number("l_extendedprice"))
    return reports.unmatched_numbers(claims, known, "claim").select("claim", "number")


@query("""SELECT o_orderstatus AS kind, CAST(o_orderdate AS DATE) AS day, c.campaign, count(*) AS orders FROM orders JOIN (VALUES ('spring', 3, 5), ('summer', 6, 8), ('autumn', 9, 11), ('winter_a', 1, 2), ('winter_b', 12, 12)) c(campaign, m1, m2) ON month(o_orderdate) BETWEEN m1 AND m2 GROUP BY ALL""")
def q_campaign_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    calendar = spark.createDataFrame([("spring", 3, 5), ("summer", 6, 8), ("autumn", 9, 11), ("winter_a", 1, 2), ("winter_b", 12, 12)], "campaign string, m1 int, m2 int")
    months = calendar.select("campaign", F.explode(F.sequence("m1", "m2")).alias("month"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("kind"), F.to_date("o_orderdate").alias("day"), F.month("o_orderdate").alias("month"))
    return orders.join(months, "month").groupBy("kind", "day", "campaign").agg(F.count(F.lit(1)).alias("orders"))


_TEMPLATES = ("{segment} in {nation}", "news of {segment} {nation}", "{nation}")
_GENERATED = """WITH n AS (SELECT n_nationkey, n_name FROM nation), m AS (SELECT DISTINCT c_mktsegment FROM customer), t(ord, template) AS (VALUES (1, '{segment} in {nation}'), (2, 'news of {segment} {nation}'), (3, '{nation}')),
x AS (SELECT replace(replace(template, '{segment}', c_mktsegment), '{nation}', n_name) AS query, CASE WHEN ord = 1 AND n_nationkey < 5 THEN 'A' WHEN ord = 2 THEN 'B' ELSE 'C' END AS tier, ord = 2 AS dated, n_nationkey FROM n CROSS JOIN m CROSS JOIN t),
u AS (SELECT query, min({'tier': tier, 'dated': NOT dated, 'nation': n_nationkey}) AS b FROM x GROUP BY query),
r AS (SELECT query, b.tier AS tier, CASE WHEN b.tier = 'A' THEN 0 WHEN NOT b.dated THEN 1 ELSE 2 END AS stage, row_number() OVER (ORDER BY CASE WHEN b.tier = 'A' THEN 0 WHEN NOT b.dated THEN 1 ELSE 2 END, b.nation, query) AS place FROM u)"""


@query(_GENERATED + " SELECT query, tier, CAST(place AS INTEGER) AS place FROM r WHERE tier = 'A' OR place <= 150")
def q_query_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search queries: templates filled with the product of two small dimensions, each once, under a budget that spares tier A."""
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    segments = table(spark, sf_dir, "customer").select("c_mktsegment").distinct()  # a handful: the product is bounded by the dimensions
    filled = F.array(*[F.struct(F.lit(k).alias("ord"), F.replace(F.replace(F.lit(t), F.lit("{segment}"), F.col("c_mktsegment")), F.lit("{nation}"), F.col("n_name")).alias("query")) for k, t in enumerate(_TEMPLATES, 1)])
    each = nations.withColumn("one", F.lit(1)).join(segments.withColumn("one", F.lit(1)), "one").select("n_nationkey", F.explode(filled).alias("q")).select("n_nationkey", "q.ord", "q.query")
    tier = F.when((F.col("ord") == 1) & (F.col("n_nationkey") < 5), "A").when(F.col("ord") == 2, "B").otherwise("C")
    unique = each.groupBy("query").agg(F.min(F.struct(tier.alias("tier"), (F.col("ord") != 2).alias("undated"), "n_nationkey")).alias("b")).select("query", "b.*")
    stage = F.when(F.col("tier") == "A", 0).when(~F.col("undated"), 1).otherwise(2)
    return dedup.within_budget(unique, [stage, F.col("n_nationkey"), F.col("query")], 150, free=F.col("tier") == "A").select("query", "tier", "place")
