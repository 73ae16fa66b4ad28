"""Queries of dates, freshness and campaigns, over articles whose dates come from events and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import temporal as W
from gristmill.functions import text as X
from gristmill.functions import times as T
from gristmill.functions import urls as U
from gristmill.operators import ledger
from gristmill.operators.lineage import once
from gristmill.plans.registry import query, table
from gristmill.plans.sql import any_of

AS_OF = "2024-01-20 12:00:00"
_NOW = f"TIMESTAMP '{AS_OF}'"
_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

# addresses and heads of texts are made of the tables' own dates, numbers and sentences
_DATED = f"""SELECT d.doc_id, split_part(d.text, '.', 1) AS title, d.text AS content, e.ts AS published, e.k, o.ts AS other,
 coalesce(regexp_extract(p.url, '^[a-z]+://[^/]+'), 'http://none.example') || CASE e.k % 4 WHEN 0 THEN strftime(o.ts, '/%Y/%m/%d/') WHEN 1 THEN strftime(o.ts, '/%Y%m%d.html') WHEN 2 THEN '/tags/' || d.source || '/' ELSE '/x' || e.k END AS url,
 CASE e.k % 7 WHEN 0 THEN strftime(o.ts, '%Y年%m月%d日 ') WHEN 1 THEN strftime(o.ts, '%Y-%m-%d ') WHEN 2 THEN (e.k % 30) || ' 天前 ' WHEN 3 THEN (e.k % 40) || '小时前 ' WHEN 4 THEN '昨天 ' WHEN 5 THEN '今天 ' ELSE '' END || split_part(d.text, '.', 2) AS summary
FROM (SELECT greatest(count(*) // 10, 1) AS dated FROM events) n CROSS JOIN documents d LEFT JOIN (SELECT event_id, ts, {_K} AS k FROM events) e ON e.event_id = 10 * d.doc_id LEFT JOIN events o ON o.event_id = 10 * ((d.doc_id * 37) % n.dated) LEFT JOIN pages p ON p.page_id = d.doc_id"""


def dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with two dates of events: published, and other, which stands in the address and at the head of the text."""
    docs, pages, events = (table(spark, sf_dir, t) for t in ("documents", "pages", "events"))
    k = F.get_json_object("props", "$.k").cast("int")
    own = events.where("event_id % 10 = 0").select((F.col("event_id") / 10).cast("long").alias("doc_id"), F.col("ts").cast("timestamp").alias("published"), k.alias("k"))
    other = events.where("event_id % 10 = 0").select((F.col("event_id") / 10).cast("long").alias("other_id"), F.col("ts").cast("timestamp").alias("other"))
    host = F.regexp_extract("url", "^[a-z]+://[^/]+", 0)
    base = pages.select(F.col("page_id").alias("doc_id"), host.alias("host"))
    n_dated = events.agg(F.floor(F.count(F.lit(1)) / 10).alias("n_dated"))  # one row
    a = docs.crossJoin(n_dated).join(own, "doc_id", "left").withColumn("other_id", F.col("doc_id") * 37 % F.greatest("n_dated", F.lit(1))).join(other, "other_id", "left").join(base, "doc_id", "left")
    form = lambda f: F.date_format("other", f)
    k = F.col("k")
    path = F.when(k % 4 == 0, form("'/'yyyy/MM/dd'/'")).when(k % 4 == 1, form("'/'yyyyMMdd'.html'")).when(k % 4 == 2, F.concat(F.lit("/tags/"), "source", F.lit("/"))).otherwise(F.concat(F.lit("/x"), k))
    head = F.when(k % 7 == 0, form("yyyy'年'MM'月'dd'日 '")).when(k % 7 == 1, form("yyyy-MM-dd' '")).when(k % 7 == 2, F.concat(k % 30, F.lit(" 天前 "))).when(k % 7 == 3, F.concat(k % 40, F.lit("小时前 "))).when(k % 7 == 4, "昨天 ").when(k % 7 == 5, "今天 ").otherwise("")
    return a.select(
        "doc_id", F.split_part("text", F.lit("."), F.lit(1)).alias("title"), F.col("text").alias("content"), "published", "k", "other",
        F.concat(F.coalesce("host", F.lit("http://none.example")), path).alias("url"), F.concat(head, F.split_part("text", F.lit("."), F.lit(2))).alias("summary"),
    )


def _as_of():
    return F.lit(AS_OF).cast("timestamp")


_URL_DAY = r"coalesce(try_cast(CASE WHEN regexp_matches(url, '/\d{4}[/_-]\d{1,2}[/_-]\d{1,2}(?:\D|$)') THEN regexp_replace(regexp_extract(url, '/(\d{4}[/_-]\d{1,2}[/_-]\d{1,2})', 1), '[/_]', '-', 'g') END AS DATE), try_cast(CASE WHEN regexp_matches(url, '/\d{8}(?:\D|$)') THEN regexp_replace(regexp_extract(url, '/(\d{8})', 1), '(\d{4})(\d{2})(\d{2})', '\1-\2-\3') END AS DATE))"


@query(f"SELECT doc_id, {_URL_DAY} AS day FROM ({_DATED})")
def q_url_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(spark, sf_dir).select("doc_id", U.url_date(F.col("url")).alias("day"))


_HEAD = "trim(concat_ws(' ', coalesce(summary, ''), substr(coalesce(content, ''), 1, 200)))"
_TEXT_DAY = rf"try_cast(CASE WHEN regexp_matches(substr({_HEAD}, 1, 100), '\d{{4}}[年/.-]\d{{1,2}}[月/.-]\d{{1,2}}') THEN regexp_replace(regexp_extract(substr({_HEAD}, 1, 100), '(\d{{4}}[年/.-]\d{{1,2}}[月/.-]\d{{1,2}})', 1), '[年月/.]', '-', 'g') END AS DATE)"
_AGO = rf"try_cast(regexp_extract(substr({_HEAD}, 1, 40), '(\d{{1,4}})\s*(?:天|小时)\s*前', 1) AS INTEGER)"
_REL = f"CASE WHEN regexp_matches(substr({_HEAD}, 1, 41), '天\\s*前') THEN CAST({_NOW} - to_days({_AGO}) AS DATE) WHEN regexp_matches(substr({_HEAD}, 1, 41), '小时\\s*前') THEN CAST({_NOW} - to_hours({_AGO}) AS DATE) END"
_WORD = f"CASE WHEN starts_with({_HEAD}, '昨天') THEN CAST({_NOW} AS DATE) - 1 WHEN starts_with({_HEAD}, '今天') THEN CAST({_NOW} AS DATE) END"
_OWN = "CASE WHEN doc_id % 3 = 0 THEN CAST(published AS DATE) END"


@query(f"""SELECT doc_id, coalesce(CASE WHEN abs(date_diff('day', own, u)) > 7 THEN u END, own, t, r, w, u) AS day,
 CASE WHEN abs(date_diff('day', own, u)) > 7 THEN 'url_conflict' WHEN own IS NOT NULL THEN 'published' WHEN t IS NOT NULL THEN 'text' WHEN r IS NOT NULL THEN 'relative' WHEN w IS NOT NULL THEN 'word' WHEN u IS NOT NULL THEN 'url' END AS origin
FROM (SELECT doc_id, {_OWN} AS own, {_URL_DAY} AS u, {_TEXT_DAY} AS t, {_REL} AS r, {_WORD} AS w FROM ({_DATED}))""")
def q_date_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third article has a date of its own; the others get one from text or address, if these hold any."""
    own = F.when(F.col("doc_id") % 3 == 0, F.date_format("published", "yyyy-MM-dd"))
    found = W.resolve_date(own, F.col("url"), F.lit(None).cast("string"), F.col("summary"), F.col("content"), _as_of())
    return dated(spark, sf_dir).select("doc_id", found.alias("f")).select("doc_id", "f.day", "f.origin")


@query(f"SELECT doc_id, CAST(published AS DATE) AS published, {_URL_DAY} AS url_day FROM ({_DATED}) WHERE published IS NULL OR abs(date_diff('day', CAST(published AS DATE), {_URL_DAY})) > 7")
def q_suspicious_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles without date, or with one that is more than a week off that of the address."""
    a = dated(spark, sf_dir).select("doc_id", F.to_date("published").alias("published"), U.url_date(F.col("url")).alias("url_day"))
    return a.where(F.col("published").isNull() | (F.abs(F.datediff("published", "url_day")) > 7))


_TIER = "CASE k % 3 WHEN 0 THEN 'channel' WHEN 1 THEN 'search' WHEN 2 THEN 'broad' ELSE 'broad' END"
_GATE = f"""CASE WHEN k % 17 = 0 THEN 'trusted' WHEN abs(date_diff('day', p, u)) > 7 AND u < CAST({_NOW} AS DATE) - CASE tier WHEN 'broad' THEN 7 ELSE 1 END THEN 'url_conflict' WHEN p > CAST({_NOW} AS DATE) + 1 THEN 'future'
 WHEN p IS NOT NULL THEN CASE WHEN p >= CAST({_NOW} AS DATE) - CASE tier WHEN 'channel' THEN 1 WHEN 'search' THEN 3 ELSE 7 END THEN 'kept' ELSE 'old' END WHEN tier = 'broad' THEN 'undated_kept' ELSE 'undated' END"""
_GATED = f"SELECT *, {_GATE} AS gate FROM (SELECT doc_id, k, {_TIER} AS tier, CASE WHEN k % 5 > 0 THEN CAST(published AS DATE) END AS p, {_URL_DAY} AS u FROM ({_DATED}))"


@query(f"""WITH g AS (SELECT * FROM ({_GATED})), n AS (SELECT tier, count(*) FILTER (gate IN ('trusted', 'kept', 'undated_kept')) AS passing FROM g GROUP BY tier)
SELECT g.tier, g.gate, count(*) AS rows, count(*) FILTER (g.gate IN ('trusted', 'kept', 'undated_kept') OR n.passing = 0) AS left_rows FROM g JOIN n USING (tier) GROUP BY ALL""")
def q_date_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date gate by tier of source; a tier of which nothing passes is kept whole."""
    k = F.col("k")
    a = dated(spark, sf_dir).select("k", F.when(k % 3 == 0, "channel").when(k % 3 == 1, "search").otherwise("broad").alias("tier"), F.when(k % 5 > 0, F.to_date("published")).alias("published"), U.url_date(F.col("url")).alias("url_day"))
    gate = W.date_gate({"published": F.col("published"), "url_day": F.col("url_day"), "tier": F.col("tier"), "trusted": F.coalesce(k % 17 == 0, F.lit(False))}, _as_of())
    counted = a.groupBy("tier", gate.alias("gate")).agg(F.count(F.lit(1)).alias("rows"))
    passing = F.col("gate").isin(*W.PASSING)
    per_tier = counted.groupBy("tier").agg(F.count_if(passing).alias("passing"))
    return counted.join(per_tier, "tier").select("tier", "gate", "rows", F.when(passing | (F.col("passing") == 0), F.col("rows")).otherwise(0).alias("left_rows"))


_ORDERS = """SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE) AS day, string_agg(CASE l_linenumber % 3 WHEN 0 THEN strftime(l_shipdate, '%Y-%m-%d') WHEN 1 THEN strftime(l_shipdate, '%Y年%m月%d日') ELSE strftime(l_shipdate, '%Y年%m月') END, ' ; ' ORDER BY l_linenumber, l_shipdate, l_partkey) AS told
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL"""
ORDERS_NOW = "1998-06-15 12:00:00"
_ONOW = f"TIMESTAMP '{ORDERS_NOW}'"


def told_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as articles whose text tells the ship dates of their lines, in three forms."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    n, ship = F.col("l_linenumber"), F.col("l_shipdate").cast("timestamp")
    form = F.when(n % 3 == 0, F.date_format(ship, "yyyy-MM-dd")).when(n % 3 == 1, F.date_format(ship, "yyyy'年'MM'月'dd'日'")).otherwise(F.date_format(ship, "yyyy'年'MM'月'"))
    each = lines.select("l_orderkey", F.struct(n.alias("n"), ship.alias("ship"), F.col("l_partkey").alias("part"), form.alias("form")).alias("line"))
    told = each.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("line")), lambda x: x["form"]), " ; ").alias("told"))
    return orders.join(told, orders.o_orderkey == told.l_orderkey).select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", F.to_date("o_orderdate").alias("day"), "told")


_FULL = r"list_transform(regexp_extract_all(told, '\d{4}年\d{1,2}月\d{1,2}日'), lambda x: try_cast(regexp_replace(regexp_replace(x, '[年月]', '-', 'g'), '日', '') AS DATE))"
_PLAIN = r"list_transform(regexp_extract_all(told, '\d{4}-\d{1,2}-\d{1,2}'), lambda x: try_cast(x AS DATE))"
_REST = r"list_transform(regexp_extract_all(regexp_replace(told, '\d{4}年\d{1,2}月\d{1,2}日', ' ', 'g'), '\d{4}年\d{1,2}月'), lambda x: try_cast(regexp_replace(x, '[年月]', '-', 'g') || '01' AS DATE))"
_MINED = f"""SELECT *, len(dates) AS total, len(list_filter(dates, lambda d: year(d) < year({_ONOW}))) AS historical, len(list_filter(dates, lambda d: d >= CAST({_ONOW} AS DATE) - 7)) AS recent, list_min(dates) AS oldest, list_max(dates) AS newest
FROM (SELECT *, list_concat(list_concat({_FULL}, {_PLAIN}), {_REST}) AS dates FROM ({_ORDERS}))"""


def mined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(told_orders(spark, sf_dir), m=W.content_dates(F.col("told"), F.lit(ORDERS_NOW).cast("timestamp"))).select("*", "m.*").drop("m")


@query(f"SELECT o_orderkey, CAST(total AS INTEGER) AS total, CAST(historical AS INTEGER) AS historical, CAST(recent AS INTEGER) AS recent, CASE WHEN total > 0 THEN round(historical / total, 3) ELSE 0.0 END AS ratio, oldest, newest FROM ({_MINED})")
def q_content_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(spark, sf_dir).select("o_orderkey", "total", "historical", "recent", "ratio", "oldest", "newest")


_SIGNS = "('1-URGENT', '5-LOW')"
_FRESH = f"""WITH m AS (SELECT *, o_custkey || ':' || o_orderpriority AS cluster, o_orderstatus AS fact, CASE WHEN total > 0 THEN round(historical / total, 3) ELSE 0.0 END AS ratio FROM ({_MINED})),
l AS (SELECT cluster, arg_max(fact, o_orderkey) AS known_fact, min(day) AS first_seen FROM m WHERE day < DATE '1998-06-01' GROUP BY cluster),
n AS (SELECT m.*, l.cluster IS NOT NULL AS known, known_fact, first_seen, CASE WHEN o_orderkey % 2 = 0 THEN newest END AS occurred, CASE WHEN o_orderkey % 7 = 0 THEN newest + 40 END AS effective FROM m LEFT JOIN l USING (cluster) WHERE day >= DATE '1998-06-01' AND day < DATE '1998-07-15')
SELECT *, CASE WHEN day > CAST({_ONOW} AS DATE) THEN 'date_conflict' WHEN effective > CAST({_ONOW} AS DATE) THEN 'upcoming_fact' WHEN known AND o_orderpriority = '1-URGENT' THEN 'updated_fact'
 WHEN known AND fact = known_fact THEN CASE WHEN first_seen < CAST({_ONOW} AS DATE) - 3 THEN 'republished_old_fact' ELSE 'ongoing_fact' END WHEN known THEN 'updated_fact'
 WHEN ratio >= 0.6 AND recent = 0 THEN CASE WHEN contains(o_orderpriority, 'LOW') THEN 'retrospective_summary' ELSE 'historical_background' END WHEN occurred >= CAST({_ONOW} AS DATE) - 7 THEN 'new_fact'
 WHEN year(occurred) < year({_ONOW}) OR occurred < CAST({_ONOW} AS DATE) - 30 THEN 'historical_background' WHEN occurred IS NOT NULL THEN 'ongoing_fact' ELSE 'unknown_fact_time' END AS status FROM n"""
_FIT = "CASE status WHEN 'new_fact' THEN 'core' WHEN 'updated_fact' THEN 'core' WHEN 'upcoming_fact' THEN 'core' WHEN 'ongoing_fact' THEN 'tracking' WHEN 'republished_old_fact' THEN 'reject' WHEN 'date_conflict' THEN 'reject' WHEN 'unknown_fact_time' THEN CASE WHEN contains(o_orderpriority, 'HIGH') THEN 'review' ELSE 'reference' END ELSE 'reference' END"


def fresh_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six weeks of orders as events, judged against the ledger of what a customer ordered with that priority before."""
    now = F.lit(ORDERS_NOW).cast("timestamp")
    m = mined(spark, sf_dir).withColumn("cluster", F.concat_ws(":", "o_custkey", "o_orderpriority"))
    log = m.where("day < '1998-06-01'")
    last = ledger.latest(log.select("cluster", "o_orderkey", F.col("o_orderstatus").alias("known_hash")), "cluster", "o_orderkey").drop("o_orderkey")
    seen = log.groupBy("cluster").agg(F.min("day").alias("first_seen"), F.lit(True).alias("known"))
    key = F.col("o_orderkey")
    e = m.where("day >= '1998-06-01' and day < '1998-07-15'").join(last, "cluster", "left").join(seen, "cluster", "left")
    given = {
        "sanity": W.sanity(F.col("day").cast("timestamp"), F.lit(""), now, 11)["status"],
        "effective": F.when(key % 7 == 0, F.date_add("newest", 40)),
        "occurred": F.when(key % 2 == 0, F.col("newest")),
        "title": F.lit(""),
        "fact": F.col("o_orderpriority"),
        "fact_hash": F.col("o_orderstatus"),
        "known_title": F.lit(""),
        **{c: F.col(c) for c in ("ratio", "recent", "known", "known_hash", "first_seen")},
    }
    found = W.fact_freshness(given, now, high_value=("HIGH",), delta_words=("1-URGENT",), looking_back="LOW")
    return e.withColumn("f", found).select("*", "f.status", "f.eligibility").drop("f")


@query(f"SELECT o_orderkey, status, {_FIT} AS eligibility FROM ({_FRESH})")
def q_fact_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fresh_orders(spark, sf_dir).select("o_orderkey", "status", "eligibility")


@query(f"SELECT status, {_FIT} AS eligibility, count(*) AS rows, count(DISTINCT cluster) AS clusters, min(first_seen) AS first_seen FROM ({_FRESH}) GROUP BY ALL")
def q_freshness_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fresh_orders(spark, sf_dir).groupBy("status", "eligibility").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("cluster").alias("clusters"), F.min("first_seen").alias("first_seen"))


CAMPAIGNS = {"spring": ("pai", "zh"), "winter": ("nicht",), "summer": ("auf",), "open": ("oui",)}
CALENDAR = {"spring": (1, 15, 2, 10), "winter": (12, 1, 1, 10), "summer": (6, 1, 6, 20)}
_CTEXT = "concat_ws(' ', title, url, substr(content, 1, 500))"
_CNAME = f"CASE WHEN {any_of(_CTEXT, CAMPAIGNS['spring'])} THEN 'spring' WHEN {any_of(_CTEXT, CAMPAIGNS['winter'])} THEN 'winter' WHEN {any_of(_CTEXT, CAMPAIGNS['summer'])} THEN 'summer' WHEN {any_of(_CTEXT, CAMPAIGNS['open'])} THEN 'open' END"
_CYEAR = f"coalesce(list_min(list_filter(list_transform(regexp_extract_all(lower({_CTEXT}), '202[0-9]'), lambda y: CAST(y AS INTEGER)), lambda y: y <= 2025)), CASE WHEN k % 6 < 2 THEN 2024 END, year(CASE WHEN k % 6 < 5 THEN published - to_days(400 * (k % 4)) END))"


@query(f"""SELECT name, temporality, year, count(*) AS rows FROM (SELECT coalesce(name, 'not_campaign') AS name, CASE WHEN name IS NOT NULL THEN year END AS year, CASE WHEN name IS NULL THEN 'not_campaign' WHEN year IS NULL THEN 'unknown_campaign_time' WHEN year > 2024 THEN 'upcoming_campaign'
 WHEN year = 2024 THEN CASE name WHEN 'spring' THEN 'current_campaign' WHEN 'winter' THEN 'upcoming_campaign' WHEN 'summer' THEN 'upcoming_campaign' ELSE 'current_campaign' END WHEN year = 2023 THEN 'retrospective' ELSE 'historical_campaign' END AS temporality
FROM (SELECT {_CNAME} AS name, CAST({_CYEAR} AS INTEGER) AS year FROM ({_DATED}))) GROUP BY ALL""")
def q_campaign_temporality(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    text = F.concat_ws(" ", "title", "url", F.substring("content", 1, 500))
    published = F.when(k % 6 < 5, F.date_sub(F.to_date("published"), 400 * (k % 4)))
    found = W.campaign({"text": text, "time": F.when(k % 6 < 2, "in_window").otherwise("old"), "published": published}, CAMPAIGNS, CALENDAR, _as_of())
    return dated(spark, sf_dir).select(found.alias("c")).groupBy("c.name", "c.temporality", "c.year").agg(F.count(F.lit(1)).alias("rows"))


_PK = r"CASE WHEN regexp_matches(lower(url), '(?:^|/)(?:tags?|tagged|topic|topics?)/') THEN 'tag_page' WHEN regexp_matches(lower(url), '(?:^|/)(?:page|p)\d+') THEN 'listing_page' WHEN length(trim(content)) > 200 THEN 'article_page' ELSE 'unknown' END"


@query(f"SELECT kind, kind IN ('article_page', 'unknown') AS admitted, count(*) AS rows FROM (SELECT {_PK} AS kind FROM ({_DATED})) GROUP BY ALL")
def q_page_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of page and whether they may become events."""
    kind = W.page_kind(F.col("url"), F.col("title"), F.col("content"))
    return dated(spark, sf_dir).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("rows")).select("kind", F.col("kind").isin("article_page", "unknown").alias("admitted"), "rows")


_D = f"floor((epoch_us({_NOW}) - epoch_us(ts)) / 86400000000.0)"


@query(f"""SELECT merge, monitor, gap, count(*) AS rows FROM (SELECT CASE WHEN ts > {_NOW} THEN 'old' WHEN {_D} <= 2 THEN 'in_window' WHEN {_D} <= 7 THEN 'near_window' ELSE 'old' END AS merge,
 CASE WHEN ts BETWEEN {_NOW} - INTERVAL 1 DAY AND {_NOW} THEN 'in_window' WHEN ts BETWEEN {_NOW} - INTERVAL 3 DAY AND {_NOW} + INTERVAL 2 DAY THEN 'near_window' WHEN ts < {_NOW} THEN 'old' ELSE 'near_window' END AS monitor,
 CASE WHEN ts BETWEEN {_NOW} - INTERVAL 1 DAY AND {_NOW} THEN 'in_window' WHEN ts BETWEEN {_NOW} - INTERVAL 36 HOUR AND {_NOW} + INTERVAL 12 HOUR THEN 'near_window' ELSE 'old' END AS gap FROM events) GROUP BY ALL""")
def q_status_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The variants of the time status that treat the future differently."""
    now = _as_of()
    start, ts = now - F.expr("interval 1 day"), F.col("ts")
    variants = {"merge": T.time_status(ts, now, future="old"), "monitor": W.margin_status(ts, start, now), "gap": W.margin_status(ts, start, now, hours=12, outside="old")}
    return table(spark, sf_dir, "events").groupBy(*[v.alias(n) for n, v in variants.items()]).agg(F.count(F.lit(1)).alias("rows"))


@query(f"SELECT doc_id, substr(sha256(coalesce(url, '') || '|' || 'documents' || '|' || doc_id), 1, 16) AS article_id, 'sha256:' || substr(sha256(coalesce(content, '')), 1, 16) AS content_hash, CASE WHEN length(title) > 60 THEN substr(title, 1, 57) || '...' ELSE title END AS short_title FROM ({_DATED})")
def q_article_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(spark, sf_dir).select("doc_id", X.article_id(F.col("url"), F.lit("documents"), F.col("doc_id")).alias("article_id"), X.content_hash(F.col("content")).alias("content_hash"), X.short_title(F.col("title")).alias("short_title"))
