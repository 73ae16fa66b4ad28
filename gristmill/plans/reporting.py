"""Queries of report selection, gates, discovery statistics and categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gristmill.functions import text as X
from gristmill.functions import times as T
from gristmill.functions import urls as U
from gristmill.operators import dedup, gates, lineage, reports, scoring
from gristmill.operators.clusters import number_rows
from gristmill.plans.ladders import _COMPETITORS, _EVENTS, _FINAL, _LEVELLED, _PLATFORMS, _TEXT, analysed, downgraded, event_rows
from gristmill.plans.registry import query, table
from gristmill.plans.sql import list_of

_NAMES = ("tion", "ent", "ing", "lle", "mente", "ess")


@query(f"""SELECT event_id, 'E' || strftime(ts, '%Y%m%d') || '_' || lpad(CAST(row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) AS VARCHAR), 4, '0') AS name FROM events""")
def q_event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of events by day and number in the day."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", F.to_date("ts").alias("day"))
    n = F.col("number")
    return number_rows(events, ["day"], [F.col("ts"), F.col("event_id")]).select("event_id", F.concat(F.lit("E"), F.date_format("ts", "yyyyMMdd"), F.lit("_"), F.lpad(n.cast("string"), 4, "0")).alias("name"))


@query(f"""SELECT final AS priority, level, count(*) AS rows, count(*) FILTER (confidence = 'low') AS low_confidence, count(*) FILTER (method = 'rule_fallback') AS by_rule, CAST(count(*) FILTER (freshness = 'new_fact') AS BIGINT) AS fresh FROM ({_LEVELLED}) WHERE final <> 'ARCHIVE' GROUP BY ALL""")
def q_selection_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is selected for a report, by priority and action level."""
    a = analysed(spark, sf_dir).where("final <> 'ARCHIVE'").withColumn("level", F.col("checked.action_level"))
    return a.groupBy(F.col("final").alias("priority"), "level").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("confidence") == "low").alias("low_confidence"), F.count_if(F.col("method") == "rule_fallback").alias("by_rule"), F.count_if(F.col("freshness") == "new_fact").alias("fresh")
    )


@query(f"""SELECT event_id, stage, CAST(row_number() OVER (ORDER BY stage, weighted DESC, event_id) AS INTEGER) AS place FROM (SELECT *, CASE WHEN final = 'P1' THEN 0 WHEN final = 'P2' AND level = 'test' THEN 1 WHEN level = 'watch' THEN 2 END AS stage FROM ({_LEVELLED}) WHERE final <> 'ARCHIVE') WHERE stage IS NOT NULL ORDER BY stage, weighted DESC, event_id LIMIT 5""")
def q_podcast_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five events for the podcast, filled up from those that are only watched: a top-k report."""
    a = analysed(spark, sf_dir).where("final <> 'ARCHIVE'").withColumn("level", F.col("checked.action_level"))
    stage = F.when(F.col("final") == "P1", 0).when((F.col("final") == "P2") & (F.col("level") == "test"), 1).when(F.col("level") == "watch", 2)
    top = a.select("event_id", "weighted", stage.alias("stage")).where("stage is not null").orderBy("stage", F.col("weighted").desc(), "event_id").limit(5)
    rows = top.agg(F.array_sort(F.collect_list(F.struct("stage", (-F.col("weighted")).alias("w"), "event_id"))).alias("rows")).select(F.posexplode("rows").alias("at", "r"))
    return rows.select("r.event_id", "r.stage", (F.col("at") + 1).alias("place"))


@query()
def q_distinct_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top three events of each day that share no platform or competitor, filled up where there are fewer: a top-k report."""
    d = downgraded(spark, sf_dir).where("final <> 'ARCHIVE'")
    rank = scoring.lookup(F.col("final"), {"P0": 0, "P1": 1, "P2": 2}, 3)
    rows = d.select(F.to_date("ts").alias("day"), "event_id", rank.alias("rank"), (-F.col("weighted")).alias("order"), F.concat("platforms", "competitors").alias("entities"))
    return gates.distinct_top(rows, "day", ["rank", "order", "event_id"], "entities", 3).select("day", "event_id", "place")


_TOLD = f"""SELECT event_id AS id, CAST(ts AS DATE) AS day, user_id || ':' || kind AS key, CAST(k % 97 AS VARCHAR) || '-' || user_id AS fact, substr(lower(regexp_replace(coalesce(fact, ''), '[^a-zA-Z]', '', 'g')), 1, 15) AS topic, {list_of(_TEXT, _NAMES)} AS entities, coalesce(evidence, '') AS title FROM ({_EVENTS})"""


@query(f"""WITH t AS (SELECT * FROM ({_TOLD}) WHERE id % 2 = 0), y AS (SELECT * REPLACE (day + 1 AS day) FROM ({_TOLD}) WHERE id % 2 = 1), ke AS (SELECT DISTINCT day, unnest(entities) AS e FROM y),
tt AS (SELECT DISTINCT day, topic FROM t WHERE length(topic) >= 5), yt AS (SELECT DISTINCT day, topic FROM y WHERE length(topic) >= 5),
tc AS (SELECT day, topic, list_distinct(string_split(topic, '')) AS c FROM tt), yc AS (SELECT day, topic, list_distinct(string_split(topic, '')) AS c FROM yt),
near AS (SELECT DISTINCT tc.day, tc.topic FROM tc JOIN yc ON tc.day = yc.day WHERE len(list_intersect(tc.c, yc.c)) / (len(tc.c) + len(yc.c) - len(list_intersect(tc.c, yc.c))) >= 0.6)
SELECT id FROM t WHERE (day, key) IN (SELECT (day, key) FROM y) OR (day, fact) IN (SELECT (day, fact) FROM y) OR (title <> '' AND (day, substr(title, 1, 20)) IN (SELECT (day, substr(title, 1, 20)) FROM y)) OR (day, topic) IN (SELECT (day, topic) FROM near)
UNION SELECT id FROM (SELECT t.id, count(*) AS n FROM (SELECT id, day, unnest(entities) AS e FROM t) t JOIN ke USING (day, e) WHERE t.e <> 'tion' AND t.e <> 'ent' AND t.e <> 'ing' GROUP BY t.id) WHERE n >= 2""")
def q_cross_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with even numbers that one with an odd number told the day before."""
    e = event_rows(spark, sf_dir)
    topic = F.substring(F.lower(F.regexp_replace(X.nz(F.col("fact")), "[^a-zA-Z]", "")), 1, 15)
    rows = e.select(
        F.col("event_id").alias("id"), F.to_date("ts").alias("day"), F.concat_ws(":", "user_id", "kind").alias("key"), F.concat_ws("-", F.col("k") % 97, "user_id").alias("fact"),
        topic.alias("topic"), X.keyword_hits(F.col("text"), _NAMES).alias("entities"), X.nz(F.col("evidence")).alias("title"),
    )
    return gates.cross_day(rows.where("id % 2 = 0"), rows.where("id % 2 = 1"), common=("tion", "ent", "ing"))


@query()
def q_greedy_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that a greedy pass over similar titles (by words) of one source absorbs, and what is kept for each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.substring_index("text", ".", 1).alias("title"), F.array("source").alias("sources"), F.col("n_chars").cast("double").alias("rich"))
    return dedup.greedy_removal(docs, "doc_id", "title", "sources", "rich", 0.55, letters=r"(\S+)")


_BEFORE = f"""SELECT id, key, half, coalesce(title, '') AS title, {list_of('title', _PLATFORMS)} AS entities, {list_of('fact', _COMPETITORS)} AS actions, list_distinct(list_transform(range(1, length(norm) - 1), lambda i: substr(norm, i, 3))) AS grams, norm
FROM (SELECT *, lower(regexp_replace(coalesce(title, ''), '[^\\p{{L}}\\p{{N}}_]', '', 'g')) AS norm FROM (SELECT min(event_id) AS id, kind || ':' || user_id AS key, CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-16' THEN 'now' ELSE 'before' END AS half, arg_min(title, event_id) AS title, arg_min(fact, event_id) AS fact FROM ({_EVENTS}) GROUP BY ALL))"""


@query(f"""WITH c AS MATERIALIZED ({_BEFORE}), n AS (SELECT * FROM c WHERE half = 'now'), p AS (SELECT * FROM c WHERE half = 'before')
SELECT CAST(n.id AS VARCHAR) AS id, CAST(p.id AS VARCHAR) AS previous_id FROM n JOIN p ON n.key = p.key OR (len(n.entities) > 0 AND list_sort(n.entities) = list_sort(p.entities) AND list_has_any(n.actions, p.actions))
 OR (n.norm <> '' AND n.norm = p.norm) OR (len(n.grams) > 0 AND len(p.grams) > 0 AND len(list_intersect(n.grams, p.grams)) / (len(n.grams) + len(p.grams) - len(list_intersect(n.grams, p.grams))) >= 0.7)""")
def q_like_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters (kind and user) of the second half of the month and their like of the first: by key, by equal entities of
    their first events and a common action, or by similar titles of these."""
    e = event_rows(spark, sf_dir)
    half = F.when(F.to_date("ts") >= "2024-01-16", "now").otherwise("before")
    first = F.min(F.struct("event_id", "title", "fact")).alias("first")
    c = e.groupBy(half.alias("half"), F.concat_ws(":", "kind", "user_id").alias("key")).agg(first).select("half", "key", "first.*")
    c = lineage.cut(c.select(F.col("event_id").alias("id"), "half", "key", "title", X.keyword_hits(F.col("title"), _PLATFORMS).alias("entities"), X.keyword_hits(F.col("fact"), _COMPETITORS).alias("actions")))
    return reports.like_before(c.where("half = 'now'"), c.where("half = 'before'"))


# --- gates ---------------------------------------------------------------------------------------------------------

_TURNS = "SELECT conv_id, turn, role, coalesce(text, '') AS text, coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), '') AS source FROM conversations"


@query(f"""SELECT conv_id, turn, unnest(list_filter([CASE WHEN len(string_split(text, chr(10))) < 2 THEN 'few_sections' END, CASE WHEN len(list_filter(list_distinct(regexp_extract_all(text, '(\\d+(?:\\.\\d+)?)', 1)), lambda x: NOT list_contains(regexp_extract_all(source, '(\\d+(?:\\.\\d+)?)', 1), x))) > 0 THEN 'unsourced_number' END,
 CASE WHEN length(text) * 5 > length(source) * 6 AND length(source) > 0 THEN 'longer_than_source' END, CASE WHEN regexp_matches(text, '[#$%&*]{{3}}') THEN 'unclean' END, CASE WHEN length(text) < 120 THEN 'too_short' END], lambda x: x IS NOT NULL)) AS issue FROM ({_TURNS}) WHERE role = 'assistant'""")
def q_draft_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of answers, as drafts, against the turn before, as their source."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", X.nz(F.col("text")).alias("text"), F.coalesce(F.lag("text").over(w), F.lit("")).alias("source")).where("role = 'assistant'")
    text, source = F.col("text"), F.col("source")
    found = gates.issues([
        ("few_sections", F.size(F.split(text, "\n")) < 2),
        ("unsourced_number", F.size(gates.unsourced(text, source)) > 0),
        ("longer_than_source", (F.length(text) * 5 > F.length(source) * 6) & (F.length(source) > 0)),
        ("unclean", text.rlike("[#$%&*]{3}")),
        ("too_short", F.length(text) < 120),
    ])
    return c.select("conv_id", "turn", F.explode(found).alias("issue"))


_WORDS = "list_distinct(list_filter(regexp_split_to_array(trim({}), '\\s+'), lambda x: x <> ''))"


@query(f"""SELECT conv_id, turn, CAST(len(list_filter(b, lambda x: NOT list_contains(a, x))) AS INTEGER) AS added, CAST(len(list_filter(a, lambda x: NOT list_contains(b, x))) AS INTEGER) AS dropped, CAST(len(list_filter(a, lambda x: list_contains(b, x))) AS INTEGER) AS kept
FROM (SELECT conv_id, turn, {_WORDS.format('text')} AS b, {_WORDS.format('source')} AS a FROM ({_TURNS}) WHERE turn > 0)""")
def q_draft_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that each turn adds to the one before, drops from it and keeps."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", X.nz(F.col("text")).alias("text"), F.coalesce(F.lag("text").over(w), F.lit("")).alias("source")).where("turn > 0")
    d = gates.compare_sets(F.array_distinct(X.words(F.col("source"))), F.array_distinct(X.words(F.col("text"))))
    return c.select("conv_id", "turn", d.alias("d")).select("conv_id", "turn", "d.*")


_ITEMS = {"turns": "turns >= 2", "answered": "answers > 0", "asked": "questions > 0", "long_enough": "chars >= 400", "not_too_long": "chars <= 4000", "ends_with_answer": "last_role = 'assistant'", "no_markup": "markup = 0", "no_address": "addresses = 0"}


@query(f"""SELECT conv_id, failed, failed = '' AS ok FROM (SELECT conv_id, concat_ws('|', {", ".join(f"CASE WHEN NOT ({c}) THEN '{n}' END" for n, c in _ITEMS.items())}) AS failed
FROM (SELECT conv_id, count(*) AS turns, count(*) FILTER (role = 'assistant') AS answers, count(*) FILTER (role = 'user') AS questions, sum(length(coalesce(text, ''))) AS chars, arg_max(role, turn) AS last_role, count(*) FILTER (contains(text, '###')) AS markup, count(*) FILTER (contains(text, '@')) AS addresses FROM conversations GROUP BY conv_id))""")
def q_send_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight items that have to hold before a conversation is sent."""
    text = X.nz(F.col("text"))
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("turns"), F.count_if(F.col("role") == "assistant").alias("answers"), F.count_if(F.col("role") == "user").alias("questions"), F.sum(F.length(text)).alias("chars"),
        F.max_by("role", "turn").alias("last_role"), F.count_if(text.contains("###")).alias("markup"), F.count_if(text.contains("@")).alias("addresses"),
    )
    gate = gates.send_gate({n: F.expr(c) for n, c in _ITEMS.items()})
    return c.select("conv_id", gate.alias("g")).select("conv_id", F.array_join("g.failed", "|").alias("failed"), "g.ok")


_SENTENCES = "list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '[.!?。！？\\n]'), lambda s: length(trim(s))), lambda n: n > 0)"


@query(f"""SELECT conv_id, turn, CAST(len(n) AS INTEGER) AS sentences, CAST(coalesce(list_sum(n), 0) AS INTEGER) AS chars, CAST(coalesce(list_max(n), 0) AS INTEGER) AS longest, CAST(len(list_filter(n, lambda x: x > 40)) AS INTEGER) AS long_ones,
 CASE WHEN len(list_filter(n, lambda x: x > 40)) * 2 > len(n) THEN 'fail' WHEN turn % 3 = 0 THEN 'pass' WHEN turn % 3 = 1 THEN 'revise' WHEN coalesce(list_sum(n), 0) >= 60 THEN 'pass' ELSE 'revise' END AS verdict FROM (SELECT conv_id, turn, {_SENTENCES} AS n FROM conversations)""")
def q_script_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentence statistics of turns as scripts, and the verdict of rule and review together."""
    s = gates.sentence_stats(F.col("text"))
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", s.alias("s")).select("conv_id", "turn", "s.*")
    by_rule = F.when(F.col("long_ones") * 2 > F.col("sentences"), "fail")
    reviewed = F.when(F.col("turn") % 3 == 0, "pass").when(F.col("turn") % 3 == 1, "revise")
    return c.withColumn("verdict", gates.merge_verdicts(F.coalesce(by_rule, F.lit("")), reviewed, F.col("chars")))


# --- categories and discovery --------------------------------------------------------------------------------------

_CATEGORY = """CASE event_type WHEN 'click' THEN 'feed_count' WHEN 'view' THEN 'monitor_count' ELSE CASE k % 4 WHEN 0 THEN 'search_count' ELSE CASE WHEN k % 5 = 0 THEN 'broad_count' WHEN contains(event_type, 'err') THEN 'browser_count' ELSE 'feed_count' END END END"""
_DTIER = "CASE WHEN k % 11 = 0 THEN 'channel' WHEN event_type IN ('error', 'signup') THEN 'broad' WHEN k % 3 = 0 THEN 'search' ELSE 'channel' END"
_TIERN = "CASE WHEN k % 7 < 4 THEN k % 7 WHEN k % 7 = 4 THEN 1 WHEN k % 7 = 5 THEN 2 ELSE 3 END"
_CATEGORISED = f"SELECT *, {_CATEGORY} AS category, {_DTIER} AS date_tier, {_TIERN} AS tier FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"


def categorised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the category of their source, the tier of their date and that of the source (a number or a label)."""
    k = F.get_json_object("props", "$.k").cast("int")
    e = table(spark, sf_dir, "events").withColumn("k", k)
    k = F.col("k")
    category = F.coalesce(
        scoring.lookup(F.col("event_type"), {"click": "feed_count", "view": "monitor_count"}, None),
        F.when(k % 4 == 0, "search_count"),
        F.when(k % 5 == 0, "broad_count"),
        F.when(F.col("event_type").contains("err"), "browser_count"),
        F.lit("feed_count"),
    )
    tier = F.when(k % 11 == 0, "channel").when(F.col("event_type").isin("error", "signup"), "broad").when(k % 3 == 0, "search").otherwise("channel")
    given = F.when(k % 7 < 4, (k % 7).cast("string")).when(k % 7 == 4, "tier1_direct_signal").when(k % 7 == 5, "tier2").otherwise("unheard of")
    labels = {"tier1_direct_signal": 1, "tier1": 1, "direct_signal": 1, "tier2_analysis": 2, "tier2": 2, "tier3_anchor": 3, "tier3": 3, "tier4_clue": 4, "tier4": 4}
    return e.withColumn("category", category).withColumn("date_tier", tier).withColumn("tier", F.coalesce(given.try_cast("int"), scoring.lookup(given, labels, 3)))


@query(f"SELECT category, date_tier, tier, count(*) AS rows FROM ({_CATEGORISED}) GROUP BY ALL")
def q_source_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categorised(spark, sf_dir).groupBy("category", "date_tier", "tier").agg(F.count(F.lit(1)).alias("rows"))


_STATUS = "CASE WHEN ts > TIMESTAMP '2024-01-20 12:00:00' THEN 'in_window' WHEN floor((epoch_us(TIMESTAMP '2024-01-20 12:00:00') - epoch_us(ts)) / 86400000000.0) <= 2 THEN 'in_window' WHEN floor((epoch_us(TIMESTAMP '2024-01-20 12:00:00') - epoch_us(ts)) / 86400000000.0) <= 7 THEN 'near_window' ELSE 'old' END"


@query(f"""SELECT concat_ws('x', CASE WHEN category IS NOT NULL THEN 'category' END, CASE WHEN status IS NOT NULL THEN 'status' END, CASE WHEN tier IS NOT NULL THEN 'tier' END) AS dimension, list_filter([category, status, tier], lambda x: x IS NOT NULL)[1] AS value, list_filter([category, status, tier], lambda x: x IS NOT NULL)[2] AS value2, count(*) AS rows
FROM (SELECT category, {_STATUS} AS status, CAST(tier AS VARCHAR) AS tier FROM ({_CATEGORISED})) GROUP BY GROUPING SETS ((category), (status), (tier), (category, status), (status, tier))""")
def q_discovery_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by category, time status and tier in one pass."""
    status = T.time_status(F.col("ts").cast("timestamp"), F.lit("2024-01-20 12:00:00").cast("timestamp"))
    return reports.counters(categorised(spark, sf_dir).withColumn("status", status), ["category", "status", "tier", ("category", "status"), ("status", "tier")])


@query("""SELECT page_id, regexp_matches(lower(url), '/product/|/products/|/goods/|/item/\\d+|/sku/|/cart|/coupon|/promotion/|/category/|/search\\?|/jobs/|/careers/|instagram\\.com/|facebook\\.com/|pinterest\\.com/|twitter\\.com/|x\\.com/|/download|/app$|\\.pdf$') AS noise,
 regexp_matches(url, '(?i)[?&]page=\\d+') AS paged, length(coalesce(regexp_extract(html, '<title>([^<]*)</title>', 1), '')) >= 4 AND NOT regexp_matches(url, '(?i)[?&]page=\\d+') AND NOT regexp_matches(url, '/\\d{3,6}(/|\\?)') AS candidate FROM pages""")
def q_enrich_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose text is worth fetching: titled, and neither a list nor a numbered part."""
    url = F.col("url")
    paged = url.rlike(r"(?i)[?&]page=\d+")
    titled = F.length(X.nz(F.regexp_extract("html", "<title>([^<]*)</title>", 1))) >= 4
    return table(spark, sf_dir, "pages").select("page_id", U.is_noise(url).alias("noise"), paged.alias("paged"), (titled & ~paged & ~url.rlike(r"/\d{3,6}(/|\?)")).alias("candidate"))


@query(f"""WITH f AS (SELECT *, strftime(ts, '%G-W%V') AS period, {list_of(_TEXT, _NAMES)} AS names FROM ({_FINAL}) WHERE final <> 'ARCHIVE'), x AS (SELECT period, unnest(names) AS name, weighted, event_id FROM f),
s AS (SELECT period, name, count(*) AS rows, CAST(max(weighted) AS DOUBLE) AS best FROM x GROUP BY ALL)
SELECT period, name, rows, best, lag(rows) OVER (PARTITION BY name ORDER BY period) AS before, CAST(100 * rows // sum(rows) OVER (PARTITION BY period) AS BIGINT) AS percent FROM s""")
def q_period_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selected events by week and name they hold, with the week before and the share of the week's in percent, cut."""
    d = downgraded(spark, sf_dir).where("final <> 'ARCHIVE'").select(T.period_id(F.to_date("ts"), "weekly").alias("period"), F.explode(X.keyword_hits(F.col("text"), _NAMES)).alias("name"), "weighted")
    s = d.groupBy("period", "name").agg(F.count(F.lit(1)).alias("rows"), F.max("weighted").alias("best"))
    before = F.lag("rows").over(Window.partitionBy("name").orderBy("period"))
    return s.select("*", before.alias("before"), F.floor(100 * F.col("rows") / F.sum("rows").over(Window.partitionBy("period"))).alias("percent"))
