"""Queries over articles: documents as bodies, pages as addresses and markup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import text as X
from gristmill.functions import times as T
from gristmill.functions import urls as U
from gristmill.operators import dedup, reports, scoring
from gristmill.plans.registry import query, table

#: Parameters: small lexicons of the tables' invented words.
CORE, PLATFORM, NEGATIVE = ("tionou", "keit", "ouvi", "mente"), ("thereti", "lichung", "eauoi", "ción"), ("idiot", "clown", "worthless")
KEYWORDS = (*CORE, *PLATFORM, *NEGATIVE)
_SQL_HITS = "list_filter([" + ", ".join(f"'{k}'" for k in KEYWORDS) + "], lambda k: contains(lower(coalesce(text, '')), k))"


def _any_sql(words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce(text, '')), '{w}')" for w in words) + ")"


def scored(docs: DataFrame) -> DataFrame:
    """Rule score, reasons, decision and pool of ``docs``."""
    text = F.col("text")
    score, reasons = scoring.rule_score([
        (X.any_keyword(text, CORE), 5, "core"),
        (X.any_keyword(text, PLATFORM), 3, "platform"),
        (F.length("text") > 500, 2, "rich"),
        (F.col("lang") == "en", 1, "main_language"),
        (X.any_keyword(text, NEGATIVE), -5, "negative"),
        (text.contains("###"), -3, "markup"),
        (F.length(F.trim(X.nz(text))) < 100, -2, "thin"),
    ])
    out = docs.withColumn("rule_score", score).withColumn("reasons", reasons)
    out = out.withColumn("decision", scoring.decide(F.col("rule_score"), 6, 3))
    guard = scoring.first_guard(
        [(X.any_keyword(text, NEGATIVE), "reject", "negative"), (text.contains("###"), "reference", "markup"), (F.col("decision") == "keep", "main", "score"), (F.col("decision") == "review", "reference", "score")],
        ("reject", "score"),
    )
    return out.withColumn("g", guard).withColumn("pool", F.col("g.outcome")).withColumn("pool_reason", F.col("g.reason")).drop("g")


SCORED_SQL = f"""
SELECT *, CASE WHEN neg THEN 'reject' WHEN mark THEN 'reference' WHEN decision = 'keep' THEN 'main' WHEN decision = 'review' THEN 'reference' ELSE 'reject' END AS pool,
  CASE WHEN neg THEN 'negative' WHEN mark THEN 'markup' ELSE 'score' END AS pool_reason
FROM (SELECT *, CASE WHEN rule_score >= 6 THEN 'keep' WHEN rule_score >= 3 THEN 'review' ELSE 'reject' END AS decision
  FROM (SELECT *, CAST((CASE WHEN {_any_sql(CORE)} THEN 5 ELSE 0 END) + (CASE WHEN {_any_sql(PLATFORM)} THEN 3 ELSE 0 END) + (CASE WHEN length(text) > 500 THEN 2 ELSE 0 END)
      + (CASE WHEN lang = 'en' THEN 1 ELSE 0 END) - (CASE WHEN neg THEN 5 ELSE 0 END) - (CASE WHEN mark THEN 3 ELSE 0 END) - (CASE WHEN length(trim(coalesce(text, ''))) < 100 THEN 2 ELSE 0 END) AS INTEGER) AS rule_score
    FROM (SELECT *, {_any_sql(NEGATIVE)} AS neg, coalesce(contains(text, '###'), false) AS mark FROM documents)))"""


@query(f"SELECT source, pool, count(*) AS n, sum(CAST(rule_score AS BIGINT))::BIGINT AS total_score FROM ({SCORED_SQL}) GROUP BY ALL")
def q_rule_score_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored(table(spark, sf_dir, "documents"))
    return s.groupBy("source", "pool").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("rule_score").cast("long")).alias("total_score"))


@query(f"SELECT doc_id, array_to_string({_SQL_HITS}, '|') AS hits, CAST(len({_SQL_HITS}) AS INTEGER) AS n_hits FROM documents")
def q_keyword_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = X.keyword_hits(F.col("text"), KEYWORDS)
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(hits, "|").alias("hits"), F.size(hits).alias("n_hits"))


@query(f"SELECT keyword, count(*) AS n FROM (SELECT unnest({_SQL_HITS}) AS keyword FROM documents) GROUP BY keyword ORDER BY n DESC, keyword LIMIT 20")
def q_keyword_freq_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "documents").select(F.explode(X.keyword_hits(F.col("text"), KEYWORDS)).alias("keyword"))
    return words.groupBy("keyword").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "keyword").limit(20)


@query("""SELECT lang, CASE WHEN n > 500 THEN 'rich' WHEN n > 100 THEN 'moderate' WHEN n > 0 THEN 'thin' ELSE 'empty' END AS status, count(*) AS rows
FROM (SELECT lang, length(trim(coalesce(text, ''))) AS n FROM documents) GROUP BY ALL""")
def q_content_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("lang", X.content_status(F.col("text")).alias("status")).agg(F.count(F.lit(1)).alias("rows"))


_URL = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"


@query(f"""WITH p AS (SELECT page_id, lower(regexp_extract(url, '{_URL}', 1)) || '://' || lower(regexp_extract(url, '{_URL}', 2)) || coalesce(nullif(rtrim(regexp_extract(url, '{_URL}', 3), '/'), ''), '/') AS base, lower(regexp_extract(url, '{_URL}', 2)) AS host, rtrim(regexp_extract(url, '{_URL}', 3), '/') AS path, lower(regexp_extract(url, '{_URL}', 1)) AS scheme, regexp_extract(url, '{_URL}', 3) AS raw,
  substr(regexp_extract(url, '{_URL}', 4), 2) AS q FROM pages),
f AS (SELECT *, list_filter(string_split(q, '&'), lambda x: contains(x, '=') AND lower(split_part(x, '=', 1)) NOT IN ('utm_source','utm_medium','utm_campaign','utm_content','utm_term','from','share')) AS pairs, list_filter(string_split(q, '&'), lambda x: x <> '' AND lower(split_part(x, '=', 1)) NOT IN ('utm_source','utm_medium','utm_campaign','utm_term','utm_content','from','is_from_web','share_token','share_time','spm','tt_from','oid','ctype','cid','refer','pos','page','_ref','did')) AS monitored FROM p)
SELECT page_id, base || CASE WHEN len(pairs) > 0 THEN '?' || array_to_string(pairs, '&') ELSE '' END AS filtered,
  base || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS kept, base AS dropped, scheme || '://' || regexp_replace(host, '^www[.]', '') || CASE WHEN raw = '/' THEN '/' ELSE path END || CASE WHEN len(monitored) > 0 THEN '?' || array_to_string(list_transform(list_sort(list_transform(monitored, lambda x, k: {{'name': split_part(x, '=', 1), 'k': k, 'p': CASE WHEN contains(x, '=') THEN x ELSE x || '=' END}})), lambda x: x.p), '&') ELSE '' END AS canonical, host || lower(path) AS funnel FROM f""")
def q_url_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", U.normalize_url(url).alias("filtered"), U.normalize_url(url, query="keep").alias("kept"), U.page_key(url).alias("dropped"), U.canonical_url(url).alias("canonical"), U.funnel_key(url).alias("funnel"))


@query(f"""WITH h AS (SELECT lower(regexp_extract(url, '{_URL}', 2)) AS host FROM pages),
t(domain, tier, ord) AS (VALUES ('example.com', 1, 1), ('example.net', 2, 2), ('m.example.net', 3, 3), ('thther.example.org', 4, 4), ('example.org', 5, 5)),
f AS (SELECT host, coalesce((SELECT domain FROM t WHERE domain = host), (SELECT arg_min(domain, ord) FROM t WHERE host LIKE '%.' || domain)) AS domain FROM h)
SELECT coalesce(f.domain, '(none)') AS domain, coalesce(tier, 0) AS tier, count(*) AS pages, count(DISTINCT host) AS hosts FROM f LEFT JOIN t ON t.domain = f.domain GROUP BY 1, 2""")
def q_url_host_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiers = spark.createDataFrame([("example.com", 1, 1), ("example.net", 2, 2), ("m.example.net", 3, 3), ("thther.example.org", 4, 4), ("example.org", 5, 5)], "domain string, tier int, ord int")
    pages = table(spark, sf_dir, "pages").select(U.url_part(F.col("url"), "host").alias("host"))
    found = U.match_hosts(pages, "host", tiers)
    return found.groupBy(F.coalesce("domain", F.lit("(none)")).alias("domain"), F.coalesce("tier", F.lit(0)).alias("tier")).agg(F.count(F.lit(1)).alias("pages"), F.count_distinct("host").alias("hosts"))


@query("""SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(html, '<html[^>]*lang="([^"]*)"', 1) AS lang,
  CAST(len(regexp_extract_all(html, '<a[^>]*href="([^"]*)"', 1)) AS INTEGER) AS links FROM pages""")
def q_html_title_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = F.regexp_extract_all("html", F.lit('<a[^>]*href="([^"]*)"'), F.lit(1))
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.regexp_extract("html", '<html[^>]*lang="([^"]*)"', 1).alias("lang"), F.size(links).alias("links"))


_KEY_SQL = "regexp_replace(lower(coalesce(text, '')), '\\s+', '', 'g')"


@query(f"SELECT doc_id, source, lang FROM (SELECT *, row_number() OVER (PARTITION BY md5({_KEY_SQL}) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def q_dedup_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    keyed = docs.select("doc_id", "source", "lang", F.md5(F.regexp_replace(F.lower(X.nz(F.col("text"))), r"\s+", "").cast("binary")).alias("key"))
    return dedup.first_wins(keyed, F.col("key"), ["doc_id"]).select("doc_id", "source", "lang")


@query(f"""WITH d AS (SELECT doc_id, source, md5({_KEY_SQL}) AS k1, lower(split_part(text, chr(10), 1)) AS k2, CAST(substr(source, 4) AS INTEGER) % 3 AS tier FROM documents),
a AS (SELECT *, row_number() OVER (PARTITION BY k1 ORDER BY tier, doc_id) AS rn FROM d), b AS (SELECT *, row_number() OVER (PARTITION BY k2 ORDER BY tier, doc_id) AS rn2 FROM a WHERE rn = 1),
src AS (SELECT a.k1, list(a.source) AS all1 FROM a GROUP BY a.k1), g AS (SELECT b.k2, flatten(list(s.all1)) AS names FROM b JOIN src s USING (k1) GROUP BY b.k2)
SELECT b.doc_id, array_to_string(list_sort(list_filter(list_distinct(g.names), lambda x: x <> b.source)), ',') AS merged FROM b JOIN g USING (k2) WHERE rn2 = 1""")
def q_dedup_tier_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "source", F.md5(F.regexp_replace(F.lower(X.nz(F.col("text"))), r"\s+", "").cast("binary")).alias("k1"), F.lower(F.substring_index("text", "\n", 1)).alias("k2"), (F.substring("source", 4, 9).cast("int") % 3).alias("tier"))
    merged = dedup.merge_by_tier(rows, [F.col("k1"), F.col("k2")], "tier", "doc_id", "source")
    return merged.select("doc_id", F.array_join(F.array_except("merged_sources", F.array("source")), ",").alias("merged"))


@query("SELECT source, count(*) AS new_rows FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY source")
def q_anti_new_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = dedup.unseen(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")
    return fresh.groupBy("source").agg(F.count(F.lit(1)).alias("new_rows"))


def _sets_sql(sets: str) -> str:
    return f"""SELECT concat_ws('x', CASE WHEN lang IS NOT NULL THEN 'lang' END, CASE WHEN pool IS NOT NULL THEN 'pool' END, CASE WHEN source IS NOT NULL THEN 'source' END) AS dimension,
  list_filter([lang, pool, source], lambda x: x IS NOT NULL)[1] AS value, list_filter([lang, pool, source], lambda x: x IS NOT NULL)[2] AS value2, count(*) AS rows FROM ({SCORED_SQL}) GROUP BY GROUPING SETS {sets}"""


@query(_sets_sql("((lang), (pool), (source), (lang, pool), (pool, source))"))
def q_funnel_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.counters(scored(table(spark, sf_dir, "documents")), ["lang", "pool", "source", ("lang", "pool"), ("pool", "source")])


@query(f"SELECT source, count(*) FILTER (pool = 'main') AS main, count(*) FILTER (pool = 'reference') AS reference, count(*) FILTER (pool = 'reject') AS reject FROM ({SCORED_SQL}) GROUP BY source")
def q_source_pool_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored(table(spark, sf_dir, "documents"))
    return s.groupBy("source").pivot("pool", ["main", "reference", "reject"]).count().fillna(0, ["main", "reference", "reject"])


_HEALTH = f"""SELECT *, CASE WHEN recent >= 0.3 AND kept >= 0.1 THEN 'A' WHEN recent >= 0.3 THEN 'B' WHEN old >= 0.8 AND matched > 0 THEN 'C' WHEN old >= 0.8 THEN 'D' WHEN old >= 0.5 THEN 'C' ELSE 'B' END AS grade
FROM (SELECT source, total, main, matched, (in_window + near_window) / total AS recent, old_rows / total AS old, main / total AS kept, in_window, near_window, old_rows, unknown_time
FROM (SELECT source, count(*) AS total, count(*) FILTER (pool = 'main') AS main, count(*) FILTER (len({_SQL_HITS}) > 0) AS matched, count(*) FILTER (t = 'in_window') AS in_window, count(*) FILTER (t = 'near_window') AS near_window, count(*) FILTER (t = 'old') AS old_rows, count(*) FILTER (t = 'unknown_time') AS unknown_time
FROM (SELECT d.*, CASE WHEN e.ts IS NULL THEN 'unknown_time' WHEN e.ts > TIMESTAMP '2024-01-31' - to_days(CAST(substr(source, 4) AS INTEGER)) THEN 'in_window' WHEN floor((epoch_us(TIMESTAMP '2024-01-31' - to_days(CAST(substr(source, 4) AS INTEGER))) - epoch_us(e.ts)) / 86400000000.0) <= 2 THEN 'in_window'
  WHEN floor((epoch_us(TIMESTAMP '2024-01-31' - to_days(CAST(substr(source, 4) AS INTEGER))) - epoch_us(e.ts)) / 86400000000.0) <= 7 THEN 'near_window' ELSE 'old' END AS t FROM ({SCORED_SQL}) d LEFT JOIN events e ON e.event_id = 10 * d.doc_id) GROUP BY source))"""


def source_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, ratios and grade of each source. A source's clock stands as many days before the last event as its number."""
    events = table(spark, sf_dir, "events").where("event_id % 10 = 0").select((F.col("event_id") / 10).cast("long").alias("doc_id"), F.col("ts").cast("timestamp").alias("ts"))
    s = scored(table(spark, sf_dir, "documents")).join(events, "doc_id", "left")
    clock = F.timestamp_micros(F.unix_micros(F.lit("2024-01-31 00:00:00").cast("timestamp")) - F.substring("source", 4, 9).cast("long") * 86_400_000_000)
    s = s.withColumn("t", T.time_status(F.col("ts"), clock))
    of = lambda t: F.count_if(F.col("t") == t)
    s = s.groupBy("source").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("pool") == "main").alias("main"), F.count_if(X.any_keyword(F.col("text"), KEYWORDS)).alias("matched"),
        of("in_window").alias("in_window"), of("near_window").alias("near_window"), of("old").alias("old_rows"), of("unknown_time").alias("unknown_time"),
    )
    s = s.select("*", ((F.col("in_window") + F.col("near_window")) / F.col("total")).alias("recent"), (F.col("old_rows") / F.col("total")).alias("old"), (F.col("main") / F.col("total")).alias("kept"))
    return s.withColumn("grade", reports.source_grade(F.col("recent"), F.col("old"), F.col("kept"), F.col("matched")))


@query(f"SELECT source, total, main, matched, in_window, near_window, old_rows, unknown_time, floor(recent * 10000) / 10000 AS recent_ratio, floor(old * 10000) / 10000 AS old_ratio, grade, CASE grade WHEN 'A' THEN 'keep_primary' WHEN 'B' THEN 'keep_secondary_limit' WHEN 'C' THEN 'reference_only' ELSE 'disable_candidate' END AS recommendation FROM ({_HEALTH})")
def q_source_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lambda c: F.floor(F.col(c) * 10000) / 10000
    advice = scoring.lookup(F.col("grade"), reports.RECOMMENDED, "")
    return source_health(spark, sf_dir).select("source", "total", "main", "matched", "in_window", "near_window", "old_rows", "unknown_time", cut("recent").alias("recent_ratio"), cut("old").alias("old_ratio"), "grade", advice.alias("recommendation"))


@query(f"SELECT grade, count(*) AS sources, CAST(sum(total) AS BIGINT) AS articles, CAST(sum(main) AS BIGINT) AS main, CAST(sum(unknown_time) AS BIGINT) AS unknown_time FROM ({_HEALTH}) GROUP BY ROLLUP (grade)")
def q_health_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources by grade, and all of them (null)."""
    return source_health(spark, sf_dir).rollup("grade").agg(F.count(F.lit(1)).alias("sources"), F.sum("total").alias("articles"), F.sum("main").alias("main"), F.sum("unknown_time").alias("unknown_time"))


@query(f"SELECT pool, doc_id, rule_score, CAST(rn AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY pool ORDER BY rule_score DESC, doc_id) AS rn FROM ({SCORED_SQL})) WHERE rn <= 50")
def q_top50_per_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored(table(spark, sf_dir, "documents"))
    return reports.top_per_group(s, ["pool"], [F.col("rule_score").desc(), F.col("doc_id")], 50).select("pool", "doc_id", "rule_score", "rank")


@query(f"""SELECT d.source, count(*) AS raw_rows, count(l.doc_id) AS processed, count(*) FILTER (l.quality = 1) AS good, count(*) FILTER (l.doc_id IS NULL) AS unprocessed
FROM ({SCORED_SQL}) d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l USING (doc_id) GROUP BY d.source""")
def q_funnel_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.lit(True).alias("met"))
    rows = table(spark, sf_dir, "documents").select("doc_id", "source").join(labels, "doc_id", "left")
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("raw_rows"), F.count("met").alias("processed"), F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("met").isNull()).alias("unprocessed"))


@query(f"""SELECT 'low_main_share' AS issue, source FROM (SELECT source, count(*) AS n, count(*) FILTER (pool = 'main') AS m FROM ({SCORED_SQL}) GROUP BY source) WHERE m * 100 < n * 42
UNION ALL SELECT 'mostly_reject', source FROM (SELECT source, count(*) AS n, count(*) FILTER (pool = 'reject') AS r FROM ({SCORED_SQL}) GROUP BY source) WHERE r * 100 > n * 15""")
def q_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored(table(spark, sf_dir, "documents")).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("pool") == "main").alias("m"), F.count_if(F.col("pool") == "reject").alias("r"))
    issues = F.array_compact(F.array(F.when(F.col("m") * 100 < F.col("n") * 42, "low_main_share"), F.when(F.col("r") * 100 > F.col("n") * 15, "mostly_reject")))
    return s.select(F.explode(issues).alias("issue"), "source")


@query("""SELECT lang, CASE WHEN contains(text, '###') THEN 'markup' WHEN regexp_matches(text, '!!( |$|\\n)') THEN 'shouting' WHEN contains(text, ' | ') THEN 'table' WHEN length(text) < 100 THEN 'notice' WHEN regexp_matches(text, '(?m)^(Licensed|Released)') THEN 'licence' ELSE 'article' END AS page_type, count(*) AS rows
FROM documents GROUP BY ALL""")
def q_page_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    guard = scoring.first_guard([(t.contains("###"), "markup", ""), (t.rlike("!!( |$|\n)"), "shouting", ""), (t.contains(" | "), "table", ""), (F.length(t) < 100, "notice", ""), (t.rlike("(?m)^(Licensed|Released)"), "licence", "")], ("article", ""))
    return table(spark, sf_dir, "documents").groupBy("lang", guard["outcome"].alias("page_type")).agg(F.count(F.lit(1)).alias("rows"))


@query(f"""SELECT doc_id, rule_score * 10 + CASE WHEN length(text) > 1000 THEN 15 WHEN length(text) > 300 THEN 5 ELSE 0 END AS evergreen_score FROM ({SCORED_SQL}) WHERE pool <> 'reject' AND NOT mark AND length(text) >= 200""")
def q_evergreen(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored(table(spark, sf_dir, "documents"))
    s = s.where((F.col("pool") != "reject") & ~F.coalesce(F.col("text").contains("###"), F.lit(False)) & (F.length("text") >= 200))
    return s.select("doc_id", (F.col("rule_score") * 10 + F.when(F.length("text") > 1000, 15).when(F.length("text") > 300, 5).otherwise(0)).alias("evergreen_score"))


@query("""SELECT doc_id, 'tionou' AS keyword, substr(list_filter(list_transform(regexp_split_to_array(text, '[.!?\\n]'), lambda s: trim(s)), lambda s: contains(lower(s), 'tionou') AND length(s) > 10)[1], 1, 200) AS evidence
FROM documents WHERE contains(lower(text), 'tionou')""")
def q_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where(F.lower("text").contains("tionou"))
    return docs.select("doc_id", F.lit("tionou").alias("keyword"), X.evidence(F.col("text"), "tionou").alias("evidence"))


@query(f"""WITH m AS (SELECT doc_id, k.type, k.ord FROM documents d, (VALUES ('core', 'tionou', 1), ('core', 'keit', 1), ('platform', 'lichung', 2), ('platform', 'eauoi', 2), ('risk', 'idiot', 3), ('risk', 'clown', 3)) k(type, keyword, ord) WHERE contains(lower(d.text), k.keyword)),
u AS (SELECT DISTINCT doc_id, type, ord FROM m), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS rn FROM u)
SELECT doc_id, type AS event_type, CAST(rn AS INTEGER) AS rank FROM r WHERE rn <= 2""")
def q_rule_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = [("core", ("tionou", "keit"), 1), ("platform", ("lichung", "eauoi"), 2), ("risk", ("idiot", "clown"), 3)]
    met = F.array_compact(F.array(*[F.when(X.any_keyword(F.col("text"), ks), F.lit(t)) for t, ks, _ in types]))
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(F.slice(met, 1, 2)).alias("pos", "event_type")).select("doc_id", "event_type", (F.col("pos") + 1).alias("rank"))


@query("""WITH g AS (SELECT item_id, unnest(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')))) AS gram FROM (SELECT item_id, list_filter(regexp_split_to_array(trim(text), '\\s+'), lambda x: x <> '') AS w FROM benchmark) WHERE len(w) >= 4),
d AS (SELECT DISTINCT doc_id, gram FROM (SELECT doc_id, unnest(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) AS gram FROM (SELECT doc_id, list_filter(regexp_split_to_array(trim(text), '\\s+'), lambda x: x <> '') AS w FROM documents) WHERE len(w) >= 4) SEMI JOIN g USING (gram)),
n AS (SELECT item_id, count(*) AS total FROM g GROUP BY item_id)
SELECT item_id, doc_id, count(*) AS common, any_value(total) AS total FROM g JOIN d USING (gram) JOIN n USING (item_id) GROUP BY item_id, doc_id HAVING count(*) * 2 >= any_value(total)""")
def q_ngram_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    def grams(df: DataFrame, key: str) -> DataFrame:
        w = df.select(key, X.words(F.col("text")).alias("w")).where(F.size("w") >= 4)
        each = F.transform(F.sequence(F.lit(1), F.size("w") - 3), lambda i: F.array_join(F.slice("w", i, 4), " "))
        return w.select(key, F.explode(F.array_distinct(each)).alias("gram"))

    items = grams(table(spark, sf_dir, "benchmark"), "item_id")
    total = items.groupBy("item_id").agg(F.count(F.lit(1)).alias("total"))
    met = grams(table(spark, sf_dir, "documents"), "doc_id").join(items, "gram").groupBy("item_id", "doc_id").agg(F.count(F.lit(1)).alias("common"))
    return met.join(total, "item_id").where("common * 2 >= total").select("item_id", "doc_id", "common", "total")


@query("""SELECT conv_id, turn, CAST(len(p) AS INTEGER) AS clauses, CAST(coalesce(list_max(p), 0) AS INTEGER) AS longest, CAST(coalesce(list_sum(p), 0) AS BIGINT) AS chars
FROM (SELECT conv_id, turn, list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '[,.;:!?\\n]'), lambda s: length(trim(s))), lambda n: n > 0) AS p FROM conversations)""")
def q_rhythm(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = X.sentence_lengths(F.col("text"))
    total = F.aggregate(n, F.lit(0).cast("long"), lambda a, x: a + x)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.size(n).alias("clauses"), F.coalesce(F.array_max(n), F.lit(0)).alias("longest"), total.alias("chars"))


@query(f"""SELECT 'pools' AS check_name, (SELECT count(*) FROM documents) AS left_rows, (SELECT count(*) FROM ({SCORED_SQL}) WHERE pool IN ('main', 'reference', 'reject')) AS right_rows, (SELECT count(*) FROM documents) = (SELECT count(*) FROM ({SCORED_SQL}) WHERE pool IN ('main', 'reference', 'reject')) AS ok
UNION ALL SELECT 'labelled', (SELECT count(*) FROM labels), (SELECT count(*) FROM labels SEMI JOIN documents USING (doc_id)), (SELECT count(*) FROM labels) = (SELECT count(*) FROM labels SEMI JOIN documents USING (doc_id))""")
def q_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return reports.reconcile([("pools", docs, scored(docs).where(F.col("pool").isin("main", "reference", "reject"))), ("labelled", labels, labels.join(docs.select("doc_id"), "doc_id", "left_semi"))])


def q_title_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of document titles (first lines) with trigram similarity of 0.7 or more, once for each distinct title."""
    titles = table(spark, sf_dir, "documents").select(F.substring_index("text", "\n", 1).alias("title"), "doc_id").where(F.length("title") >= 12)
    firsts = dedup.spread(titles.groupBy("title").agg(F.min("doc_id").alias("doc_id"))).withColumn("grams", X.char_ngrams(F.col("title")))
    return dedup.similar_pairs(firsts, "doc_id", "grams", 0.7).select("a", "b", (F.floor(F.col("similarity") * 1e6) / 1e6).alias("similarity"))


query("""WITH t AS (SELECT min(doc_id) AS doc_id, title FROM (SELECT doc_id, split_part(text, chr(10), 1) AS title FROM documents) WHERE length(title) >= 12 GROUP BY title),
g AS (SELECT doc_id, list_distinct(list_transform(range(1, length(title) - 1), lambda i: substr(title, i, 3))) AS grams FROM t),
e AS (SELECT doc_id, unnest(grams) AS gram, len(grams) AS n FROM g), c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i, any_value(x.n) + any_value(y.n) - count(*) AS u FROM e x JOIN e y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY 1, 2)
SELECT a, b, floor(i / u * 1e6) / 1e6 AS similarity FROM c WHERE i / u >= 0.7""")(q_title_similarity)


@query()
def q_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = X.chunks(F.col("text"), 2000)
    return table(spark, sf_dir, "documents").select("doc_id", F.size(pieces).alias("chunks"), F.aggregate(pieces, F.lit(0).cast("long"), lambda a, p: a + F.length(p)).alias("chars"))


_ANCHOR = "'(?is)<a\\s[^>]*\\shref=\"[^\"]*\"[^>]*>.*?</a>|<a\\shref=\"[^\"]*\"[^>]*>.*?</a>'"


@query(f"""SELECT page_id, url, title FROM (SELECT page_id, regexp_extract(base, '^([a-z]+://[^/?#]*)', 1) AS site, regexp_extract(a, 'href="([^"]*)"', 1) AS href, trim(regexp_replace(regexp_replace(a, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS title
FROM (SELECT page_id, url AS base, unnest(regexp_extract_all(html, {_ANCHOR})) AS a FROM pages)), LATERAL (SELECT CASE WHEN starts_with(href, 'http') THEN href WHEN starts_with(href, '/') THEN site || href END AS url) WHERE url IS NOT NULL AND length(title) >= 3""")
def q_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses and titles of the links of pages, relative ones under the page's host."""
    found = U.links(F.col("html"), F.col("url"), least_title=3)
    return table(spark, sf_dir, "pages").select("page_id", F.explode(found).alias("l")).select("page_id", "l.url", "l.title")


@query(f"""WITH r AS (SELECT doc_id, source, {_KEY_SQL} AS k FROM documents), d AS (SELECT k, min(doc_id) AS doc_id FROM r GROUP BY k)
SELECT source, count(*) AS rows, count(d.doc_id) AS kept, count(*) - count(d.doc_id) AS merged_away FROM r LEFT JOIN d USING (k, doc_id) GROUP BY source""")
def q_merge_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each source before and after the first copy of a text has won."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", F.md5(F.regexp_replace(F.lower(X.nz(F.col("text"))), r"\s+", "").cast("binary")).alias("key"))
    before = rows.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
    after = dedup.first_wins(rows, F.col("key"), ["doc_id"]).groupBy("source").agg(F.count(F.lit(1)).alias("kept"))
    return before.join(after, "source", "left").select("source", "rows", F.coalesce("kept", F.lit(0)).alias("kept"), (F.col("rows") - F.coalesce("kept", F.lit(0))).alias("merged_away"))


@query("""SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN d.doc_id IS NULL THEN 'appended' WHEN l.doc_id IS NULL THEN 'unprocessed' ELSE 'met' END AS side, CASE WHEN l.pool = 0 THEN 'cleaned' WHEN l.pool = 1 THEN 'reference' WHEN l.pool = 2 THEN 'rejected' END AS pool
FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id % 4 > 0) d FULL JOIN (SELECT doc_id, min(CASE WHEN quality = 1 AND toxic = 0 THEN 0 WHEN quality = 1 THEN 1 ELSE 2 END) AS pool FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id""")
def q_funnel_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw articles with the pool that takes precedence among what was processed; processed ones that raw lacks are appended."""
    raw = table(spark, sf_dir, "documents").where("doc_id % 4 > 0").select("doc_id").distinct().withColumn("raw", F.lit(True))
    rank = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 0).when(F.col("quality") == 1, 1).otherwise(2)
    done = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min(rank).alias("rank"))
    both = raw.join(done, "doc_id", "full")
    pool = F.get(F.array(F.lit("cleaned"), F.lit("reference"), F.lit("rejected")), F.col("rank"))
    return both.select("doc_id", F.when(F.col("raw").isNull(), "appended").when(F.col("rank").isNull(), "unprocessed").otherwise("met").alias("side"), pool.alias("pool"))
