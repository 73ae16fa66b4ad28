"""Queries of the article and event ladders, over documents with their pages, events and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import text as X
from gristmill.functions import times as T
from gristmill.operators import ladders as L
from gristmill.operators import lineage, ratios, reports, scoring
from gristmill.operators.lineage import once
from gristmill.plans.articles import KEYWORDS, scored
from gristmill.plans.registry import query, table
from gristmill.plans.sql import any_of, count_of, first_alike, matches

#: Parameter: the time that ladders take for now.
AS_OF = "2024-01-20 12:00:00"

#: Parameters: small lexicons of the tables' invented words.
ARTICLE = L.ArticleRules(
    social_domains=("blog.",),
    product_urls=(r"[?]page=",),
    review_words=("ist",),
    homepage_domains=("m.example.org",),
    promotion=("%", "$", "###"),
    promotion_titles=("%", "!!"),
    jobs=("@",),
    notices=(r"^the ",),
    reports=(r"^(?:la|le) .*tion",),
    news_domains=("example.net",),
    articles=(r"ing", r"ung$"),
    near_hosts=("/zh/9", "//m.tion"),
    near_hosts_2=("/fr/9",),
    far_suffixes=(".co.uk", "n.example.org"),
    near_strong=("pai",),
    near_moderate=("zh",),
    home_words=("the",),
    local_letters="[a-z]",
    retro_title_strong=("###",),
    retro_title_weak=("ess",),
    retro_body=("nicht nicht", "zh"),
    core={"direct": ("zh",), "platform": ("nicht",), "category": ("oui", "pai", "eau"), "competitor": ("auf",)},
    strong_words=("pai",),
    context_words=("dans",),
    farms=("blog.tion.example.com",),
    farm_suffixes=("hen.example.com",),
    junk=("licensed",),
)
FRESHNESS = {"click": "newly_discovered", "view": "day_primary", "signup": "week_fallback", "error": "bootstrap_seen"}

_ARTICLES = """SELECT d.doc_id, split_part(d.text, '.', 1) AS title, split_part(d.text, '.', 2) AS summary, d.text AS content, p.url, d.lang, d.source, e.ts AS published, e.event_type AS kind, CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k
FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id LEFT JOIN events e ON e.event_id = 10 * d.doc_id"""


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles: title and summary are the first sentences, the page gives the address, an event the time."""
    docs, pages, events = (table(spark, sf_dir, t) for t in ("documents", "pages", "events"))
    dated = events.where("event_id % 10 = 0").select((F.col("event_id") / 10).cast("long").alias("doc_id"), F.col("ts").alias("published"), F.col("event_type").alias("kind"), F.get_json_object("props", "$.k").cast("int").alias("k"))
    out = docs.join(pages.select(F.col("page_id").alias("doc_id"), "url"), "doc_id", "left").join(dated, "doc_id", "left")
    sentence = lambda n: F.split_part("text", F.lit("."), F.lit(n))
    return out.select("doc_id", sentence(1).alias("title"), sentence(2).alias("summary"), F.col("text").alias("content"), "text", "url", "lang", "source", "published", "kind", "k")


_T, _S = "lower(coalesce(title, ''))", "lower(coalesce(summary, ''))"
_BODY = f"concat_ws(' ', {_T}, {_S}, lower(substr(coalesce(content, ''), 1, 500)))"
_U = "lower(coalesce(url, ''))"
_PARTS = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"
_HOST = f"regexp_replace(regexp_extract({_U}, '{_PARTS}', 2), '^www[.]', '')"
_PATH = f"regexp_extract(lower(trim(coalesce(url, ''))), '{_PARTS}', 3)"
_PAGE = f"""CASE WHEN {any_of(_HOST, ARTICLE.social_domains)} THEN 'social_post'
 WHEN {matches(_U, ARTICLE.product_urls)} THEN CASE WHEN {any_of(_BODY, ARTICLE.review_words)} THEN 'article' ELSE 'product_page' END
 WHEN {_HOST} IN ('m.example.org') AND {_PATH} IN ('', '/', '/index.html', '/index.htm') THEN 'homepage'
 WHEN {count_of(_BODY, ARTICLE.promotion)} + 2 * {count_of(_T, ARTICLE.promotion_titles)} >= 3 THEN 'promotion' WHEN {any_of(_BODY, ARTICLE.jobs)} THEN 'job'
 WHEN {matches(_T, ARTICLE.notices)} THEN 'official_notice' WHEN {matches(_T, ARTICLE.reports)} THEN 'report' WHEN {any_of(_HOST, ARTICLE.news_domains)} AND {_PATH} NOT IN ('', '/') THEN 'news'
 WHEN {matches(_U, ARTICLE.news_urls)} THEN 'news' WHEN {matches(_T, ARTICLE.articles)} THEN 'article' WHEN length({_U}) > 40 AND length({_BODY}) > 100 THEN 'article' ELSE 'unknown' END"""
_PLACE = f"""CASE WHEN {any_of(_U, ARTICLE.near_hosts)} THEN 'hk' WHEN {any_of(_U, ARTICLE.near_hosts_2)} THEN 'tw' WHEN suffix(regexp_extract({_U}, '{_PARTS}', 2), '.co.uk') OR suffix(regexp_extract({_U}, '{_PARTS}', 2), 'n.example.org') THEN 'overseas'
 WHEN {any_of(_BODY, ARTICLE.near_strong)} THEN 'hk' WHEN {any_of(_T, ARTICLE.near_moderate)} OR {any_of(f"substr({_S}, 1, 200)", ARTICLE.near_moderate)} THEN 'hk' WHEN {any_of(_BODY, ARTICLE.home_words)} THEN 'mainland' WHEN {matches(_BODY, ["[a-z]"])} THEN 'mainland' ELSE 'unknown' END"""
_RETRO_BODY = "concat_ws(' ', coalesce(summary, ''), substr(coalesce(content, ''), 1, 500))"
_RETRO = f"CASE WHEN {any_of('title', ARTICLE.retro_title_strong)} THEN 'strong' WHEN {any_of('title', ARTICLE.retro_title_weak)} OR {any_of(_RETRO_BODY, ARTICLE.retro_body)} THEN 'weak' ELSE 'none' END"
_CORE_BODY = "concat_ws(' ', coalesce(title, ''), coalesce(summary, ''), substr(coalesce(content, ''), 1, 1000))"
_CORE = f"""CASE WHEN {any_of(_CORE_BODY, ("zh",))} THEN 'direct' WHEN {any_of(_CORE_BODY, ("nicht",))} THEN 'platform'
 WHEN {any_of(_CORE_BODY, ("pai",))} OR {count_of(_CORE_BODY, ("oui", "pai", "eau"))} >= 2 OR ({any_of(_CORE_BODY, ("oui", "pai", "eau"))} AND {any_of(_CORE_BODY, ("dans",))}) THEN 'category' WHEN {any_of(_CORE_BODY, ("auf",))} THEN 'competitor' ELSE '' END"""
_AGE = f"floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(published)) / 86400000000.0)"
_TIME = f"CASE WHEN k % 10 = 0 THEN 'uncertain_date' WHEN published IS NULL THEN 'unknown_time' WHEN published > TIMESTAMP '{AS_OF}' THEN 'in_window' WHEN {_AGE} <= 2 THEN 'in_window' WHEN {_AGE} <= 7 THEN 'near_window' ELSE 'old' END"
_BLOCKED = "('product_page', 'homepage', 'social_post', 'promotion', 'job', 'unknown')"
_FLAGS = f"""concat_ws('|', CASE WHEN page IN {_BLOCKED} THEN 'page_type:' || page END, CASE WHEN place IN ('hk', 'tw') THEN 'region:' || place END,
 CASE WHEN {count_of(f"concat_ws(' ', {_T}, {_S})", ARTICLE.promotion_titles)} >= 2 THEN 'promo_title' END, CASE WHEN length(trim({_S})) < 20 AND length(trim({_T})) < 15 THEN 'thin_content' END)"""
_CLASSED = f"SELECT *, {_PAGE} AS page, {_PLACE} AS place, {_RETRO} AS retro, {_CORE} AS core, {_TIME} AS time FROM ({_ARTICLES})"


def classed(df: DataFrame) -> DataFrame:
    """Articles with kind of page, place, retrospective level, core kind and time status."""
    at = [F.col(c) for c in ("title", "summary", "content")]
    status = T.time_status(F.col("published"), F.lit(AS_OF).cast("timestamp"))
    return once(
        df,
        page=L.page_type(F.col("url"), *at, ARTICLE),
        place=L.region(F.col("url"), *at, ARTICLE),
        retro=L.retrospective(*at, ARTICLE),
        core=L.core_hit(*at, ARTICLE),
        time=F.when(F.col("k") % 10 == 0, "uncertain_date").otherwise(status),
    )


@query(f"SELECT page, place, retro, core, time, count(*) AS rows FROM ({_CLASSED}) GROUP BY ALL")
def q_article_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classed(articles(spark, sf_dir)).groupBy("page", "place", "retro", "core", "time").agg(F.count(F.lit(1)).alias("rows"))


@query(f"SELECT doc_id, {_FLAGS} AS flags FROM ({_CLASSED})")
def q_noise_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = L.noise_flags(F.col("page"), F.col("place"), F.col("title"), F.col("summary"), ARTICLE)
    return classed(articles(spark, sf_dir)).select("doc_id", F.array_join(flags, "|").alias("flags"))


_SCORE = f"""CAST((CASE WHEN {any_of("content", ("tionou", "keit", "ouvi", "mente"))} THEN 5 ELSE 0 END) + (CASE WHEN {any_of("content", ("thereti", "lichung", "eauoi", "ción"))} THEN 3 ELSE 0 END) + (CASE WHEN length(content) > 500 THEN 2 ELSE 0 END)
 + (CASE WHEN lang = 'en' THEN 1 ELSE 0 END) - (CASE WHEN {any_of("content", ("idiot", "clown", "worthless"))} THEN 5 ELSE 0 END) - (CASE WHEN coalesce(contains(content, '###'), false) THEN 3 ELSE 0 END) - (CASE WHEN length(trim(coalesce(content, ''))) < 100 THEN 2 ELSE 0 END) AS INTEGER)"""
_GUARDED = f"""SELECT c.*, {_SCORE} AS score, {count_of("content", KEYWORDS)} AS keywords, CASE kind WHEN 'click' THEN 'newly_discovered' WHEN 'view' THEN 'day_primary' WHEN 'signup' THEN 'week_fallback' WHEN 'error' THEN 'bootstrap_seen' ELSE '' END AS fresh,
 CASE WHEN k % 23 = 0 THEN 'unknown_campaign_time' WHEN k % 29 = 0 THEN 'historical_campaign' ELSE 'not_campaign' END AS campaign, CASE k % 4 WHEN 0 THEN 'search' ELSE 'feed' END AS source_type, CASE k % 2 WHEN 0 THEN 'browser' ELSE 'reader' END AS collector,
 CASE l.quality WHEN 1 THEN 'main' WHEN 0 THEN 'reject' END AS reviewed, page IN {_BLOCKED} AS blocked, {any_of("title", ("lle lle", "quech"))} AS mismatch
FROM ({_CLASSED}) c LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l ON l.doc_id = c.doc_id AND c.doc_id % 3 = 0"""
_MAIN = "CASE WHEN blocked THEN 'reference' ELSE 'main' END"
_REF = "CASE WHEN page IN ('social_post', 'homepage', 'job') THEN 'reject' ELSE 'reference' END"
_POOL_RULES = [
    ("place IN ('hk', 'tw', 'overseas')", "'reject'", "region"),
    ("trim(coalesce(url, '')) = ''", "'reject'", "no_url"),
    ("trim(coalesce(title, '')) = ''", "'reject'", "no_title"),
    (f"CAST(published AS DATE) > CAST(TIMESTAMP '{AS_OF}' + INTERVAL 1 DAY AS DATE)", "'reject'", "future_date"),
    (f"{_HOST} IN ('blog.tion.example.com') OR suffix({_HOST}, 'hen.example.com')", "'reject'", "content_farm"),
    ("mismatch", "'reject'", "seasonal_mismatch"),
    (f"""{any_of("concat_ws(' ', coalesce(title, ''), coalesce(summary, ''))", ("licensed",))} AND score <= 1""", "'reject'", "junk"),
    ("campaign = 'historical_campaign'", "'reject'", "historical_campaign"),
    ("campaign = 'unknown_campaign_time' AND time IN ('unknown_time', 'old')", "'reject'", "unknown_campaign"),
    ("campaign = 'unknown_campaign_time'", "'reference'", "unknown_campaign"),
    ("time = 'old'", "'reject'", "old"),
    ("retro = 'strong' AND core <> '' AND score >= 5", _REF, "retrospective_strong"),
    ("retro = 'strong'", "'reject'", "retrospective_strong"),
    ("retro = 'weak'", _REF, "retrospective_weak"),
    ("fresh = 'bootstrap_seen' AND (core <> '' AND score >= 5 OR score >= 6)", _REF, "bootstrap_seen"),
    ("fresh = 'bootstrap_seen' AND score >= 3", "'reference'", "bootstrap_seen"),
    ("fresh = 'bootstrap_seen'", "'reject'", "bootstrap_seen"),
    ("fresh = 'newly_discovered' AND core <> '' AND score >= 4", _MAIN, "newly_discovered"),
    ("fresh = 'newly_discovered' AND score >= 5", _REF, "newly_discovered"),
    ("fresh = 'newly_discovered' AND time = 'unknown_time' AND (core <> '' OR score >= 2 AND keywords >= 2)", _REF, "newly_discovered"),
    ("fresh = 'newly_discovered' AND time = 'unknown_time'", "'reject'", "newly_discovered"),
    ("fresh = 'newly_discovered' AND score >= 3", _REF, "newly_discovered"),
    ("fresh = 'newly_discovered'", "'reject'", "newly_discovered"),
    ("fresh = 'week_fallback' AND core <> '' AND score >= 5", _MAIN, "week_fallback"),
    ("fresh = 'week_fallback' AND score >= 3 AND (core <> '' OR keywords > 0)", _REF, "week_fallback"),
    ("fresh = 'week_fallback'", "'reject'", "week_fallback"),
    ("fresh = 'day_primary' AND (score >= 6 OR core <> '' AND score >= 4)", _MAIN, "day_primary"),
    ("time = 'uncertain_date' AND core <> '' AND (score >= 5 OR score >= 3 AND collector = 'browser')", _MAIN, "uncertain_date"),
    ("time = 'uncertain_date' AND (core <> '' OR score >= 4)", _REF, "uncertain_date"),
    ("time = 'uncertain_date'", "'reject'", "uncertain_date"),
    ("time = 'unknown_time' AND (core <> '' OR source_type = 'search' AND (keywords >= 3 AND score >= 3 OR score >= 5))", _REF, "unknown_time"),
    ("time = 'unknown_time'", "'reject'", "unknown_time"),
    ("reviewed = 'main' AND score >= 3", _MAIN, "reviewed"),
    ("reviewed = 'reject' AND score >= 6", _REF, "reviewed"),
    ("reviewed = 'reject'", "'reject'", "reviewed"),
    ("score >= 6", _MAIN, "rule_keep"),
    ("score >= 3 AND core <> '' AND score >= 4 AND time = 'in_window'", _MAIN, "rule_review"),
    ("score >= 3 AND core = '' AND keywords = 0", "'reject'", "no_keywords"),
    ("score >= 5 AND time = 'in_window'", _MAIN, "rule_review"),
    ("score >= 3", _REF, "rule_review"),
    ("time IN ('in_window', 'near_window') AND score >= 0 AND (core <> '' OR keywords > 0)", _REF, "kept_in_window"),
]
_POOLED = f"""SELECT doc_id, source, score, page, time, CASE {" ".join(f"WHEN {c} THEN {p}" for c, p, _ in _POOL_RULES)} ELSE 'reject' END AS pool, CASE {" ".join(f"WHEN {c} THEN '{r}'" for c, _, r in _POOL_RULES)} ELSE 'low_score' END AS reason FROM ({_GUARDED})"""


def pooled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with pool and reason."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality")).where("doc_id % 3 = 0")
    a = scored(classed(articles(spark, sf_dir))).join(labels, "doc_id", "left")
    k = F.col("k")
    given = {
        **{c: F.col(c) for c in ("url", "title", "summary", "page", "place", "retro", "core", "time", "decision")},
        "published": F.to_date("published"),
        "score": F.col("rule_score"),
        "freshness": scoring.lookup(F.col("kind"), FRESHNESS, ""),
        "source_type": F.when(k % 4 == 0, "search").otherwise("feed"),
        "collector": F.when(k % 2 == 0, "browser").otherwise("reader"),
        "keywords": L.hits(F.col("content"), KEYWORDS),
        "campaign": F.when(k % 23 == 0, "unknown_campaign_time").when(k % 29 == 0, "historical_campaign").otherwise("not_campaign"),
        "mismatch": L.has(F.col("title"), ("lle lle", "quech")),
        "reviewed": F.when(F.col("quality") == 1, "main").when(F.col("quality") == 0, "reject"),
    }
    decided = L.pool_decision(given, ARTICLE, F.lit(AS_OF).cast("timestamp"))
    return once(a, d=decided).select("doc_id", "source", F.col("rule_score").alias("score"), "page", "time", "d.pool", "d.reason")


@query(f"SELECT doc_id, pool, reason FROM ({_POOLED})")
def q_pool_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pooled(spark, sf_dir).select("doc_id", "pool", "reason")


@query(f"""SELECT total, main, reference, reject, main * 10000 // greatest(total, 1) / 100.0 AS main_percent, reference * 10000 // greatest(total, 1) / 100.0 AS reference_percent, reject * 10000 // greatest(total, 1) / 100.0 AS reject_percent
FROM (SELECT count(*) AS total, count(*) FILTER (pool = 'main') AS main, count(*) FILTER (pool = 'reference') AS reference, count(*) FILTER (pool = 'reject') AS reject FROM ({_POOLED}))""")
def q_funnel_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pools of the funnel and their shares in hundredths of a percent, cut."""
    of = lambda p: F.count_if(F.col("pool") == p).alias(p)
    counted = pooled(spark, sf_dir).agg(F.count(F.lit(1)).alias("total"), of("main"), of("reference"), of("reject"))
    percent = lambda p: (F.floor(F.col(p) * 10000 / F.greatest("total", F.lit(1))) / 100.0).alias(f"{p}_percent")
    return counted.select("*", *map(percent, ("main", "reference", "reject")))


@query(f"SELECT doc_id, CAST(row_number() OVER (ORDER BY tier, score, doc_id) AS INTEGER) AS place FROM (SELECT *, CAST(substr(source, 4) AS INTEGER) % 3 AS tier FROM ({_POOLED})) WHERE pool = 'reference' AND score BETWEEN 3 AND 7 ORDER BY tier, score, doc_id LIMIT 50")
def q_review_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 reference articles to review first, by tier and score: a top-k report."""
    rows = pooled(spark, sf_dir).where("pool = 'reference' and score between 3 and 7").withColumn("tier", F.substring("source", 4, 9).cast("int") % 3)
    top = rows.orderBy("tier", "score", "doc_id").limit(50)
    ranked = top.agg(F.array_sort(F.collect_list(F.struct("tier", "score", "doc_id"))).alias("rows")).select(F.posexplode("rows").alias("at", "row"))
    return ranked.select("row.doc_id", (F.col("at") + 1).alias("place"))


@query(f"""SELECT source, count(*) FILTER (score >= 4 AND pool = 'reject' AND reason IN ('old', 'no_keywords', 'unknown_time', 'low_score')) AS suspected, count(*) FILTER (pool = 'reject') AS rejected FROM ({_POOLED}) GROUP BY source""")
def q_suspected_missed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected articles whose score would have let them in, by source."""
    missed = (F.col("score") >= 4) & (F.col("pool") == "reject") & F.col("reason").isin("old", "no_keywords", "unknown_time", "low_score")
    return pooled(spark, sf_dir).groupBy("source").agg(F.count_if(missed).alias("suspected"), F.count_if(F.col("pool") == "reject").alias("rejected"))


# --- events --------------------------------------------------------------------------------------------------------

KINDS = {"click": "platform_rule", "view": "marketing", "signup": "competitor_move", "error": "unclear"}
EVENT = L.EventRules(
    importance={"platform_rule": 5, "policy_change": 5, "competitor_move": 4, "marketing": 2},
    strategic=("ation", "ung"),
    direct=("zh", "pai"),
    channel=("sch",),
    competitor=("lle",),
    category=("que", "ble"),
    generic=("tion", "ver"),
    national=("ess",),
    multi=("oui",),
    single=("dans", "auf"),
    source_tiers={"src1": 5, "src2": 4, "src17": 3, "src4": 2},
    domain_tiers={"example.org": 4, "example.net": 3, "m.example.net": 2},
    data=("tion", "ent", "ing", "ver"),
    high_value=("keit", "mente"),
    direction=("her",),
    opinion=("eau",),
    data_value=r"[%$#]",
    variables={"v0": 5, "v1": 4, "v2": 3, "v3": 2, "v4": 1},
    type_action={"platform_rule": 5, "competitor_move": 4, "marketing": 2},
    stock_strong=("###",),
    stock=("ist", "zh"),
    business=("tion", "lle"),
    finance=("ción",),
    action=("los", "que"),
    abroad=("auf", "nicht", "lich"),
    home=("der", "sch"),
    market_scale=("ing", "los"),
    market=("tion",),
)
_KIND = "CASE event_type WHEN 'click' THEN 'platform_rule' WHEN 'view' THEN 'marketing' WHEN 'signup' THEN 'competitor_move' WHEN 'error' THEN 'unclear' ELSE 'background_only' END"
_EVENTS = f"""SELECT e.event_id, e.ts, e.value, e.user_id, {_KIND} AS kind, CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k, d.source AS source_name, p.url, split_part(d.text, '.', 1) AS title,
 split_part(d.text, '.', CAST(1 + e.event_id % 10 AS INTEGER)) AS fact, split_part(d.text, '.', CAST(2 + e.event_id % 10 AS INTEGER)) AS evidence
FROM events e LEFT JOIN documents d ON d.doc_id = e.event_id // 10 LEFT JOIN pages p ON p.page_id = d.doc_id"""
_PLATFORMS, _COMPETITORS = ("the", "und", "les"), ("ver", "que")
_TEXT = "concat_ws(' ', coalesce(title, ''), coalesce(fact, ''), coalesce(evidence, ''))"


def event_rows(spark: SparkSession, sf_dir: str, known: DataFrame | None = None) -> DataFrame:
    """Events with the sentences of their article (ten events an article), its source and address, and what is ``known`` of
    them by event_id: that is joined before the sentences are, which are long."""
    events, docs, pages = (table(spark, sf_dir, t) for t in ("events", "documents", "pages"))
    e = events.select("event_id", "ts", "value", "user_id", scoring.lookup(F.col("event_type"), KINDS, "background_only").alias("kind"), F.get_json_object("props", "$.k").cast("int").alias("k"), F.floor(F.col("event_id") / 10).alias("doc_id"))
    also = [c for c in known.columns if c != "event_id"] if known is not None else []
    if known is not None:
        e = e.join(known, "event_id", "left")
    told = F.split(F.substring_index("text", ".", 11), r"\.").alias("told")  # the sentences that events tell, not the whole article
    d = docs.select("doc_id", F.col("source").alias("source_name"), told).join(pages.select(F.col("page_id").alias("doc_id"), "url"), "doc_id", "left")
    sentence = lambda n: F.when(F.col("told").isNotNull(), X.nz(F.get("told", n.cast("int") - 1)))
    at = F.col("event_id") % 10
    out = e.join(d, "doc_id", "left").select("event_id", "ts", "value", "user_id", "kind", "k", "source_name", "url", sentence(F.lit(1)).alias("title"), sentence(1 + at).alias("fact"), sentence(2 + at).alias("evidence"), *also)
    return once(out, text=F.concat_ws(" ", X.nz(F.col("title")), X.nz(F.col("fact")), X.nz(F.col("evidence"))))


_HOST_E = f"regexp_replace({_HOST}, '^m[.]', '')"
_NAME = "coalesce(source_name, '')"
_CREDIBILITY = f"""CASE WHEN trim(coalesce(url, '')) = '' THEN 0 WHEN {_NAME} = 'src1' THEN 5 WHEN {_NAME} = 'src2' THEN 4 WHEN {_NAME} = 'src17' THEN 3 WHEN {_NAME} = 'src4' THEN 2
 WHEN contains({_NAME}, 'src1') OR contains('src1', {_NAME}) THEN 5 WHEN contains({_NAME}, 'src2') OR contains('src2', {_NAME}) THEN 4 WHEN contains({_NAME}, 'src17') OR contains('src17', {_NAME}) THEN 3 WHEN contains({_NAME}, 'src4') OR contains('src4', {_NAME}) THEN 2
 WHEN {_HOST_E} = 'example.org' THEN 4 WHEN {_HOST_E} = 'example.net' THEN 3 WHEN {_HOST_E} = 'm.example.net' THEN 2 WHEN suffix({_HOST_E}, '.example.org') THEN 4 WHEN suffix({_HOST_E}, '.example.net') THEN 3 WHEN suffix({_HOST_E}, '.m.example.net') THEN 2 ELSE 1 END"""
_IMPORTANCE = f"""CASE WHEN {any_of("concat_ws(' ', coalesce(title, ''), coalesce(fact, ''))", EVENT.strategic)} THEN least(base + 1, 5) ELSE base END"""
_RELEVANCE = f"CASE WHEN {any_of(_TEXT, EVENT.direct)} THEN 5 WHEN {any_of(_TEXT, EVENT.channel)} THEN 4 WHEN {any_of(_TEXT, EVENT.competitor)} THEN 3 WHEN {any_of(_TEXT, EVENT.generic)} THEN 2 WHEN {any_of(_TEXT, EVENT.category)} THEN 1 ELSE 0 END"
_SCOPE = f"""CASE WHEN {any_of(_TEXT, EVENT.national)} THEN 5 WHEN n_platforms >= 2 OR n_competitors >= 2 OR {any_of(_TEXT, EVENT.multi)} THEN 4 WHEN kind IN ('platform_rule', 'platform_move', 'policy_change') THEN 3
 WHEN n_platforms = 1 OR n_competitors = 1 OR {any_of(_TEXT, EVENT.single)} THEN 2 WHEN kind = 'marketing' THEN 1 ELSE 2 END"""
_VALUED = f"regexp_matches({_TEXT}, '[%$#]')"
_RICH = f"""CASE WHEN {any_of(_TEXT, EVENT.high_value)} AND {_VALUED} THEN 5 WHEN {_VALUED} AND {count_of(_TEXT, EVENT.data)} >= 2 THEN 4 WHEN {_VALUED} OR {count_of(_TEXT, EVENT.data)} >= 2 THEN 3 WHEN {any_of(_TEXT, EVENT.direction)} THEN 2
 WHEN {any_of(_TEXT, EVENT.opinion)} THEN 1 WHEN trim(coalesce(fact, '')) = '' THEN 0 ELSE 1 END"""
_MOST = "greatest(CASE k % 7 WHEN 0 THEN 5 WHEN 1 THEN 4 WHEN 2 THEN 3 WHEN 3 THEN 2 WHEN 4 THEN 1 ELSE 0 END, CASE k % 11 WHEN 0 THEN 5 WHEN 1 THEN 4 WHEN 2 THEN 3 WHEN 3 THEN 2 WHEN 4 THEN 1 ELSE 0 END)"
_ACT = f"CASE WHEN kind = 'platform_rule' AND {_MOST} >= 4 THEN 5 WHEN {_MOST} >= 4 THEN 4 WHEN {_MOST} >= 2 THEN {_MOST} ELSE greatest(CASE kind WHEN 'platform_rule' THEN 5 WHEN 'competitor_move' THEN 4 WHEN 'marketing' THEN 2 ELSE 1 END, {_MOST}) END"
_HOURS = f"(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(ts)) / 3600000000.0"
_SENSE_BASE = "CASE k % 5 WHEN 0 THEN 5 WHEN 1 THEN 4 WHEN 2 THEN 2 WHEN 3 THEN 1 ELSE 0 END"
_SENSE = f"""CASE WHEN ts IS NULL THEN {_SENSE_BASE} WHEN {_SENSE_BASE} = 0 THEN CASE WHEN {_HOURS} < 24 THEN 5 WHEN {_HOURS} < 72 THEN 4 WHEN {_HOURS} < 168 THEN 2 ELSE 1 END
 WHEN {_SENSE_BASE} = 2 THEN CASE WHEN {_HOURS} < 24 THEN 4 WHEN {_HOURS} < 72 THEN 3 ELSE 2 END ELSE {_SENSE_BASE} END"""
_NOVEL_BASE = "CASE k % 6 WHEN 0 THEN 5 WHEN 1 THEN 3 WHEN 2 THEN 1 ELSE CASE WHEN coalesce(fact, '') <> '' AND NOT repeated THEN 3 ELSE 0 END END"
_NOVEL = f"CASE WHEN coalesce(fact, '') <> '' AND repeated THEN greatest({_NOVEL_BASE} - 2, 0) ELSE {_NOVEL_BASE} END"
_REPEATED = "row_number() OVER (PARTITION BY fact ORDER BY event_id) > 1"


def _dimensions_sql(repeated: str, source: str) -> str:
    return f"""SELECT *, {_IMPORTANCE} AS importance, {_RELEVANCE} AS relevance, {_SCOPE} AS scope, {_CREDIBILITY} AS credibility, {_RICH} AS richness, {_ACT} AS actionability, {_SENSE} AS sensitivity, {_NOVEL} AS novelty
FROM (SELECT *, CASE kind WHEN 'platform_rule' THEN 5 WHEN 'competitor_move' THEN 4 WHEN 'marketing' THEN 2 ELSE 1 END AS base, {count_of(_TEXT, _PLATFORMS)} AS n_platforms, {count_of(_TEXT, _COMPETITORS)} AS n_competitors,
  coalesce(fact, '') <> '' AND {repeated} AS repeated FROM ({source}))"""


_DIMENSIONS = _dimensions_sql(_REPEATED, _EVENTS)
_ALIKE = f"SELECT e.*, coalesce(first_alike < event_id, false) AS alike FROM ({_EVENTS}) e LEFT JOIN ({first_alike('SELECT event_id AS id, CAST(ts AS DATE) AS batch, fact AS text FROM (' + _EVENTS + ')')}) f ON f.batch = CAST(ts AS DATE) AND f.text = fact"
_WEIGHTS = {"importance": 0.15, "relevance": 0.2, "scope": 0.15, "credibility": 0.1, "richness": 0.1, "actionability": 0.1, "sensitivity": 0.1, "novelty": 0.1}
_SUM = f"({' + '.join(f'{c} * {round(w * 1000)}' for c, w in _WEIGHTS.items())}) / 1000.0 AS weighted"
_WEIGHTED = f"SELECT *, {_SUM} FROM ({_DIMENSIONS})"
_LEVEL = "CASE WHEN weighted >= 4.3 THEN 'P0' WHEN weighted >= 3.6 THEN 'P1' WHEN weighted >= 2.8 THEN 'P2' ELSE 'ARCHIVE' END"
_RATED = f"""SELECT *, {_LEVEL} AS priority, CASE k % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' ELSE 'high' END AS confidence, CASE WHEN k % 7 = 0 THEN 'rule_fallback' ELSE 'llm' END AS method,
 CASE k % 13 WHEN 0 THEN 'republished_old_fact' WHEN 1 THEN 'historical_background' WHEN 2 THEN 'retrospective_summary' WHEN 3 THEN 'date_conflict' ELSE 'new_fact' END AS freshness FROM ({_WEIGHTED})"""


def dimensions(spark: SparkSession, sf_dir: str, alike: bool = False) -> DataFrame:
    """Events with the eight dimensions, their weighted sum and priority. A fact is repeated if an earlier event has it
    or, where ``alike`` is asked for, if one of the same day has a fact whose matching blocks cover more than 0.85."""
    if alike:
        facts = event_rows(spark, sf_dir).select("event_id", F.to_date("ts").alias("day"), "fact")
        e = event_rows(spark, sf_dir, ratios.first_alike(facts, "event_id", "fact", "day").withColumnRenamed("first_alike", "first_id"))
    else:
        e = event_rows(spark, sf_dir)
        firsts = e.where(F.col("fact") != "").groupBy("fact").agg(F.min("event_id").alias("first_id"))
        # events without a fact meet nothing: keys of their own keep them from one task
        own = F.coalesce(F.nullif(F.col("fact"), F.lit("")), F.concat(F.lit("\0"), F.col("event_id")))
        e = e.withColumn("_told", own).join(firsts.withColumnRenamed("fact", "_told"), "_told", "left").drop("_told").withColumn("first_id", F.when(F.col("fact") != "", F.col("first_id")))
    e = e.withColumn("repeated", F.coalesce(F.col("first_id") < F.col("event_id"), F.lit(False)))
    k = F.col("k")
    variables = F.array(F.concat(F.lit("v"), k % 7), F.concat(F.lit("v"), k % 11))
    label = lambda names, n: F.coalesce(F.get(F.array(*map(F.lit, names)), (k % n).cast("int")), F.lit(""))
    e = once(e, low=X.lowered(F.col("text")), low_told=X.lowered(F.concat_ws(" ", X.nz(F.col("title")), X.nz(F.col("fact")))))
    low = X.Lowered(F.col("low"))
    e = e.withColumn("platforms", X.keyword_hits(low, _PLATFORMS)).withColumn("competitors", X.keyword_hits(low, _COMPETITORS)).withColumn("variables", variables)
    e = once(
        e,
        importance=L.importance(F.col("kind"), F.col("title"), F.col("fact"), EVENT, low=X.Lowered(F.col("low_told"))),
        relevance=L.relevance(low, EVENT),
        scope=L.impact_scope(low, F.size("platforms"), F.size("competitors"), F.col("kind"), EVENT),
        credibility=L.credibility(F.col("source_name"), F.col("url"), EVENT),
        richness=L.richness(F.col("text"), F.col("fact"), EVENT, low=low),
        actionability=L.actionability(F.col("variables"), F.col("kind"), EVENT),
        sensitivity=L.time_sensitivity(label(("today", "recent", "background", "old_background"), 5), F.col("ts"), F.lit(AS_OF).cast("timestamp"), EVENT),
        novelty=L.novelty(label(("new", "follow_up", "old_background"), 6), F.col("fact"), F.col("repeated"), EVENT),
    )
    e = e.withColumn("weighted", scoring.weighted_sum({c: F.col(c) for c in _WEIGHTS}, _WEIGHTS))
    w = F.col("weighted")
    return e.select(
        "*",
        F.when(w >= 4.3, "P0").when(w >= 3.6, "P1").when(w >= 2.8, "P2").otherwise("ARCHIVE").alias("priority"),
        F.when(k % 3 == 0, "low").when(k % 3 == 1, "medium").otherwise("high").alias("confidence"),
        F.when(k % 7 == 0, "rule_fallback").otherwise("llm").alias("method"),
        F.when(k % 13 == 0, "republished_old_fact").when(k % 13 == 1, "historical_background").when(k % 13 == 2, "retrospective_summary").when(k % 13 == 3, "date_conflict").otherwise("new_fact").alias("freshness"),
    )


@query(f"SELECT event_id, {', '.join(_WEIGHTS)}, CAST(weighted AS DOUBLE) AS weighted, {_LEVEL} AS priority FROM (SELECT *, {_SUM} FROM ({_dimensions_sql('alike', _ALIKE)}))")
def q_event_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all events, the novelty against all earlier facts of the day by the ratio of matching blocks."""
    return dimensions(spark, sf_dir, alike=True).select("event_id", *_WEIGHTS, "weighted", "priority")


_STOCK = f"({count_of(_TEXT, EVENT.stock_strong)} >= 1 OR {count_of(_TEXT, EVENT.stock)} >= 1 AND {count_of(_TEXT, EVENT.stock)} > {count_of(_TEXT, EVENT.business)})"
_FINANCE = f"({count_of(_TEXT, EVENT.finance)} >= 1 AND {count_of(_TEXT, EVENT.finance)} >= {count_of(_TEXT, EVENT.action)})"
_ABROAD = f"({count_of(_TEXT, EVENT.abroad)} >= 2 AND {count_of(_TEXT, EVENT.abroad)} > {count_of(_TEXT, EVENT.home)})"


@query(f"SELECT kind, count(*) FILTER ({_STOCK}) AS stock_market, count(*) FILTER ({_FINANCE}) AS corporate_finance, count(*) FILTER ({_ABROAD}) AS abroad, count(*) FILTER ({_STOCK} OR {_FINANCE} OR {_ABROAD}) AS archived FROM ({_EVENTS}) GROUP BY kind")
def q_excluded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that the three exclusion predicates hold for, and those to archive, by kind."""
    text = F.col("text")
    stock, finance, abroad = L.stock_market(text, EVENT), L.corporate_finance(text, EVENT), L.not_at_home(text, EVENT)
    return event_rows(spark, sf_dir).groupBy("kind").agg(F.count_if(stock).alias("stock_market"), F.count_if(finance).alias("corporate_finance"), F.count_if(abroad).alias("abroad"), F.count_if(stock | finance | abroad).alias("archived"))


_TOLD = "concat_ws(' ', coalesce(title, ''), coalesce(fact, ''))"
_STALE = "freshness IN ('historical_background', 'retrospective_summary')"
_SCALE = f"({any_of(_TOLD, EVENT.market_scale)} AND {any_of(_TOLD, EVENT.market)} AND richness >= 4)"
_EXITS = [
    ("trim(coalesce(url, '')) = ''", "no_url"),
    ("trim(coalesce(fact, '')) = ''", "no_fact"),
    (_STOCK, "stock_market"),
    ("freshness IN ('republished_old_fact', 'date_conflict')", "old_or_conflict"),
    (f"{_STALE} AND NOT {_SCALE}", "background"),
    (_FINANCE, "corporate_finance"),
    ("relevance <= 1", "irrelevant"),
    (_ABROAD, "abroad"),
]
_CAPS = [
    (f"{_STALE} AND {_SCALE}", "market_scale"),
    ("confidence = 'low' AND NOT (weighted >= 3.5 AND credibility >= 3)", "low_confidence"),
    ("method = 'rule_fallback'", "rule_fallback"),
    ("credibility < 2", "low_credibility"),
    ("relevance < 3", "low_relevance"),
    ("kind = 'background_only'", "background_only"),
    ("kind = 'unclear'", "unclear"),
    ("trim(coalesce(evidence, '')) = ''", "no_evidence"),
]
_EXIT = f"CASE {' '.join(f'WHEN {c} THEN {chr(39)}{r}{chr(39)}' for c, r in _EXITS)} ELSE '' END"
_HELD = "concat_ws('|', " + ", ".join(f"CASE WHEN priority IN ('P0', 'P1') AND {c} THEN '{r}' END" for c, r in _CAPS) + ")"
_FINAL = f"SELECT *, CASE WHEN exit_ <> '' THEN 'ARCHIVE' WHEN held <> '' THEN 'P2' ELSE priority END AS final, CASE WHEN exit_ <> '' THEN exit_ ELSE held END AS reasons FROM (SELECT *, {_EXIT} AS exit_, {_HELD} AS held FROM ({_RATED}))"


def downgraded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rated events with the priority that the downgrade chain leaves, and its reasons."""
    d = dimensions(spark, sf_dir)
    given = {c: F.col(c) for c in ("url", "fact", "title", "text", "evidence", "freshness", "confidence", "method", "kind", "weighted", "credibility", "relevance", "richness")} | {"low": X.Lowered(F.col("low")), "low_told": X.Lowered(F.col("low_told"))}
    out = once(d, d=L.downgrade(F.col("priority"), given | {"eligibility": F.lit("")}, EVENT))
    return out.select("*", F.col("d.priority").alias("final"), F.col("d.reasons").alias("reasons")).drop("d")


@query(f"SELECT event_id, final, reasons FROM ({_FINAL})")
def q_priority_downgrade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return downgraded(spark, sf_dir).select("event_id", "final", F.array_join("reasons", "|").alias("reasons"))


@query(f"""WITH f AS (SELECT * FROM ({_FINAL})), r AS (SELECT 'reason' AS what, unnest(string_split(reasons, '|')) AS name FROM f WHERE reasons <> '')
SELECT what, name, count(*) AS rows FROM (SELECT 'priority' AS what, final AS name FROM f UNION ALL SELECT 'kind', kind FROM f UNION ALL SELECT 'confidence', confidence FROM f UNION ALL SELECT * FROM r) GROUP BY ALL
UNION ALL SELECT 'mean_score_milli', 'all', CAST(floor(sum(CAST(weighted * 1000 AS BIGINT)) / count(*)) AS BIGINT) FROM f""")
def q_rating_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by priority, kind, confidence and downgrade reason, and the mean score in thousandths, cut."""
    d = downgraded(spark, sf_dir)
    pairs = F.concat(
        F.array(*[F.struct(F.lit(what).alias("what"), F.col(c).alias("name")) for what, c in (("priority", "final"), ("kind", "kind"), ("confidence", "confidence"))]),
        F.transform("reasons", lambda r: F.struct(F.lit("reason").alias("what"), r.alias("name"))),
    )
    milli = F.round(F.col("weighted") * 1000).cast("long").alias("milli")
    counted = lineage.cut(d.select(F.explode(pairs).alias("p"), milli).groupBy("p.what", "p.name").agg(F.count(F.lit(1)).alias("rows"), F.sum("milli").alias("milli")))  # the events are rated once
    each = F.col("what") == "priority"  # one row an event
    mean = counted.agg(F.floor(F.sum(F.when(each, F.col("milli"))) / F.sum(F.when(each, F.col("rows")))).alias("rows")).select(F.lit("mean_score_milli").alias("what"), F.lit("all").alias("name"), "rows")
    counted = counted.select("what", "name", "rows")
    return counted.unionByName(mean)


# --- impact --------------------------------------------------------------------------------------------------------

IMPACT = L.ImpactRules(
    channels={"north": ("the", "sch"), "south": ("les",), "west": ("ción",)},
    generic_channels=("ver",),
    default_channels=("north", "south"),
    channel_variables=("v1",),
    variables={"volume": ("tion",), "price": ("ing", "ung")},
    impact={"platform_rule": "risk", "competitor_move": "watch", "marketing": "opportunity"},
    owners={"platform_rule": "rules team", "competitor_move": "market team"},
    metrics={"volume": "orders", "price": "price gap", "v0": "share"},
    questions={"opportunity": ("how long?", "which share?"), "risk": ("how likely?", "what is done?"), "watch": ("which signs?",)},
    actions={"platform_rule": "check {channel} rules", "competitor_move": "follow {channel}"},
    action_parts=((("v1", "v2"), ", count return"), (("v0",), ", review range")),
    vague=("watch",),
    labels={"A": ("ung",), "B": ("lle",), "C": ("tion",), "R": ("oui",), "K": ("zh",), "X": ("que",)},
)
_VARS = "['v' || (k % 7), 'v' || (k % 11)]"
_NAMED = f"list_filter([CASE WHEN {any_of(_TEXT, ('the', 'sch'))} THEN 'north' END, CASE WHEN {any_of(_TEXT, ('les',))} THEN 'south' END, CASE WHEN {any_of(_TEXT, ('ción',))} THEN 'west' END], lambda x: x IS NOT NULL)"
_CHANNELS = f"CASE WHEN len({_NAMED}) > 0 THEN {_NAMED} WHEN {any_of(_TEXT, ('ver',))} OR list_contains({_VARS}, 'v1') THEN ['north', 'south'] ELSE ['to be confirmed'] END"
_ALLVARS = f"list_filter(['v' || (k % 7), CASE WHEN k % 11 <> k % 7 THEN 'v' || (k % 11) END, CASE WHEN {any_of(_TEXT, ('tion',))} THEN 'volume' END, CASE WHEN {any_of(_TEXT, ('ing', 'ung'))} THEN 'price' END], lambda x: x IS NOT NULL)"
_METRICS = f"list_filter([CASE WHEN k % 7 = 0 OR k % 11 = 0 THEN 'share' END, CASE WHEN {any_of(_TEXT, ('tion',))} THEN 'orders' END, CASE WHEN {any_of(_TEXT, ('ing', 'ung'))} THEN 'price gap' END], lambda x: x IS NOT NULL)"
_TYPE = "CASE kind WHEN 'platform_rule' THEN 'risk' WHEN 'competitor_move' THEN 'watch' WHEN 'marketing' THEN 'opportunity' ELSE 'noise' END"
_ANALYSED = f"""SELECT *, {_TYPE} AS impact_type, CASE WHEN final = 'ARCHIVE' THEN 'archive' WHEN final = 'P1' THEN 'test' ELSE 'watch' END AS level0,
 CASE WHEN final = 'ARCHIVE' THEN 'file, no action' ELSE replace(CASE kind WHEN 'platform_rule' THEN 'check {{channel}} rules' WHEN 'competitor_move' THEN 'follow {{channel}}' ELSE 'watch {{channel}}' END, '{{channel}}', CASE WHEN channels[1] = 'to be confirmed' THEN 'channels concerned' ELSE channels[1] END)
   || CASE WHEN list_contains({_VARS}, 'v1') OR list_contains({_VARS}, 'v2') THEN ', count return' ELSE '' END || CASE WHEN list_contains({_VARS}, 'v0') THEN ', review range' ELSE '' END END AS action,
 CASE WHEN confidence = 'high' AND credibility >= 4 AND richness >= 4 THEN 'high' WHEN confidence = 'high' OR credibility >= 3 AND richness >= 3 THEN 'medium' ELSE 'low' END AS sure,
 list_filter([CASE {_TYPE} WHEN 'opportunity' THEN 'how long?' WHEN 'risk' THEN 'how likely?' WHEN 'watch' THEN 'which signs?' END, CASE {_TYPE} WHEN 'opportunity' THEN 'which share?' WHEN 'risk' THEN 'what is done?' END, CASE WHEN kind IN ('platform_rule', 'policy_change') THEN 'details and start?' END, CASE WHEN confidence = 'low' THEN 'can the data be checked elsewhere?' END], lambda x: x IS NOT NULL)[1:3] AS questions
FROM (SELECT *, {_CHANNELS} AS channels, {_METRICS} AS metrics FROM ({_FINAL}))"""
_LEVELLED = f"""SELECT *, CASE WHEN vague THEN 'watch' ELSE l2 END AS level, concat_ws('|', CASE WHEN no_metrics THEN 'no_metrics' END, CASE WHEN vague THEN 'vague_action' END) AS why
FROM (SELECT *, CASE WHEN no_metrics THEN 'watch' ELSE level0 END AS l2, contains(lower(action), 'watch') AND length(action) < 20 AS vague FROM (SELECT *, len(metrics) = 0 AND level0 = 'test' AS no_metrics FROM ({_ANALYSED})))"""


def analysed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Downgraded events with their impact analysis and the action level that its checks leave."""
    d = downgraded(spark, sf_dir)
    e = {c: F.col(c) for c in ("platforms", "text", "variables", "kind", "confidence", "credibility", "richness", "relevance", "title", "method")} | {"priority": F.col("final"), "text": X.Lowered(F.col("low"))}
    d = once(d, a=L.analysis(e, IMPACT))
    given = {c: F.col("a")[c] for c in ("action_level", "recommended_action", "metrics")}
    return once(d, checked=L.analysis_downgrade(given, e, IMPACT))


@query(f"""SELECT event_id, impact_type, array_to_string(channels, '|') AS channels, array_to_string({_ALLVARS}, '|') AS variables, action, level, why, CASE kind WHEN 'platform_rule' THEN 'rules team' WHEN 'competitor_move' THEN 'market team' ELSE 'undecided' END AS owner,
 array_to_string(CASE WHEN len(metrics) > 0 THEN metrics ELSE ['undecided'] END, '|') AS metrics, array_to_string(questions, '|') AS questions, sure FROM ({_LEVELLED})""")
def q_impact_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = analysed(spark, sf_dir)
    line = lambda c: F.array_join(F.col("a")[c], "|").alias(c)
    return a.select(
        "event_id", "a.impact_type", line("channels"), line("variables"), F.col("a.recommended_action").alias("action"), F.col("checked.action_level").alias("level"), F.array_join("checked.reasons", "|").alias("why"),
        "a.owner", line("metrics"), line("questions"), F.col("a.confidence").alias("sure"),
    )


_LABELS = f"""list_filter([CASE WHEN a_ THEN 'A' END, CASE WHEN {any_of(_TOLD, ('lle',))} THEN 'B' END, CASE WHEN {any_of(_TOLD, ('tion',))} AND NOT a_ THEN 'C' END, CASE WHEN {any_of(_TOLD, ('oui',))} THEN 'R' END, CASE WHEN {any_of(_TOLD, ('zh',))} THEN 'K' END, CASE WHEN {any_of(_TOLD, ('que',))} THEN 'X' END], lambda x: x IS NOT NULL)"""
_LABELLED = f"""SELECT *, CASE WHEN len(raw_labels) > 0 THEN raw_labels ELSE ['C'] END AS labels FROM (SELECT *, {_LABELS} AS raw_labels FROM (SELECT *, {any_of(_TOLD, ('ung',))} OR final IN ('P0', 'P1') AS a_ FROM ({_LEVELLED})))"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(analysed(spark, sf_dir), labels=L.judgment_labels(F.col("title"), F.col("fact"), F.col("final"), IMPACT, low=X.Lowered(F.col("low_told")))).withColumn("level", F.col("checked.action_level"))


@query(f"""SELECT event_id, array_to_string(labels, '') AS labels, CASE WHEN confidence = 'low' THEN CASE WHEN final = 'P1' OR weighted >= 3.5 AND credibility >= 3 THEN 'look' ELSE 'verify' END WHEN method = 'rule_fallback' THEN 'rule' ELSE '' END AS tag FROM ({_LABELLED})""")
def q_judgment_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag = L.confidence_tag(F.col("confidence"), F.col("method"), F.col("final"), F.col("weighted"), F.col("credibility"))
    return labelled(spark, sf_dir).select("event_id", F.array_join("labels", "").alias("labels"), tag.alias("tag"))


@query(f"""WITH l AS (SELECT * FROM ({_LABELLED})), u AS (SELECT * FROM l WHERE final <> 'ARCHIVE')
SELECT 'risk' AS section, event_id FROM (SELECT event_id FROM u WHERE list_contains(labels, 'R') ORDER BY event_id LIMIT 3)
UNION ALL SELECT 'opportunity', event_id FROM (SELECT event_id FROM u WHERE list_contains(labels, 'B') OR list_contains(labels, 'K') ORDER BY event_id LIMIT 5)
UNION ALL SELECT 'competitor', event_id FROM (SELECT event_id FROM u WHERE n_competitors > 0 ORDER BY event_id LIMIT 5)
UNION ALL SELECT 'category', event_id FROM (SELECT event_id FROM u WHERE {any_of(_TEXT, EVENT.category)} ORDER BY event_id LIMIT 5)
UNION ALL SELECT 'tracking', event_id FROM (SELECT event_id FROM u WHERE level = 'watch' OR final = 'P2' ORDER BY event_id LIMIT 5)""")
def q_report_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of five sections of a report, in input order: a top-k report. One row may enter several sections."""
    rows = {"risk": 3, "opportunity": 5, "competitor": 5, "category": 5, "tracking": 5}
    entered = {
        "risk": F.array_contains("labels", "R"),
        "opportunity": F.arrays_overlap("labels", F.array(F.lit("B"), F.lit("K"))),
        "competitor": F.size("competitors") > 0,
        "category": L.has(X.Lowered(F.col("low")), EVENT.category),
        "tracking": (F.col("level") == "watch") | (F.col("final") == "P2"),
    }
    sections = F.array_compact(F.array(*[F.when((F.col("final") != "ARCHIVE") & c, name) for name, c in entered.items()]))
    each = labelled(spark, sf_dir).select("event_id", F.explode(sections).alias("section"))
    top = reports.top_per_group(each, ["section"], [F.col("event_id")], max(rows.values()), "place")
    return top.where(F.col("place") <= scoring.lookup(F.col("section"), rows, 0)).select("section", "event_id")


@query(f"SELECT impact_type, level, event_id, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY impact_type, level ORDER BY weighted DESC, event_id) AS place FROM ({_LEVELLED})) WHERE place <= 2")
def q_urgency_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two best events of each kind of impact and action level: a top-k report."""
    from gristmill.operators import reports

    a = analysed(spark, sf_dir).select("event_id", "weighted", "a.impact_type", F.col("checked.action_level").alias("level"))
    return reports.top_per_group(a, ["impact_type", "level"], [F.col("weighted").desc(), F.col("event_id")], 2, "place").select("impact_type", "level", "event_id", "place")
