"""Queries of gates, gaps, routing and enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import text as X
from gristmill.functions import times as T
from gristmill.functions import urls as U
from gristmill.operators import dedup, reports, scoring
from gristmill.plans.articles import SCORED_SQL, scored
from gristmill.plans.registry import query, table

_N = r"lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(coalesce(split_part(text, chr(10), 1), '')), '\d{4}年\d{1,2}月\d{1,2}日', '', 'g'), '\d{4}[-/]\d{1,2}[-/]\d{1,2}', '', 'g'), '\d{1,2}月\d{1,2}日', '', 'g'), '\d+\.?\d*%?', '', 'g'), '[，。、！？；：‘’“”【】《》（）\[\]{},.!?;:''\x22()<>]', '', 'g'), '\s+', '', 'g'))"

@query(f"SELECT lang || ':' || substr({_N}, 1, 40) || ':' || CASE WHEN lang < source THEN lang || '|' || source ELSE source || '|' || lang END AS cluster_key, substr(md5({_N}), 1, 12) AS fact_hash, count(*) AS n, min(doc_id) AS founder FROM documents GROUP BY 1, 2")
def q_cluster_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("title", F.substring_index("text", "\n", 1))
    key = X.cluster_key(F.col("lang"), F.col("title"), F.array("source", "lang"))
    return docs.groupBy(key.alias("cluster_key"), X.fact_hash(F.col("title")).alias("fact_hash")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("founder"))


@query("""SELECT doc_id, length(text) AS chars, CAST(row_number() OVER (ORDER BY length(text), doc_id) AS INTEGER) AS place FROM documents WHERE length(text) < 200 ORDER BY length(text), doc_id LIMIT 40""")
def q_missing_fulltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 40 shortest texts under the limit, as candidates for fetching: a top-k report."""
    short = table(spark, sf_dir, "documents").where(F.length("text") < 200).select("doc_id", F.length("text").cast("long").alias("chars"))
    top = short.orderBy("chars", "doc_id").limit(40)
    ranked = top.agg(F.array_sort(F.collect_list(F.struct("chars", "doc_id"))).alias("rows")).select(F.posexplode("rows").alias("pos", "row"))
    return ranked.select("row.doc_id", "row.chars", (F.col("pos") + 1).alias("place"))


@query(f"""SELECT doc_id, issue FROM (SELECT doc_id, unnest(list_filter([CASE WHEN len(string_split(text, chr(10))) < 3 THEN 'few_sections' END, CASE WHEN regexp_matches(text, '[#$%&*]{{3}}') THEN 'unclean' END, CASE WHEN regexp_matches(text, '(token|password|secret) *=') THEN 'secret' END,
CASE WHEN regexp_matches(text, '[0-9]{{1,3}}\\.[0-9]{{1,3}}\\.[0-9]{{1,3}}\\.[0-9]{{1,3}}') THEN 'address' END], lambda x: x IS NOT NULL)) AS issue FROM documents)""")
def q_cleanliness_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    issues = F.array_compact(F.array(
        F.when(F.size(F.split(t, "\n")) < 3, "few_sections"),
        F.when(t.rlike("[#$%&*]{3}"), "unclean"),
        F.when(t.rlike("(token|password|secret) *="), "secret"),
        F.when(t.rlike(r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"), "address"),
    ))
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(issues).alias("issue"))


@query("""SELECT k.keyword, k.ord FROM (VALUES ('tionou', 1), ('lichung', 2), ('eauoi', 3), ('no such word', 4), ('absent', 5)) k(keyword, ord) WHERE NOT EXISTS (SELECT 1 FROM documents WHERE contains(lower(text), k.keyword))""")
def q_platform_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lexicon entries that no document mentions."""
    lexicon = ("tionou", "lichung", "eauoi", "no such word", "absent")
    entries = spark.createDataFrame([(k, i + 1) for i, k in enumerate(lexicon)], "keyword string, ord int")
    met = table(spark, sf_dir, "documents").select(F.explode(X.keyword_hits(F.col("text"), lexicon)).alias("keyword")).distinct()
    return entries.join(met, "keyword", "left_anti")


@query(f"""WITH e AS (SELECT doc_id, source, rule_score, CASE pool WHEN 'main' THEN 100 WHEN 'reference' THEN 80 ELSE 50 END + 10 * CAST(contains(lower(text), 'tionou') AS INTEGER) + 10 * CAST(contains(lower(text), 'keit') AS INTEGER) AS priority FROM ({SCORED_SQL}))
SELECT source, doc_id, priority FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY priority DESC, doc_id) AS rn FROM e) WHERE rn <= 5""")
def q_enrich_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    bonus = scoring.lookup(F.col("pool"), {"main": 100, "reference": 80}, 50)
    s = scored(table(spark, sf_dir, "documents")).withColumn("priority", bonus + 10 * F.size(X.keyword_hits(F.col("text"), ("tionou", "keit"))))
    return reports.top_per_group(s, ["source"], [F.col("priority").desc(), F.col("doc_id")], 5).select("source", "doc_id", "priority")


_ROUNDS = """WITH p AS (SELECT page_id, url, split_part(url, '/', 4) AS lang, contains(url, 'example.org') AS narrow FROM pages), n AS (SELECT lang, count(*) FILTER (narrow) * 3 < count(*) AS few FROM p GROUP BY lang)"""


@query(_ROUNDS + """ SELECT p.lang, CASE WHEN narrow THEN 'day_primary' ELSE 'week_fallback' END AS round, count(DISTINCT url) AS rows FROM p JOIN n USING (lang) WHERE narrow OR few AND url NOT IN (SELECT url FROM p WHERE narrow) GROUP BY ALL""")
def q_two_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A narrow round of pages for each language, and a wider one, without addresses of the first, where that brought less than a third."""
    pages = table(spark, sf_dir, "pages").select("url", F.get(F.split("url", "/"), F.lit(3)).alias("lang"), F.col("url").contains("example.org").alias("narrow"))
    few = pages.groupBy("lang").agg((F.count_if("narrow") * 3 < F.count(F.lit(1))).alias("few"))
    first, second = pages.where("narrow"), pages.where("not narrow").join(few.where("few"), "lang", "left_semi")
    both = first.withColumn("round", F.lit("day_primary")).unionByName(dedup.unseen(second, first, "url").withColumn("round", F.lit("week_fallback")))
    return both.groupBy("lang", "round").agg(F.count_distinct("url").alias("rows"))


@query("""SELECT host, items, with_url, old_items, grade FROM (SELECT *, CASE WHEN NOT ok THEN 'D' WHEN items >= 5 AND with_url >= 5 AND old_items / greatest(items, 1) <= 0.8 THEN 'A' WHEN items < 5 THEN 'B' WHEN old_items / greatest(items, 1) > 0.8 THEN 'C' ELSE 'A' END AS grade
FROM (SELECT host, bool_or(titled) AS ok, count(*) AS items, count(*) FILTER (NOT paged) AS with_url, count(*) FILTER (ts < TIMESTAMP '2024-01-20') AS old_items
FROM (SELECT lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host, regexp_matches(html, '<title>[^<%]*</title>') AS titled, contains(url, '?') AS paged, e.ts FROM pages p LEFT JOIN events e ON e.event_id = p.page_id * 40) GROUP BY host))""")
def q_route_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grade of each host as a route: whether a page of it can be read, its pages, those with a plain address, and old ones."""
    events = table(spark, sf_dir, "events").where("event_id % 40 = 0").select((F.col("event_id") / 40).cast("long").alias("page_id"), "ts")
    p = table(spark, sf_dir, "pages").join(events, "page_id", "left")
    s = p.groupBy(U.url_part(F.col("url"), "host").alias("host")).agg(
        F.bool_or(F.col("html").rlike("<title>[^<%]*</title>")).alias("ok"), F.count(F.lit(1)).alias("items"), F.count_if(~F.col("url").contains("?")).alias("with_url"), F.count_if(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")).alias("old_items")
    )
    grade = reports.route_grade(F.col("ok"), F.col("items"), F.col("with_url"), F.col("old_items") / F.greatest("items", F.lit(1)))
    return s.select("host", "items", "with_url", "old_items", grade.alias("grade"))


@query("""SELECT section, doc_id, CAST(rn AS INTEGER) AS rank FROM (SELECT s.section, d.doc_id, row_number() OVER (PARTITION BY s.section ORDER BY d.n_chars DESC, d.doc_id) AS rn FROM documents d JOIN (VALUES ('north', 'keit'), ('south', 'ción'), ('west', 'eauoi'), ('west', 'ouvi')) s(section, keyword)
ON contains(lower(d.text), s.keyword) AND NOT EXISTS (SELECT 1 FROM (VALUES ('west', 'eauoi', 'ouvi')) q(section, k1, k2) WHERE q.section = s.section AND s.keyword = q.k2 AND contains(lower(d.text), q.k1))) WHERE rn <= 10""")
def q_section_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document enters every section of which it holds a word; ten a section."""
    sections = {"north": ("keit",), "south": ("ción",), "west": ("eauoi", "ouvi")}
    names = F.array_compact(F.array(*[F.when(X.any_keyword(F.col("text"), ks), F.lit(s)) for s, ks in sections.items()]))
    routed = table(spark, sf_dir, "documents").select("doc_id", "n_chars", F.explode(names).alias("section"))
    return reports.top_per_group(routed, ["section"], [F.col("n_chars").desc(), F.col("doc_id")], 10).select("section", "doc_id", "rank")


@query(f"""SELECT pool, CASE WHEN rule_score >= 8 THEN 'high' WHEN rule_score >= 3 THEN 'middle' ELSE 'low' END AS score_bucket, CASE WHEN contains(lower(text), 'http') THEN 'linked' ELSE 'plain' END AS kind, count(*) AS rows FROM ({SCORED_SQL}) GROUP BY ALL""")
def q_score_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored(table(spark, sf_dir, "documents"))
    return s.groupBy("pool", X.bucket(F.col("rule_score"), [8, 3], ["high", "middle", "low"]).alias("score_bucket"), F.when(F.lower("text").contains("http"), "linked").otherwise("plain").alias("kind")).agg(F.count(F.lit(1)).alias("rows"))


@query("""SELECT o_custkey, CAST(len(d) AS INTEGER) AS dates, list_min(d) AS first_date, list_max(d) AS last_date FROM (SELECT o_custkey, list_transform(regexp_extract_all(told, '[0-9]{4}[-/][0-9]{2}[-/][0-9]{2}'), lambda x: CAST(replace(x, '/', '-') AS DATE)) AS d
FROM (SELECT o_custkey, string_agg(CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y/%m/%d') ELSE strftime(o_orderdate, 'on %Y-%m-%d') END, ', ') AS told FROM orders GROUP BY o_custkey))""")
def q_text_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates that are read from a customer's orders told as text."""
    day = F.col("o_orderdate").cast("timestamp")
    form = F.when(F.col("o_orderkey") % 2 == 0, F.date_format(day, "yyyy/MM/dd")).otherwise(F.date_format(day, "'on 'yyyy-MM-dd"))
    d = T.text_dates(F.col("told"))
    told = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_join(F.collect_list(form), ", ").alias("told"))
    return told.select("o_custkey", F.size(d).alias("dates"), F.array_min(d).alias("first_date"), F.array_max(d).alias("last_date"))


_STIFF, _LIVELY = ("[a-z]+mente", "[a-z]+keit"), ("[a-z]+ing ", "eau")


@query(r"""SELECT conv_id, turn, CAST(greatest(0, least(100, 100 - 5 * (len(regexp_extract_all(text, '[a-z]+mente')) + len(regexp_extract_all(text, '[a-z]+keit'))) + least(20, 2 * (len(regexp_extract_all(text, '[a-z]+ing ')) + len(regexp_extract_all(text, 'eau'))))
 - CASE WHEN mean > 40 THEN 20 WHEN mean > 30 THEN 10 ELSE 0 END - CASE WHEN 2 * len(regexp_extract_all(text, 'the ')) + len(regexp_extract_all(text, 'und ')) < 3 THEN 15 ELSE 0 END)) AS INTEGER) AS score
FROM (SELECT conv_id, turn, coalesce(text, '') AS text, coalesce(list_avg(list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '[。！？\n]'), lambda s: length(trim(s))), lambda n: n > 5)), 0) AS mean FROM conversations)""".replace("\\n", "\n"))
def q_orality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", X.orality(F.col("text"), _STIFF, _LIVELY, you="the ", we="und ").alias("score"))
