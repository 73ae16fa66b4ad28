"""Queries of loosely typed input: JSON that breaks off, values of unknown shape, list pages, counted writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import loose, repair
from gristmill.operators.lineage import new_path
from gristmill.plans.ladders import KINDS, event_rows
from gristmill.plans.registry import query, table
from gristmill.sources import metrics, sites

_DOC = """'{"id": ' || event_id || ', "type": "' || event_type || ' \\"x\\"", "list": [' || props || ', {"user": [' || user_id || ', -1.5e3, []]}, null], "done": true}'"""


@query(f"""WITH d AS (SELECT event_id, {_DOC} AS doc FROM events), c AS (SELECT event_id, left(doc, CAST(event_id * 7 % (length(doc) + 1) AS INTEGER)) AS cut FROM d),
t AS (SELECT event_id, cut, unnest(range(length(cut), 0, -1)) AS n FROM c), p AS (SELECT event_id, n, left(cut, n) || closer AS json FROM t CROSS JOIN (VALUES (''), ('}}'), (']}}'), ('}}]}}'), (']}}]}}'), (']]}}]}}')) k(closer) WHERE left(cut, 1) = '{{' AND NOT regexp_matches(left(cut, n), '[, ]$'))
SELECT c.event_id, length(cut) AS n_cut, r.json AS repaired FROM c LEFT JOIN (SELECT event_id, arg_max(json, n) AS json FROM p WHERE json_valid(json) AND json LIKE '{{%' GROUP BY event_id) r USING (event_id)""")
def q_json_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON texts, each cut somewhere, and repaired."""
    e = table(spark, sf_dir, "events")
    doc = F.concat(F.lit('{"id": '), "event_id", F.lit(', "type": "'), "event_type", F.lit(' \\"x\\"", "list": ['), "props", F.lit(', {"user": ['), "user_id", F.lit(', -1.5e3, []]}, null], "done": true}'))
    e = e.select("event_id", doc.alias("doc"))
    cut = e.select("event_id", F.left("doc", (F.col("event_id") * 7 % (F.length("doc") + 1)).cast("int")).alias("cut"))
    return cut.select("event_id", F.length("cut").cast("long").alias("n_cut"), repair.repair_json(F.col("cut")).alias("repaired"))


_LOOSE = """CASE event_id % 5 WHEN 0 THEN '{"v": ["' || event_type || '", ' || user_id || ', null, "b"]}' WHEN 1 THEN '{"v": ' || user_id || '}' WHEN 2 THEN '{"v": "' || event_type || '"}' WHEN 3 THEN '{"v": null}' ELSE '{"v" broken' END"""


@query("""SELECT event_id, CASE event_id % 5 WHEN 0 THEN event_type || ' ' || user_id || ' b' WHEN 1 THEN CAST(user_id AS VARCHAR) WHEN 2 THEN event_type ELSE '' END AS v FROM events""")
def q_loose_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field that comes as a list, a number, a text, null or not at all."""
    e = table(spark, sf_dir, "events").withColumn("doc", F.expr(_LOOSE))
    return e.select("event_id", loose.loose_text(loose.variant(F.col("doc")), "$.v").alias("v"))


@query("""WITH d AS (SELECT doc_id, lang, source, CAST(doc_id % 3 AS VARCHAR) AS n FROM documents), u AS (SELECT doc_id, unnest([lang, 'all', source, n, 'end']) AS word, unnest([1, 2, 3, 4, 5]) AS at_ FROM d), f AS (SELECT doc_id, word, min(at_) AS at_ FROM u GROUP BY ALL)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY at_) - 1 AS INTEGER) AS place, word FROM f""")
def q_lexicon_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested lexicon for each document, flattened: lists, lists in categories, numbers, and a value that is no list."""
    lexicon = F.concat(F.lit('{"a": {"x": ["'), "lang", F.lit('", "all"], "y": ["all", null, "'), "source", F.lit('"], "z": "none"}, "b": ['), F.col("doc_id") % 3, F.lit(', "all"], "c": 5, "d": {"q": ["end"]}}'))
    docs = table(spark, sf_dir, "documents").select("doc_id", loose.variant(lexicon).alias("lexicon"))
    return loose.flatten_lexicon(docs, "lexicon")


#: Parameter: hosts with the way their list pages are read.
SITES = [
    {"host": "example.org", "state": "initialState", "path": ["feed", "items"], "id": "itemId", "title": "name", "published": "at", "url": "https://example.org/p/{}"},
    {"host": "example.net", "links": ["/"], "least_title": 4},
]


def list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as list pages: every third has a state object of two items in a script, every fifth a JSON-LD article, every
    seventh a meta tag with its time."""
    k = F.col("page_id")
    state = F.concat(F.lit('<script>window.initialState = {"feed": {"items": [{"itemId": '), k, F.lit(', "name": "first } {", "at": "2024-01-02"}, {"itemId": '), k + 1, F.lit(', "name": " second <b>one</b> "}, {"name": "none"}]}}; go()</script>'))
    linked = F.concat(F.lit('<script type="application/ld+json">{"@type": "NewsArticle", "headline": "News &amp; more", "datePublished": "2024-02-03", "url": "/n/'), k, F.lit('"}</script>'))
    meta = F.lit('<meta property="article:published_time" content="2024-03-04T05:06:07Z">')
    more = F.concat(F.when(k % 3 == 0, state).otherwise(""), F.when(k % 5 == 0, linked).otherwise(""), F.when(k % 7 == 0, meta).otherwise(""))
    return table(spark, sf_dir, "pages").select("page_id", "url", F.concat(more, F.coalesce("html", F.lit(""))).alias("html"))


@query()
def q_site_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of all list pages, read as their site asks."""
    return sites.site_items(list_pages(spark, sf_dir), SITES).select("page_id", "item_url", "title", "published", "origin")


@query(f"""WITH e AS (SELECT event_id, value, k, kind, coalesce(fact, '') <> '' AS told FROM (SELECT e.event_id, e.value, CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k, CASE event_type WHEN 'click' THEN 'platform_rule' WHEN 'view' THEN 'marketing' WHEN 'signup' THEN 'competitor_move' WHEN 'error' THEN 'unclear' ELSE 'background_only' END AS kind,
 split_part(d.text, '.', CAST(1 + e.event_id % 10 AS INTEGER)) AS fact FROM events e LEFT JOIN documents d ON d.doc_id = e.event_id // 10)),
r AS (SELECT count(*) AS total, count(*) FILTER (told) AS extracted, count(*) FILTER (NOT told) AS failed, count(*) FILTER (k % 7 = 0) AS rule_fallback, min(event_id) AS first_id, max(event_id) AS last_id, count(*) FILTER (kind = 'platform_rule') AS kind_platform_rule, count(*) FILTER (kind = 'marketing') AS kind_marketing, count(*) FILTER (kind = 'competitor_move') AS kind_competitor_move, count(*) FILTER (kind = 'unclear') AS kind_unclear FROM e)
SELECT name, CAST(value AS DOUBLE) AS value FROM (UNPIVOT (SELECT *, CAST(1 AS BIGINT) AS rows_hold, CAST(1 AS BIGINT) AS parts_hold FROM r) ON COLUMNS(*) INTO NAME name VALUE value)""")
def q_extraction_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of an extraction batch, gathered by the write itself, and whether they hold against what was written."""
    e = event_rows(spark, sf_dir)
    told = F.coalesce(F.col("fact"), F.lit("")) != ""
    counters = {"total": F.count(F.lit(1)), "extracted": F.count_if(told), "failed": F.count_if(~told), "rule_fallback": F.count_if(F.col("k") % 7 == 0), "first_id": F.min("event_id"), "last_id": F.max("event_id")}
    counters |= metrics.count_by(F.col("kind"), {f"kind_{v}": v for v in KINDS.values()})
    path = new_path(spark, "extracted")
    got = metrics.write_counted(e, path, counters)
    holds = metrics.reconciled(spark.read.parquet(path), got, "total", ["extracted", "failed"])
    row = got | {f"{k}_hold": int(v) for k, v in holds.items()}
    return spark.createDataFrame([(k, float(v)) for k, v in row.items()], "name string, value double")
