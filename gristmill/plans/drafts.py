"""Queries that validate daily reports, built from the events of their day, against these events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gristmill.operators import drafts
from gristmill.operators.lineage import cut
from gristmill.plans.registry import query, table

#: Parameters: the checks in the tables' terms.
RULES = drafts.DraftRules(
    required=("1", "2", "3", "4", "8", "11"),
    tracking_section="11",
    action_section="8",
    action_word="act:",
    body_sections=("2", "3", "4", "5"),
    core_section="2",
    id_pattern=r"E\d{8}_\d{7}",
    number_pattern=r"\d+[.\d]*%|\d+ (?:tons|pieces)",
    low_marks=("(unsure)", "(check)"),
    fallback_marks=("(by rule)",),
    vague=("keep watching", "more to come"),
    concrete=("orders", "share"),
    most_unsourced=3,
)

_KINDS = {"confidence": "CASE k % 3 WHEN 0 THEN 'low' ELSE 'high' END", "method": "CASE k % 7 WHEN 0 THEN 'rule_fallback' ELSE 'llm' END", "eligibility": "CASE k % 5 WHEN 0 THEN 'tracking' WHEN 1 THEN 'archive' ELSE 'core' END"}
_KINDS |= {"novelty": "CASE k % 4 WHEN 0 THEN 'repeated' WHEN 1 THEN 'ongoing' ELSE 'new_today' END", "priority": "CASE WHEN value >= 60 THEN 'P1' WHEN value >= 20 THEN 'P2' ELSE 'ARCHIVE' END"}


def report_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ids as reports cite them, a title and a text with figures."""
    e = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    ident = F.concat(F.lit("E"), F.date_format("ts", "yyyyMMdd"), F.lit("_"), F.lpad(F.col("event_id").cast("string"), 7, "0"))
    said = F.concat(F.lit("up "), F.col("k").cast("string"), F.lit("% of "), (F.col("k") * 7).cast("string"), F.lit(" tons"))
    out = e.select(F.date_format("ts", "yyyy-MM-dd").alias("report"), ident.alias("event_id"), F.concat_ws(" ", "event_type", "user_id").alias("title"), said.alias("text"), "k", "value", *[F.expr(v).alias(n) for n, v in _KINDS.items()])
    return out.withColumns({"weighted": F.least(F.col("value") / 20, F.lit(5.0)), "credibility": F.col("k") % 6})


#: Events that a report cites: the day's first by value.
_CITED = 25


def report_texts(events: DataFrame) -> DataFrame:
    """A report a day of its events of the greatest value, in sections by their key, with flaws that follow from it."""
    top = events.withColumn("n", F.row_number().over(Window.partitionBy("report").orderBy(F.desc("value"), "event_id"))).where(F.col("n") <= _CITED)
    mark = F.concat(F.when(F.col("k") % 2 == 0, " (unsure)").otherwise(""), F.when(F.col("k") % 14 == 0, " (by rule)").otherwise(""))
    ident = F.when(F.col("k") % 17 == 3, F.regexp_replace("event_id", "_0", "_9")).otherwise(F.col("event_id"))
    figure = F.when(F.col("k") % 6 == 5, "1234 pieces").otherwise(F.concat((F.col("k") * 7 % 10).cast("string"), F.lit(" tons")))
    line = F.concat(F.lit("- "), ident, F.lit(" "), "title", F.lit(" up "), F.col("k").cast("string"), F.lit("% "), figure, mark, F.when(F.col("k") % 11 == 0, "; keep watching").otherwise(""), F.when(F.col("k") % 22 == 0, " orders").otherwise(""))
    line = F.concat(line, F.when(F.col("k") % 9 == 0, "\n- act: do").otherwise(""))
    section = F.get(F.array(*map(F.lit, (2, 3, 4, 8, 11))), (F.col("k") % 5).cast("int"))
    lines = top.groupBy("report", section.alias("section")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", line.alias("line")))), lambda x: x["line"]), "\n").alias("body"))
    texts = lines.groupBy("report").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("section", "body"))), lambda x: F.concat(F.lit("## "), x["section"].cast("string"), F.lit(" part\n"), x["body"])), "\n").alias("body"))
    return texts.select("report", F.concat(F.lit("# "), "report", F.lit("\n## 1 first\nmore to come\n"), "body").alias("text"))


_EVENTS = f"""SELECT strftime(ts, '%Y-%m-%d') AS report, 'E' || strftime(ts, '%Y%m%d') || '_' || lpad(CAST(event_id AS VARCHAR), 7, '0') AS event_id, event_type || ' ' || user_id AS title, 'up ' || k || '% of ' || k * 7 || ' tons' AS text, k, value, {', '.join(f'{v} AS {n}' for n, v in _KINDS.items())}, least(value / 20, 5.0) AS weighted, k % 6 AS credibility
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"""
_LINE = """'- ' || CASE WHEN k % 17 = 3 THEN replace(event_id, '_0', '_9') ELSE event_id END || ' ' || title || ' up ' || k || '% ' || CASE WHEN k % 6 = 5 THEN '1234 pieces' ELSE (k * 7 % 10) || ' tons' END || CASE WHEN k % 2 = 0 THEN ' (unsure)' ELSE '' END || CASE WHEN k % 14 = 0 THEN ' (by rule)' ELSE '' END
 || CASE WHEN k % 11 = 0 THEN '; keep watching' ELSE '' END || CASE WHEN k % 22 = 0 THEN ' orders' ELSE '' END || CASE WHEN k % 9 = 0 THEN chr(10) || '- act: do' ELSE '' END"""
_TEXTS = f"""SELECT report, '# ' || report || chr(10) || '## 1 first' || chr(10) || 'more to come' || chr(10) || string_agg('## ' || section || ' part' || chr(10) || body, chr(10) ORDER BY section) AS text FROM (SELECT report, section, string_agg(line, chr(10) ORDER BY n) AS body FROM (
 SELECT report, [2, 3, 4, 8, 11][1 + k % 5] AS section, n, {_LINE} AS line FROM (SELECT *, row_number() OVER (PARTITION BY report ORDER BY value DESC, event_id) AS n FROM e) WHERE n <= {_CITED}) GROUP BY ALL) GROUP BY report"""
_IDS, _NUMBERS = r"E\d{8}_\d{7}", r"\d+[.\d]*%|\d+ (?:tons|pieces)"
_ISSUES = f"""WITH e AS MATERIALIZED ({_EVENTS}), t AS MATERIALIZED ({_TEXTS}),
pos AS (SELECT report, text, unnest(range(1, length(text) + 1)) AS p FROM t),
c AS MATERIALIZED (SELECT report, substr(text, p, 17) AS event_id, list_last(regexp_extract_all(chr(10) || substr(text, 1, p - 1), '\\n## (\\d+)', 1)) AS section, substr(text, greatest(p - 150, 1), p + 100 - greatest(p - 150, 1)) AS near_low, substr(text, greatest(p - 200, 1), p + 50 - greatest(p - 200, 1)) AS near_rule FROM pos WHERE substr(text, p, 1) = 'E' AND regexp_full_match(substr(text, p, 17), '{_IDS}')),
k AS (SELECT c.report, c.event_id, c.section, near_low, near_rule, priority, confidence, method, eligibility, novelty, weighted, credibility FROM c JOIN e USING (report, event_id)),
f AS (SELECT DISTINCT report FROM e WHERE priority <> 'ARCHIVE' AND (novelty = 'ongoing' OR eligibility = 'tracking')),
m AS (SELECT report, unnest(CASE WHEN f.report IS NULL THEN ['1', '2', '3', '4', '8'] ELSE ['1', '2', '3', '4', '8', '11'] END) AS section, regexp_extract_all(chr(10) || text, '\\n## (\\d+)', 1) AS have FROM t LEFT JOIN f USING (report)),
n AS (SELECT report, unnest(regexp_extract_all(text, '{_NUMBERS}')) AS number FROM t),
u AS (SELECT report, count(*) AS n FROM n WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.report = n.report AND contains(e.text, n.number)) GROUP BY report HAVING count(*) > 3),
b AS (SELECT report, event_id, any_value(priority) AS priority, any_value(confidence) AS confidence, any_value(method) AS method, any_value(weighted) AS weighted, any_value(credibility) AS credibility, bool_or(contains(near_low, '(unsure)') OR contains(near_low, '(check)')) AS low, bool_or(contains(near_rule, '(by rule)')) AS by_rule FROM k GROUP BY ALL),
a AS (SELECT report, len(list_filter(string_split(split_part(chr(10) || text, chr(10) || '## 8', 2), chr(10)), lambda s: starts_with(ltrim(s), '-') AND contains(s, 'act:'))) AS n FROM (SELECT report, CASE WHEN contains(text, chr(10) || '## 8') THEN '## 8' || split_part(split_part(text, chr(10) || '## 8', 2), chr(10) || '## ', 1) ELSE '' END AS text FROM t)),
v AS (SELECT report, w AS phrase, substr(text, greatest(p - 40, 1), p + 40 + length(w) - greatest(p - 40, 1)) AS near FROM pos, (VALUES ('keep watching'), ('more to come')) x(w) WHERE substr(text, p, length(w)) = w)
SELECT report, 'missing_section' AS type, 'high' AS severity, section AS detail FROM m WHERE NOT list_contains(have, section)
UNION ALL SELECT report, 'missing_event_id', 'high', '' FROM t WHERE report NOT IN (SELECT report FROM c)
UNION ALL SELECT DISTINCT report, 'invalid_event_id', 'high', event_id FROM c WHERE (report, event_id) NOT IN (SELECT (report, event_id) FROM e)
UNION ALL SELECT report, 'unsupported_claim', 'medium', CAST(n AS VARCHAR) FROM u
UNION ALL SELECT report, 'invalid_unique_action', 'high', CAST(n AS VARCHAR) FROM a WHERE n > 1
UNION ALL SELECT report, 'low_confidence_strong_claim', CASE WHEN priority = 'P1' OR weighted >= 3.5 AND credibility >= 3 THEN 'low' ELSE 'medium' END, event_id FROM b WHERE confidence = 'low' AND NOT low
UNION ALL SELECT report, 'rule_fallback_strong_claim', 'medium', event_id FROM b WHERE method = 'rule_fallback' AND NOT by_rule
UNION ALL SELECT DISTINCT report, 'tracking_in_core_signal', 'medium', event_id FROM k WHERE section IN ('2', '3', '4', '5') AND eligibility = 'tracking' AND priority <> 'ARCHIVE'
UNION ALL SELECT DISTINCT report, 'repeated_in_core_signal', 'high', event_id FROM k WHERE section = '2' AND novelty = 'repeated'
UNION ALL SELECT DISTINCT report, 'background_in_core_signal', 'medium', event_id FROM k WHERE section = '2' AND eligibility = 'archive'
UNION ALL SELECT DISTINCT report, 'vague_action', 'low', phrase FROM v WHERE NOT (contains(near, 'orders') OR contains(near, 'share'))"""


def _checked(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = cut(report_events(spark, sf_dir))
    reports = cut(report_texts(events))
    return reports, drafts.draft_issues(reports, events, RULES)


@query(_ISSUES)
def q_draft_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of the daily reports."""
    return _checked(spark, sf_dir)[1]


@query(f"""WITH i AS ({_ISSUES}), d AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS report FROM events)
SELECT report, high, medium, low, high = 0 AND medium <= 3 AS sendable FROM (SELECT d.report, count(*) FILTER (severity = 'high') AS high, count(*) FILTER (severity = 'medium') AS medium, count(*) FILTER (severity = 'low') AS low FROM d LEFT JOIN i USING (report) GROUP BY d.report)""")
def q_draft_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the daily reports may be sent."""
    reports, issues = _checked(spark, sf_dir)
    return drafts.verdicts(reports, issues)
