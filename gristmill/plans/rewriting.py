"""Queries of report rewriting and of resuming what is written."""

from __future__ import annotations

import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import rewrite
from gristmill.operators.lineage import new_path
from gristmill.plans.registry import query, table
from gristmill.plans.sql import quoted
from gristmill.sources import readers

#: Parameter: marks and leftovers of the tables' texts; a rule may leave work for those before it.
RULES = (("###+", "#"), ("[ \\t]+\\n", "\n"), ("\\n\\n\\n+", "\n\n"), ("[(] *[)]", ""), ("([%$&*])[%$&*]", "$1"), ("##", "#"))
_PASSES = 3


def _sanitized_sql() -> str:
    state = ", ".join(f"CAST(0 AS BIGINT) AS c{k}" for k in range(len(RULES)))
    out = f"SELECT doc_id, text AS t0, {state} FROM documents WHERE text IS NOT NULL"
    for _ in range(_PASSES):
        for k, (pattern, replacement) in enumerate(RULES):
            pattern, replacement = quoted(pattern).replace("\\n", "\\n"), quoted(replacement.replace("$1", "\\1"))
            out = f"SELECT * REPLACE (regexp_replace(t0, {pattern}, {replacement}, 'g') AS t0, c{k} + len(regexp_extract_all(t0, {pattern})) AS c{k}) FROM ({out})"
    return f"SELECT doc_id, md5(t0) AS digest, length(t0) AS chars, {', '.join(f'c{k}' for k in range(len(RULES)))} FROM ({out})"


@query(_sanitized_sql())
def q_sanitized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents under the rewrite rules, with how often each rule changed something."""
    made = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.explode(F.array(rewrite.sanitize(F.col("text"), RULES, _PASSES))).alias("s"))
    return made.select("doc_id", F.md5(F.col("s.text").cast("binary")).alias("digest"), F.length("s.text").cast("long").alias("chars"), *[F.get("s.counts", F.lit(k)).cast("long").alias(f"c{k}") for k in range(len(RULES))])


_WORD = "regexp_extract(text, '[a-z]+')"


@query(f"SELECT doc_id, '# head' || chr(10) || CASE WHEN length({_WORD}) >= 5 THEN {_WORD} ELSE array_to_string(string_split({_WORD}, ''), chr(10)) END || chr(10) || source || ' end' AS text FROM documents WHERE {_WORD} <> ''")
def q_joined_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that were written a letter a line, put together again."""
    word = F.regexp_extract("text", "[a-z]+", 0)
    split = F.concat(F.lit("# head\n"), F.array_join(F.regexp_extract_all("text_word", F.lit("."), F.lit(0)), "\n"), F.lit("\n"), "source", F.lit(" end"))
    docs = table(spark, sf_dir, "documents").withColumn("text_word", word).where("text_word <> ''")
    return docs.select("doc_id", rewrite.join_letters(split).alias("text"))


_HEADS = ("ref", "evidence")


@query("""WITH r AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS n FROM documents WHERE text IS NOT NULL),
t AS (SELECT doc_id, string_agg('|' || CASE WHEN doc_id % 3 = 0 THEN '' WHEN n = 1 THEN ' E' || doc_id || ' |' ELSE '  |' END || ' ' || n || ' | ' || length(line) || ' |', chr(10) ORDER BY n) AS rows, count(*) AS k FROM r GROUP BY doc_id)
SELECT doc_id, 'before' || chr(10) || CASE WHEN doc_id % 3 = 0 OR k < 2 THEN '| n | chars |' || chr(10) || '|---|---|' ELSE '| ref | n | chars |' || chr(10) || '|---|---|---|' END || chr(10) || CASE WHEN k < 2 AND doc_id % 3 <> 0 THEN replace(rows, '|  |', '|') ELSE rows END || chr(10) || '## 08 next' || chr(10) || chr(10) || 'Do ' || doc_id || '.' || chr(10) || '## 09 end' AS text FROM t""")
def q_table_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports with a table of a document's lines: reference columns that are blank go, vague lines go, a section is replaced."""
    docs = table(spark, sf_dir, "documents").where("text is not null")
    ref = F.when((F.col("doc_id") % 3 != 0), F.concat(F.lit(" E"), F.col("doc_id").cast("string"), F.lit(" "))).otherwise("  ")
    rows = F.transform(F.split("text", "\n"), lambda line, n: F.concat(F.lit("|"), F.when(n == 1, ref).otherwise("  "), F.lit("| "), n.cast("string"), F.lit(" | "), F.length(line).cast("string"), F.lit(" |")))
    report = F.concat(F.lit("before\n- more to come\n| ref | n | chars |\n|---|---|---|\n"), F.array_join(rows, "\n"), F.lit("\nmore to come\n## 08 next\nold\n|---|---|\n## 09 end"))
    cleaned = rewrite.replace_section(rewrite.drop_lines(rewrite.drop_empty_columns(report, _HEADS), ["more to come"]), "08 next", F.concat(F.lit("Do "), F.col("doc_id").cast("string"), F.lit(".")))
    return docs.select("doc_id", cleaned.alias("text"))


@query("""SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS rows, day(min(ts)) % 5 <> 0 AS valid, day(min(ts)) > 10 AS fresh, day(min(ts)) % 5 <> 0 AND day(min(ts)) > 10 AS resume FROM events GROUP BY 1""")
def q_resume_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of events as an earlier run has left them: those up to the tenth were written before the run, and every fifth
    has another count than its manifest says."""
    events = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.dayofmonth("ts").alias("n"))
    path = new_path(spark, "days")
    events.where("n <= 10").drop("n").write.partitionBy("day").parquet(path)
    time.sleep(1.1)  # times of files may have whole seconds
    since = datetime.fromtimestamp(time.time() // 1, timezone.utc)
    events.where("n > 10").drop("n").write.mode("append").partitionBy("day").parquet(path)
    written = spark.read.schema("event_id long, day string").parquet(path)
    expected = events.groupBy("day").agg((F.count(F.lit(1)) + (F.min("n") % 5 == 0).cast("int")).alias("rows"))
    return readers.resume_status(written, expected, "day", since)
