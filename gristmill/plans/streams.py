"""Queries that run a stream over all rows of a table and return what it has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.operators.lineage import new_path
from gristmill.plans.registry import query, table
from gristmill.streaming import state


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of its files; the table may be one file or a folder of them."""
    held = table(spark, sf_dir, name)
    reader = spark.readStream.schema(held.schema)
    if any(f.endswith(f"/{name}.parquet") for f in held.inputFiles()):
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return reader.parquet(f"{sf_dir}/{name}.parquet")


_MS = "epoch_us(ts) // 1000"
_STEPS = "(3, 'ongoing'), (7, 'background'), (12, 'dropped')"


@query(f"""WITH e AS (SELECT user_id, event_type, {_MS} AS ms FROM events), r AS (SELECT *, lag(ms) OVER w AS before, lead(ms) OVER w AS after FROM e WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ms)), w AS (SELECT max(ms) - 86400000 AS mark FROM e)
SELECT user_id, event_type, status, count(*) AS times, max(at_ms) AS last_ms FROM (
 SELECT user_id, event_type, ms AS at_ms, CASE WHEN before IS NULL OR ms - before >= 12 * 86400000 THEN 'new' ELSE 'seen' END AS status FROM r
 UNION ALL SELECT user_id, event_type, ms + days * 86400000, status FROM r CROSS JOIN (VALUES {_STEPS}) s(days, status) CROSS JOIN w WHERE ms + days * 86400000 <= coalesce(after, mark)) GROUP BY ALL""")
def q_ledger_ageing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and kinds of event as a ledger whose entries age by the watermark alone, and are dropped in the end."""
    told = state.ageing(stream(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", [(3, "ongoing"), (7, "background"), (12, "dropped")])
    at = state.run_to_end(told, "ageing")
    return spark.read.schema(told.schema).parquet(f"{at}/out").groupBy("user_id", "event_type", "status").agg(F.count(F.lit(1)).alias("times"), F.max("at_ms").alias("last_ms"))


def _ledger_rows(batch: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    error = F.when(k.isNull(), "no key").when(F.col("value") > 100, "value out of range").when(k % 20 == 0, "key withdrawn")
    return batch.select("event_id", "user_id", k.alias("k"), error.alias("error"))


@query("""WITH e AS (SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, value FROM events)
SELECT coalesce(error, 'kept') AS outcome, count(*) AS rows, min(event_id) AS first_id, max(event_id) AS last_id FROM (SELECT *, CASE WHEN k IS NULL THEN 'no key' WHEN value > 100 THEN 'value out of range' WHEN k % 20 = 0 THEN 'key withdrawn' END AS error FROM e) GROUP BY 1""")
def q_ledger_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events through the ledger sink: what it kept, and the dead letters by reason."""
    columns = "event_id long, user_id long, k int, batch int"
    path = new_path(spark, "ledger")
    state.run_to_end(stream(spark, sf_dir, "events"), "ledger-run", state.LedgerSink(f"{path}/rows", f"{path}/dead", _ledger_rows))
    kept = spark.read.schema(columns).parquet(f"{path}/rows").withColumn("error", F.lit("kept"))
    dead = spark.read.schema("event_id long, user_id long, k int, error string, batch int").parquet(f"{path}/dead")
    return kept.unionByName(dead).groupBy(F.col("error").alias("outcome")).agg(F.count(F.lit(1)).alias("rows"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))
