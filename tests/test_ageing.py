"""Entries that age by the watermark alone, and a ledger that replayed batches don't double."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gristmill.streaming import state

DAY = dt.datetime(2024, 1, 1)


@pytest.fixture
def rocks(spark):
    spark.conf.set(*state.STORE)
    yield
    spark.conf.unset(state.STORE[0])


def test_entries_age_by_the_watermark(spark, tmp_path, rocks):
    schema = "k string, ts timestamp"
    at = lambda *rows: spark.createDataFrame([(k, None if d is None else DAY + dt.timedelta(days=d)) for k, d in rows], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    at(("a", 0), ("b", 1), (None, 0.5), ("z", None))

    def step():
        told = state.ageing(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), ["k"], "ts", [(3, "ongoing"), (7, "background"), (20, "dropped")], "0 days")
        run = told.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
        run.awaitTermination(120)
        rows = spark.read.schema(told.schema).parquet(str(tmp_path / "out")).collect()
        kept = run.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
        return sorted((r["k"] or "", r["at_ms"] / state.DAY_MS - (DAY - dt.datetime(1970, 1, 1)).days, r["status"]) for r in rows), kept

    assert step()[0] == [("", 0.5, "new"), ("a", 0, "new"), ("b", 1, "new")]
    at(("c", 5))  # only the clock moves
    seen, kept = step()
    assert [r for r in seen if r[0] != "c"] == [("", 0.5, "new"), ("", 3.5, "ongoing"), ("a", 0, "new"), ("a", 3, "ongoing"), ("b", 1, "new"), ("b", 4, "ongoing")]
    at(("b", 6), ("d", 21))
    seen, less = step()
    assert [r for r in seen if r[0] == "a"] == [("a", 0, "new"), ("a", 3, "ongoing"), ("a", 7, "background"), ("a", 20, "dropped")]
    assert [r for r in seen if r[0] == "b"] == [("b", 1, "new"), ("b", 4, "ongoing"), ("b", 6, "seen"), ("b", 9, "ongoing"), ("b", 13, "background")]
    assert less < kept + 4  # a and the null key are gone with their timers, though d has come
    at(("a", 22), ("a", 50))  # forgotten, so new; in one batch the steps between its rows are told as well
    seen, _ = step()
    assert [r for r in seen if r[0] == "a"][4:] == [("a", 22, "new"), ("a", 25, "ongoing"), ("a", 29, "background"), ("a", 42, "dropped"), ("a", 50, "new")]


def test_a_batch_run_twice_leaves_one_copy(spark, tmp_path):
    def prepare(batch):
        return batch.withColumn("error", F.when(F.try_to_number("v", F.lit("999")).isNull(), "not a number"))

    sink = state.LedgerSink(str(tmp_path / "rows"), str(tmp_path / "dead"), prepare)
    rows = spark.createDataFrame([("a", "1"), ("b", "x"), ("c", None), ("d", "2")], "k string, v string")
    for _ in range(2):
        sink(rows, 7)
    sink(rows.where("k = 'a'"), 8)
    read = lambda what: sorted((r["k"], r["batch"]) for r in spark.read.parquet(str(tmp_path / what)).collect())
    assert read("rows") == [("a", 7), ("a", 8), ("d", 7)] and read("dead") == [("b", 7), ("c", 7)]


def test_a_failed_batch_is_replayed_after_restart(spark, tmp_path):
    spark.createDataFrame([("a", "1"), ("b", "x")], "k string, v string").coalesce(1).write.parquet(str(tmp_path / "in"))
    tries = []

    def prepare(batch):
        return batch.withColumn("error", F.when(F.col("v") == "x", "poison"))

    class Dying(state.LedgerSink):
        def __call__(self, batch, batch_id):
            super().__call__(batch, batch_id)
            tries.append(batch_id)
            if len(tries) == 1:
                raise RuntimeError("lost after the write, before the commit")

    def run():
        stream = spark.readStream.schema("k string, v string").parquet(str(tmp_path / "in"))
        sink = Dying(str(tmp_path / "rows"), str(tmp_path / "dead"), prepare)
        stream.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination(120)

    with pytest.raises(Exception, match="lost after the write"):
        run()
    run()
    assert tries == [0, 0]
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 1 and spark.read.parquet(str(tmp_path / "dead")).count() == 1


def test_keys_of_one_bucket_age_apart(spark, tmp_path, rocks):
    big = 2**62 + 1
    schema = "k long, d date, ts timestamp"
    rows = [(big, None, DAY), (big + 1, DAY.date(), DAY), (None, None, DAY + dt.timedelta(days=1)), (None, DAY.date(), DAY + dt.timedelta(days=3))]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    told = state.ageing(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), ["k", "d"], "ts", [(3, "ongoing"), (7, "dropped")], "0 days", buckets=1)
    run = told.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    got = spark.read.schema(told.schema).parquet(str(tmp_path / "out")).collect()
    zero = (DAY - dt.datetime(1970, 1, 1)).days
    day = DAY.date()
    # the mark has reached the third day: steps of that day are told
    assert {(r["k"], r["d"], r["at_ms"] / state.DAY_MS - zero, r["status"]) for r in got} == {(big, None, 0, "new"), (big, None, 3, "ongoing"), (big + 1, day, 0, "new"), (big + 1, day, 3, "ongoing"), (None, None, 1, "new"), (None, day, 3, "new")}
    assert len(got) == 6 and run.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 1
