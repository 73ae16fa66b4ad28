"""The interval join against all pairs, and its plan."""

import datetime as dt
import random

from pyspark.sql import functions as F

from gristmill.operators import intervals
from gristmill.plans.registry import QUERIES

DAY = dt.datetime(2024, 1, 1)


def test_interval_join_meets_every_pair_once(spark):
    rng = random.Random(4)
    at = lambda: DAY + dt.timedelta(microseconds=rng.randrange(40 * 86_400_000_000))
    points = [(k, at()) for k in range(300)] + [(300, None), (301, DAY), (302, DAY - dt.timedelta(days=9000))]
    windows = [(k, s, s + dt.timedelta(seconds=rng.choice([-5, 0, 1, 59, 3600, 3601, 86_400, 86_400 * 30, 86_400 * 4000]))) for k in range(200) for s in [rng.choice([at(), DAY])]] + [(200, None, DAY), (201, DAY, None)]
    got = intervals.interval_join(spark.createDataFrame(points, "id int, at timestamp"), spark.createDataFrame(windows, "w int, opens timestamp, closes timestamp"), "at", "opens", "closes", 60)
    expected = sorted((p, w) for p, t in points for w, a, b in windows if t and a and b and a <= t < b)
    assert sorted((r["id"], r["w"]) for r in got.collect()) == expected
    none = spark.createDataFrame([], "w int, opens timestamp, closes timestamp")
    assert intervals.interval_join(spark.createDataFrame(points, "id int, at timestamp"), none, "at", "opens", "closes").count() == 0


def test_calendars_pass_the_new_year(spark):
    years = spark.createDataFrame([(2023,), (2024,)], "year int")
    got = {(r["name"], r["year"]): (str(r["opens"]), str(r["closes"])) for r in intervals.calendar_windows(years, {"a": (2, 1, 2, 28), "b": (12, 20, 1, 5), "c": (7, 7, 7, 7)}).collect()}
    assert got[("a", 2024)] == ("2024-02-01", "2024-02-29") and got[("b", 2023)] == ("2023-12-20", "2024-01-06") and got[("c", 2023)] == ("2023-07-07", "2023-07-08")


def test_no_nested_loop_in_the_plan(spark):
    for name in ("q_campaign_windows", "q_open_incidents"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_stopped_days_are_exempt(spark):
    days = spark.createDataFrame([("2024-01-01", 9), ("2024-01-02", 1), ("2024-01-03", 1)], "day string, rows int").withColumn("day", F.to_date("day"))
    stopped = spark.createDataFrame([("2024-01-01",), ("2024-01-03",), ("2024-01-05",), ("2024-01-05",)], "day string").withColumn("day", F.to_date("day"))
    row = intervals.coverage_with_exemptions(days, stopped, "2024-01-01", "2024-01-05", 2).first()
    assert (row["healthy_days"], row["degraded_days"], row["missing_dates"], row["exempt_days"], row["raw_ratio"], row["status"]) == (1, 1, ["2024-01-04"], 2, 0.4, "failing")


def test_stabbed_counts_windows_without_pairs(spark):
    rng = random.Random(6)
    at = lambda: DAY + dt.timedelta(microseconds=rng.choice([rng.randrange(40 * 86_400_000_000), rng.randrange(40)]))
    points = [(k, at()) for k in range(300)] + [(300, None), (301, DAY), (302, dt.datetime(1960, 1, 1)), (303, DAY)]
    windows = [(k, s, s + dt.timedelta(microseconds=rng.choice([-5, 0, 1, 2, 3, 4, 5, 17, 59_000_000, 3_600_000_000, 3_600_000_001, 86_400_000_000 * 4000]))) for k in range(200) for s in [rng.choice([at(), DAY, dt.datetime(1955, 1, 1)])]] + [(200, None, DAY), (201, DAY, None)]
    df = spark.createDataFrame(windows, "w int, opens timestamp, closes timestamp")
    got = intervals.stabbed(spark.createDataFrame(points, "id int, at timestamp"), df, "at", "opens", "closes", "w")
    met = {p: [w for w, a, b in windows if t and a and b and a <= t < b] for p, t in points}
    assert sorted((r["id"], r["windows"], r["first_name"], r["last_name"]) for r in got.collect()) == sorted((p, len(w), min(w), max(w)) for p, w in met.items() if w)
    assert intervals.stabbed(spark.createDataFrame(points, "id int, at timestamp"), df.limit(0), "at", "opens", "closes", "w").count() == 0


def test_many_open_windows_make_no_pairs(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    df = QUERIES["q_open_incidents"](spark, str(tmp_path))
    n = events.where("event_type = 'error' and value > 0").count()
    assert {r["open_windows"] for r in df.collect()} == {n}
    assert "_level" not in df._jdf.queryExecution().toString()
