"""Streams against their batch twins, readers, and gates on hand-made rows."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from gristmill.functions import times as T
from gristmill.operators import gates
from gristmill.sources import readers
from gristmill.streaming import state


@pytest.fixture
def stream_of(spark, tmp_path):
    def make(rows, schema):
        df = spark.createDataFrame(rows, schema)
        df.coalesce(1).write.parquet(str(tmp_path / "in"))
        return df, spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))

    return make


def drained(spark, tmp_path, out, name, mode="append"):
    run = out.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    run.awaitTermination(120)
    return spark.table(name).collect()


def hours(*n):
    return [dt.datetime(2024, 1, 1) + dt.timedelta(hours=h) for h in n]


def test_windowed_counts_follow_the_day_of_the_zone(spark, stream_of, tmp_path):
    rows = [(t, "a") for t in hours(0, 22, 23, 30, 46, 47, 2000)]
    df, stream = stream_of(rows, "ts timestamp, k string")
    got = {(r["window"]["start"], r["k"]): r["rows"] for r in drained(spark, tmp_path, state.windowed_counts(stream, "ts", ["k"]), "windows")}
    day = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    assert got == {(day(-1), "a"): 2, (day(23), "a"): 3, (day(47), "a"): 1}
    assert {str(r["d"]) for r in df.select(T.daily_window(F.col("ts")).alias("d")).collect()} >= {"2024-01-02", "2024-01-03", "2024-01-04"}


def test_sessions_end_after_a_gap(spark, stream_of, tmp_path):
    _, stream = stream_of([(t, "u") for t in hours(0, 1, 2, 9, 10, 3000)], "ts timestamp, u string")
    assert sorted(r["rows"] for r in drained(spark, tmp_path, state.sessions(stream, "ts", "u", "6 hours"), "sessions")) == [2, 3]


def test_first_seen_drops_repeats(spark, stream_of, tmp_path):
    _, stream = stream_of([(t, k) for t, k in zip(hours(0, 1, 2, 3), "abab", strict=True)], "ts timestamp, k string")
    assert sorted(r["k"] for r in drained(spark, tmp_path, state.first_seen(stream, "ts", ["k"]), "seen")) == ["a", "b"]


def test_lateness_by_tier(spark, stream_of, tmp_path):
    now = dt.datetime(2024, 1, 10)
    ago = lambda d: now - dt.timedelta(days=d)
    rows = [(1, ago(0.5), now, "channel"), (2, ago(2), now, "channel"), (3, ago(2), now, "search"), (4, ago(5), now, "search"), (5, ago(5), now, "broad"), (6, ago(8), now, "broad"), (7, ago(-2), now, "broad"), (8, None, now, "broad"), (9, None, now, "channel")]
    _, stream = stream_of(rows, "id int, ts timestamp, arrived timestamp, tier string")
    got = {r["id"]: r["gate"] for r in drained(spark, tmp_path, state.lateness(stream, "ts", "arrived", "tier"), "late")}
    assert got == {1: "kept", 2: "late", 3: "kept", 4: "late", 5: "kept", 6: "late", 7: "future", 8: "kept", 9: "undated"}
    counted = drained(spark, tmp_path, state.gate_counts(state.lateness(stream, "ts", "arrived", "tier"), "ts"), "gates", "complete")
    assert sum(r["rows"] for r in counted if r["gate"] == "late") == 3


@pytest.mark.parametrize(("kind", "starts"), [("weekly", ["2024-01-29", "2024-02-05"]), ("monthly", ["2024-01-01", "2024-02-01"]), ("yearly", ["2024-01-01"])])
def test_calendar_counts(spark, stream_of, tmp_path, kind, starts):
    _, stream = stream_of([(dt.datetime(2024, 1, 31), "a"), (dt.datetime(2024, 2, 4), "a"), (dt.datetime(2024, 2, 5), "a")], "ts timestamp, k string")
    got = drained(spark, tmp_path, state.calendar_counts(stream, "ts", kind, ["k"]), f"calendar_{kind}", "complete")
    assert sorted(str(r["period"]) for r in got) == starts and sum(r["rows"] for r in got) == 3


def test_ledger_keeps_the_last_line_and_skips_broken_ones(spark, tmp_path):
    lines = [json.dumps({"k": "a", "v": 1}), "{broken", json.dumps({"k": "b", "v": 2}), json.dumps({"k": "a", "v": 3}), json.dumps({"v": 9}), ""]
    (tmp_path / "l.jsonl").write_text("\n".join(lines))
    schema = spark.createDataFrame([], "k string, v int").schema
    assert sorted((r["k"], r["v"]) for r in readers.read_ledger(spark, str(tmp_path / "l.jsonl"), schema, "k").collect()) == [("a", 3), ("b", 2)]
    assert readers.read_ledger(spark, str(tmp_path / "l.jsonl"), schema).count() == 4


def test_bootstrap_and_levels_and_candidates(spark):
    df = spark.createDataFrame([("u1", 1), ("u2", 2)], "url string, n int")
    none = df.limit(0).select("url")
    assert {r["freshness"] for r in readers.seen_or_bootstrap(df, none, "url").collect()} == {"bootstrap_seen"}
    assert [(r["url"], r["freshness"]) for r in readers.seen_or_bootstrap(df, df.where("n = 1"), "url").collect()] == [("u2", "newly_discovered")]
    daily, weekly = (spark.createDataFrame(x, "day string, t string") for x in ([("1", "d")], [("1", "w"), ("2", "w")]))
    assert sorted(map(tuple, readers.first_level([daily, weekly], "day").collect())) == [("1", "d", 0), ("2", "w", 1)]
    a, b = (spark.createDataFrame(x, "url string, pos int") for x in ([("u1", 0), ("u1", 1), ("u3", 2)], [("u1", 0), ("u2", 1)]))
    found = readers.candidates([("a", a), ("b", b)], df.where("n = 1"), "url", "pos", exempt=["b"])
    assert sorted((r["url"], r["source_file"]) for r in found.collect()) == [("u2", "b"), ("u3", "a")]


def test_days_fall_back_and_leave_archived_rows_out(spark, tmp_path):
    main = spark.createDataFrame([("2024-01-01", 1, "P1"), ("2024-01-01", 2, "ARCHIVE"), ("2024-02-01", 3, "P1")], "dt string, id int, priority string")
    second = spark.createDataFrame([("2024-01-01", 8, "P1"), ("2024-01-02", 9, "P1")], "dt string, id int, priority string")
    for name, df in (("m", main), ("f", second)):
        df.write.partitionBy("dt").parquet(str(tmp_path / name))
    rows = readers.read_days(spark, str(tmp_path / "m"), str(tmp_path / "f"), "2024-01-01", "2024-01-31", archived="priority = 'ARCHIVE'").collect()
    assert sorted((r["id"], str(r["_file_date"])) for r in rows) == [(1, "2024-01-01"), (9, "2024-01-02")]


def test_outcomes_and_markdown(spark, tmp_path):
    df = spark.createDataFrame([("a", 2, "two", "event"), ("a", 1, "one", "event"), ("b", 1, "x", "failed"), ("b", 2, "y", "other")], "s string, n int, line string, outcome string")
    readers.write_outcomes(df, str(tmp_path / "o"), ["event", "failed"])
    assert spark.read.parquet(str(tmp_path / "o")).groupBy("outcome").count().count() == 2
    text = {r["s"]: r["text"] for r in readers.markdown(df, "Report", "s", ["n"], "line").collect()}
    assert text["a"] == "# Report\n\n## a\n- one\n- two\n"


def test_distinct_top_equals_a_greedy_loop(spark):
    draw = random.Random(5)
    rows = [(g, k, draw.random(), draw.sample(["p", "q", "r", "s"], draw.randint(0, 2))) for g in range(4) for k in range(30)]
    df = spark.createDataFrame(rows, "g int, id int, score double, e array<string>").withColumn("order", -F.col("score"))
    got = {}
    for r in gates.distinct_top(df, "g", ["order", "id"], "e", 3).collect():
        got.setdefault(r["g"], {})[r["place"]] = r["id"]
    for g in range(4):
        ranked = sorted((x for x in rows if x[0] == g), key=lambda x: (-x[2], x[1]))
        chosen, seen = [], set()
        for x in ranked:
            if len(chosen) < 3 and not (set(x[3]) & seen):
                chosen.append(x[1])
                seen |= set(x[3])
        chosen += [x[1] for x in ranked if x[1] not in chosen]
        assert [got[g][k] for k in (1, 2, 3)] == chosen[:3]


def test_cross_day(spark):
    schema = "id int, day date, key string, fact string, topic string, entities array<string>, title string"
    d = dt.date(2024, 1, 2)
    now = [(1, d, "k", "", "", [], ""), (2, d, "", "f", "", [], ""), (3, d, "", "", "abcdefg", [], ""), (4, d, "", "", "", ["x", "y", "big"], ""), (5, d, "", "", "", ["x", "big"], ""), (6, d, "", "", "", [], "t" * 20 + "1"), (7, d, "z", "z", "zzzzz", [], "z")]
    y = d - dt.timedelta(days=1)
    old = [(11, y, "k", "f", "abcdefh", ["x", "y", "big"], "t" * 20 + "2"), (12, y - dt.timedelta(days=1), "z", "z", "zzzzz", [], "z")]
    got = gates.cross_day(spark.createDataFrame(now, schema), spark.createDataFrame(old, schema), common=("big",))
    assert sorted(r["id"] for r in got.collect()) == [1, 2, 3, 4, 6]


def test_gates(spark):
    one = lambda c: spark.range(1).select(c.alias("c")).first()["c"]
    assert one(gates.issues([("a", F.lit(True)), ("b", F.lit(None).cast("boolean")), ("c", F.lit(True))])) == ["a", "c"]
    assert tuple(one(gates.send_gate({"a": F.lit(True), "b": F.lit(None).cast("boolean")}))) == (["b"], False)
    assert one(gates.unsourced(F.lit("3 and 4.5 and 7"), F.lit("4.5, 3"))) == ["7"]
    assert [one(gates.merge_verdicts(F.lit(a), F.lit(b).cast("string"), F.lit(s))) for a, b, s in (("fail", "pass", 99), ("", "pass", 0), ("", None, 60), ("", None, 59))] == ["fail", "pass", "pass", "revise"]
    s = one(gates.sentence_stats(F.lit("Ab. " + "c" * 50 + "! ")))
    assert tuple(s) == (2, 52, 50, 1)


def test_topics_of_alike_letters_equal_all_pairs(spark):
    draw = random.Random(11)
    letters = "abcdefgh平台规则变化商家流量\U0001f642ж"
    sets = lambda k: [(d, sorted(set(draw.choices(letters, k=draw.randint(1, k))))) for d in (1, 2) for _ in range(120)]
    t, y = sets(9), sets(14)
    frame = lambda rows: spark.createDataFrame(rows, "day int, letters array<string>").distinct()
    for least in (0.5, 0.6, 0.9):
        got = {(r["day"], "".join(r["letters"])) for r in gates._alike_letters(frame(t), frame(y), least).collect()}
        assert got == {(d, "".join(a)) for d, a in t for e, b in y if d == e and len(set(a) & set(b)) / len(set(a) | set(b)) >= least}


def test_topics_meet_in_bounded_tiles(spark, monkeypatch):
    monkeypatch.setattr(gates, "TILE", 25)
    draw = random.Random(12)
    letters = "".join(map(chr, range(0x4E00, 0x4E00 + 150)))
    seeds = [draw.sample(letters, draw.randint(1, 90)) for _ in range(40)]
    sets = lambda n: [(d, sorted({*draw.sample(s := draw.choice(seeds), draw.randint(0, len(s))), *draw.sample(letters, draw.randint(0, 9))})) for d in (1, 2, 3, None) for _ in range(n if d != 3 else 1)]
    t, y = sets(90), [*sets(130), (2, [])]
    frame = lambda rows: spark.createDataFrame(rows, "day int, letters array<string>").distinct()
    got = {(r["day"], "".join(r["letters"])) for r in gates._alike_letters(frame(t), frame(y), 0.6).collect()}
    expected = {(d, "".join(a)) for d, a in t for e, b in y if d is not None and d == e and a and len(set(a) & set(b)) / len(set(a) | set(b)) >= 0.6}
    assert got == expected and 20 < len(expected) < 150
