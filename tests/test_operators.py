"""Operators and expressions on hand-made rows."""

import datetime as dt
import difflib
import json
import random

import pytest
from pyspark.sql import functions as F

from gristmill.functions import text as X
from gristmill.functions import times as T
from gristmill.functions import urls as U
from gristmill.operators import dedup, ledger, reports, scoring
from gristmill.sources import readers


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("url", "expected"),
    [
        ("HTTPS://Example.COM/a/b/?utm_source=x&b=2&Share=3&a=1&ref=4&flag#top", "https://example.com/a/b?b=2&a=1&ref=4"),
        ("http://e.org", "http://e.org/"),
        ("not a url/", "not a url"),
        ("http://e.org/x y?q=1", "http://e.org/x y?q=1"),
        (None, None),
    ],
)
def test_normalize_url(spark, url, expected):
    assert one(spark, url, U.normalize_url) == expected


def test_normalize_url_is_idempotent_and_sorts(spark):
    make = lambda c: U.normalize_url(c, sort_query=True, strip_www=True)
    assert one(spark, "http://www.E.org/p/?z=1&a=2", lambda c: make(make(c))) == "http://e.org/p?a=2&z=1"


@pytest.mark.parametrize(("url", "expected"), [("http://e/2024/05/06/x", "2024-05-06"), ("http://e/20240506", "2024-05-06"), ("http://e/2024/02/31/x", None), ("http://e/1999/01/01/", None), ("http://e/x", None)])
def test_url_date(spark, url, expected):
    got = one(spark, url, U.url_date)
    assert (got and str(got)) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [("2024-05-06 07:08:09", "2024-05-06 07:08:09"), ("2024/5/6", "2024-05-06 00:00:00"), ("2024年5月6日", "2024-05-06 00:00:00"), ("Mon, 06 May 2024 07:08:09 GMT", "2024-05-06 07:08:09"), ("1714979289", "2024-05-06 07:08:09"), ("2024-05-06T07:08:09Z", "2024-05-06 07:08:09"), ("soon", None), ("", None), (None, None)],
)
def test_parse_any_ts(spark, text, expected):
    got = spark.createDataFrame([(text,)], "x string").select(T.parse_any_ts(F.col("x")).cast("string").alias("y")).first()["y"]
    assert got == expected


def test_time_status_counts_elapsed_days(spark):
    status = lambda c: T.time_status(c.cast("timestamp"), F.lit("2024-08-09 07:00:00").cast("timestamp"), future="old")
    assert [one(spark, v, status) for v in ("2024-08-06 07:00:01", "2024-08-06 07:00:00", "2024-08-02 06:00:00", "2024-08-01 07:00:00", "2024-08-10 00:00:00", None)] == ["in_window", "near_window", "near_window", "old", "old", "unknown_time"]


def test_periods(spark):
    row = spark.createDataFrame([(dt.date(2021, 1, 1),)], "d date").select(T.period_id(F.col("d"), "weekly").alias("w"), T.due_periods(F.col("d")).alias("due"), T.period_end(F.col("d"), "yearly").alias("e"), T.previous_period(F.col("d"), "monthly").alias("p")).first()
    assert (row["w"], row["due"], str(row["e"]), str(row["p"])) == ("2020-W53", ["monthly", "yearly"], "2022-01-01", "2020-12-31")


def test_ngrams_and_jaccard(spark):
    assert one(spark, "ab", lambda c: F.size(X.char_ngrams(c))) == 0
    assert one(spark, "abcabc", lambda c: F.size(X.char_ngrams(c))) == 3
    assert one(spark, "abc", lambda c: X.jaccard(X.char_ngrams(c), X.char_ngrams(c))) == 1.0
    assert one(spark, "a", lambda c: X.jaccard(X.char_ngrams(c), X.char_ngrams(c))) == 0.0


def test_text_helpers(spark):
    assert one(spark, "2024-05-06 Rose 12.5%!", X.cluster_text) == "rose"
    assert one(spark, "**a** [b](c)\n## d", X.strip_markdown) == "a b\nd"
    assert [s["title"] for s in one(spark, "# t\n## 1. One\nx\n## Two\n## 2 Three\ny", X.report_sections)] == ["One", "Three"]
    assert one(spark, "aaa\nbbb\n\ncccccc", lambda c: X.chunks(c, 8)) == ["aaa\nbbb", "cccccc"]
    assert one(spark, 'Sure:\n```json\n{"a": 1}\n```', lambda c: X.parse_json(c, "a int"))["a"] == 1
    assert one(spark, None, lambda c: X.keyword_hits(c, ["a"])) == []


def test_guards_and_caps(spark):
    df = spark.createDataFrame([("P0", 1), ("P2", 1), ("ARCHIVE", 1), ("P1", None)], "level string, x int")
    level, reasons = scoring.cap(F.col("level"), ["P0", "P1", "P2", "ARCHIVE"], [(F.col("x") == 1, "P2", "one")])
    assert [(r["l"], r["r"]) for r in df.select(level.alias("l"), reasons.alias("r")).collect()] == [("P2", ["one"]), ("P2", ["one"]), ("ARCHIVE", ["one"]), ("P1", [])]


def test_first_wins_keeps_rows_without_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 3, "z"), (None, 4, "w")], "k string, pos int, v string")
    assert sorted(r["v"] for r in dedup.first_wins(df, F.col("k"), ["pos"]).collect()) == ["w", "y", "z"]


def test_union_sources_fills_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("t",)], "y string")
    rows = dedup.union_sources([("a", a), ("b", b)]).orderBy("priority").collect()
    assert [(r["x"], r["y"], r["source_file"]) for r in rows] == [(1, None, "a"), (None, "t", "b")]


def test_similar_pairs_finds_all(spark):
    texts = ["the quick brown fox", "the quick brown fix", "a slow green turtle", "the quick brawn fox", "", "aa"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").withColumn("g", X.char_ngrams(F.col("t")))
    got = {(r["a"], r["b"]) for r in dedup.similar_pairs(df, "id", "g", 0.5).collect()}
    grams = [{t[i : i + 3] for i in range(len(t) - 2)} for t in texts]
    assert got == {(i, j) for i in range(6) for j in range(i + 1, 6) if grams[i] and grams[j] and len(grams[i] & grams[j]) / len(grams[i] | grams[j]) >= 0.5}
    assert difflib.SequenceMatcher(None, texts[0], texts[1]).ratio() > 0.85


def test_ledger(spark):
    df = spark.createDataFrame([("k", 1, dt.date(2024, 1, 1), "f"), ("k", 2, dt.date(2024, 1, 1), "f"), ("k", 3, dt.date(2024, 1, 2), "g"), ("k", 4, dt.date(2024, 1, 3), "g"), ("k", 5, dt.date(2024, 1, 20), "g"), ("k", 6, dt.date(2024, 1, 21), "g")], "key string, seq int, day date, fact string")
    assert [r["status"] for r in ledger.novelty(df, "key", "seq", "day", "fact").orderBy("seq").collect()] == ["new_today", "new_today", "updated_today", "repeated", "background", "repeated"]
    assert ledger.latest(df, "key", "seq").first()["seq"] == 6


def test_as_of_join_takes_the_latest_before(spark):
    left = spark.createDataFrame([("a", 5), ("a", 1), ("b", 9)], "k string, t int")
    right = spark.createDataFrame([("a", 2, "x"), ("a", 5, "y"), ("a", 7, "z")], "k string, s int, v string")
    got = {(r["k"], r["t"]): r["v"] for r in ledger.as_of_join(left, right, "k", "t", "s", ["v"]).collect()}
    assert got == {("a", 5): "y", ("a", 1): None, ("b", 9): None}


def test_numbers_need_evidence(spark):
    claims = spark.createDataFrame([(1, "%", 10.0), (1, "%", 50.0), (2, "%", 10.0)], "k int, unit string, number double")
    known = spark.createDataFrame([(1, "%", 10.5), (2, "m", 10.0)], "k int, unit string, number double")
    assert {(r["k"], r["number"]) for r in reports.unmatched_numbers(claims, known, "k").collect()} == {(1, 50.0), (2, 10.0)}


def test_envelopes_pools_and_resume(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"articles": [{"id": 1, "t": "x"}, {"id": 2}]}))
    (tmp_path / "b.json").write_text(json.dumps([{"id": 3, "t": "y"}]))
    (tmp_path / "c.json").write_text("{broken")
    schema = spark.createDataFrame([], "id long, t string").schema
    rows = readers.read_envelopes(spark, [str(tmp_path / f"{n}.json") for n in "abc"], schema)
    assert sorted(r["id"] for r in rows.collect()) == [1, 2, 3]
    pooled = rows.select("id", F.lit("2024-01-01").alias("dt"), F.when(F.col("id") > 1, "main").otherwise("reject").alias("final_pool"))
    readers.write_pools(pooled, str(tmp_path / "pools"))
    readers.write_pools(pooled, str(tmp_path / "pools"))
    assert spark.read.parquet(str(tmp_path / "pools")).count() == 3
    assert readers.resume(rows, pooled.where("id < 3"), "id").count() == 1


def test_novelty_stream_equals_batch(spark, tmp_path):
    from gristmill.streaming import state

    rows = [(k, s, dt.date(2024, 1, 1) + dt.timedelta(days=(s * 7 + k) % 23 + s // 3), f"f{(s + k) % 3}") for k in range(3) for s in range(12)]
    df = spark.createDataFrame(rows, "key long, seq long, day date, fact string")
    df.where("seq < 6").coalesce(1).write.parquet(str(tmp_path / "in"))
    df.where("seq >= 6").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    run = state.novelty_stream(stream, "key", "seq", "day", "fact").writeStream.format("memory").queryName("novelty").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    got = {(r["key"], r["seq"]): r["status"] for r in spark.table("novelty").collect()}
    expected = {(r["key"], r["seq"]): r["status"] for r in ledger.novelty(df, "key", "seq", "day", "fact").collect()}
    assert got == expected


def test_merge_by_tier_collects_no_repeats(spark):
    rows = [(k, k % 2, k, f"s{k % 3}", "a" if k < 6 else "b", "one") for k in range(9)]
    df = spark.createDataFrame(rows, "id long, tier int, pos int, source string, k1 string, k2 string")
    out = dedup.merge_by_tier(df, [F.col("k1"), F.col("k2")], "tier", "pos", "source")
    assert "collect_list" not in out._jdf.queryExecution().toString()
    assert [(r["id"], r["merged_sources"]) for r in out.collect()] == [(0, ["s1", "s2"])]


def test_chunks_equal_brute_force(spark):
    draw = random.Random(2)
    texts = ["\n".join("x" * draw.choice((0, 1, 5, 9, 30)) for _ in range(draw.randint(0, 12))) for _ in range(60)]
    expected = []
    for t in texts:
        out = []
        for part in t.split("\n"):
            if part and out and len(out[-1]) + 1 + len(part) <= 20:
                out[-1] += f"\n{part}"
            elif part:
                out.append(part)
        expected.append(out)
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    assert [r["c"] for r in df.select("id", X.chunks(F.col("t"), 20).alias("c")).orderBy("id").collect()] == expected


def test_canonical_urls_of_monitored_lists(spark):
    from gristmill.functions import urls as U

    cases = {
        "HTTP://WWW.A.com": "http://a.com",
        "https://a.com/": "https://a.com/",
        "https://a.com/x//?b=2&a=1&a=0&utm_source=q&page=3&C#f": "https://a.com/x?C=&a=1&a=0&b=2",
        "//a.com/x/": "https://a.com/x",
        "https://a.com?": "https://a.com",
        "https://a.com/?k=&j": "https://a.com/?j=&k=",
        "no address/": "no address",
        "": "",
        None: None,
    }
    got = spark.createDataFrame([(u,) for u in cases], "u string").select(U.canonical_url(F.col("u")).alias("c")).collect()
    assert [r["c"] for r in got] == list(cases.values())


def test_minutes_ago_are_recent_and_the_ratio_is_rounded(spark):
    from gristmill.functions import temporal as W

    text = "2021年3月4日, 5分钟前, 3小时前 and 2022-01-02, 90 分钟前 2023-05-06"
    m = spark.range(1).select(W.content_dates(F.lit(text), F.lit("2024-01-01 00:30:00").cast("timestamp")).alias("m")).first()["m"]
    assert (m["total"], m["historical"], m["recent"], m["ratio"], str(m["newest"])) == (6, 5, 3, 0.833, "2024-01-01")


def test_components_of_chains_stars_and_noise(spark):
    from gristmill.operators import linking

    draw = random.Random(9)
    ids = draw.sample(range(10_000), 400)
    edges = list(zip(ids[:300], ids[1:300])) + [(ids[300], x) for x in ids[301:350]] + [(ids[k], ids[k]) for k in range(5)] + [(None, 1), tuple(ids[398:])]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    got = {r["id"]: r["component"] for r in linking.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for x in up}
    assert linking.components(spark.createDataFrame([], "a long, b long")).count() == 0
