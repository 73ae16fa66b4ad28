"""Dates, freshness, ladders and greedy operators on hand-made rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gristmill.functions import temporal as W
from gristmill.functions import text as X
from gristmill.functions import urls as U
from gristmill.operators import dedup, ladders, reports

NOW = "2026-08-09 12:00:00"
CAMPAIGNS = {"618": (6, 18), "双11": (11, 11)}


def as_of():
    return F.lit(NOW).cast("timestamp")


def one(spark, *columns):
    row = spark.range(1).select(*[c.alias(f"c{k}") for k, c in enumerate(columns)]).first()
    return row[0] if len(columns) == 1 else tuple(row)


def freshness(spark, title="Title of it", fact="", content="", occurred=None, effective=None, ledger=None, published="2026-08-09"):
    """The status and eligibility of an event whose article says ``content``."""
    day = lambda x: F.lit(x).cast("date")
    text = F.lit(f"{title} {content}")
    dates = W.content_dates(text, as_of(), CAMPAIGNS)
    known = ledger or {}
    e = {
        "sanity": W.sanity(F.lit(published).cast("timestamp"), F.lit("json_ld"), as_of())["status"],
        "effective": day(effective),
        "occurred": F.coalesce(day(occurred), dates["newest"]),
        "title": F.lit(title),
        "fact": F.lit(fact),
        "fact_hash": X.fact_hash(F.lit(fact)),
        "ratio": dates["ratio"],
        "recent": dates["recent"],
        "known": F.lit(ledger is not None),
        "known_hash": X.fact_hash(F.lit(known.get("fact"))) if ledger else F.lit(None).cast("string"),
        "known_title": F.lit(known.get("title")).cast("string"),
        "first_seen": day(known.get("first_seen")),
    }
    return tuple(one(spark, W.fact_freshness(e, as_of(), high_value=("政策",))))


@pytest.mark.parametrize(
    ("case", "expected"),
    [
        ({"fact": "2026年8月9日在多地试点", "content": "今天宣布。2026年8月9日试点。", "occurred": "2026-08-09"}, ("new_fact", "core")),
        ({"title": "去年数据汇总", "fact": "2025年销售数据公布", "content": "2025年11月11日", "occurred": "2025-11-11", "ledger": {"fact": "2025年销售数据公布", "title": "去年数据汇总", "first_seen": "2025-11-12"}}, ("republished_old_fact", "reject")),
        ({"title": "2025年大事回顾复盘", "fact": "复盘多起事件", "content": "2025年3月A，2025年6月B，2025年11月C，2025年12月D。"}, ("retrospective_summary", "reference")),
        ({"title": "去年市场规模", "fact": "约1.5万亿", "content": "2025年规模。2026年8月9日公布。", "occurred": "2025-12-31"}, ("historical_background", "reference")),
        ({"fact": "起执行新规", "content": "今天宣布，2026年8月15日起执行。", "occurred": "2026-08-09", "effective": "2026-08-15"}, ("upcoming_fact", "core")),
        ({"published": "2026-08-16"}, ("date_conflict", "reject")),
        ({"content": "今年618，各平台公布新规则。"}, ("historical_background", "reference")),
        ({"content": "2025年11月11日落幕。战报汇总。", "title": "战报", "fact": "战报汇总", "ledger": {"fact": "战报汇总", "title": "战报", "first_seen": "2025-11-12"}}, ("republished_old_fact", "reject")),
        ({"fact": "同一事实", "title": "题", "ledger": {"fact": "同一事实", "title": "题", "first_seen": "2026-08-08"}}, ("ongoing_fact", "tracking")),
        ({"fact": "另一事实", "title": "题", "ledger": {"fact": "同一事实", "title": "题", "first_seen": "2026-08-08"}}, ("updated_fact", "core")),
        ({"fact": "首次开放", "title": "题", "ledger": {"fact": "首次开放", "title": "题", "first_seen": "2025-08-08"}}, ("updated_fact", "core")),
        ({"occurred": "2026-07-20"}, ("ongoing_fact", "tracking")),
        ({}, ("unknown_fact_time", "reference")),
        ({"fact": "政策"}, ("unknown_fact_time", "review")),
    ],
)
def test_fact_freshness(spark, case, expected):
    assert freshness(spark, **case) == expected


def test_content_dates_are_counted_by_kind(spark):
    got = one(spark, W.content_dates(F.lit("今年618新规则。2025年3月、2026年8月9日、2026-08-01、昨天、3天前、2小时前、2024年2月31日"), as_of(), CAMPAIGNS))
    assert (got["total"], got["historical"], got["recent"], str(got["oldest"]), str(got["newest"])) == (7, 1, 4, "2025-03-01", "2026-08-09")
    empty = one(spark, W.content_dates(F.lit(None).cast("string"), as_of()))
    assert (empty["total"], empty["ratio"], empty["oldest"]) == (0, 0.0, None)


@pytest.mark.parametrize(("url", "title", "kind"), [("https://e.com/tags/x", "x", "tag_page"), ("https://e.com/category/b", "", "category_page"), ("https://e.com/search?q=x", "", "search_page"), ("https://e.com/list/1", "", "listing_page"), ("https://e.com/a", "首页", "homepage"), ("https://e.com/a", "x", "article_page")])
def test_page_kind(spark, url, title, kind):
    assert one(spark, W.page_kind(F.lit(url), F.lit(title), F.lit("w " * 150))) == kind


@pytest.mark.parametrize(
    ("published", "url", "summary", "day", "origin"),
    [
        ("2026-08-01", "http://e/2026/08/03/x", "", "2026-08-01", "published"),
        ("2026-08-01", "http://e/2026/01/03/x", "", "2026-01-03", "url_conflict"),
        (None, "http://e/x", "2026年7月5日 — text", "2026-07-05", "text"),
        (None, "http://e/20260102", "3 天前 — text", "2026-08-06", "relative"),
        (None, "http://e/20260102", "13小时前", "2026-08-08", "relative"),
        (None, "http://e/x", "昨天 — text", "2026-08-08", "word"),
        (None, "http://e/20260102", "text", "2026-01-02", "url"),
        (None, "http://e/x", None, None, None),
    ],
)
def test_resolve_date(spark, published, url, summary, day, origin):
    s = lambda x: F.lit(x).cast("string")
    got = one(spark, W.resolve_date(s(published), s(url), s(None), s(summary), s(None), as_of()))
    assert (got and (str(got["day"]), got["origin"])) == (day and (day, origin))


@pytest.mark.parametrize(("now", "expected"), [("2026-12-25", "current_campaign"), ("2026-01-05", "current_campaign"), ("2026-06-01", "upcoming_campaign")])
def test_campaign_across_the_new_year(spark, now, expected):
    a = {"text": F.lit("winter 2026"), "time": F.lit("old"), "published": F.lit(None).cast("date")}
    assert one(spark, W.campaign(a, {"w": ("winter",)}, {"w": (12, 1, 1, 10)}, F.lit(now).cast("timestamp")))["temporality"] == expected


@pytest.mark.parametrize(("text", "time", "expected"), [("sale 2026", "old", "retrospective"), ("sale 2025", "old", "retrospective"), ("sale 2024", "old", "historical_campaign"), ("sale 2027", "old", "upcoming_campaign"), ("sale", "old", "unknown_campaign_time"), ("sale", "in_window", "retrospective"), ("none", "old", "not_campaign")])
def test_campaign_years(spark, text, time, expected):
    a = {"text": F.lit(text), "time": F.lit(time), "published": F.lit(None).cast("date")}
    assert one(spark, W.campaign(a, {"s": ("sale",)}, {"s": (7, 1, 7, 20)}, as_of()))["temporality"] == expected
    assert one(spark, W.seasonal_mismatch(F.lit("sale"), as_of(), {"sale": (6, 7)})) is True


@pytest.mark.parametrize(("n", "before", "days", "sources", "expected"), [(5, None, 3, 3, "emerging"), (5, None, 2, 3, "unclear"), (6, 4, 3, 3, "accelerating"), (6, 4, 3, 2, "unclear"), (2, 4, 1, 1, "weakening"), (5, 4, 1, 1, "stable"), (10, 12, 1, 1, "stable"), (7, 12, 1, 1, "unclear")])
def test_trend(spark, n, before, days, sources, expected):
    assert one(spark, reports.trend(F.lit(n), F.lit(before).cast("int"), F.lit(days), F.lit(sources))) == expected


def test_like_before_takes_any_of_three_tests(spark):
    schema = "id int, key string, entities array<string>, actions array<string>, title string"
    now = spark.createDataFrame([(1, "k1", ["a", "b"], ["x"], "the quick brown fox"), (2, "k2", [], [], "quite another long title here now"), (3, "", ["c"], ["y"], "")], schema)
    old = spark.createDataFrame([(7, "k1", [], [], "nothing"), (8, "kk", ["b", "a"], ["x", "z"], "nope"), (9, "k9", [], [], "The quick, brown fox!"), (10, "", ["c"], ["n"], "zzz"), (11, "q", [], [], "quite another long titles here now")], schema)
    assert sorted(map(tuple, reports.like_before(now, old).collect())) == [("1", "7"), ("1", "8"), ("1", "9"), ("2", "11")]


@pytest.mark.parametrize(("args", "expected"), [((0.3, 0.0, 0.1, 0), "A"), ((0.3, 0.0, 0.05, 0), "B"), ((0.1, 0.8, 0.0, 1), "C"), ((0.1, 0.8, 0.0, 0), "D"), ((0.1, 0.5, 0.0, 0), "C"), ((0.1, 0.2, 0.0, 0), "B")])
def test_source_grade(spark, args, expected):
    assert one(spark, reports.source_grade(*map(F.lit, args))) == expected


@pytest.mark.parametrize(("args", "expected"), [((False, 9, 9, 0.0), "D"), ((True, 5, 5, 0.8), "A"), ((True, 4, 4, 0.0), "B"), ((True, 5, 5, 0.9), "C"), ((True, 6, 2, 0.1), "A")])
def test_route_grade(spark, args, expected):
    assert one(spark, reports.route_grade(*map(F.lit, args))) == expected


def test_keys(spark):
    names = F.array(*map(F.lit, ("b", "a", "b")))
    assert one(spark, X.cluster_key(F.lit("t"), F.lit("2026年8月9日 Big News 3.5%!"), names)) == "t:bignews:a|b"
    long_ = F.array(*[F.lit(f"{k}" * 60) for k in range(5)])
    assert one(spark, F.length(X.cluster_key(F.lit("t"), F.lit("x"), long_))) == len("t:x:") + 12
    assert one(spark, X.period_key(F.array(F.lit("p")), F.array(F.lit("c2"), F.lit("c1")), F.lit("t"), F.array().cast("array<string>"))) == "p|c1|c2|t"
    assert one(spark, X.title_similarity(F.lit("a b c"), F.lit("ABC!"))) == 1.0
    assert one(spark, X.mark_near(F.lit("x" * 300 + "E1 sure" + "y" * 300 + "mark"), F.lit("E1"), ("mark",))) is False
    assert one(spark, X.mark_near(F.lit("a mark at E1"), F.lit("E1"), ("mark",))) is True
    assert one(spark, X.mark_near(F.lit("nothing"), F.lit("E1"), ("mark",))) is True


def test_orality(spark):
    score = lambda t: one(spark, X.orality(F.lit(t), ("因此",), ("吧",)))
    assert score("我们我们你说吧。") == 100
    assert score("因此。因此。你们看看我们") == 90
    assert score("短句。") == 85
    assert score("你你我们" + "长" * 45) == 80


def test_links(spark):
    html = '<a href="/a?x=1">One <b>two</b></a><a class=c href="http://o.e/b">Three</a><a href="#t">Top</a><a href="/p.pdf">File</a>'
    got = one(spark, U.links(F.lit(html), F.lit("https://h.e/x"), least_title=4, exclude=r"\.pdf$"))
    assert [tuple(x) for x in got] == [("https://h.e/a?x=1", "One two"), ("http://o.e/b", "Three")]


def brute_greedy(rows, least):
    """The greedy removal as a double loop."""
    gone = {}
    for i, (a, title, entities, rich) in enumerate(rows):
        if a in gone:
            continue
        for b, title_b, entities_b, rich_b in rows[i + 1 :]:
            if b in gone:
                continue
            x, y = set(title), set(title_b)
            if not x or not y or len(x & y) / len(x | y) < least or (entities and entities_b and not set(entities) & set(entities_b)):
                continue
            gone[a if rich_b > rich else b] = b if rich_b > rich else a
    return gone


def test_greedy_removal_equals_brute_force(spark):
    draw = random.Random(3)
    rows = [(k, "".join(draw.choices("abcdefgh", k=draw.randint(0, 6))), draw.sample(["p", "q", "r"], draw.randint(0, 2)), float(draw.randint(0, 4))) for k in range(60)]
    df = spark.createDataFrame(rows, "id long, title string, entities array<string>, rich double")
    pairs = dedup.greedy_pairs(df, "id", "title", "entities", "rich", 0.55, letters="([a-z])")
    assert {r["absorbed"]: r["kept"] for r in dedup.fold_pairs(pairs).collect()} == brute_greedy(rows, 0.55)


def test_pool_decision_guards_come_in_order(spark):
    rules = ladders.ArticleRules(junk=("junk",), farms=("farm.e",))
    base = {"url": "http://e/x", "title": "t", "summary": "s", "published": "2026-08-09", "page": "news", "place": "mainland", "retro": "none", "core": "", "score": 7, "decision": "keep", "time": "in_window", "freshness": "", "source_type": "feed", "collector": "reader", "keywords": 1, "campaign": "not_campaign", "mismatch": False, "reviewed": None}

    def decide(**changes):
        a = {k: F.lit(v) for k, v in (base | changes).items()}
        a["published"], a["reviewed"] = a["published"].cast("date"), a["reviewed"].cast("string")
        return tuple(one(spark, ladders.pool_decision(a, rules, as_of())))

    assert decide() == ("main", "rule_keep")
    assert decide(page="unknown") == ("reference", "rule_keep")
    assert decide(url="", place="hk") == ("reject", "region")
    assert decide(url="http://farm.e/1") == ("reject", "content_farm")
    assert decide(published="2026-08-11") == ("reject", "future_date")
    assert decide(time="old") == ("reject", "old")
    assert decide(retro="weak", page="job") == ("reject", "retrospective_weak")
    assert decide(freshness="newly_discovered", score=4, core="x") == ("main", "newly_discovered")
    assert decide(reviewed="reject", score=7) == ("reference", "reviewed")
    assert decide(decision="review", score=4, keywords=0) == ("reject", "no_keywords")
    assert decide(decision="reject", score=0) == ("reference", "kept_in_window")
    assert decide(decision="reject", score=0, time="x") == ("reject", "low_score")


def test_downgrade_exits_before_caps(spark):
    r = ladders.EventRules(stock_strong=("###",))
    base = {"url": "u", "fact": "f", "title": "t", "text": "t", "evidence": "e", "freshness": "new_fact", "eligibility": "", "confidence": "high", "method": "llm", "kind": "k", "weighted": 4.0, "credibility": 3, "relevance": 4, "richness": 3}

    def down(priority="P0", **changes):
        got = one(spark, ladders.downgrade(F.lit(priority), {k: F.lit(v) for k, v in (base | changes).items()}, r))
        return got["priority"], got["reasons"]

    assert down() == ("P0", [])
    assert down(kind="unclear", evidence="") == ("P2", ["unclear", "no_evidence"])
    assert down(priority="P2", kind="unclear") == ("P2", [])
    assert down(fact=" ", text="###") == ("ARCHIVE", ["no_fact"])
    assert down(relevance=1, kind="unclear") == ("ARCHIVE", ["irrelevant"])
    assert down(confidence="low") == ("P0", []) and down(confidence="low", weighted=3.0) == ("P2", ["low_confidence"])


def test_margin_status(spark):
    at = lambda s: F.lit(s).cast("timestamp")
    start, end = at("2026-08-08 12:00:00"), at(NOW)
    got = one(spark, *[W.margin_status(at(t), start, end, 12, "old") for t in ("2026-08-09 12:00:00", "2026-08-09 20:00:00", "2026-08-11 00:00:00", "2026-08-08 01:00:00", "2026-08-07 00:00:00", None)])
    assert got == ("in_window", "near_window", "old", "near_window", "old", "unknown_time")
    assert dt.date(2026, 8, 9) == one(spark, W.relative_date(F.lit("5 minutes ago"), as_of()))
