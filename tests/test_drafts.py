"""Draft checks on hand-made reports."""

import re

import pytest
from pyspark.sql import functions as F

from gristmill.operators import drafts

RULES = drafts.DraftRules(("1", "2", "11"), "11", "8", "act", ("2",), "2", r"E\d\d", r"\d+[.\d]*%", ("(low)",), ("(rule)",), ("so (what)",), ("orders",), 1, (10, 12), (10, 12), 5)
EVENTS = "report string, event_id string, text string, priority string, confidence string, method string, eligibility string, novelty string, weighted double, credibility int"


def issues(spark, text, *events):
    rows = [("r", e, said, *rest) for e, said, *rest in events]
    found = drafts.draft_issues(spark.createDataFrame([("r", text)], "report string, text string"), spark.createDataFrame(rows, EVENTS), RULES)
    return sorted((r["type"], r["severity"], r["detail"]) for r in found.collect())


def test_places_have_their_section(spark):
    text = "E01 a\n## 2 b\nE02E03 平台 E04\n## no\n## 11\nE05"
    got = spark.createDataFrame([(text,), ("none",), ("",)], "t string").select(drafts.places(F.col("t"), r"E\d\d").alias("p")).collect()
    expected = [(m[0], m.start() + 1, s) for m, s in zip(re.finditer(r"E\d\d", text), ["", "2", "2", "2", "11"], strict=True)]
    assert [tuple(x) for x in got[0]["p"]] == expected and got[1]["p"] == got[2]["p"] == []


def test_numbers_are_borne_out_by_longer_ones(spark):
    got = spark.range(1).select(drafts.sources_of(F.lit("up 12.5% and 7%"), r"\d+[.\d]*%").alias("s")).first()["s"]
    assert sorted(got) == ["12.5%", "2.5%", "5%", "7%"]


def test_a_clean_report_has_no_issues(spark):
    text = "## 1 a\n## 2 b\nE01 up 5%\n## 11 c\nE02 (low)"
    events = [("E01", "up 15%", "P1", "high", "llm", "core", "new_today", 4.0, 5), ("E02", "", "P2", "low", "llm", "tracking", "ongoing", 1.0, 1)]
    assert issues(spark, text, *events) == []


def test_every_check_finds_its_case(spark):
    text = "## 2 b\nE01" + "." * 30 + "E02" + "." * 30 + "E09 3% 4% so (what)" + "." * 20 + "so (what) orders\n## 8 d\n- act\n - act\n"
    events = [("E01", "", "P1", "low", "rule_fallback", "tracking", "repeated", 1.0, 1), ("E02", "", "P2", "low", "llm", "archive", "new_today", 3.5, 2), ("E03", "", "ARCHIVE", None, None, None, None, None, None)]
    assert issues(spark, text, *events) == [
        ("background_in_core_signal", "medium", "E02"),
        ("invalid_event_id", "high", "E09"),
        ("invalid_unique_action", "high", "2"),
        ("low_confidence_strong_claim", "low", "E01"),
        ("low_confidence_strong_claim", "medium", "E02"),
        ("missing_section", "high", "1"),
        ("missing_section", "high", "11"),
        ("repeated_in_core_signal", "high", "E01"),
        ("rule_fallback_strong_claim", "medium", "E01"),
        ("tracking_in_core_signal", "medium", "E01"),
        ("unsupported_claim", "medium", "2"),
        ("vague_action", "low", "so (what)"),
    ]


@pytest.mark.parametrize("text", [None, "", "plain"])
def test_texts_without_anything(spark, text):
    got = issues(spark, text, ("E01", "", None, None, None, None, None, None, None))
    assert got == [("missing_event_id", "high", ""), ("missing_section", "high", "1"), ("missing_section", "high", "2")]
