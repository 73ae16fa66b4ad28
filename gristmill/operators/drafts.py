"""Validation of report drafts against the events they are made from: issue rows (report, type, severity, detail)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions import text as X


@dataclass(frozen=True)
class DraftRules:
    """Parameters of the checks: sections by number, marks, phrases and how far around a place they are looked for."""

    required: Sequence[str]
    tracking_section: str
    action_section: str
    action_word: str
    body_sections: Sequence[str]
    core_section: str
    id_pattern: str
    number_pattern: str
    low_marks: Sequence[str]
    fallback_marks: Sequence[str]
    vague: Sequence[str]
    concrete: Sequence[str]
    most_unsourced: int = 5
    low_window: tuple[int, int] = (150, 100)
    fallback_window: tuple[int, int] = (200, 50)
    vague_window: int = 40


def places(text: Column, pattern: str) -> Column:
    """Array of (what, at, before): all places of ``pattern`` in a text, from 1, with the number of the section they lie in.

    One fold over the pieces between the places; ``before`` is the last ``## number`` that comes first.
    """
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    pairs = F.arrays_zip(F.slice(F.split(text, pattern), 1, F.greatest(F.size(found), F.lit(1))).alias("piece"), found.alias("what"))
    start = F.struct(F.lit(1).alias("at"), F.lit("").alias("section"), F.array().cast("array<struct<what:string,at:int,section:string>>").alias("out"))
    number = lambda piece, held: F.coalesce(F.nullif(F.element_at(F.concat(F.array(F.lit("")), F.regexp_extract_all(F.concat(F.lit("\n"), piece), F.lit(r"\n## (\d+)"), F.lit(1))), -1), F.lit("")), held)

    def step(acc: Column, x: Column) -> Column:
        at, section = acc["at"] + F.length(x["piece"]), number(x["piece"], acc["section"])
        return F.struct((at + F.length(x["what"])).alias("at"), section.alias("section"), F.concat(acc["out"], F.array(F.struct(x["what"].alias("what"), at.alias("at"), section.alias("section")))).alias("out"))

    return F.when(F.size(found) > 0, F.aggregate(pairs, start, step)["out"]).otherwise(F.array().cast("array<struct<what:string,at:int,section:string>>"))


def around(text: Column, at: Column, before: int, after: int) -> Column:
    """Characters of a text from ``before`` characters before a place (from 1) to ``after`` behind it."""
    begin = F.greatest(at - before, F.lit(1))
    return F.substr(text, begin, at + after - begin)


def sources_of(text: Column, pattern: str) -> Column:
    """All strings that a number written like ``pattern`` in a text bears out: it and what follows in it from any digit on."""
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    ends = F.transform(found, lambda t: F.filter(F.transform(F.sequence(F.lit(1), F.length(t)), lambda k: F.substr(t, k)), lambda s: s.rlike(r"^\d")))
    return F.array_distinct(F.flatten(ends))


def draft_issues(reports: DataFrame, events: DataFrame, r: DraftRules) -> DataFrame:
    """Issues (report, type, severity, detail) of ``reports`` (report, text) against ``events`` (report, event_id, title,
    text, priority, confidence, method, eligibility, novelty, weighted, credibility).

    Sections, ids, numbers and phrases are rows that meet events in equi-joins on the report, so that a report of many
    events is spread like others. A null text has all sections missing; events without a report are met by none.
    """
    reports = reports.select("report", X.nz(F.col("text")).alias("draft"))
    issue = lambda df, kind, severity, detail: df.select("report", F.lit(kind).alias("type"), severity.alias("severity"), detail.alias("detail"))
    high, medium, low = F.lit("high"), F.lit("medium"), F.lit("low")
    live = F.coalesce(F.col("priority") != "ARCHIVE", F.lit(True))
    followed = events.where(live & ((F.col("novelty") == "ongoing") | (F.col("eligibility") == "tracking"))).select("report").distinct().withColumn("followed", F.lit(True))
    numbers = F.regexp_extract_all(F.concat(F.lit("\n"), F.col("draft")), F.lit(r"\n## (\d+)"), F.lit(1))
    needed = F.filter(F.array(*map(F.lit, r.required)), lambda s: (s != r.tracking_section) | F.col("followed").isNotNull())
    missing = reports.join(followed, "report", "left").select("report", F.explode(F.array_except(needed, numbers)).alias("section"))
    cited = reports.select("report", F.explode(places(F.col("draft"), r.id_pattern)).alias("p"), "draft")
    cited = cited.select("report", F.col("p.what").alias("event_id"), F.col("p.section").alias("section"), around(F.col("draft"), F.col("p.at"), *r.low_window).alias("near_low"), around(F.col("draft"), F.col("p.at"), *r.fallback_window).alias("near_rule"))
    known = cited.join(events, ["report", "event_id"])
    named = reports.select("report", F.explode(F.regexp_extract_all("draft", F.lit(f"({r.number_pattern})"), F.lit(1))).alias("number"))
    sourced = events.select("report", F.explode(sources_of(F.col("text"), r.number_pattern)).alias("number")).distinct()
    unsourced = named.join(sourced, ["report", "number"], "left_anti").groupBy("report").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > r.most_unsourced)
    section = F.get(F.filter(F.split(F.concat(F.lit("\n"), F.col("draft")), r"\n## "), lambda s: s.startswith(r.action_section)), F.lit(0))
    actions = F.size(F.filter(F.split(section, "\n"), lambda s: F.ltrim(s).startswith("-") & s.contains(r.action_word)))
    marked = lambda column, marks: F.max(X.any_keyword(F.col(column), marks).cast("int")) == 1
    facts = ["priority", "confidence", "method", "weighted", "credibility"]
    by_event = known.groupBy("report", "event_id", *facts).agg(marked("near_low", r.low_marks).alias("low"), marked("near_rule", r.fallback_marks).alias("rule"))
    strong = F.coalesce((F.col("priority") == "P1") | ((F.col("weighted") >= 3.5) & (F.col("credibility") >= 3)), F.lit(False))
    in_body = known.where(F.col("section").isin(*r.body_sections) & (F.col("eligibility") == "tracking") & live).select("report", "event_id").distinct()
    core = known.where(F.col("section") == r.core_section).select("report", "event_id", "novelty", "eligibility").distinct()
    phrases = reports.select("report", F.explode(places(F.col("draft"), "|".join(f"\\Q{p}\\E" for p in r.vague))).alias("p"), "draft")
    width = F.lit(r.vague_window) + F.length("p.what")
    begin = F.greatest(F.col("p.at") - r.vague_window, F.lit(1))
    empty = phrases.where(~X.any_keyword(F.substr("draft", begin, F.col("p.at") + width - begin), r.concrete)).select("report", F.col("p.what").alias("phrase")).distinct()
    found = [
        issue(missing, "missing_section", high, F.col("section")),
        issue(reports.join(cited.select("report").distinct(), "report", "left_anti"), "missing_event_id", high, F.lit("")),
        issue(cited.select("report", "event_id").distinct().join(events.select("report", "event_id"), ["report", "event_id"], "left_anti"), "invalid_event_id", high, F.col("event_id")),
        issue(unsourced, "unsupported_claim", medium, F.col("n").cast("string")),
        issue(reports.where(actions > 1), "invalid_unique_action", high, actions.cast("string")),
        issue(by_event.where((F.col("confidence") == "low") & ~F.col("low")), "low_confidence_strong_claim", F.when(strong, "low").otherwise("medium"), F.col("event_id")),
        issue(by_event.where((F.col("method") == "rule_fallback") & ~F.col("rule")), "rule_fallback_strong_claim", medium, F.col("event_id")),
        issue(in_body, "tracking_in_core_signal", medium, F.col("event_id")),
        issue(core.where("novelty = 'repeated'"), "repeated_in_core_signal", high, F.col("event_id")),
        issue(core.where("eligibility = 'archive'"), "background_in_core_signal", medium, F.col("event_id")),
        issue(empty, "vague_action", low, F.col("phrase")),
    ]
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out


def verdicts(reports: DataFrame, issues: DataFrame, most_medium: int = 3) -> DataFrame:
    """For each report how many issues of each severity it has, and whether it may be sent: none high, few medium."""
    n = issues.groupBy("report").agg(*[F.count_if(F.col("severity") == s).alias(s) for s in ("high", "medium", "low")])
    zero = [F.coalesce(s, F.lit(0)).alias(s) for s in ("high", "medium", "low")]
    out = reports.select("report").join(n, "report", "left").select("report", *zero)
    return out.withColumn("sendable", (F.col("high") == 0) & (F.col("medium") <= most_medium))
