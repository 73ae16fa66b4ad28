"""Ladders of ordered rules over articles and events. Lexicons, maps and thresholds are parameters; nothing reads the clock.

Each function takes columns and returns a column, so that a whole ladder is one projection inside the scan's stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions import text as X
from gristmill.functions import urls as U
from gristmill.operators import scoring

Words = Sequence[str]


def hits(text: Column | X.Lowered, words: Words) -> Column:
    """How many of ``words`` a text holds, each counted once, whatever the case."""
    low = X.lowered(text)
    return sum((F.when(low.contains(str(w).lower()), 1).otherwise(0) for w in words), F.lit(0))


def has(text: Column | X.Lowered, words: Words) -> Column:
    return X.any_keyword(text, words)


# --- articles ------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class ArticleRules:
    """Lexicons of the article ladder."""

    social_domains: Words = ()
    product_urls: Words = ()
    review_words: Words = ()
    homepage_domains: Words = ()
    promotion: Words = ()
    promotion_titles: Words = ()
    jobs: Words = ()
    notices: Words = ()
    reports: Words = ()
    news_domains: Words = ()
    news_urls: Words = (r"/news/", r"/article/", r"/detail/", r"/post/", r"/\d{4}/\d{2}/", r"/\d{4}-\d{2}-\d{2}")
    articles: Words = ()
    near_hosts: Words = ()
    near_hosts_2: Words = ()
    far_suffixes: Words = ()
    home_strong: Words = ()
    near_strong: Words = ()
    near_moderate: Words = ()
    home_words: Words = ()
    local_letters: str = r"\p{L}"
    retro_title_strong: Words = ()
    retro_title_weak: Words = ()
    retro_body: Words = ()
    core: Mapping[str, Words] = field(default_factory=dict)
    weighed: str = "category"
    strong_words: Words = ()
    context_words: Words = ()
    farms: Words = ()
    farm_suffixes: Words = ()
    junk: Words = ()
    blocked_pages: Words = ("product_page", "homepage", "social_post", "promotion", "job", "unknown")
    rejected_pages: Words = ("social_post", "homepage", "job")


def domain(url: Column) -> Column:
    """Host without www."""
    return F.regexp_replace(U.url_part(F.lower(X.nz(url)), "host"), r"^www\.", "")


def page_type(url: Column, title: Column, summary: Column, content: Column, rules: ArticleRules) -> Column:
    """One of ten kinds of page: social, product, homepage, promotion (3 points), job, notice, report, news, article by
    its words, else article if both address and text are long, else unknown."""
    low = F.lower(F.trim(X.nz(url)))
    host, path = domain(url), U.url_part(low, "path")
    title = F.lower(X.nz(title))
    body = F.concat_ws(" ", title, F.lower(X.nz(summary)), F.lower(F.substring(X.nz(content), 1, 500)))
    any_of = lambda c, patterns: F.lit(False) if not patterns else c.rlike("|".join(f"(?:{p})" for p in patterns))
    holds = lambda c, words: sum((F.when(c.contains(w), 1).otherwise(0) for w in words), F.lit(0)) > 0
    promoted = hits(body, rules.promotion) + 2 * hits(title, rules.promotion_titles)
    return (
        F.when(holds(host, rules.social_domains), "social_post")
        .when(any_of(low, rules.product_urls), F.when(has(body, rules.review_words), "article").otherwise("product_page"))
        .when(host.isin(*rules.homepage_domains) & path.isin("", "/", "/index.html", "/index.htm"), "homepage")
        .when(promoted >= 3, "promotion")
        .when(has(body, rules.jobs), "job")
        .when(any_of(title, rules.notices), "official_notice")
        .when(any_of(title, rules.reports), "report")
        .when(holds(host, rules.news_domains) & (path != "") & (path != "/"), "news")
        .when(any_of(low, rules.news_urls), "news")
        .when(any_of(title, rules.articles), "article")
        .when((F.length(low) > 40) & (F.length(body) > 100), "article")
        .otherwise("unknown")
    )


def region(url: Column, title: Column, summary: Column, content: Column, rules: ArticleRules) -> Column:
    """Where an article is at home: by host, far suffix, strong words, words of the title or summary, home words, letters."""
    low = F.lower(X.nz(url))
    title, summary = F.lower(X.nz(title)), F.lower(X.nz(summary))
    body = F.concat_ws(" ", title, summary, F.lower(F.substring(X.nz(content), 1, 500)))
    host = U.url_part(low, "host")
    ends = F.lit(False)
    for suffix in rules.far_suffixes:
        ends = ends | host.endswith(suffix)
    return (
        F.when(has(low, rules.near_hosts), "hk")
        .when(has(low, rules.near_hosts_2), "tw")
        .when(ends, "overseas")
        .when(has(body, rules.near_strong), "hk")
        .when(has(title, rules.near_moderate) | has(F.substring(summary, 1, 200), rules.near_moderate), "hk")
        .when(has(body, rules.home_words), "mainland")
        .when(body.rlike(rules.local_letters), "mainland")
        .otherwise("unknown")
    )


def noise_flags(page: Column, place: Column, title: Column, summary: Column, rules: ArticleRules) -> Column:
    """Labels of what speaks against an article."""
    body = F.concat_ws(" ", F.lower(X.nz(title)), F.lower(X.nz(summary)))
    flags = [
        F.when(page.isin(*rules.blocked_pages), F.concat(F.lit("page_type:"), page)),
        F.when(place.isin("hk", "tw"), F.concat(F.lit("region:"), place)),
        F.when(hits(body, rules.promotion_titles) >= 2, "promo_title"),
        F.when((F.length(F.trim(X.nz(summary))) < 20) & (F.length(F.trim(X.nz(title))) < 15), "thin_content"),
    ]
    return F.array_compact(F.array(*flags))


def retrospective(title: Column, summary: Column, content: Column, rules: ArticleRules) -> Column:
    """``strong`` or ``weak`` by the title, ``weak`` by the first 500 characters of the body, else ``none``."""
    body = F.concat_ws(" ", X.nz(summary), F.substring(X.nz(content), 1, 500))
    return F.when(has(title, rules.retro_title_strong), "strong").when(has(title, rules.retro_title_weak) | has(body, rules.retro_body), "weak").otherwise("none")


def core_hit(title: Column, summary: Column, content: Column, rules: ArticleRules) -> Column:
    """The first kind of ``rules.core`` that title, summary or the first 1,000 characters name, or an empty string.

    The weighed kind needs a strong word, two hits, or one beside a context word.
    """
    body = F.concat_ws(" ", X.nz(title), X.nz(summary), F.substring(X.nz(content), 1, 1000))
    out = F.lit("")
    for kind, words in reversed(list(rules.core.items())):
        met = has(body, words)
        if kind == rules.weighed:
            strong = [w for w in words if w in rules.strong_words]
            met = has(body, strong) | (hits(body, words) >= 2) | (met & has(body, rules.context_words))
        out = F.when(met, kind).otherwise(out)
    return out


def pool_decision(a: Mapping[str, Column], rules: ArticleRules, as_of: Column) -> Column:
    """struct(pool, reason) of an article by ordered guards; what is blocked as noise is lowered by one pool afterwards.

    ``a`` names url, title, summary, published (date), page, place, retro, core (kind or empty), score, decision, time,
    freshness, source_type, collector, keywords (count), campaign, mismatch (boolean), and reviewed (the pool that a
    review recommends, or null).
    """
    score, core, time, fresh = a["score"], a["core"] != "", a["time"], a["freshness"]
    blocked = a["page"].isin(*rules.blocked_pages)
    host = domain(a["url"])
    farm = host.isin(*rules.farms) if rules.farms else F.lit(False)
    for suffix in rules.farm_suffixes:
        farm = farm | host.endswith(suffix)
    text = F.concat_ws(" ", X.nz(a["title"]), X.nz(a["summary"]))
    search = a["source_type"].isin("xcrawl", "tavily", "search", "gap")
    windows = time.isin("in_window", "near_window")
    some = core | (a["keywords"] > 0)
    # (condition, pool, reason, whether noise lowers it)
    guards = [
        (a["place"].isin("hk", "tw", "overseas"), "reject", "region", False),
        (F.trim(X.nz(a["url"])) == "", "reject", "no_url", False),
        (F.trim(X.nz(a["title"])) == "", "reject", "no_title", False),
        (a["published"] > F.date_add(as_of.cast("date"), 1), "reject", "future_date", False),
        (farm, "reject", "content_farm", False),
        (a["mismatch"], "reject", "seasonal_mismatch", False),
        (has(text, rules.junk) & (score <= 1), "reject", "junk", False),
        (a["campaign"] == "historical_campaign", "reject", "historical_campaign", False),
        ((a["campaign"] == "unknown_campaign_time") & time.isin("unknown_time", "old"), "reject", "unknown_campaign", False),
        (a["campaign"] == "unknown_campaign_time", "reference", "unknown_campaign", False),
        (time == "old", "reject", "old", False),
        ((a["retro"] == "strong") & core & (score >= 5), "reference", "retrospective_strong", True),
        (a["retro"] == "strong", "reject", "retrospective_strong", False),
        (a["retro"] == "weak", "reference", "retrospective_weak", True),
        ((fresh == "bootstrap_seen") & ((core & (score >= 5)) | (score >= 6)), "reference", "bootstrap_seen", True),
        ((fresh == "bootstrap_seen") & (score >= 3), "reference", "bootstrap_seen", False),
        (fresh == "bootstrap_seen", "reject", "bootstrap_seen", False),
        ((fresh == "newly_discovered") & core & (score >= 4), "main", "newly_discovered", True),
        ((fresh == "newly_discovered") & (score >= 5), "reference", "newly_discovered", True),
        ((fresh == "newly_discovered") & (time == "unknown_time") & (core | ((score >= 2) & (a["keywords"] >= 2))), "reference", "newly_discovered", True),
        ((fresh == "newly_discovered") & (time == "unknown_time"), "reject", "newly_discovered", False),
        ((fresh == "newly_discovered") & (score >= 3), "reference", "newly_discovered", True),
        (fresh == "newly_discovered", "reject", "newly_discovered", False),
        ((fresh == "week_fallback") & core & (score >= 5), "main", "week_fallback", True),
        ((fresh == "week_fallback") & (score >= 3) & some, "reference", "week_fallback", True),
        (fresh == "week_fallback", "reject", "week_fallback", False),
        ((fresh == "day_primary") & ((score >= 6) | (core & (score >= 4))), "main", "day_primary", True),
        ((time == "uncertain_date") & core & ((score >= 5) | ((score >= 3) & (a["collector"] == "browser"))), "main", "uncertain_date", True),
        ((time == "uncertain_date") & (core | (score >= 4)), "reference", "uncertain_date", True),
        (time == "uncertain_date", "reject", "uncertain_date", False),
        ((time == "unknown_time") & (core | (search & (((a["keywords"] >= 3) & (score >= 3)) | (score >= 5)))), "reference", "unknown_time", True),
        (time == "unknown_time", "reject", "unknown_time", False),
        ((a["reviewed"] == "main") & (score >= 3), "main", "reviewed", True),
        (a["reviewed"] == "reference", "reference", "reviewed", True),
        ((a["reviewed"] == "reject") & (score >= 6), "reference", "reviewed", True),
        (a["reviewed"] == "reject", "reject", "reviewed", False),
        (a["decision"] == "keep", "main", "rule_keep", True),
        ((a["decision"] == "review") & core & (score >= 4) & (time == "in_window"), "main", "rule_review", True),
        ((a["decision"] == "review") & ~some, "reject", "no_keywords", False),
        ((a["decision"] == "review") & (score >= 5) & (time == "in_window"), "main", "rule_review", True),
        (a["decision"] == "review", "reference", "rule_review", True),
        (windows & (score >= 0) & some, "reference", "kept_in_window", True),
    ]
    make = lambda pool, reason: F.struct(pool.alias("pool"), F.lit(reason).alias("reason"))
    lowered = {"main": F.when(blocked, "reference").otherwise("main"), "reference": F.when(a["page"].isin(*rules.rejected_pages), "reject").otherwise("reference")}
    out = make(F.lit("reject"), "low_score")
    for condition, pool, reason, noisy in reversed(guards):
        out = F.when(F.coalesce(condition, F.lit(False)), make(lowered[pool] if noisy else F.lit(pool), reason)).otherwise(out)
    return out


# --- event dimensions ----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class EventRules:
    """Lexicons and maps of the event dimensions."""

    importance: Mapping[str, int] = field(default_factory=dict)
    strategic: Words = ()
    direct: Words = ()
    channel: Words = ()
    competitor: Words = ()
    category: Words = ()
    generic: Words = ()
    national: Words = ()
    multi: Words = ()
    single: Words = ()
    typical: Words = ("platform_rule", "platform_move", "policy_change")
    minor: Words = ("marketing",)
    source_tiers: Mapping[str, int] = field(default_factory=dict)
    domain_tiers: Mapping[str, int] = field(default_factory=dict)
    data: Words = ()
    high_value: Words = ()
    direction: Words = ()
    opinion: Words = ()
    data_value: str = r"\d+(?:\.\d+)?\s*%"
    variables: Mapping[str, int] = field(default_factory=dict)
    direct_types: Words = ("platform_rule", "policy_change", "data_signal")
    type_action: Mapping[str, int] = field(default_factory=dict)
    sensitivity: Mapping[str, int] = field(default_factory=lambda: {"today": 5, "recent": 4, "background": 2, "old_background": 1})
    novelty: Mapping[str, int] = field(default_factory=lambda: {"new": 5, "follow_up": 3, "unclear": 3, "old_background": 1})
    stock_strong: Words = ()
    stock: Words = ()
    business: Words = ()
    finance: Words = ()
    action: Words = ()
    abroad: Words = ()
    home: Words = ()
    market_scale: Words = ()
    market: Words = ()


def importance(kind: Column, title: Column, fact: Column, r: EventRules, low: X.Lowered | None = None) -> Column:
    """By type, one more for a strategic word, at most 5."""
    base = scoring.lookup(kind, dict(r.importance), 1)
    raised = F.when(has(low or F.concat_ws(" ", X.nz(title), X.nz(fact)), r.strategic), F.least(base + 1, F.lit(5))).otherwise(base)
    return F.least(F.greatest(raised, F.lit(0)), F.lit(5))


def relevance(text: Column | X.Lowered, r: EventRules) -> Column:
    """5 for a direct name, 4 for a channel, 3 for a competitor, 2 for general words of the trade, 1 for the category, else 0."""
    return F.when(has(text, r.direct), 5).when(has(text, r.channel), 4).when(has(text, r.competitor), 3).when(has(text, r.generic), 2).when(has(text, r.category), 1).otherwise(0)


def impact_scope(text: Column | X.Lowered, platforms: Column, competitors: Column, kind: Column, r: EventRules) -> Column:
    """``platforms`` and ``competitors`` are how many an event names."""
    return (
        F.when(has(text, r.national), 5)
        .when((platforms >= 2) | (competitors >= 2) | has(text, r.multi), 4)
        .when(kind.isin(*r.typical), 3)
        .when((platforms == 1) | (competitors == 1) | has(text, r.single), 2)
        .when(kind.isin(*r.minor), 1)
        .otherwise(2)
    )


def credibility(name: Column, url: Column, r: EventRules) -> Column:
    """Tier of a source: 0 without address, by name, by the first known name that holds it or is held by it, by host, by
    the first known domain that the host lies under, else 1."""
    name = X.nz(name)
    host = F.regexp_replace(domain(url), r"^m\.", "")
    out = F.lit(1)
    for d, tier in reversed(list(r.domain_tiers.items())):
        out = F.when(host.endswith(f".{d}"), tier).otherwise(out)
    out = F.coalesce(scoring.lookup(host, dict(r.domain_tiers), None), out) if r.domain_tiers else out
    for known, tier in reversed(list(r.source_tiers.items())):
        out = F.when(name.contains(known) | F.lit(known).contains(name), tier).otherwise(out)
    out = F.coalesce(scoring.lookup(name, dict(r.source_tiers), None), out) if r.source_tiers else out
    return F.when(F.trim(X.nz(url)) == "", 0).otherwise(out)


def richness(text: Column, fact: Column, r: EventRules, low: X.Lowered | None = None) -> Column:
    """5 for a key figure with a value, 4 for a value and two data words, 3 for one of these, 2 for a direction, 1 for an
    opinion or a bare fact, 0 without fact."""
    low = low or X.Lowered(X.lowered(text))
    valued, words = X.nz(text).rlike(r.data_value), hits(low, r.data)
    return (
        F.when(has(low, r.high_value) & valued, 5)
        .when(valued & (words >= 2), 4)
        .when(valued | (words >= 2), 3)
        .when(has(low, r.direction), 2)
        .when(has(low, r.opinion), 1)
        .when(F.trim(X.nz(fact)) == "", 0)
        .otherwise(1)
    )


def actionability(variables: Column, kind: Column, r: EventRules) -> Column:
    """The highest weight of an event's variables (from 2 on), 5 for types to act on with 4; else at least that of its type."""
    most = F.coalesce(F.array_max(F.transform(variables, lambda v: scoring.lookup(v, dict(r.variables), 0))), F.lit(0))
    by_type = scoring.lookup(kind, dict(r.type_action), 1)
    return F.when(kind.isin(*r.direct_types) & (most >= 4), 5).when(most >= 4, 4).when(most >= 2, most).otherwise(F.greatest(by_type, most))


def time_sensitivity(label: Column, published: Column, as_of: Column, r: EventRules) -> Column:
    """By label; where it says nothing, by age in hours (24, 72, 168); a background of the last days is raised."""
    base = scoring.lookup(X.nz(label), dict(r.sensitivity), 0)
    age = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(published.cast("timestamp"))) / F.lit(3_600_000_000.0)
    inferred = F.when(age < 24, 5).when(age < 72, 4).when(age < 168, 2).otherwise(1)
    raised = F.when(age < 24, 4).when(age < 72, 3).otherwise(base)
    return F.when(published.isNull(), base).when(base == 0, inferred).when(base == 2, raised).otherwise(base)


def novelty(label: Column, fact: Column, repeated: Column, r: EventRules) -> Column:
    """By label; an unlabelled fact has 3 if it is the first of its kind; a repeated one loses 2."""
    base = scoring.lookup(X.nz(label), dict(r.novelty), 0)
    told = X.nz(fact) != ""
    base = F.when((base == 0) & told & ~repeated, 3).otherwise(base)
    return F.when(told & repeated, F.greatest(base - 2, F.lit(0))).otherwise(base)


def stock_market(text: Column | X.Lowered, r: EventRules) -> Column:
    """Market news: a strong sign, or more stock signs than signs of business."""
    stock = hits(text, r.stock)
    return (hits(text, r.stock_strong) >= 1) | ((stock >= 1) & (stock > hits(text, r.business)))


def corporate_finance(text: Column | X.Lowered, r: EventRules) -> Column:
    found = hits(text, r.finance)
    return (found >= 1) & (found >= hits(text, r.action))


def not_at_home(text: Column | X.Lowered, r: EventRules) -> Column:
    found = hits(text, r.abroad)
    return (found >= 2) & (found > hits(text, r.home))


def downgrade(priority: Column, e: Mapping[str, Column], r: EventRules) -> Column:
    """struct(priority, reasons): exits to ARCHIVE in order, else the caps at P2 that hold for a P0 or P1.

    ``e`` names url, fact, title, text, evidence, freshness, eligibility, confidence, method, kind, weighted and the
    dimensions credibility, relevance and richness; ``low`` and ``low_told``, if given, text, and title with fact, lower-cased.
    """
    empty = lambda c: F.trim(X.nz(c)) == ""
    stale = e["freshness"].isin("historical_background", "retrospective_summary") | (e["eligibility"] == "reference")
    stale = F.coalesce(stale, F.lit(False))
    text = e.get("low", e["text"])
    told = e.get("low_told") or F.concat_ws(" ", X.nz(e["title"]), X.nz(e["fact"]))
    scale = has(told, r.market_scale) & has(told, r.market) & (e["richness"] >= 4)
    exits = [
        (empty(e["url"]), "no_url"),
        (empty(e["fact"]), "no_fact"),
        (stock_market(text, r), "stock_market"),
        (e["freshness"].isin("republished_old_fact", "date_conflict") | (e["eligibility"] == "reject"), "old_or_conflict"),
        (stale & ~scale, "background"),
        (corporate_finance(text, r), "corporate_finance"),
        (e["relevance"] <= 1, "irrelevant"),
        (not_at_home(text, r), "abroad"),
    ]
    caps = [
        (stale & scale, "market_scale"),
        ((e["confidence"] == "low") & ~((e["weighted"] >= 3.5) & (e["credibility"] >= 3)), "low_confidence"),
        (e["method"] == "rule_fallback", "rule_fallback"),
        (e["credibility"] < 2, "low_credibility"),
        (e["relevance"] < 3, "low_relevance"),
        (e["kind"] == "background_only", "background_only"),
        (e["kind"] == "unclear", "unclear"),
        (empty(e["evidence"]), "no_evidence"),
    ]
    sure = lambda c: F.coalesce(c, F.lit(False))
    left = scoring.first_guard([(c, "ARCHIVE", reason) for c, reason in exits], ("", ""))
    high = priority.isin("P0", "P1")
    held = F.array_compact(F.array(*[F.when(high & sure(c), F.lit(reason)) for c, reason in caps]))
    return F.struct(
        F.when(left["outcome"] != "", "ARCHIVE").when(F.size(held) > 0, "P2").otherwise(priority).alias("priority"),
        F.when(left["outcome"] != "", F.array(left["reason"])).otherwise(held).alias("reasons"),
    )


# --- impact --------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class ImpactRules:
    """Lexicons and maps of the impact analysis."""

    channels: Mapping[str, Words] = field(default_factory=dict)
    generic_channels: Words = ()
    default_channels: Words = ()
    channel_variables: Words = ()
    variables: Mapping[str, Words] = field(default_factory=dict)
    impact: Mapping[str, str] = field(default_factory=dict)
    owners: Mapping[str, str] = field(default_factory=dict)
    metrics: Mapping[str, str] = field(default_factory=dict)
    questions: Mapping[str, Words] = field(default_factory=dict)
    detail_types: Words = ("platform_rule", "policy_change")
    detail_question: str = "details and start?"
    doubt_question: str = "can the data be checked elsewhere?"
    actions: Mapping[str, str] = field(default_factory=dict)
    archive_action: str = "file, no action"
    other_action: str = "watch {channel}"
    action_parts: Sequence[tuple[Words, str]] = ()
    to_confirm: str = "to be confirmed"
    undecided: str = "undecided"
    any_channel: str = "channels concerned"
    vague: Words = ()
    labels: Mapping[str, Words] = field(default_factory=dict)


def affected_channels(platforms: Column, text: Column, variables: Column, r: ImpactRules) -> Column:
    """Channels that an event names, in order; the default ones if it names only general words or telling variables."""
    named = F.array_compact(F.array(*[F.when(F.arrays_overlap(platforms, F.array(*map(F.lit, words))) | has(text, words), F.lit(name)) for name, words in r.channels.items()]))
    default = F.array(*map(F.lit, r.default_channels))
    hint = has(text, r.generic_channels) | F.arrays_overlap(variables, F.array(*map(F.lit, r.channel_variables)))
    return F.when(F.size(named) > 0, named).when(F.coalesce(hint, F.lit(False)), default).otherwise(F.array(F.lit(r.to_confirm)))


def affected_variables(variables: Column, text: Column, r: ImpactRules) -> Column:
    found = F.array_compact(F.array(*[F.when(has(text, words), F.lit(name)) for name, words in r.variables.items()]))
    out = F.array_union(variables, found)
    return F.when(F.size(out) > 0, out).otherwise(F.array(F.lit(r.to_confirm)))


def action_level(priority: Column) -> Column:
    """A P1 is tested; what is archived stays so; the rest, P0 included, is watched."""
    return F.when(priority == "ARCHIVE", "archive").when(priority == "P1", "test").otherwise("watch")


def analysis_confidence(confidence: Column, credibility: Column, richness: Column) -> Column:
    return F.when((confidence == "high") & (credibility >= 4) & (richness >= 4), "high").when((confidence == "high") | ((credibility >= 3) & (richness >= 3)), "medium").otherwise("low")


def analysis(e: Mapping[str, Column], r: ImpactRules) -> Column:
    """struct of an event's impact analysis by rule. ``e`` names platforms, text, variables, kind, priority, confidence,
    credibility, richness, relevance and title."""
    impact = scoring.lookup(e["kind"], dict(r.impact), "noise")
    channels = affected_channels(e["platforms"], e["text"], e["variables"], r)
    variables = affected_variables(e["variables"], e["text"], r)
    metrics = F.array_compact(F.transform(variables, lambda v: F.try_element_at(F.create_map(*[F.lit(x) for kv in r.metrics.items() for x in kv]), v)))
    asked = F.array(*[F.lit(None).cast("string")])
    for kind, questions in reversed(list(r.questions.items())):
        asked = F.when(impact == kind, F.array(*map(F.lit, questions))).otherwise(asked)
    questions = F.concat(asked, F.array(F.when(e["kind"].isin(*r.detail_types), r.detail_question), F.when(e["confidence"] == "low", r.doubt_question)))
    first = F.when(channels[0] == r.to_confirm, r.any_channel).otherwise(channels[0])
    template = scoring.lookup(e["kind"], dict(r.actions), r.other_action)
    parts = [F.when(F.arrays_overlap(e["variables"], F.array(*map(F.lit, words))), F.lit(part)).otherwise("") for words, part in r.action_parts]
    action = F.when(e["priority"] == "ARCHIVE", r.archive_action).otherwise(F.concat(F.replace(template, F.lit("{channel}"), first), *parts))
    strength = F.when(e["relevance"] >= 4, "direct").when(e["relevance"] >= 3, "indirect").otherwise("weak")
    shown = F.when(channels[0] == r.to_confirm, r.any_channel).otherwise(F.array_join(F.slice(channels, 1, 3), ", "))
    return F.struct(
        impact.alias("impact_type"),
        channels.alias("channels"),
        variables.alias("variables"),
        F.concat_ws(" | ", strength, shown, impact, F.substring(X.nz(e["title"]), 1, 80)).alias("sentence"),
        action.alias("recommended_action"),
        action_level(e["priority"]).alias("action_level"),
        scoring.lookup(e["kind"], dict(r.owners), r.undecided).alias("owner"),
        F.when(F.size(metrics) > 0, metrics).otherwise(F.array(F.lit(r.undecided))).alias("metrics"),
        F.slice(F.array_compact(questions), 1, 3).alias("questions"),
        analysis_confidence(e["confidence"], e["credibility"], e["richness"]).alias("confidence"),
    )


def analysis_downgrade(given: Mapping[str, Column], e: Mapping[str, Column], r: ImpactRules) -> Column:
    """struct(action_level, reasons): checks in order, each on what the one before left.

    ``given`` names action_level, recommended_action and metrics; ``e`` priority, confidence, method, kind, credibility.
    """
    level, action = given["action_level"], given["recommended_action"]
    reasons: list[Column] = []

    def step(condition: Column, to: str, reason: str) -> None:
        nonlocal level
        condition = F.coalesce(condition, F.lit(False))
        reasons.append(F.when(condition, F.lit(reason)))
        level = F.when(condition, to).otherwise(level)

    step((e["priority"] == "ARCHIVE") & (level != "archive"), "archive", "archived")
    for name, condition in (("low_confidence", e["confidence"] == "low"), ("rule_fallback", e["method"] == "rule_fallback"), ("unclear", e["kind"] == "unclear"), ("low_credibility", e["credibility"] < 2)):
        step(condition & (level == "immediate"), "test", name)
    step(F.trim(X.nz(action)) == "", "watch", "no_action")
    vague_metrics = (F.size(given["metrics"]) == 0) | (F.get(given["metrics"], F.lit(0)) == r.undecided)
    step(vague_metrics & level.isin("immediate", "test"), "watch", "no_metrics")
    step(has(action, r.vague) & (F.length(action) < 20), "watch", "vague_action")
    return F.struct(level.alias("action_level"), F.array_compact(F.array(*reasons)).alias("reasons"))


def judgment_labels(title: Column, summary: Column, priority: Column, r: ImpactRules, low: X.Lowered | None = None) -> Column:
    """Labels A (also for P0 and P1), B, C (only without A), R, K and X whose words a text holds; C if none does."""
    text = low or F.concat_ws(" ", X.nz(title), X.nz(summary))
    a = has(text, r.labels.get("A", ())) | F.coalesce(priority.isin("P0", "P1"), F.lit(False))
    made = [F.when(a, "A"), F.when(has(text, r.labels.get("B", ())), "B"), F.when(has(text, r.labels.get("C", ())) & ~a, "C"), *[F.when(has(text, r.labels.get(k, ())), k) for k in "RKX"]]
    out = F.array_compact(F.array(*made))
    return F.when(F.size(out) > 0, out).otherwise(F.array(F.lit("C")))


def confidence_tag(confidence: Column, method: Column, priority: Column, weighted: Column, credibility: Column) -> Column:
    backed = (priority == "P1") | ((weighted >= 3.5) & (credibility >= 3))
    return F.when(confidence == "low", F.when(backed, "look").otherwise("verify")).when(method == "rule_fallback", "rule").otherwise("")
