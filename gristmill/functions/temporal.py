"""When things happened: dates in texts, resolution of an article's date, event times, freshness of facts, campaigns.

Nothing reads the clock: every rule takes ``as_of``. Dates and times are without zone, in that of the tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions import text as X
from gristmill.functions import times as T
from gristmill.functions import urls as U

_HOUR = 3_600_000_000

#: How far a date's source is trusted, and what each freshness of a fact is fit for.
DATE_CONFIDENCE = {"json_ld": "high", "html_time": "high", "og_metadata": "high", "url_date": "medium", "tavily": "low", "search_snippet": "low"}
ELIGIBILITY = {
    "new_fact": "core",
    "updated_fact": "core",
    "upcoming_fact": "core",
    "ongoing_fact": "tracking",
    "historical_background": "reference",
    "retrospective_summary": "reference",
    "republished_old_fact": "reject",
    "date_conflict": "reject",
    "unknown_fact_time": "review",
}
#: Patterns of addresses of pages that are no articles.
PAGE_PATTERNS = (
    (r"(?:^|/)(?:tags?|tagged|topic|topics?)/", "tag_page"),
    (r"(?:^|/)(?:category|categories|channel|section|column|subject)/", "category_page"),
    (r"(?:^|/)(?:search|s\?|query|so\?|find)", "search_page"),
    (r"(?:^|/)(?:list|listing|index|archive|news|资讯|新闻)(?:/|$)", "listing_page"),
    (r"(?:^|/)(?:page|p)\d+", "listing_page"),
)
#: Words that tell of something new in a fact, and of looking back.
DELTA_WORDS = ("新增", "首次", "上线", "发布", "宣布", "出台", "调整", "升级", "推出", "试点", "落地", "开放")
LOOKING_BACK = "回顾|复盘|时间线|盘点|总结|对比|大事记|本文由AI生成|AI生成"


def _lookup(key: Column, values: Mapping[str, str], default: str) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), key), F.lit(default))


def _days_before(as_of: Column, days: Column) -> Column:
    return F.date_sub(as_of.cast("date"), days.cast("int"))


def margin_status(ts: Column, start: Column, end: Column, hours: int = 48, outside: str = "near_window") -> Column:
    """Status against a window: within it, within ``hours`` around it, before that old, and ``outside`` after it."""
    t, a, b = (F.unix_micros(c.cast("timestamp")) for c in (ts, start, end))
    margin = F.lit(hours * _HOUR)
    return F.when(ts.isNull(), "unknown_time").when(t.between(a, b), "in_window").when(t.between(a - margin, b + margin), "near_window").when(t < a, "old").otherwise(outside)


def relative_date(text: Column, as_of: Column) -> Column:
    """Date of the first relative time of a text: days, hours, minutes or weeks ago, or today, yesterday and the day before."""
    found = lambda p, k=1: F.regexp_extract(X.nz(text), p, k)
    number = found(r"(\d{1,4})\s*(?:天|小时|分钟|周|day|hour|minute|week)s?\s*(?:前|ago)").try_cast("int")
    unit = found(r"\d{1,4}\s*(天|小时|分钟|周|day|hour|minute|week)s?\s*(?:前|ago)")
    hours = F.when(unit.isin("天", "day"), number * 24).when(unit.isin("周", "week"), number * 168).when(unit.isin("小时", "hour"), number).when(unit != "", 0)
    at = F.to_date(F.timestamp_micros(F.unix_micros(as_of.cast("timestamp")) - hours.cast("long") * _HOUR))
    named = F.when(text.rlike("前天"), 2).when(text.rlike("昨天|昨日|(?i:yesterday)"), 1).when(text.rlike("今天|今日|(?i:today)"), 0)
    return F.coalesce(at, F.when(named.isNotNull(), _days_before(as_of, named)))


def leading_date(text: Column, chars: int = 100) -> Column:
    """The first date of the first characters of a text."""
    head = F.substring(X.nz(text), 1, chars)
    y, m, d = (F.regexp_extract(head, r"(\d{4})[年/\-.](\d{1,2})[月/\-.](\d{1,2})", k) for k in (1, 2, 3))
    return F.when(y != "", F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd"))


def resolve_date(published: Column, url: Column, raw: Column, summary: Column, content: Column, as_of: Column) -> Column:
    """struct(day, origin) of an article: its own date, unless the address is more than a week off and then counts; the
    raw record's; a date, a relative time or a word for a day at the head of the text; that of the address."""
    own, in_url = T.parse_any_ts(F.when(F.length(published) > 5, published)).cast("date"), U.url_date(url, calendar=True)
    text = F.trim(F.concat_ws(" ", X.nz(summary), F.substring(X.nz(content), 1, 200)))
    steps = [
        ("url_conflict", F.when(F.abs(F.datediff(own, in_url)) > 7, in_url)),
        ("published", own),
        ("raw", F.when(F.length(raw) > 5, F.try_to_date(F.substring(raw, 1, 10), "yyyy-MM-dd"))),
        ("text", leading_date(text)),
        ("relative", relative_date(F.substring(F.when(text.rlike(r"^.{0,40}(?:前|ago)"), text), 1, 40), as_of)),
        ("word", F.when(text.startswith("昨天"), _days_before(as_of, F.lit(1))).when(text.startswith("今天"), as_of.cast("date"))),
        ("url", in_url),
    ]
    return F.coalesce(*[F.when(day.isNotNull(), F.struct(day.alias("day"), F.lit(origin).alias("origin"))) for origin, day in steps])


def sanity(published: Column, source: Column, as_of: Column, future_hours: int = 6) -> Column:
    """struct(status, confidence) of an article's date: invalid_future_date beyond ``future_hours``, valid or unknown."""
    late = F.unix_micros(published.cast("timestamp")) > F.unix_micros(as_of.cast("timestamp")) + F.lit(future_hours * _HOUR)
    status = F.when(published.isNull(), "unknown").when(late, "invalid_future_date").otherwise("valid")
    return F.struct(status.alias("status"), _lookup(F.lower(F.trim(X.nz(source))), DATE_CONFIDENCE, "unknown").alias("confidence"))


def page_kind(url: Column, title: Column, content: Column) -> Column:
    """Kind of page for the admission of events: lists, tags, categories and searches are no events."""
    low, title = F.lower(X.nz(url)), F.trim(X.nz(title))
    out = F.when(F.length(F.trim(X.nz(content))) > 200, "article_page").otherwise("unknown")
    out = F.when(title.rlike("^(分类|栏目|频道|资讯列表|全部文章)") & (F.length(title) < 30), "listing_page").otherwise(out)
    out = F.when(title.rlike("标签|话题|专题") & (F.length(title) < 30), "tag_page").otherwise(out)
    out = F.when(title.rlike("(?i)^(首页|主页|home)$"), "homepage").otherwise(out)
    for pattern, kind in reversed(PAGE_PATTERNS):
        out = F.when(low.rlike(pattern), kind).otherwise(out)
    return out


def _all(text: Column, pattern: str, *groups: int) -> list[Column]:
    return [F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in groups]


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once however often it names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _dates(found: Column, with_day: bool = True) -> Column:
    """Calendar dates of matches that hold year, month and, ``with_day``, day; impossible ones are left out."""
    padded = lambda parts, k: F.lpad(F.get(parts, F.lit(k)), 2, "0")
    made = lambda parts: F.try_to_date(F.concat_ws("-", F.get(parts, F.lit(0)), padded(parts, 1), padded(parts, 2) if with_day else F.lit("01")), "yyyy-MM-dd")
    return F.array_compact(F.transform(found, lambda m: _bound(F.split(m, r"[^0-9]+"), made)))


def _before(as_of: Column, numbers: Column, micros: int) -> Column:
    """Dates so many times ``micros`` before ``as_of``."""
    return F.transform(numbers, lambda n: F.to_date(F.timestamp_micros(F.unix_micros(as_of.cast("timestamp")) - n.cast("long") * F.lit(micros))))


def content_dates(text: Column, as_of: Column, campaigns: Mapping[str, tuple[int, int]] | None = None) -> Column:
    """struct(total, historical, recent, ratio, oldest, newest) of the dates that a text mentions.

    Full dates count each, then year and month where no day follows, relative times, and this year's ``campaigns``
    (name -> month and day; pattern ``今年`` before the name). Historical is before ``as_of``'s year, recent within the
    last seven days or later.
    """
    campaigns = campaigns or {}
    text = X.nz(text)
    day = as_of.cast("date")
    full = r"(\d{4})\s*年\s*(\d{1,2})\s*月\s*(\d{1,2})\s*日"
    plain = r"(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})"
    rest = F.regexp_replace(F.regexp_replace(text, full, " "), plain, " ")
    found = [_dates(*_all(text, full, 0)), _dates(*_all(text, plain, 0)), _dates(*_all(rest, r"(\d{4})\s*年\s*(\d{1,2})\s*月", 0), with_day=False)]
    none = F.array().cast("array<date>")
    for word, back in (("今天", 0), ("今日", 0), ("昨天", 1), ("昨日", 1), ("前天", 2)):
        found.append(F.when(text.contains(word), F.array_repeat(F.date_sub(day, back), F.regexp_count(text, F.lit(word)))).otherwise(none))
    for unit, micros in (("天", 24 * _HOUR), ("小时", _HOUR), ("周", 168 * _HOUR), ("分钟", _HOUR // 60)):
        (numbers,) = _all(text, rf"(\d{{1,5}})\s*{unit}前", 1)
        found.append(F.when(text.contains("前"), _before(as_of, numbers, micros)).otherwise(none))
    for name, (month, dom) in campaigns.items():
        found.append(F.array_repeat(F.make_date(F.year(day), F.lit(month), F.lit(dom)), F.regexp_count(text, F.lit(rf"今年\s*{name}"))))
    def counted(dates: Column) -> Column:
        n = F.size(dates)
        historical = F.size(F.filter(dates, lambda d: F.year(d) < F.year(day)))
        return F.struct(
            n.alias("total"),
            historical.alias("historical"),
            F.size(F.filter(dates, lambda d: d >= F.date_sub(day, 7))).alias("recent"),
            F.when(n > 0, F.round(historical / n, 3)).otherwise(0.0).alias("ratio"),
            F.array_min(dates).alias("oldest"),
            F.array_max(dates).alias("newest"),
        )

    return _bound(F.concat(*found), counted)


def delta(title: Column, fact: Column, ledger_title: Column, words: Sequence[str] = DELTA_WORDS) -> Column:
    """What is new against the ledger: another title of over four characters, an action word in the fact."""
    title, before = F.trim(X.nz(title)), F.trim(X.nz(ledger_title))
    return F.array_compact(F.array(F.when((title != "") & (before != "") & (title != before) & (F.length(title) > 4), "event_title"), F.when(X.any_keyword(fact, words), "fact_action_word")))


def fact_freshness(e: Mapping[str, Column], as_of: Column, high_value: Sequence[str] = (), delta_words: Sequence[str] = DELTA_WORDS, looking_back: str = LOOKING_BACK) -> Column:
    """struct(status, eligibility) of a fact, by rules in order.

    ``e`` names sanity (status of the article's date), effective, occurred (dates), title, fact, fact_hash, ratio and
    recent (of the text's dates), and the ledger's entry of the same cluster: known (boolean), known_hash, known_title
    and first_seen.
    """
    day = as_of.cast("date")
    told = F.concat_ws(" ", X.nz(e["title"]), X.nz(e["fact"]))
    same = (X.nz(e["fact_hash"]) != "") & (e["fact_hash"] == e["known_hash"])
    known = F.coalesce(e["known"], F.lit(False))
    back = (e["ratio"] >= 0.6) & (e["recent"] == 0)
    occurred = e["occurred"]
    status = (
        F.when(e["sanity"] == "invalid_future_date", "date_conflict")
        .when(e["effective"] > day, "upcoming_fact")
        .when(known & (F.size(delta(e["title"], e["fact"], e["known_title"], delta_words)) > 0), "updated_fact")
        .when(known & same, F.when(e["first_seen"] < F.date_sub(day, 3), "republished_old_fact").otherwise("ongoing_fact"))
        .when(known, "updated_fact")
        .when(back, F.when(told.rlike(looking_back), "retrospective_summary").otherwise("historical_background"))
        .when(occurred >= F.date_sub(day, 7), "new_fact")
        .when((F.year(occurred) < F.year(day)) | (occurred < F.date_sub(day, 30)), "historical_background")
        .when(occurred.isNotNull(), "ongoing_fact")
        .otherwise("unknown_fact_time")
    )
    fit = F.when(status == "unknown_fact_time", F.when(X.any_keyword(told, high_value), "review").otherwise("reference")).otherwise(_lookup(status, ELIGIBILITY, "reference"))
    return F.struct(status.alias("status"), fit.alias("eligibility"))


def date_gate(a: Mapping[str, Column], as_of: Column, cutoffs: Mapping[str, int] | None = None) -> Column:
    """Why an article passes the date gate or not: trusted, url_conflict, future, kept, old, undated_kept or undated.

    ``a`` names published and url_day (dates), tier (channel, search or broad) and trusted. ``as_of`` is the start of the
    window; ``cutoffs`` are the days before it that a tier may reach back.
    """
    cutoffs = dict(cutoffs or {"channel": 1, "search": 3, "broad": 7})
    day = as_of.cast("date")
    reach = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in cutoffs.items() for x in kv]), a["tier"]), F.lit(1))
    loose = F.when(a["tier"] == "broad", cutoffs["broad"]).otherwise(cutoffs["channel"])
    conflict = (F.abs(F.datediff(a["published"], a["url_day"])) > 7) & (a["url_day"] < F.date_sub(day, loose))
    return (
        F.when(a["trusted"], "trusted")
        .when(F.coalesce(conflict, F.lit(False)), "url_conflict")
        .when(a["published"] > F.date_add(day, 1), "future")
        .when(a["published"].isNotNull(), F.when(a["published"] >= F.date_sub(day, reach), "kept").otherwise("old"))
        .when(a["tier"] == "broad", "undated_kept")
        .otherwise("undated")
    )


PASSING = ("trusted", "kept", "undated_kept")


def years(text: Column) -> Column:
    """Distinct years of the 2020s that a text names, sorted."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(X.nz(text), F.lit("(202[0-9])"), F.lit(1)), lambda y: y.cast("int"))))


def campaign(a: Mapping[str, Column], keywords: Mapping[str, Sequence[str]], calendar: Mapping[str, tuple[int, int, int, int]], as_of: Column, tail_days: int = 30) -> Column:
    """struct(name, temporality, year) of the first campaign (in lexicon order) that an article names.

    The year is the first in the text up to the next one, else this year for an article in or near the window, else the
    year it was published. This year's campaign is current within its ``calendar`` window (month, day to month, day;
    it may pass the new year), upcoming before, retrospective for ``tail_days`` after and historical then; last year's
    is retrospective, earlier ones are historical. ``a`` names text, time (status) and published (date).
    """
    day = as_of.cast("date")
    this = F.year(day)
    low = F.lower(X.nz(a["text"]))
    name = F.coalesce(*[F.when(X.any_keyword(low, words), F.lit(n)) for n, words in keywords.items()])
    named = F.get(F.filter(years(low), lambda y: y <= this + 1), F.lit(0))
    year = F.coalesce(named, F.when(a["time"].isin("in_window", "near_window"), this), F.year(a["published"]))
    of = lambda k: F.coalesce(*[F.when(name == n, F.lit(w[k])) for n, w in calendar.items()]) if calendar else F.lit(None).cast("int")
    start, end = F.make_date(this, of(0), of(1)), F.make_date(this, of(2), of(3))
    across = of(0) > of(2)
    in_year = (
        F.when(start.isNull(), "current_campaign")
        .when(across & ((day >= start) | (day <= end)), "current_campaign")
        .when(~across & day.between(start, end), "current_campaign")
        .when(day < start, "upcoming_campaign")
        .when(F.datediff(day, end) <= tail_days, "retrospective")
        .otherwise("historical_campaign")
    )
    when = (
        F.when(name.isNull(), "not_campaign")
        .when(year.isNull(), "unknown_campaign_time")
        .when(year > this, "upcoming_campaign")
        .when(year == this, in_year)
        .when(year == this - 1, "retrospective")
        .otherwise("historical_campaign")
    )
    return F.struct(F.coalesce(name, F.lit("not_campaign")).alias("name"), when.alias("temporality"), F.when(name.isNotNull(), year).alias("year"))


def seasonal_mismatch(text: Column, as_of: Column, allowed: Mapping[str, Sequence[int]]) -> Column:
    """Whether a text names a word (of ``allowed``: word -> months) in a month it doesn't belong to."""
    out = F.lit(False)
    for word, months in allowed.items():
        out = out | (X.any_keyword(text, [word]) & ~F.month(as_of.cast("date")).isin(*months))
    return out
