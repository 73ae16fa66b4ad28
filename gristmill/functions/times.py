"""Date and time expressions. Nothing reads the clock: every rule takes ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY = 86_400_000_000


def parse_any_ts(text: Column) -> Column:
    """Timestamp of a date string in ISO, slash, dot, Chinese, RFC 2822 or epoch form; null for anything else."""
    t = F.trim(text)
    plain = F.regexp_replace(F.regexp_replace(t, r"[年月./]", "-"), r"[日]", "")
    plain = F.regexp_replace(plain, r"^(\d{4})-(\d{1,2})-(\d{1,2})", "$1-$2-$3")
    mail = F.regexp_replace(F.regexp_replace(t, r"^[A-Za-z]{3}, *", ""), r"(GMT|UTC?)$", "+0000")
    epoch = F.when(t.rlike(r"^\d{10}$"), F.timestamp_seconds(t.try_cast("long"))).when(t.rlike(r"^\d{13}$"), F.timestamp_millis(t.try_cast("long")))
    forms = [F.try_to_timestamp(plain, F.lit(f)) for f in ("yyyy-M-d HH:mm:ss", "yyyy-M-d HH:mm", "yyyy-M-d")]
    return F.coalesce(epoch, *forms, F.try_to_timestamp(t), F.try_to_timestamp(mail, F.lit("d MMM yyyy HH:mm:ss Z")))


def age_days(ts: Column, as_of: Column) -> Column:
    """Whole days that have passed since ``ts``; negative for the future. Not a calendar difference."""
    return F.floor((F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(ts.cast("timestamp"))) / F.lit(float(_DAY))).cast("long")


def time_status(ts: Column, as_of: Column, fresh: int = 2, near: int = 7, future: str = "in_window") -> Column:
    """in_window (to ``fresh`` days), near_window (to ``near``), old or unknown_time; ``future`` names what lies ahead."""
    age = age_days(ts, as_of)
    return F.when(ts.isNull(), "unknown_time").when(ts > as_of, future).when(age <= fresh, "in_window").when(age <= near, "near_window").otherwise("old")


def daily_window(ts: Column, start_hour: int = 7, zone_hours: int = 8) -> Column:
    """Date of the window [day - 1 at ``start_hour``, day at ``start_hour``) of a zone that holds ``ts`` (UTC)."""
    moved = F.timestamp_micros(F.unix_micros(ts.cast("timestamp")) + F.lit((24 + zone_hours - start_hour) * 3_600_000_000))
    return F.to_date(moved)


def period_start(day: Column, kind: str) -> Column:
    """First day of the ``weekly`` (Monday), ``monthly`` or ``yearly`` period."""
    return F.to_date(F.date_trunc({"weekly": "week", "monthly": "month", "yearly": "year"}[kind], day))


def period_end(day: Column, kind: str) -> Column:
    """First day after the period."""
    start = period_start(day, kind)
    return F.date_add(start, 7) if kind == "weekly" else F.to_date(F.add_months(start, 1 if kind == "monthly" else 12))


def period_id(day: Column, kind: str) -> Column:
    """2024-W05, 2024-01 or 2024."""
    if kind == "weekly":
        return F.format_string("%d-W%02d", F.extract(F.lit("YEAROFWEEK"), day).cast("int"), F.weekofyear(day))
    return F.date_format(day, "yyyy-MM" if kind == "monthly" else "yyyy")


def previous_period(day: Column, kind: str) -> Column:
    """A day of the period before."""
    return F.date_sub(period_start(day, kind), 1)


def due_periods(day: Column) -> Column:
    """Periods that end before ``day``: weekly on Mondays, monthly on the first, yearly on 1 January."""
    return F.array_compact(F.array(F.when(F.dayofweek(day) == 2, "weekly"), F.when(F.dayofmonth(day) == 1, "monthly"), F.when((F.dayofmonth(day) == 1) & (F.month(day) == 1), "yearly")))


def text_dates(text: Column) -> Column:
    """All calendar dates yyyy-mm-dd (also with slashes or dots) of a text, in order."""
    found = F.regexp_extract_all(text, F.lit(r"((?:19|20)\d{2}[-/.]\d{1,2}[-/.]\d{1,2})"), F.lit(1))
    return F.array_compact(F.transform(found, lambda d: F.try_to_date(F.regexp_replace(d, "[/.]", "-"), "y-M-d")))
