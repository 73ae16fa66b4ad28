"""Points in windows of time: a binned interval join, calendars, and half-open periods."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def interval_join(points: DataFrame, windows: DataFrame, at: str, start: str, end: str, width: int = 3600) -> DataFrame:
    """Rows of ``points`` beside each of ``windows`` with ``start`` <= ``at`` < ``end`` (timestamps or dates).

    Windows may overlap and be of any lengths; column names of both sides differ. A window lies in at most two bins of
    its level, whose bins are ``width`` seconds times a power of two and no shorter than the window; a point has a bin at
    each level that occurs, of which there are some dozens at most. So both meet in an equi-join on level and bin, and
    each pair once; the bounds are tested again there. Nulls and windows that end before they start meet nothing.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    sized = windows.withColumns({"_from": micros(start), "_to": micros(end)}).where("_from < _to")
    sized = sized.withColumn("_level", F.greatest(F.ceil(F.log2((F.col("_to") - F.col("_from")) / F.lit(width * 1e6))), F.lit(0)).cast("int"))
    levels = sorted(r["_level"] for r in sized.select("_level").distinct().collect())  # at most 64 numbers
    wide = lambda level: F.shiftleft(F.lit(width * 1_000_000).cast("long"), level)
    bin_of = lambda t, level: F.floor((t - F.pmod(t, level)) / level).cast("long")  # noqa: E731  exact: the numerator is a multiple
    span = F.call_function("shiftleft", F.lit(width * 1_000_000).cast("long"), F.col("_level"))
    entered = sized.withColumn("_bin", F.explode(F.sequence(bin_of(F.col("_from"), span), bin_of(F.col("_to") - 1, span))))
    own = F.array(*[F.struct(F.lit(k).alias("level"), bin_of(F.col("_at"), wide(k)).alias("bin")) for k in levels]) if levels else F.array().cast("array<struct<level:int,bin:bigint>>")
    placed = points.withColumn("_at", micros(at)).where("_at is not null").select("*", F.explode(own).alias("_place"))
    placed = placed.select(*points.columns, "_at", F.col("_place.level").alias("_level"), F.col("_place.bin").alias("_bin"))
    met = placed.join(entered, ["_level", "_bin"]).where((F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_to")))
    return met.select(*points.columns, *windows.columns)


def stabbed(points: DataFrame, windows: DataFrame, at: str, start: str, end: str, name: str) -> DataFrame:
    """``points`` that lie in any of ``windows`` (``start`` <= ``at`` < ``end``, timestamps), each with how many it lies in
    (``windows``) and the smallest and largest ``name`` of these (``first_name``, ``last_name``).

    No point meets a window: a window is cut into bins of microseconds times powers of four, at most six a power, the bins
    are counted, and a point looks up its bin of each power that occurs. So time grows with the rows, however many windows
    are open at once. Nulls and windows that end before they start meet nothing.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    bounds = windows.select(micros(start).alias("_from"), micros(end).alias("_to"), F.col(name).alias("_name")).where("_from < _to")
    # bins of level k are 4^k wide; the ends that don't fill a bin of the next level stay at their level
    up, down = lambda t, k: F.shiftright(t + F.lit((1 << 2 * k) - 1), 2 * k), lambda t, k: F.shiftright(t, 2 * k)
    longest = bounds.agg(F.max(F.col("_to") - F.col("_from"))).first()[0] or 0  # one number
    levels = range(max(longest, 1).bit_length() // 2 + 1)
    none = F.array().cast("array<bigint>")
    numbers = lambda a, b: F.when(a < b, F.sequence(a, b - 1)).otherwise(none)

    def of_level(k: int):
        a, b = up(F.col("_from"), k), down(F.col("_to"), k)
        inner_a, inner_b = up(F.col("_from"), k + 1) * 4, down(F.col("_to"), k + 1) * 4
        held = F.when(inner_a < inner_b, F.concat(numbers(a, inner_a), numbers(inner_b, b))).otherwise(numbers(a, b))
        return F.transform(held, lambda n: F.struct(F.lit(k).alias("level"), n.alias("bin")))

    cut = bounds.select("_name", F.explode(F.concat(*map(of_level, levels))).alias("_b")).groupBy("_b.level", "_b.bin")
    cut = cut.agg(F.count(F.lit(1)).alias("n"), F.min("_name").alias("lo"), F.max("_name").alias("hi"))
    times = points.select(micros(at).alias("_at")).where("_at is not null").distinct()
    looked = times.select("_at", F.explode(F.array(*[F.struct(F.lit(k).alias("level"), down(F.col("_at"), k).alias("bin")) for k in levels])).alias("_b")).select("_at", "_b.*")
    found = looked.join(cut, ["level", "bin"]).groupBy("_at").agg(F.sum("n").alias("windows"), F.min("lo").alias("first_name"), F.max("hi").alias("last_name"))
    return points.withColumn("_at", micros(at)).join(found, "_at").drop("_at")


def calendar_windows(years: DataFrame, calendar: Mapping[str, tuple[int, int, int, int]]) -> DataFrame:
    """Windows (name, year, opens, closes) of each of ``years`` (year) and campaign of ``calendar``: month and day of the
    first and the last day. One whose last day comes before its first ends in the next year; ``closes`` is the day after."""
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), *[F.lit(x).alias(c) for c, x in zip(("m1", "d1", "m2", "d2"), w, strict=True)]) for n, w in calendar.items()]))
    each = years.select("year", rows.alias("w")).select("year", "w.*")
    across = F.struct("m2", "d2") < F.struct("m1", "d1")
    return each.select("name", "year", F.make_date("year", "m1", "d1").alias("opens"), F.date_add(F.make_date(F.col("year") + across.cast("int"), "m2", "d2"), 1).alias("closes"))


def within_period(df: DataFrame, time: str, file_date: str, start: Column, end: Column) -> DataFrame:
    """Rows of the half-open period from ``start`` to ``end``, with ``effective_time`` and ``time_source``.

    A row without ``time`` falls under its file's date (``file_date``); one that has neither stays, as unknown.
    """
    effective = F.coalesce(F.col(time), F.col(file_date).cast("timestamp"))
    source = F.when(F.col(time).isNotNull(), "event").when(F.col(file_date).isNotNull(), "file_date").otherwise("unknown")
    out = df.withColumns({"effective_time": effective, "time_source": source})
    inside = (F.col("effective_time") >= start.cast("timestamp")) & (F.col("effective_time") < end.cast("timestamp"))
    return out.where(inside | F.col("effective_time").isNull())


def coverage_with_exemptions(days: DataFrame, stopped: DataFrame, start: str, end: str, healthy: int, normal: float = 0.85, least: float = 0.7) -> DataFrame:
    """One row on how the days from ``start`` to ``end`` are covered by ``days`` (day, rows).

    A day is healthy from ``healthy`` rows on, degraded with fewer, else missing. Days of ``stopped`` (day) that aren't
    healthy were stopped on purpose: they are neither degraded nor missing, but still expected. The status follows from
    the share of days with any data.
    """
    spine = days.sparkSession.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("day"))
    held = stopped.select("day").distinct().withColumn("stopped", F.lit(True))
    each = spine.join(days, "day", "left").join(held, "day", "left")
    rows, good = F.coalesce("rows", F.lit(0)), F.coalesce(F.col("rows") >= healthy, F.lit(False))
    counted = ~good & F.col("stopped").isNull()
    out = each.agg(
        F.count(F.lit(1)).alias("expected_days"),
        F.count_if(good).alias("healthy_days"),
        F.count_if(counted & (rows > 0)).alias("degraded_days"),
        F.count_if(counted & (rows == 0)).alias("missing_days"),
        F.count_if(~good & F.col("stopped").isNotNull()).alias("exempt_days"),
        F.array_sort(F.collect_list(F.when(counted & (rows == 0), F.col("day").cast("string")))).alias("missing_dates"),
    )
    raw = (F.col("healthy_days") + F.col("degraded_days")) / F.col("expected_days")
    return out.withColumns({"coverage_ratio": F.round(F.col("healthy_days") / F.col("expected_days"), 4), "raw_ratio": F.round(raw, 4), "status": F.when(raw >= normal, "normal").when(raw >= least, "degraded").otherwise("failing")})
