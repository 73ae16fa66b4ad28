"""Gates on drafts and reports, and selections for them: issue rows, set comparisons, greedy top rows, cross-day repeats."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions import text as X
from gristmill.operators import lineage


def issues(checks: Sequence[tuple[str, Column]]) -> Column:
    """Names of the checks whose condition holds, in order; a null condition doesn't."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in checks]))


def send_gate(items: Mapping[str, Column]) -> Column:
    """struct(items that fail, may be sent): all items have to hold; a null one fails."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in items.items()]))
    return F.struct(failed.alias("failed"), (F.size(failed) == 0).alias("ok"))


def numbers(text: Column) -> Column:
    """Distinct numbers of a text, as they are written."""
    return F.array_distinct(F.regexp_extract_all(X.nz(text), F.lit(r"(\d+(?:\.\d+)?)"), F.lit(1)))


def unsourced(draft: Column, source: Column) -> Column:
    """Numbers of a draft that its source lacks."""
    return F.array_except(numbers(draft), numbers(source))


def compare_sets(before: Column, after: Column) -> Column:
    """struct(added, dropped, kept) of two arrays as sets."""
    return F.struct(F.size(F.array_except(after, before)).alias("added"), F.size(F.array_except(before, after)).alias("dropped"), F.size(F.array_intersect(before, after)).alias("kept"))


def sentence_stats(text: Column, pattern: str = r"[.!?。！？\n]", long_from: int = 40) -> Column:
    """struct(sentences, chars, longest, long_ones) of a script."""
    lengths = F.filter(F.transform(F.split(X.nz(text), pattern), lambda s: F.length(F.trim(s))), lambda n: n > 0)
    return F.struct(
        F.size(lengths).alias("sentences"),
        F.aggregate(lengths, F.lit(0), lambda a, n: a + n).alias("chars"),
        F.coalesce(F.array_max(lengths), F.lit(0)).alias("longest"),
        F.size(F.filter(lengths, lambda n: n > long_from)).alias("long_ones"),
    )


def merge_verdicts(by_rule: Column, reviewed: Column, score: Column, least: int = 60) -> Column:
    """A review's verdict unless a rule forbids: ``fail`` by rule stays, else the review's, else by score."""
    return F.when(by_rule == "fail", "fail").otherwise(F.coalesce(reviewed, F.when(score >= least, "pass").otherwise("revise")))


def distinct_top(df: DataFrame, group: str, order: Sequence[str], entities: str, rows: int = 3) -> DataFrame:
    """The first ``rows`` rows of each group, by ``order``, of which no two share an entity; then, if these are too few,
    the first of the others. Adds ``place``. A top-k report.

    Rows of one set of entities exclude each other, so of each set only the first ``rows`` can be chosen: a group is cut
    to that before it is gathered, and the greedy choice runs over sets, not rows.
    """
    who = F.array_join(F.array_sort(F.array_distinct(F.coalesce(entities, F.array().cast("array<string>")))), "|")
    cut = df.withColumn("_who", who).withColumn("_n", F.row_number().over(Window.partitionBy(group, "_who").orderBy(*order))).where(F.col("_n") <= rows).drop("_n", "_who")
    row = F.struct(*order, F.struct(*df.columns).alias("row"))
    held = cut.groupBy(group).agg(F.array_sort(F.collect_list(row)).alias("all"))
    kind = held.schema["all"].dataType.simpleString()
    none = F.array().cast("array<string>")
    start = F.struct(F.array().cast(kind).alias("chosen"), none.alias("seen"))

    def take(acc: Column, x: Column) -> Column:
        its = F.coalesce(x["row"][entities], none)
        free = (F.size(acc["chosen"]) < rows) & ~F.coalesce(F.arrays_overlap(acc["seen"], its), F.lit(False))
        return F.when(free, F.struct(F.concat(acc["chosen"], F.array(x)).alias("chosen"), F.concat(acc["seen"], its).alias("seen"))).otherwise(acc)

    held = held.withColumn("a", F.aggregate("all", start, take)).withColumn("picked", F.col("a.chosen"))
    filled = F.slice(F.concat("picked", F.filter("all", lambda x: ~F.array_contains(F.col("picked"), x))), 1, rows)
    return held.select(F.posexplode(filled).alias("place", "x")).select("x.row.*", (F.col("place") + 1).alias("place"))


#: Topics of a day are dealt into tiles of about so many sets of characters.
TILE = 8192


def _bits(sets: pa.ListArray, other: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Bits of both lists of sets, a bit for each character that both lists know."""
    shared = pc.unique(sets.flatten())
    shared = shared.filter(pc.is_in(shared, pc.unique(other.flatten())))
    out = []
    for part in (sets, other):
        row, bit = pc.list_parent_indices(part), pc.index_in(part.flatten(), shared)
        known = bit.is_valid()
        flat = np.zeros((len(part), 64 * max(1, -(-len(shared) // 64))), bool)
        flat[row.filter(known).to_numpy(), bit.filter(known).to_numpy()] = True
        out.append(np.packbits(flat, axis=1).view(np.uint64))
    return out[0], out[1]


def _met(sets: pa.ListArray, other: pa.ListArray, least: float) -> np.ndarray:
    """Places in ``sets`` of those with Jaccard similarity ``least`` to one of ``other``; a set is done with at its first."""
    bits, bits_o = _bits(sets, other)
    n, n_o = (pc.list_value_length(x).to_numpy(zero_copy_only=False).astype(np.int32) for x in (sets, other))
    done = np.zeros(len(sets), bool)
    step = 64
    at = 0
    open_ = np.arange(len(sets))
    while at < len(other) and len(open_):
        for part in np.array_split(open_, max(1, len(open_) * step >> 18)):
            common = np.zeros((len(part), min(step, len(other) - at)), np.int32)
            for w in range(bits.shape[1]):
                common += np.bitwise_count(bits[part, w, None] & bits_o[at : at + step, w])
            with np.errstate(invalid="ignore"):
                done[part] = (common / (n[part, None] + n_o[at : at + step] - common) >= least).any(axis=1)
        open_, at, step = open_[~done[open_]], at + step, min(2 * step, 2048)
    return np.flatnonzero(done)


def _alike_letters(t: DataFrame, y: DataFrame, least: float) -> DataFrame:
    """Topics (day, letters) of ``t`` whose characters have Jaccard similarity ``least`` with those of one of ``y`` (both
    day, letters: arrays, distinct rows).

    The sets of a day are dealt into tiles, and each tile of ``t`` meets each of ``y`` in a task of bounded size, as bits.
    One similar set is enough, so a set leaves the tile when its first is found; in a day with many sets that is soon.
    """
    tiles = lambda df, name: df.where("day is not null").groupBy("day").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias(name))
    known = tiles(t, "tiles_t").join(tiles(y, "tiles_y"), "day")

    def dealt(df: DataFrame, own: str, other: str, side: int) -> DataFrame:
        at = df.join(known, "day").withColumn(own, F.pmod(F.xxhash64("letters"), F.col(own)).cast("int"))
        return at.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).select("day", "tiles_t", "tiles_y", F.lit(side).alias("side"), "letters")

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side")
        now, old = (table.filter(pc.equal(side, k)).select(["day", "letters"]) for k in (0, 1))
        if not len(now) or not len(old):
            return now.slice(0, 0)
        return now.take(pa.array(_met(now.column("letters").combine_chunks(), old.column("letters").combine_chunks(), least)))

    schema = f"day {t.schema['day'].dataType.simpleString()}, letters array<string>"
    met = lineage.spread(dealt(t, "tiles_t", "tiles_y", 0).union(dealt(y, "tiles_y", "tiles_t", 1)), "day", "tiles_t", "tiles_y")
    return met.groupBy("day", "tiles_t", "tiles_y").applyInArrow(run, schema).distinct()


def cross_day(today: DataFrame, yesterday: DataFrame, common: Sequence[str] = (), least: float = 0.6) -> DataFrame:
    """Rows (id) of ``today`` that ``yesterday`` told already; both have id, day (of telling), key, fact, topic, entities
    and title.

    Told already is an equal key or fact, a topic (of five characters or more) that shares ``least`` of its characters,
    two entities that aren't ``common`` ones, or an equal beginning of the title (20 characters). Each test is a join on
    equal values, days among them; topics meet in tiles, as bits of their characters.
    """
    columns = ["id", "day", "key", "fact", "topic", "entities", "title"]
    t = lineage.cut(today.select(*columns).withColumn("day", F.col("day").cast("date")))
    y = lineage.cut(yesterday.select(*columns).withColumn("day", F.date_add(F.col("day").cast("date"), 1)))
    equal = lambda a, b: t.select("id", "day", a.alias("v")).where("v <> ''").join(y.select("day", b.alias("v")).distinct(), ["day", "v"], "left_semi").select("id")
    by_value = [equal(F.col(c), F.col(c)) for c in ("key", "fact")] + [equal(F.substring("title", 1, 20), F.substring("title", 1, 20))]
    each = lambda df: df.select("id", "day", F.explode(F.array_except(F.array_distinct("entities"), F.array(*map(F.lit, common)) if common else F.array().cast("array<string>"))).alias("e"))
    known = each(y).select("day", "e").distinct()
    by_entity = each(t).join(known, ["day", "e"]).groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n >= 2").select("id")
    with_letters = lambda df: df.where(F.length("topic") >= 5).withColumn("letters", F.array_sort(F.array_distinct(F.regexp_extract_all("topic", F.lit("(?s)."), F.lit(0)))))
    kinds = lambda df: with_letters(df).select("day", "letters").distinct()
    by_topic = with_letters(t).join(_alike_letters(kinds(t), kinds(y), least), ["day", "letters"], "left_semi").select("id")
    out = by_topic
    for part in (*by_value, by_entity):
        out = out.union(part)
    return out.distinct()
