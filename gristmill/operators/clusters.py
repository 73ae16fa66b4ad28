"""First-fit clusters by four tests, and gapless numbers in an order, without a group that one task must hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions import text as X
from gristmill.operators import dedup, lineage


def first_fit_groups(members: DataFrame, near: DataFrame) -> DataFrame:
    """First fit over groups: (place, founder) for ``members`` (place, grp), taken in order of ``place``.

    Rows fit if they share a group or their groups are ``near`` (grp, other; both ways, without a group itself). A row
    joins the first founder before it that it fits, else it is one. Rows of one group all fit each other.

    All rows are decided in rounds. Of each group only its first undecided row and its first founder matter, so a round is
    two aggregates and joins with one row a group; no pairs of rows are made, and no group is held by a task. A row is
    decided once no undecided row before it could still come in first: rows without one become founders, the others join.
    The first undecided row of all is decided in each round; how many rounds it takes is how long chains are in which each
    row waits for the one before.
    """
    open_rows = lineage.cut(members.select("place").distinct().withColumn("state", F.lit("open")))
    founders, settled, turn = None, [], 0
    members, near = lineage.cut(members.distinct()), lineage.cut(near.distinct())
    while not open_rows.isEmpty():
        # founders keep their state; members of clusters can be forgotten
        known = open_rows if founders is None else open_rows.unionByName(founders)
        own = members.join(known, "place").groupBy("grp").agg(F.min(F.when(F.col("state") == "open", F.col("place"))).alias("u"), F.min(F.when(F.col("state") == "founder", F.col("place"))).alias("f"))
        around = own.unionByName(near.join(own.withColumnRenamed("grp", "other"), "other").select("grp", "u", "f")).groupBy("grp").agg(F.min("u").alias("u"), F.min("f").alias("f"))
        before = lambda c: F.min(F.when(F.col(c) < F.col("place"), F.col(c))).alias(c)
        seen = members.join(open_rows, "place").join(around, "grp", "left").groupBy("place").agg(before("u"), before("f"))
        state = F.when(F.col("f").isNotNull() & (F.col("u").isNull() | (F.col("u") > F.col("f"))), "member").when(F.col("f").isNull() & F.col("u").isNull(), "founder").otherwise("open")
        decided = lineage.cut(seen.select("place", state.alias("state"), "f"))
        joined = decided.where("state = 'member'").select("place", F.col("f").alias("founder"))
        begun = decided.where("state = 'founder'").select("place", "state")
        settled.append(joined)
        founders = begun if founders is None else founders.unionByName(begun)
        if turn % 4 == 3:  # keeps plans short
            settled, founders = [lineage.cut(_all(settled))], lineage.cut(founders)
        open_rows, turn = decided.where("state = 'open'").select("place", "state"), turn + 1
    own = members.select("place", F.col("place").alias("founder")).limit(0) if founders is None else founders.select("place", F.col("place").alias("founder"))
    return _all([own, *settled])


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def first_fit_clusters(rows: DataFrame, period: str, least_entities: float = 0.6, least_titles: float = 0.65) -> DataFrame:
    """``rows`` (place, ``period``, key, fact, entities, actions, title) with ``founder``: the place of their cluster's first row.

    Within a period, in order of ``place`` (unique numbers), a row joins the first founder with the same key, the same
    fact (null and empty facts are none), entities alike (Jaccard ``least_entities``) with an action in common, or a title
    alike (equal, or Jaccard ``least_titles`` of its three-character grams; null and empty titles are like none). A cluster
    is known by its founder alone. Similar titles and entity sets are found among distinct ones, by prefix-filtered joins.
    """
    name = lambda kind, *parts: F.md5(F.to_json(F.struct(F.lit(kind).alias("kind"), F.col(period).cast("string").alias("period"), *[p.alias(f"p{k}") for k, p in enumerate(parts)]), {"ignoreNullFields": "false"}))
    rows = lineage.cut(rows.withColumn("entities", F.array_sort(F.array_distinct(F.coalesce("entities", F.array().cast("array<string>"))))))
    titled = rows.where(F.coalesce(F.col("title"), F.lit("")) != "")
    of_set = rows.where((F.size("entities") > 0) & (F.size("actions") > 0)).withColumn("set", name("set", F.col("entities"))).select("place", period, "set", "entities", F.explode(F.array_distinct("actions")).alias("action"))
    of_set = of_set.withColumn("grp", name("entities", F.col("set"), F.col("action")))
    members = [
        rows.select("place", name("key", F.col("key")).alias("grp")),
        rows.where(F.coalesce(F.col("fact"), F.lit("")) != "").select("place", name("fact", F.col("fact")).alias("grp")),
        titled.select("place", name("title", F.col("title")).alias("grp")),
        of_set.select("place", "grp"),
    ]
    dated = lambda grams: F.transform(grams, lambda g: F.concat(F.col(period).cast("string"), F.lit(":"), g))
    titles = titled.select(name("title", F.col("title")).alias("id"), dated(X.char_ngrams(F.col("title"))).alias("grams")).dropDuplicates(["id"])
    sets = of_set.select(F.col("set").alias("id"), dated(F.col("entities")).alias("grams")).dropDuplicates(["id"])
    both = lambda pairs: pairs.select(F.col("a").alias("grp"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("grp"), F.col("a").alias("other")))
    alike = both(dedup.similar_pairs(lineage.cut(titles), "id", "grams", least_titles))
    groups = of_set.select("set", "action", "grp").distinct()
    of = lambda c: groups.select(F.col("set").alias(f"set_{c}"), "action", F.col("grp").alias(c))
    pairs = both(dedup.similar_pairs(lineage.cut(sets), "id", "grams", least_entities)).withColumnsRenamed({"grp": "set_grp", "other": "set_other"})
    near = pairs.join(of("grp"), "set_grp").join(of("other"), ["set_other", "action"]).select("grp", "other")
    founders = first_fit_groups(_all(members), alike.unionByName(near))
    return rows.join(founders, "place")


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column], number: str = "number") -> DataFrame:
    """``df`` with gapless numbers from 1 in each ``group``, in ``order`` (and ties in any order).

    Rows are sorted in ranges, so a large group lies in several tasks; each counts its own rows of a group, and the counts
    of the ranges before it are added.
    """
    keys = [F.col(c) for c in group]
    placed = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn("_place", F.monotonically_increasing_id())
    placed = lineage.cut(placed.withColumn("_range", F.shiftright("_place", 33)))
    ranges = placed.groupBy(*group, "_range").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(*[F.col(c).alias(f"_g{k}") for k, c in enumerate(group)], F.col("_range").alias("_of"), "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    same = F.col("_range") == F.col("_of")
    for k, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{k}"))
    return placed.join(offsets, same).select(*[placed[c] for c in df.columns], (F.col("_place") - F.col("_first") + F.col("_before") + 1).alias(number))
