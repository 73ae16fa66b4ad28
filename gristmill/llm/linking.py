"""Components of a similarity graph from shared keys, without comparing all members of a key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import components, discard, stored


def _labelled(rows: DataFrame, comps: DataFrame | None, end: str, label: str) -> DataFrame:
    """``rows`` with the component of their column ``end`` so far, which is the id itself where it has no link."""
    if comps is None:
        return rows.withColumn(label, F.col(end))
    named = comps.select(F.col("id").alias(end), F.col("component").alias(label))
    return rows.join(named, end, "left").withColumn(label, F.coalesce(label, end))


def link_by_keys(keys: DataFrame, within: Callable[[DataFrame], DataFrame], confirm: Callable[[DataFrame], DataFrame] | None = None, rounds: int = 2, remaining: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Components (id, component) of the links among ids that share a key; ids without links may be missing.

    ``keys`` has key, id and home; two ids are candidates if they share a key that one of them is at home in.
    ``within`` keeps those of some pairs (a, b) that are near enough and adds a ``distance``; ``confirm``, if given,
    decides on what is left at a higher price.

    Every id is first compared with one member of each of its keys, the nearest found being confirmed first; pairs that
    lie in one component by then need no more work. Keys that still hold several components are compared with other
    members in further rounds, which merges large groups at linear cost. What is open when a round brings nothing new
    is compared pair by pair, between components only, so that no link is lost. ``remaining``, if given, names those
    pairs (a, b) of the open rows (key, id, home, c: component so far) that can be links by some exact rule.
    """
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("home"), F.col("id"))).alias("hub")).where("n > 1 and hub is not null")
    keys = stored(keys.join(shared, "key").select("key", "id", "home", "hub"), "keys")
    edges: DataFrame | None = None
    written: list[DataFrame] = [keys]
    comps: DataFrame | None = None
    tested: DataFrame | None = None

    def add(new: DataFrame) -> bool:
        nonlocal edges, comps
        new = stored(new.select("a", "b"), "links")
        written.append(new)
        if new.isEmpty():
            return False
        edges = new if edges is None else edges.union(new)
        before, comps = comps, stored(components(edges), "components")
        written.append(before)
        return True

    def settle(pairs: DataFrame) -> bool:
        nonlocal tested
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        found = stored(within(pairs), "pairs")
        written.append(found)
        tested = found.select("a", "b") if tested is None else tested.union(found.select("a", "b"))
        if confirm is None:
            return add(found)
        if comps is not None:  # pairs between components, each of which may join two
            return add(confirm(found.select("a", "b")))
        nearest = found.groupBy("a").agg(F.min(F.struct("distance", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
        some = add(confirm(nearest))
        open_ = _labelled(_labelled(found, comps, "a", "ca"), comps, "b", "cb").where("ca <> cb")
        return add(confirm(open_.select("a", "b").join(nearest, ["a", "b"], "left_anti"))) or some

    settle(keys.where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct())
    for r in range(rounds + 1):
        rows = _labelled(keys.select("id", "key", "home"), comps, "id", "c")
        spread = rows.groupBy("key").agg(F.min("c").alias("least"), F.max("c").alias("most"), F.count(F.lit(1)).alias("n")).where("least <> most and n > 2")
        rows = stored(rows.join(spread.select("key"), "key"), "open-keys")
        written.append(rows)
        if rows.isEmpty():
            break
        if r < rounds:
            member = F.when(F.col("home"), F.struct(F.xxhash64(F.lit(r), "id").alias("r"), "id", "c"))
            hubs = rows.groupBy("key").agg(F.min(member).alias("m")).select("key", F.col("m.id").alias("hub"), F.col("m.c").alias("hub_c"))
            pairs = rows.join(hubs, "key").where("c <> hub_c").select(F.greatest("id", "hub").alias("a"), F.least("id", "hub").alias("b")).distinct()
            if settle(pairs):
                continue
        if remaining is not None:
            settle(remaining(rows))
            break
        other = rows.select("key", F.col("id").alias("b"), F.col("c").alias("cb"), F.col("home").alias("hb"))
        settle(rows.join(other, "key").where("c <> cb and b < id and (home or hb)").select(F.col("id").alias("a"), "b").distinct())
        break
    if comps is None:
        comps = stored(keys.select("id", F.col("id").alias("component")).limit(0), "components")
    discard(*written)
    return comps
