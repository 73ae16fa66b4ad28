"""Cheapest repair of a conversation's structure, by an auction for shortest paths.

A conversation's rows and the states of the pattern ``(s?(ua)+)?`` span a lattice: node (i, state) stands before row i, and
arcs keep, rerole or delete that row or insert one. Costs are integers and no cycle is free, as the auction needs. Each
node has a price, never above the cost of an arc out of it plus the price of its end. A path grows along an arc where both
are equal; where there is none, the price of its end rises to the least of those sums and the path gives that node up.
Once a price is final it is the distance to the goal, and the tight arcs (price = cost + price of the end) are those of
the cheapest repairs. Following the tight arc of the least letter from the start gives the first of them in ASCII order.

A conversation is cut into blocks of rows. Auctions within blocks give the cost from each state to each, one auction over
the blocks gives the prices between them, and the tight arcs are traced block by block, so that no task holds the rows of
a whole conversation. Only the digest reads a conversation's texts one after the other, as a hash must; they stream by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from gristmill.llm.common import stored

RATE = 20
BLANK = "[^\\x20\\x09-\\x0D]"
#: Rows of a conversation in one block, a power of two.
BLOCK_ROWS = 2048
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
FAR = 1 << 60

#: States of the pattern: nothing yet, after the system row, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The role that an inserted or reroled row takes in each state; each has one.
TURN = "uuau"
ACCEPTED = (0, FAR, FAR, 0)


def damage(conversations: DataFrame, rate: int = RATE) -> DataFrame:
    """Rows (conv_id, turn, role, text) of ``conversations``, damaged as the checksum of ``conv_id:turn`` says.

    Of ``rate`` values 0 drops a row, 1 empties its text, 2 takes its sentence marks, 3 repeats it, 4 makes it a user's.
    Null ids, turns, roles and texts read as one space, but stay null as ids and turns.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % rate
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"))
    rows = rows.withColumn("kind", kind).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"))
    return rows.drop("copy")


def _head(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("-")


def ordered_rows(damaged: DataFrame) -> DataFrame:
    """``damaged`` with ``place``, which rises by conversation and turn (nulls first; ties by role and text), a row's head
    (its role's initial) and own fault. Ranges of rows are sorted apart, so that a long conversation spreads over tasks."""
    key = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role")]
    rows = damaged.repartitionByRange(*key, F.substring("text", 1, 64)).sortWithinPartitions(*key, "text")
    last = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\f\r")), -1, 1)
    fault = F.when(~F.col("text").rlike(BLANK), "b").when(~last.isin(".", "!", "?"), "t").otherwise("k")
    said = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.length("role").cast("string"), "role", "text")
    return stored(rows.select("*", F.monotonically_increasing_id().alias("place"), _head(F.col("role")).alias("head"), fault.alias("fault"), F.sha2(said, 256).alias("said")), "rows")


def blocks_of(rows: DataFrame) -> DataFrame:
    """Blocks (conv_id, block, start, heads, faults) of ``rows``, with repeats of earlier rows as faults ``d``."""
    first = rows.groupBy("said").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("said", "first")
    faults = rows.select("conv_id", "place", "head", "fault", "said").join(first, "said", "left")
    faults = faults.withColumn("fault", F.when((F.col("fault") != "b") & (F.col("place") > F.col("first")), "d").otherwise(F.col("fault")))
    blocks = faults.groupBy("conv_id", F.shiftright("place", BLOCK_ROWS.bit_length() - 1).alias("block")).agg(F.min("place").alias("start"), F.sort_array(F.collect_list(F.struct("place", "head", "fault"))).alias("rows"))
    line = lambda c: F.array_join(F.transform("rows", lambda r: r[c]), "")
    return stored(blocks.select("conv_id", "block", "start", line("head").alias("heads"), line("fault").alias("faults")), "blocks")


Arcs = list[list[tuple[int, int, str]]]


def lattice_arcs(heads: str, faults: str, last: bool) -> Arcs:
    """Arcs (end, cost, letter) out of each node 4 i + state; rows can be inserted after the last row if ``last``."""
    out: Arcs = []
    for i in range(len(heads) + 1):
        for state in range(4):
            arcs = []
            if i < len(heads):
                arcs.append((4 * (i + 1) + state, DELETE, "D"))
                if faults[i] in "kt":
                    more = TRUNCATED * (faults[i] == "t")
                    if heads[i] in STEPS[state]:
                        arcs.append((4 * (i + 1) + STEPS[state][heads[i]], KEEP + more, "K"))
                    arcs.append((4 * (i + 1) + STEPS[state][TURN[state]], REROLE + more, "R"))
            if i < len(heads) or last:
                arcs.append((4 * i + STEPS[state][TURN[state]], INSERT, "I"))
            out.append(arcs)
    return out


def auction(arcs: Arcs, goals: dict[int, int]) -> list[int]:
    """Final prices of all nodes: their distances to the goals, whose own prices are given, or FAR where none is reached.

    Origins are taken from the last node to the first. A path from an origin is extended and contracted until it ends at
    a node whose price is final; then its arcs are tight and the prices along it are final too.
    """
    n = len(arcs)
    back: list[list[int]] = [[] for _ in range(n)]
    for node, out in enumerate(arcs):
        for end, _, _ in out:
            back[end].append(node)
    reached, todo = set(goals), [*goals]
    while todo:
        for node in back[todo.pop()]:
            if node not in reached:
                reached.add(node)
                todo.append(node)
    price, final = [0] * n, [False] * n
    ways = [[(end, cost) for end, cost, _ in arcs[v] if end in reached] for v in range(n)]
    for origin in range(n - 1, -1, -1):
        if origin not in reached:
            price[origin], final[origin] = FAR, True
        path = [origin]
        while not final[path[-1]]:
            node = path[-1]
            least, to = min(((cost + price[end], end) for end, cost in ways[node]), default=(FAR, -1))
            if goals.get(node, FAR) <= least:
                least, to = goals[node], node
            if price[node] < least:
                price[node] = least
                if len(path) > 1:
                    path.pop()
            elif to == node:
                final[node] = True
            else:
                path.append(to)
        for node in path:
            final[node] = True
    return price


@lru_cache(maxsize=4096)
def block_costs(heads: str, faults: str) -> list[int]:
    """Least cost from each state before a block to each state after it (16 numbers), without rows inserted after it."""
    arcs, out = lattice_arcs(heads, faults, False), [FAR] * 16
    for goal in range(4):
        price = auction(arcs, {4 * len(heads) + goal: 0})
        for state in range(4):
            out[4 * state + goal] = price[state]
    return out


def prices_between(costs: list[list[int]]) -> list[list[int]]:
    """Prices of the four states before each block and after the last, where rows can be inserted, by an auction."""
    arcs: Arcs = []
    for k in range(len(costs) + 1):
        for state in range(4):
            out = [(4 * (k + 1) + to, costs[k][4 * state + to], "") for to in range(4) if costs[k][4 * state + to] < FAR] if k < len(costs) else [(4 * k + STEPS[state][TURN[state]], INSERT, "I")]
            arcs.append(out)
    end = 4 * len(costs)
    price = auction(arcs, {end + s: c for s, c in enumerate(ACCEPTED) if c < FAR})
    return [price[4 * k : 4 * k + 4] for k in range(len(costs) + 1)]


@lru_cache(maxsize=4096)
def trace(heads: str, faults: str, after: tuple[int, ...], last: bool) -> list[tuple[int, str, str]]:
    """For each state before a block: the state after it, the letters of the first cheapest edits, and the roles of
    inserted and reroled rows (``-`` for others). ``after`` are the prices of the states behind the block."""
    arcs, end = lattice_arcs(heads, faults, last), 4 * len(heads)
    goals = {end + s: (ACCEPTED[s] if last else c) for s, c in enumerate(after) if (ACCEPTED[s] if last else c) < FAR}
    price, out = auction(arcs, goals), []
    for state in range(4):
        node, letters, roles = state, [], []
        while price[state] < FAR and not (node >= end and goals.get(node, FAR) == price[node]):
            letter, node = min((letter, to) for to, cost, letter in arcs[node] if cost + price[to] == price[node])
            letters.append(letter)
            roles.append("ua"[node % 4 == ASSISTANT] if letter in "IR" else "-")
        out.append((node % 4, "".join(letters), "".join(roles)))
    return out


def _illegal(heads: str) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:], strict=False))


def _mapped(df: DataFrame, schema: str, f) -> DataFrame:
    """``df`` through ``f``, which takes a row as a dict and yields rows as tuples."""
    types = df.sparkSession.createDataFrame([], schema).schema
    arrow, names = to_arrow_schema(types), types.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = [out for row in batch.slice(at, 500).to_pylist() for out in f(row)]
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=arrow)

    return df.mapInArrow(run, schema)


def _solve(row: dict) -> Iterator[tuple]:
    heads, faults = row["heads"], row["faults"]
    counts = [faults.count(x) for x in "bdt"]
    yield (row["conv_id"], row["block"], row["start"], heads, faults, block_costs(heads, faults), *counts, _illegal(heads))


def _price(row: dict) -> Iterator[tuple]:
    blocks = row["blocks"]
    prices = prices_between([b["costs"] for b in blocks])
    illegal = sum(_illegal(x["heads"][-1] + y["heads"][0]) for x, y in zip(blocks, blocks[1:], strict=False))
    for k, b in enumerate(blocks):
        yield row["conv_id"], b["block"], prices[k + 1], k == len(blocks) - 1, prices[0][START] if k == 0 else 0, illegal if k == 0 else 0


def _trace(row: dict) -> Iterator[tuple]:
    traced = trace(row["heads"], row["faults"], tuple(row["after"]), row["last"])
    ends, letters, roles = zip(*traced, strict=True)
    yield row["conv_id"], row["block"], row["start"], list(ends), list(letters), list(roles)


def _follow(row: dict) -> Iterator[tuple]:
    state = START
    for b in row["blocks"]:
        yield row["conv_id"], b["block"], b["start"], b["letters"][state], b["roles"][state]
        state = b["ends"][state]


#: Fixed names of the roles by their initials.
ROLES = {"u": "user", "a": "assistant"}


def _digests(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``rows`` under ``edits`` (conv_id, start, letters, roles).

    Each block's edits come just before its rows; a conversation's texts stream through the task that hashes them.
    """
    one = rows.select("conv_id", "place", F.lit(1).alias("kind"), "role", "text")
    both = edits.select("conv_id", F.col("start").alias("place"), F.lit(0).alias("kind"), F.col("roles").alias("role"), F.col("letters").alias("text")).unionByName(one)
    both = both.repartition("conv_id").sortWithinPartitions("conv_id", "place", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen, digest, lines, todo = None, False, hashlib.sha256(), 0, iter(())

        def add(role: str, text: str) -> None:
            nonlocal lines
            digest.update((("\n" if lines else "") + role + ":").encode())
            digest.update(text.encode())
            lines += 1

        def next_edit() -> tuple[str, str]:
            """Writes the rows to insert here; the edit of the next row, if there is one."""
            for letter, role in todo:
                if letter != "I":
                    return letter, role
                add(ROLES[role], "")
            return "", ""

        for batch in batches:
            out = []
            for conv, kind, role, text in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3, 4)), strict=True):
                if kind == 0:
                    next_edit()
                    if seen and conv != now:
                        out.append((now, digest.hexdigest()))
                        digest, lines = hashlib.sha256(), 0
                    now, seen, todo = conv, True, iter(zip(text, role, strict=True))
                    continue
                letter, to = next_edit()
                if letter != "D":
                    add(ROLES[to] if letter == "R" else role, text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int64()), pa.array([d for _, d in out])], ["conv_id", "repaired_sha256"])
        if seen:
            next_edit()
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([digest.hexdigest()])], ["conv_id", "repaired_sha256"])

    return both.mapInArrow(run, "conv_id long, repaired_sha256 string")


def repair(conversations: DataFrame, damaged: DataFrame) -> DataFrame:
    """Faults and cheapest repair of each conversation of ``conversations``, whose rows are now those of ``damaged``.

    Returns conv_id, gaps (turns missing between the first and the last), blank, duplicate and truncated (rows by their
    first fault), illegal (neighbours whose initials aren't su, ua or au), cost, audit (letters of the edits: Keep, Rerole,
    Delete, Insert) and repaired_sha256 (of the repaired rows ``role:text``, joined by newlines). Rows come by turn, nulls
    first, at a tie by role and text; of equal rows all but one are duplicates. A conversation without rows has zeros, an
    empty audit and the digest of nothing; a null conv_id is a conversation of its own. An empty role has no initial and
    can't be kept. Very long texts and conversations are read whole; an audit has a letter for each row. Other columns are
    ignored; an empty table gives no rows.
    """
    rows = ordered_rows(damaged)
    solved = stored(_mapped(blocks_of(rows), "conv_id long, block long, start long, heads string, faults string, costs array<long>, blank long, duplicate long, truncated long, illegal long", _solve), "solved")
    ends = F.concat(F.substring("heads", 1, 1), F.substring("heads", -1, 1))
    of_conv = solved.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "costs", ends.alias("heads")))).alias("blocks"))
    prices = stored(_mapped(of_conv, "conv_id long, block long, after array<long>, last boolean, cost long, across long", _price), "prices")
    both = solved.join(prices.withColumnsRenamed({"conv_id": "c", "block": "b"}), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")))
    traced = _mapped(both.select("conv_id", "block", "start", "heads", "faults", "after", "last"), "conv_id long, block long, start long, ends array<int>, letters array<string>, roles array<string>", _trace)
    in_order = traced.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "start", "ends", "letters", "roles"))).alias("blocks"))
    edits = stored(_mapped(in_order, "conv_id long, block long, start long, letters string, roles string", _follow), "edits")
    audits = edits.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "letters"))), lambda e: e["letters"]), "").alias("audit"))
    turns = rows.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"))
    counts = solved.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    costs = prices.groupBy("conv_id").agg(F.sum("cost").alias("cost"), F.sum("across").alias("across"))
    out = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for part in (turns, counts, costs, audits, _digests(rows, edits)):
        part = part.withColumnRenamed("conv_id", "c")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    illegal = (F.coalesce("illegal", F.lit(0)) + F.coalesce("across", F.lit(0))).cast("long").alias("illegal")
    return out.select("conv_id", zero("gaps"), zero("blank"), zero("duplicate"), zero("truncated"), illegal, zero("cost"), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
