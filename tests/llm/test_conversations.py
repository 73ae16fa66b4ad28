"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from gristmill.llm import conversations
from gristmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\f\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows):
    for conv, turn, role, text in rows:
        said = lambda x: " " if x is None else str(x)
        kind, role, text = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20, said(role), said(text)
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        if kind:
            yield from [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def fault_of(role, text, seen):
    if not text.strip(SPACE):
        return "blank"
    if (role, text) in seen:
        return "duplicate"
    return "" if text.rstrip(SPACE)[-1] in ".!?" else "truncated"


def best_edits(rows, faults):
    """(cost, audit, roles) of the first cheapest edits: from the last row to the first, states are what was written."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {w: (0, "", []) if w in ("", "a") else None for w in follows}

    def with_inserts(best):
        for _ in range(4):
            for w in follows:
                for to in follows[w].replace("s", ""):
                    if best[to] and (not best[w] or (best[to][0] + 2, "I" + best[to][1]) < best[w][:2]):
                        best[w] = (best[to][0] + 2, "I" + best[to][1], [to, *best[to][2]])
        return best

    best = with_inserts(best)
    for (role, _), fault in zip(reversed(rows), reversed(faults), strict=True):
        now = {}
        for w in follows:
            ways = [(best[w][0] + 3, "D" + best[w][1], [None, *best[w][2]])] if best[w] else []
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if role and role[0] in follows[w] and best[role[0]]:
                    b = best[role[0]]
                    ways.append((b[0] + more, "K" + b[1], [None, *b[2]]))
                for to in follows[w].replace("s", ""):
                    if best[to]:
                        ways.append((best[to][0] + 2 + more, "R" + best[to][1], [to, *best[to][2]]))
            now[w] = min(ways, key=lambda x: x[:2], default=None)
        best = with_inserts(now)
    return best[""]


def plain(table):
    by_conv = {conv: [] for conv, *_ in table}
    for conv, turn, role, text in damaged(table):
        by_conv[conv].append((turn, role, text))
    for conv, rows in by_conv.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {t for t, _, _ in rows if t is not None}
        seen, faults = set(), []
        for _, role, text in rows:
            faults.append(fault_of(role, text, seen))
            seen.add((role, text))
        said = [(role, text) for _, role, text in rows]
        cost, audit, roles = best_edits(said, faults)
        out, at = [], 0
        for letter, role in zip(audit, roles, strict=True):
            name = {"u": "user", "a": "assistant"}.get(role)
            if letter == "I":
                out.append(f"{name}:")
                continue
            if letter in "KR":
                out.append(f"{said[at][0] if letter == 'K' else name}:{said[at][1]}")
            at += 1
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(said, said[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        yield conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def same(rows, table):
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(map(tuple, rows), key=key) == sorted(plain(table), key=key)


def test_repair_of_the_table(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same(QUERIES["op11_conversation_repair"](spark, SF).collect(), table)


@pytest.mark.parametrize("block_rows", [2, 2048])
def test_repair_of_random_conversations(spark, monkeypatch, block_rows):
    monkeypatch.setattr(conversations, "BLOCK_ROWS", block_rows)
    rng = random.Random(7)
    texts = ["Yes.", "No!", "why?", "cut", " \t", "", "A. ", "x.y", None, "é ", "B.\n", " ", "C. "]
    table = []
    for conv in range(300):
        roles = ["user", "assistant", "system", "tool", "", None, "sage"] if conv % 2 else ["user", "assistant", "user", "assistant", "system"]
        table += [(conv, rng.choice([None, *range(9)]) if conv % 3 else k, rng.choice(roles), rng.choice(texts)) for k in range(rng.randint(1, 14))]
    table += [(None, 1, "user", "A."), (None, 2, "user", "B."), (None, None, None, None)]
    frame = spark.createDataFrame(table, SCHEMA).withColumns({"place": F.lit("taken"), "block": F.lit(1), "AUDIT": F.lit(2)}).repartition(3)
    same(conversations.repair(frame, conversations.damage(frame)).collect(), table)


def test_repair_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.repair(empty, conversations.damage(empty)).count() == 0
    gone = next(c for c in range(999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    table = [(gone, 0, "user", "x."), (5, 1, "user", "word " * 300_000 + "." + " " * 300_000), (5, 2, "assistant", "y.")]
    table += [(6, k, ("user", "assistant")[k % 2], f"t{k}.") for k in range(9000)]  # longer than some blocks
    table += [(7, 3, "user", "same.")] * 500
    frame = spark.createDataFrame(table, SCHEMA)
    same(conversations.repair(frame, conversations.damage(frame)).collect(), table)


def test_final_prices_are_distances():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(2, 12)
        arcs = [[(rng.randrange(n), rng.randint(1, 5), "") for _ in range(rng.randint(0, 3))] for _ in range(n)]
        goals = {rng.randrange(n): rng.randint(0, 4) for _ in range(2)}
        far = [goals.get(v, conversations.FAR) for v in range(n)]
        for _ in range(n):
            for v in range(n):
                far[v] = min([far[v], *(c + far[to] for to, c, _ in arcs[v])])
        assert conversations.auction(arcs, goals) == [min(x, conversations.FAR) for x in far]
