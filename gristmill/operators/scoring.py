"""Scores from weighted rules, ordered guards, and decisions by threshold. Weights and lexicons are parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[Column, int, str]
Guard = tuple[Column, str, str]


def rule_score(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Sum of the points of the rules that hold, and the array of their reasons in rule order. A null condition is false."""
    held = [(F.coalesce(c, F.lit(False)), p, r) for c, p, r in rules]
    total = sum((F.when(c, F.lit(p)).otherwise(0) for c, p, _ in held), F.lit(0))
    return total.cast("int"), F.array_compact(F.array(*[F.when(c, F.lit(r)) for c, _, r in held]))


def decide(score: Column, keep: float, review: float) -> Column:
    return F.when(score >= keep, "keep").when(score >= review, "review").otherwise("reject")


def first_guard(guards: Sequence[Guard], default: tuple[str, str]) -> Column:
    """struct(outcome, reason) of the first guard that holds, in order."""
    make = lambda a, b: F.struct(F.lit(a).alias("outcome"), F.lit(b).alias("reason"))
    out = make(*default)
    for condition, outcome, reason in reversed(list(guards)):
        out = F.when(F.coalesce(condition, F.lit(False)), make(outcome, reason)).otherwise(out)
    return out


def cap(level: Column, order: Sequence[str], conditions: Sequence[tuple[Column, str, str]]) -> tuple[Column, Column]:
    """``level`` lowered by every condition that holds to that condition's level, and the reasons that did hold.

    ``order`` runs from the highest level to the lowest.
    """
    rank = F.array_position(F.array(*[F.lit(x) for x in order]), level)
    held = [(F.coalesce(c, F.lit(False)), order.index(to) + 1, r) for c, to, r in conditions]
    lowest = F.greatest(rank, *[F.when(c, F.lit(k).cast("long")) for c, k, _ in held], F.lit(0).cast("long")) if held else rank
    return F.element_at(F.array(*[F.lit(x) for x in order]), lowest.cast("int")), F.array_compact(F.array(*[F.when(c, F.lit(r)) for c, _, r in held]))


def weighted_sum(dimensions: dict[str, Column], weights: dict[str, float], scale: int = 1000) -> Column:
    """Weighted sum to ``1 / scale``, rounded half up on integers so that it doesn't hang on binary fractions."""
    total = sum((dimensions[k].cast("long") * F.lit(round(w * scale)) for k, w in weights.items()), F.lit(0).cast("long"))
    return (total / F.lit(float(scale))).cast("double")


def lookup(key: Column, values: dict[str, object], default: object) -> Column:
    """Value of ``key`` in a small map, or ``default``."""
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))
