"""Rewriting of reports: rules as data, applied until nothing changes, and rewrites that follow lines and tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.text import nz

_RULER = re.compile(r"\s*\|[\s:\-|]+\|\s*")


def sanitize(text: Column, rules: Sequence[tuple[str, str]], passes: int = 3) -> Column:
    """struct(text, counts, settled): ``text`` under ``rules`` (pattern, replacement), in order, and again until nothing
    changes, at most ``passes`` times.

    ``counts`` has for each rule how many places it changed; ``settled`` tells whether the last pass changed nothing or
    one more would not. Null texts stay null. All is one expression; a rule is a row of an array.
    """
    table = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(r).alias("r")) for p, r in rules])

    def apply(state: Column, rule: Column) -> Column:
        return F.struct(F.regexp_replace(state["text"], rule["p"], rule["r"]).alias("text"), F.concat(state["counts"], F.array(F.regexp_count(state["text"], rule["p"]))).alias("counts"))

    def once(state: Column) -> Column:
        fresh = F.struct(state["text"].alias("text"), F.array().cast("array<int>").alias("counts"))
        return F.aggregate(table, fresh, apply)

    def again(state: Column, _: Column) -> Column:
        # a one-element array names the result of a pass, so that it is computed once
        made = F.transform(F.array(once(state)), lambda new: F.struct(new["text"].alias("text"), F.zip_with(state["counts"], new["counts"], lambda a, b: a + b).alias("counts"), (new["text"] == state["text"]).alias("settled")))
        return F.when(state["settled"], state).otherwise(F.get(made, F.lit(0)))

    start = F.struct(text.alias("text"), F.array_repeat(F.lit(0), len(rules)).alias("counts"), F.lit(False).alias("settled"))
    done = F.aggregate(F.sequence(F.lit(1), F.lit(passes)), start, again)
    return F.when(text.isNotNull(), F.get(F.transform(F.array(done), lambda d: F.struct(d["text"].alias("text"), d["counts"].alias("counts"), (d["settled"] | (once(d)["text"] == d["text"])).alias("settled"))), F.lit(0)))


def joined_letters(text: str | None, least: int = 5) -> str | None:
    """``text`` with runs of lines of one character put together, where a run has ``least`` or more of them.

    One blank line within a run is skipped, two begin a new paragraph. Headings and other lines end a run.
    """
    if not text:
        return text
    out: list[str] = []
    run: list[str] = []

    def end() -> None:
        if sum(len(x.strip()) == 1 for x in run) < least:
            out.extend(run)
        else:
            parts = re.split(r"\n\n\n+", "\n".join(x.strip() for x in run).strip("\n"))
            out.append("\n\n".join(p.replace("\n", "") for p in parts))
        run.clear()

    for line in text.split("\n"):
        bare = line.strip()
        if len(bare) > 1 or bare == "#":
            end()
            out.append(line)
        else:
            run.append(line)
    end()
    return "\n".join(out)


def _cells(row: str) -> list[str]:
    return row.strip().removeprefix("|").removesuffix("|").split("|")


def without_empty_columns(text: str | None, heads: Sequence[str]) -> str | None:
    """``text`` without the columns of its Markdown tables whose head is one of ``heads`` and whose cells are all blank.

    A table is a line that begins with a bar, a line of dashes and all lines with bars that follow. Rows of too few cells
    count as blank there; a table that would lose all columns goes whole.
    """
    if not text:
        return text
    lines, out, at = text.split("\n"), [], 0
    while at < len(lines):
        if not (lines[at].lstrip().startswith("|") and at + 1 < len(lines) and _RULER.fullmatch(lines[at + 1])):
            out.append(lines[at])
            at += 1
            continue
        end = at + 2
        while end < len(lines) and lines[end].lstrip().startswith("|"):
            end += 1
        rows = [_cells(x) for x in lines[at:end]]
        gone = {k for k, name in enumerate(rows[0]) if name.strip() in heads and not any(r[k].strip() for r in rows[2:] if k < len(r))}
        if not gone:
            out.extend(lines[at:end])
        elif len(gone) < len(rows[0]):
            out.extend("|" + "|".join(c for k, c in enumerate(r) if k not in gone) + "|" for r in rows)
        at = end
    return "\n".join(out)


def join_letters(text: Column, least: int = 5) -> Column:
    """``joined_letters`` of a column."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: joined_letters(t, least))

    return run(text)


def drop_empty_columns(text: Column, heads: Sequence[str]) -> Column:
    """``without_empty_columns`` of a column."""
    names = list(heads)

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: without_empty_columns(t, names))

    return run(text)


def drop_lines(text: Column, phrases: Sequence[str]) -> Column:
    """``text`` without lines that are one of ``phrases`` and no more, with or without a list mark."""
    bare = lambda s: F.regexp_replace(F.trim(s), "^[-•] ", "")
    return F.array_join(F.filter(F.split(text, "\n"), lambda s: ~bare(s).isin(*phrases)), "\n")


def replace_section(text: Column, heading: str, body: Column) -> Column:
    """``text`` with the section under ``## heading`` replaced by ``body``, up to the next section or the end.

    Without such a section it stays as it is; a null body does too.
    """
    parts = F.split(F.concat(F.lit("\n"), text), "\n## ")
    new = F.array_join(F.transform(parts, lambda s, k: F.when((k > 0) & (F.substring_index(s, "\n", 1) == heading), F.concat(F.lit(heading + "\n\n"), body)).otherwise(s)), "\n## ")
    return F.when(body.isNull(), text).otherwise(F.substr(new, F.lit(2)))
