"""Writing with counters: what a batch holds is counted in the pass that writes it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_counted(df: DataFrame, path: str, counters: Mapping[str, Column], mode: str = "overwrite") -> dict:
    """Writes ``df`` as Parquet and returns ``counters`` (aggregates) over the rows written, from the same pass."""
    seen = Observation()
    df.observe(seen, *[c.alias(n) for n, c in counters.items()]).write.mode(mode).parquet(path)
    return seen.get


def count_by(column: Column, values: Mapping[str, object]) -> dict[str, Column]:
    """Counters for each of some known ``values`` of a column, by name."""
    return {name: F.count_if(column == value) for name, value in values.items()}


def long_form(df: DataFrame) -> DataFrame:
    """A row of counters as rows (name, value)."""
    return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in df.columns])).alias("c")).select("c.name", "c.value")


def reconciled(written: DataFrame, counters: Mapping[str, object], total: str, parts: list[str]) -> dict[str, bool]:
    """Whether counters hold: the rows there are as many as counted, and ``parts`` add up to ``total``."""
    return {"rows": written.count() == counters[total], "parts": sum(counters[p] for p in parts) == counters[total]}
