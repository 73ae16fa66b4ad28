"""Structured Streaming twins: offset windows, lateness gates, calendar periods, sessions, seen-set dedup and the novelty ledger as keyed state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gristmill.functions import times as T
from gristmill.operators import lineage


def windowed_counts(stream: DataFrame, ts: str, keys: list[str], late: str = "7 days", size: str = "1 day", offset: str = "23 hours") -> DataFrame:
    """Counts by key in daily windows that start at 07:00 of UTC+8; rows later than ``late`` are left out."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, size, size, offset), *keys).agg(F.count(F.lit(1)).alias("rows"))


def sessions(stream: DataFrame, ts: str, key: str, gap: str, late: str = "1 day") -> DataFrame:
    """Sessions of a key that end after a ``gap`` without rows."""
    return stream.withWatermark(ts, late).groupBy(key, F.session_window(ts, gap)).agg(F.count(F.lit(1)).alias("rows"))


def first_seen(stream: DataFrame, ts: str, keys: list[str], late: str = "7 days") -> DataFrame:
    """The first row of each key within the watermark."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def lateness(stream: DataFrame, ts: str, arrived: str, tier: str, days: dict[str, int] | None = None, future_days: int = 1) -> DataFrame:
    """``stream`` with ``gate``: kept, late (more than its tier's days before it ``arrived``), future or undated.

    Tiers reach back 1, 3 and 7 days by default; one watermark of the longest serves all, and this column tells them apart.
    """
    days = days or {"channel": 1, "search": 3, "broad": 7}
    limit = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in days.items() for x in kv]), F.col(tier)), F.lit(1))
    age = (F.unix_micros(F.col(arrived).cast("timestamp")) - F.unix_micros(F.col(ts).cast("timestamp"))) / F.lit(86_400_000_000.0)
    gate = F.when(F.col(ts).isNull(), F.when(F.col(tier) == "broad", "kept").otherwise("undated")).when(age < -future_days, "future").when(age > limit, "late").otherwise("kept")
    return stream.withColumn("gate", gate)


def gate_counts(gated: DataFrame, ts: str, late: str = "7 days") -> DataFrame:
    """Why rows were kept or not, counted by day: the side output of ``lateness``. Undated rows have no day and aren't counted."""
    return gated.where(F.col(ts).isNotNull()).withWatermark(ts, late).groupBy(F.window(ts, "1 day"), "gate").agg(F.count(F.lit(1)).alias("rows"))


def calendar_counts(stream: DataFrame, ts: str, kind: str, keys: list[str]) -> DataFrame:
    """Counts by ``weekly`` (from Monday), ``monthly`` or ``yearly`` period and key; months have no fixed length, so this
    runs in complete or update mode."""
    return stream.groupBy(T.period_start(F.to_date(ts), kind).alias("period"), *keys).agg(F.count(F.lit(1)).alias("rows"))


class NoveltyProcessor(StatefulProcessor):
    """Per key: first and last day and the last fact; gives each row the status that the batch fold gives."""

    def __init__(self, key: str, seq: str, day: str, fact: str, near_days: int = 3, stale_days: int = 7):
        self.key, self.seq, self.day, self.fact, self.near, self.stale = key, seq, day, fact, near_days, stale_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "first_day date, last_day date, fact string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        held = self.state.get() if self.state.exists() else None
        first, last, fact = held if held else (None, None, None)
        batch = pd.concat(list(rows)).sort_values(self.seq)
        status = []
        for day, now in zip(batch[self.day], batch[self.fact], strict=True):
            first = day if first is None or day < first else first
            if last is None:
                status.append("new_today")
            elif first == day:
                status.append("new_today" if now == fact else "updated_today")
            elif now != fact:
                status.append("updated_today")
            elif (day - last).days < self.near:
                status.append("repeated")
            else:
                status.append("ongoing" if (day - last).days < self.stale else "background")
            last, fact = day, now
        self.state.update((first, last, fact))
        yield pd.DataFrame({self.key: [key[0]] * len(batch), self.seq: batch[self.seq].values, "status": status})

    def close(self) -> None:
        pass


def novelty_stream(stream: DataFrame, key: str, seq: str, day: str, fact: str) -> DataFrame:
    """The streaming twin of ``operators.ledger.novelty``: key, seq, status."""
    schema = f"{key} {stream.schema[key].dataType.simpleString()}, {seq} {stream.schema[seq].dataType.simpleString()}, status string"
    return stream.groupBy(key).transformWithStateInPandas(NoveltyProcessor(key, seq, day, fact), schema, "Append", "None")


DAY_MS = 86_400_000
#: The state store, which keeps state out of the heap, and the setting that names it.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _aged(n_keys: int, steps: list[tuple[int, str]]) -> Callable:
    """Per bucket of keys: the time each key was last seen, and that of the last step told. Steps (days, status) are told when event time has passed them
    without a row; a key is forgotten at the last one, and a row after that is new again. A bucket's timeout is the next step of any of its keys."""
    after = [(days * DAY_MS, status) for days, status in sorted(steps)]
    end = after[-1][0]

    def age(bucket: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        *names, lasts, tolds = state.get if state.exists else [[]] * (n_keys + 2)
        held = dict(zip(zip(*names, strict=True), zip(lasts, tolds, strict=True), strict=True))
        mark, told = state.getCurrentWatermarkMs(), []

        def due(key: tuple, last: int, past: int, until: int) -> None:
            told.extend((*key, last + ms, status) for ms, status in after if past < last + ms <= until)

        if not state.hasTimedOut:
            came = [row for batch in rows for row in zip(batch["_ms"].tolist(), *(batch[f"_k{i}"].tolist() for i in range(n_keys)), strict=True)]
            for at, *key in sorted(came, key=lambda row: row[0]):
                key = tuple(key)
                status = "new"
                if key in held:  # rows of one batch may lie further apart than the steps: what has passed between them is told
                    last, past = held[key]
                    due(key, last, past, at)
                    status = "new" if last + end <= at else "seen"
                told.append((*key, at, status))
                held[key] = at, at
        kept, following = [], []
        for key, (last, past) in held.items():
            due(key, last, past, mark)
            past = max(past, mark)
            if last + end > past:
                kept.append((*key, last, past))
                following.append(next(last + ms for ms, _ in after if last + ms > past))
        if kept:
            state.update(tuple(map(list, zip(*kept, strict=True))))
            state.setTimeoutTimestamp(min(following) - 1)  # due when the mark has reached the step, not passed it
        else:
            state.remove()
        if told:
            yield pd.DataFrame(told, columns=[*(f"_k{i}" for i in range(n_keys)), "at_ms", "status"])

    return age


def ageing(stream: DataFrame, keys: list[str], ts: str, steps: list[tuple[int, str]] | None = None, late: str = "1 day", buckets: int = 2048) -> DataFrame:
    """What becomes of the keys of ``stream``: rows (keys, at_ms, status).

    A key is new, then seen at each further row. Without one it becomes ongoing after 3 days, background after 7 and is
    dropped after 30 (``steps``), which frees its state. The clock is the watermark alone: nothing depends on when rows
    arrive. A row as old as a step or older comes after that step. Null keys are keys; rows without time are left out.

    Keys share state by ``buckets`` of their hashes, so that the cost of a call is that of many keys; a stream keeps its
    number. Keys are held as strings, so their types are those that a cast to string and back keeps.
    """
    steps = steps or [(3, "ongoing"), (7, "background"), (30, "dropped")]
    at, each = F.col(ts).cast("timestamp"), range(len(keys))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("_bucket")
    rows = stream.where(F.col(ts).isNotNull()).select(bucket, *[F.col(k).cast("string").alias(f"_k{i}") for i, k in enumerate(keys)], at.alias("_at"), F.unix_millis(at).alias("_ms")).withWatermark("_at", late)
    out = ", ".join(f"_k{i} string" for i in each) + ", at_ms long, status string"
    held = ", ".join(f"k{i} array<string>" for i in each) + ", last array<long>, told array<long>"
    told = rows.groupBy("_bucket").applyInPandasWithState(_aged(len(keys), steps), out, held, "append", GroupStateTimeout.EventTimeTimeout)
    return told.select(*[F.col(f"_k{i}").cast(stream.schema[k].dataType).alias(k) for i, k in enumerate(keys)], "at_ms", "status")


class LedgerSink:
    """A function for ``foreachBatch`` that appends a batch to the ledger at ``path``, and what fails to ``dead_letters``.

    Each batch is a partition named by its id and replaces what an earlier try of it has left, so a replayed batch leaves
    one copy. ``prepare`` makes ledger rows of a batch and says in a column ``error`` why a row can't be one (null: it
    can); those go to the dead letters with their reason and batch, and the stream goes on.
    """

    def __init__(self, path: str, dead_letters: str, prepare: Callable[[DataFrame], DataFrame]):
        self.path, self.dead_letters, self.prepare = path, dead_letters, prepare

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = self.prepare(batch).persist()
        try:
            rows.where("error is null").drop("error").write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
            rows.where("error is not null").write.mode("overwrite").parquet(f"{self.dead_letters}/batch={batch_id}")
        finally:
            rows.unpersist()


def run_to_end(stream: DataFrame, name: str, sink: LedgerSink | None = None) -> str:
    """Runs ``stream`` over all that its source holds now, in the shared folder; returns the folder's path.

    The rows go to ``out`` there, or to ``sink``.
    """
    spark = stream.sparkSession
    at = lineage.new_path(spark, name)
    before = spark.conf.get(STORE[0], None)
    spark.conf.set(*STORE)
    try:
        writer = stream.writeStream.outputMode("append").option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True)
        run = (writer.foreachBatch(sink) if sink else writer.format("parquet").option("path", f"{at}/out")).start()
        run.awaitTermination()
    finally:
        spark.conf.set(STORE[0], before) if before else spark.conf.unset(STORE[0])
    return at
