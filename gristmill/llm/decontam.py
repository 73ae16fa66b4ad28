"""Benchmark decontamination with SimHash windows of the items' own sizes.

A document's windows are compared with benchmark items by 64-bit SimHashes of their words: fingerprints are cut into
BLOCKS blocks, and an item is indexed under every value of a block that differs from its own in at most BLOCK_ERRORS
bits, so that equal block values find all windows within RADIUS bits. Weighted Jaccard similarity of the five-word
shingles (weight: how often a shingle occurs) of window and item then decides.

Of the windows of an item's size, those without any of its shingles can't be similar and aren't fingerprinted. As few of
the item's shingles may lack, one of any few more is in the window: only its rarest are looked up. All windows that hold
one of them are fingerprinted, wherever they lie and whatever their order of words.

The fingerprints do lose some: of windows just above 0.8, about one in a hundred lies beyond RADIUS (see the README).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from gristmill.llm.common import discard, stored
from gristmill.llm.shingles import WORDS, shingles, word_hashes

BLOCKS, BLOCK_ERRORS = 4, 3
RADIUS = BLOCKS * (BLOCK_ERRORS + 1) - 1
BLOCK_BITS = 64 // BLOCKS
MIN_SIMILARITY = 0.8
#: Words of benchmark items that are sent to the workers at once, about 30 bytes each; a larger benchmark takes several
#: passes over the documents.
SEEDS_PER_PASS = 2_000_000
#: Windows are made and sent on in batches of about so many; candidates of a document are verified so many at a time.
WINDOW_BATCH, CANDIDATE_BATCH = 20_000, 1_000
_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """Runs of letters and digits in lower case; punctuation and symbols separate words."""
    return _WORD.findall(text.lower()) if text else []


def simhash(hashes: np.ndarray) -> int:
    """64-bit SimHash of a sequence of word hashes: the signs of the sums of their bits, words weighted by frequency."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(hashes), bitorder="little").view("<i8")[0])


def simhashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """SimHashes of all runs of ``n`` of a sequence of word hashes, by running sums of their bits."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
    return np.packbits(2 * (sums[n:] - sums[:-n]) > n, axis=1, bitorder="little").view("<i8").reshape(-1)


class Seeds:
    """Items (key, size, words): the shingles of each with their numbers, and by shingle the items of which it is one of
    the rarest; every window like an item holds one of these. All are sorted arrays."""

    def __init__(self, items: list[tuple[int, int, str]], similarity: float):
        none = np.zeros(0, np.uint64)
        all_of = [np.sort(shingles(word_hashes(line.split()))) for _, _, line in items]
        own = [np.unique(x, return_counts=True) for x in all_of]
        names, frequency = np.unique(np.concatenate([*[x for x, _ in own], none]), return_counts=True)
        rare = []
        for x in all_of:
            # a window of a document shorter than the item has the fewest of its shingles
            n = len(x) - math.ceil(similarity * len(x) - 1e-9) + 1
            rare.append(np.unique(x[np.argsort(frequency[np.searchsorted(names, x)], kind="stable")[:n]]))
        #: By length, the word runs that are whole items of fewer than WORDS words.
        self.short = {n: np.unique(np.concatenate([shingles(word_hashes(line.split()), n) for _, size, line in items if size == n])) for n in sorted({size for _, size, _ in items if size < WORDS})}
        self.places = {key: k for k, (key, _, _) in enumerate(items)}
        self.sizes = [size for _, size, _ in items]
        self.shingles = np.concatenate([*[x for x, _ in own], none])
        self.counts = np.concatenate([*[n for _, n in own], np.zeros(0, np.int64)])
        self.ends = np.cumsum([0, *[len(x) for x, _ in own]])
        found = np.concatenate([*rare, none])
        order = np.argsort(found, kind="stable")
        self.known, first = np.unique(found[order], return_index=True)
        self.first = np.append(first, len(found))
        self.items = np.repeat(np.arange(len(items)), [len(x) for x in rare])[order]

    def runs(self, found: np.ndarray, n_words: int) -> Iterator[tuple[int, int, int]]:
        """Size in words, first and last start of the windows that hold a rare shingle of an item of that size, for a
        document's shingles ``found``; a document that is shorter than an item is one window."""
        if not len(found) or not len(self.known):
            return
        near = np.minimum(np.searchsorted(self.known, found), len(self.known) - 1)
        spans: dict[int, list[list[int]]] = {}
        for p in np.flatnonzero(self.known[near] == found).tolist():
            for n in {min(self.sizes[k], n_words) for k in self.items[self.first[near[p]] : self.first[near[p] + 1]].tolist()}:
                m = max(1, n - WORDS + 1)
                low, high = max(0, p - m + 1), min(p, len(found) - m)
                some = spans.setdefault(n, [])
                if some and low <= some[-1][1] + 1:
                    some[-1][1] = max(some[-1][1], high)
                else:
                    some.append([low, high])
        for n, some in spans.items():
            for low, high in some:
                yield n, low, high

    def short_runs(self, hashes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Size, first and last start of the windows that are a short item word for word, each alone, for a document's
        word ``hashes``; documents of just its words are among ``runs``."""
        for n, known in self.short.items():
            if n < len(hashes):
                found = shingles(hashes, n)
                near = np.minimum(np.searchsorted(known, found), len(known) - 1)
                for p in np.flatnonzero(known[near] == found).tolist():
                    yield n, p, p

    def similarity(self, key: int, found: np.ndarray) -> float:
        """Weighted Jaccard similarity of the item ``key`` and a window's shingles."""
        k = self.places[key]
        own, times = self.shingles[self.ends[k] : self.ends[k + 1]], self.counts[self.ends[k] : self.ends[k + 1]]
        names, n = np.unique(found, return_counts=True)
        at = np.minimum(np.searchsorted(own, names), len(own) - 1)
        both = int(np.where(own[at] == names, np.minimum(times[at], n), 0).sum())
        return both / max(1, int(times.sum()) + len(found) - both)


ITEMS = StructType([StructField("item_id", LongType()), StructField("size", IntegerType()), StructField("fp", LongType()), StructField("words", StringType())])
WINDOWS = StructType([
    StructField("doc_id", LongType()),
    StructField("th", LongType()),
    StructField("start", IntegerType()),
    StructField("size", IntegerType()),
    StructField("fp", LongType()),
    StructField("whole", BooleanType()),
    StructField("run", IntegerType()),
    StructField("words", StringType()),
])


def fingerprint_items(benchmark: DataFrame) -> DataFrame:
    """item_id, size in words, fingerprint and words of every item that has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if w := words(text):
                    rows.append((item, len(w), simhash(word_hashes(w)), " ".join(w)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.string()))], ITEMS.names)

    return benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].cast("string").alias("text")).mapInArrow(run, ITEMS)


def windows(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """Fingerprints of the item-sized windows of ``docs`` that hold a rare shingle of an item of ``shared`` Seeds.

    Windows that overlap are one run, named by its first start; its words are a row of their own, with null start and
    fingerprint. An item of fewer than five words is one shingle: windows of just those words meet it, wherever they lie.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = shared.value
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            at = pa.array(np.repeat(np.arange(len(held)), [x[0] for x in held]))
            columns = []
            for k, f in enumerate(WINDOWS.fields):
                kind = {LongType(): pa.int64(), IntegerType(): pa.int32(), BooleanType(): pa.bool_(), StringType(): pa.string()}[f.dataType]
                if f.name in ("start", "fp"):  # each window has its own
                    columns.append(pa.concat_arrays([pa.nulls(1, kind) if x[k + 1] is None else pa.array(x[k + 1], kind) for x in held] or [pa.nulls(0, kind)]))
                else:
                    columns.append(pa.array([x[k + 1] for x in held], kind).take(at))
            held.clear()
            return pa.RecordBatch.from_arrays(columns, WINDOWS.names)

        for batch in batches:
            for part in (batch.slice(at, 500) for at in range(0, batch.num_rows, 500)):
                n_held = 0
                for doc, th, text in zip(*(part.column(k).to_pylist() for k in range(3)), strict=True):
                    w = words(text)
                    h = word_hashes(w)
                    for n, low, high in chain(seeds.runs(shingles(h), len(h)), seeds.short_runs(h)):
                        whole = n == len(h)
                        held.append((1, doc, th, None, n, None, whole, low, " ".join(w[low : high + n])))
                        for begin in range(low, high + 1, WINDOW_BATCH):
                            end = min(begin + WINDOW_BATCH, high + 1)
                            held.append((end - begin, doc, th, np.arange(begin, end), n, simhashes(h[begin : end + n - 1], n), whole, low, None))
                            n_held += end - begin + 1
                            if n_held >= WINDOW_BATCH:
                                yield flush()
                                n_held = 0
                yield flush()

    text = docs["text"].cast("string")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    return rows.mapInArrow(run, WINDOWS)


def within_radius(found: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs of distinct fingerprints (fp, size, whole) and ``items`` (key, size, fp) within RADIUS bits, by equal block
    values: fp, size, whole, key.

    A window has its item's size, or is a whole document that is shorter.
    """
    masks = [sum(1 << b for b in bits) for n in range(BLOCK_ERRORS + 1) for bits in combinations(range(BLOCK_BITS), n)]
    low = (1 << BLOCK_BITS) - 1
    block = lambda b: F.shiftrightunsigned("fp", b * BLOCK_BITS).bitwiseAND(F.lit(low)) + F.lit(b << BLOCK_BITS)
    blocks = F.array(*[block(b) for b in range(BLOCKS)])
    index = items.withColumn("block", F.explode(blocks)).withColumn("mask", F.explode(F.array(*[F.lit(m) for m in masks])))
    index = index.select("key", F.col("size").alias("item_size"), F.col("fp").alias("item_fp"), F.col("block").bitwiseXOR(F.col("mask").cast("long")).alias("block"))
    keyed = found.withColumn("block", F.explode(blocks))
    pairs = keyed.join(index, "block").where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS)
    pairs = pairs.where((F.col("size") == F.col("item_size")) | (F.col("whole") & (F.col("size") < F.col("item_size"))))
    return pairs.select("fp", "size", "whole", "key").distinct()


FOUND = StructType([
    StructField("doc_id", LongType()),
    StructField("th", LongType()),
    StructField("key", LongType()),
    StructField("start", IntegerType()),
    StructField("n_words", IntegerType()),
    StructField("similarity", DoubleType()),
])


def verified(candidates: DataFrame, runs: DataFrame, shared: Broadcast, similarity: float) -> DataFrame:
    """Those of ``candidates`` (doc_id, th, size, run, start, key) that are similar enough, with their similarity.

    The words of a run (``runs``: doc_id, th, size, run, words) meet its candidates CANDIDATE_BATCH at a time, so that
    neither is repeated much or gathered without bound.
    """
    of_run = ["doc_id", "th", "size", "run"]
    numbered = candidates.distinct().withColumn("part", F.floor((F.row_number().over(Window.partitionBy(*of_run).orderBy("start", "key")) - 1) / CANDIDATE_BATCH))
    grouped = numbered.groupBy(*of_run, "part").agg(F.collect_list(F.struct("key", "start")).alias("some"))
    held = runs.dropDuplicates(of_run).select(F.col("doc_id").alias("d"), F.col("th").alias("t"), F.col("size").alias("s"), F.col("run").alias("r"), "words")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")) & (F.col("size") == F.col("s")) & (F.col("run") == F.col("r"))
    rows = grouped.join(held, same)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = shared.value
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64())
        for batch in batches:
            for doc, th, size, run, some, line in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                h = shingles(word_hashes(line.split()))
                out = []
                for x in some:
                    found = seeds.similarity(x["key"], h[x["start"] - run :][: max(1, size - WORDS + 1)])
                    if found >= similarity:
                        out.append((doc, th, x["key"], x["start"], size, found))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], FOUND.names)

    return rows.select(*of_run, "some", "words").mapInArrow(compare, FOUND)


def contaminations(docs: DataFrame, benchmark: DataFrame, similarity: float = MIN_SIMILARITY) -> DataFrame:
    """The best window of ``docs`` (doc_id, text) for each benchmark item (item_id, text) it holds.

    Returns doc_id, th (xxhash64 of the text), item_id, start and n_words (in words), similarity. Null, empty and
    wordless texts and items match nothing; very long texts and items are searched whole; of equally similar windows the
    first counts; repeated rows count once; a null doc_id or item_id is an id like any other; ties between items give a
    row each; an empty table on either side gives no rows. Other columns are ignored.
    """
    items = stored(fingerprint_items(benchmark).distinct().withColumn("key", F.xxhash64("item_id", "words")), "items")
    total = items.agg(F.sum("size")).first()[0] or 0
    passes = -(-total // SEEDS_PER_PASS)
    found = None
    for k in range(passes):
        some = items.where(F.pmod(F.col("key"), F.lit(passes)) == k)
        sent = [(r["key"], r["size"], r["words"]) for r in some.select("key", "size", "words").toLocalIterator()]
        shared = docs.sparkSession.sparkContext.broadcast(Seeds(sent, similarity))
        rows = stored(windows(docs, shared), "windows")
        found_windows = rows.where("words is null")
        near = stored(within_radius(found_windows.select("fp", "size", "whole").distinct(), some.select("key", "size", "fp")), "near")
        candidates = found_windows.join(near, ["fp", "size", "whole"]).select("doc_id", "th", "size", "run", "start", "key")
        good = verified(candidates, rows.where("words is not null"), shared, similarity)
        best = F.max(F.struct("similarity", (-F.col("start")).alias("before"), "n_words")).alias("m")
        hits = good.groupBy("doc_id", "th", "key").agg(best).join(some.select("key", "item_id"), "key")
        hits = hits.select("doc_id", "th", "item_id", (-F.col("m.before")).alias("start"), "m.n_words", "m.similarity")
        hits = stored(hits, "hits")
        discard(rows, near)
        shared.destroy()
        found = hits if found is None else found.union(hits)
    discard(items)
    if found is None:
        empty = "doc_id long, th long, item_id long, start int, n_words int, similarity double"
        return docs.sparkSession.createDataFrame([], empty)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("before"), "n_words")).alias("m")
    found = found.groupBy("doc_id", "th", "item_id").agg(best)
    return found.select("doc_id", "th", "item_id", (-F.col("m.before")).alias("start"), "m.n_words", "m.similarity")


def decontaminate(docs: DataFrame, benchmark: DataFrame, similarity: float = MIN_SIMILARITY) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item, in all their columns; repeated rows go together."""
    hits = contaminations(docs, benchmark, similarity).select(F.col("doc_id").alias("hit_doc"), F.col("th").alias("hit_text")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(hits["hit_doc"]) & (F.xxhash64(docs["text"].cast("string")) == hits["hit_text"])
    return docs.join(hits, same, "left_anti")
