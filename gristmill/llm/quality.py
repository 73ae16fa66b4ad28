"""Quality classifier: a Bradley-Terry model learned from preference pairs.

A text's strength is a linear function of features of the text. Of a good and a bad text, the good one is preferred with
the logistic of the difference of their strengths; the weights minimise the logistic loss over such pairs. The texts'
rank order comes from the strengths; their quantile at the share of bad training rows is the threshold, and strengths
are mapped to scores so that this threshold gets CUT.

The fit is bounded by two parameters: TRAINING_ROWS labelled rows, and PAIRS preference pairs drawn from them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

#: The classifier is fitted on at most so many labelled rows, first by hash of doc_id, and at most so many pairs of them.
TRAINING_ROWS, PAIRS = 20_000, 40_000
BINS, CUT, FOLDS = 8, 0.3, 5
_CLASSES = {
    "digit": b"0123456789", "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "stop": b".", "comma": b",", "space": b" \t", "quote": b"'\"",
    "hash": b"#", "dollar": b"$", "percent": b"%", "and": b"&", "star": b"*", "bang": b"!", "bar": b"|", "slash": b"/\\", "bracket": b"()[]{}<>", "equals": b"=_+-~^@;:?", "control": bytes([*range(0, 9), *range(14, 32), 127]),
}
_TABLE = np.zeros((256, len(_CLASSES)))
for _k, _v in enumerate(_CLASSES.values()):
    _TABLE[list(_v), _k] = 1
_LONG_RUN = re.compile(r"(\S)\1{3,}")
FEATURES = [*_CLASSES, "other", "log_bytes", "log_words", "log_lines", "word_length", "distinct_words", "top_word", "short_words", "long_words", "capital_words", "symbol_words", "distinct_lines", "line_length", "distinct_pairs", "runs", "sentence_length"]


def features(text: str | None) -> np.ndarray:
    """Numbers that describe a whole text; an empty or null one has zeros."""
    if not text:
        return np.zeros(len(FEATURES))
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    counts = np.bincount(data, minlength=256)
    size = len(data)
    classes = counts @ _TABLE / size
    words = text.split()
    n = max(1, len(words))
    kinds: dict[str, int] = {}
    for w in words:
        kinds[w] = kinds.get(w, 0) + 1
    lines = text.split("\n")
    lengths = list(map(len, words))
    symbol = sum(1 for w in words if not (w[-1].isalnum() or w[-1] in ".,"))
    capital = sum(map(str.isupper, words))
    pairs = len(set(zip(words, words[1:], strict=False)))
    return np.array([
        *classes,
        1 - classes.sum(),
        np.log1p(size),
        np.log1p(len(words)),
        np.log1p(len(lines)),
        sum(lengths) / n,
        len(kinds) / n,
        max(kinds.values(), default=0) / n,
        sum(1 for x in lengths if x <= 3) / n,
        sum(1 for x in lengths if x > 20) / n,
        capital / n,
        symbol / n,
        len(set(lines)) / len(lines),
        size / len(lines),
        pairs / max(1, n - 1),
        len(_LONG_RUN.findall(text)) / n,
        n / (1 + text.count(".") + text.count("!") + text.count("?")),
    ])


@dataclass
class Model:
    """``edges``: the borders of each feature's bins; ``weights``: one for each bin; ``threshold`` and ``scale`` of the strengths."""

    edges: np.ndarray
    weights: np.ndarray
    threshold: float
    scale: float

    def design(self, x: np.ndarray) -> np.ndarray:
        """Which borders each feature lies above."""
        return (x[:, :, None] > self.edges[None]).reshape(len(x), -1).astype(np.float64)

    def strengths(self, x: np.ndarray) -> np.ndarray:
        return self.design(x) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1; CUT at the threshold."""
        z = self.scale * (self.strengths(x) - self.threshold) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, seed: int = 7) -> Model:
    """Bradley-Terry weights from pairs of a good and a bad row of ``x``, by Newton steps on the logistic loss.

    Without a good or a bad row there are no pairs: all rows then get one score, above CUT unless all are bad.
    """
    edges = np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T if len(x) else np.zeros((len(FEATURES), BINS - 1))
    model = Model(edges, np.zeros(edges.size), 0.0, 1.0)
    if not len(x) or good.all() or not good.any():
        model.threshold = -1.0 if not len(x) or good.any() else 1.0
        return model
    draw = np.random.default_rng(seed)
    d = model.design(x)
    winners, losers = np.flatnonzero(good), np.flatnonzero(~good)
    pairs = min(pairs, len(winners) * len(losers))
    diff = d[draw.choice(winners, pairs)] - d[draw.choice(losers, pairs)]
    w = model.weights
    ridge = 1e-2 * pairs / 1000
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        gradient = diff.T @ (1 - p) - ridge * w
        hessian = (diff * (p * (1 - p))[:, None]).T @ diff + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    model.weights = w
    s = d @ w
    ordered = np.sort(s)
    bad = len(losers)
    model.threshold = float((ordered[bad - 1] + ordered[bad]) / 2) - 1e-9  # of a tie at the quantile all are accepted
    return model


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo FOLDS; rows of fold 0 are held out."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS))


DESCRIBED = StructType([StructField("doc_id", LongType()), StructField("features", ArrayType(DoubleType()))])


def describe(docs: DataFrame) -> DataFrame:
    """doc_id and features of every text of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], DESCRIBED.names)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(run, DESCRIBED)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """A model of ``labels.quality`` from rows that are not held out, ``rows`` of them at most.

    Labels that are null or contradict each other (a doc_id with both) teach nothing; ids without a document are left
    out; of several texts of a doc_id the first in order is read.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("most"))
    known = known.where((F.col("q") == F.col("most")) & (fold(F.col("doc_id")) != 0)).select(F.col("doc_id").cast("long").alias("doc_id"), "q")
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)  # bounded, and so is what is broadcast and collected
    ids = F.broadcast(sample)
    some = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).join(ids.select("doc_id"), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    got = describe(some).join(ids, "doc_id").select("doc_id", "features", "q").toArrow().sort_by("doc_id")
    x = np.array(got.column("features").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    return fit(x, got.column("q").to_numpy() > 0)


SCORED = StructType([StructField("doc_id", LongType()), StructField("score", DoubleType())])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every whole text, in one pass without shuffle; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 1000) for at in range(0, batch.num_rows, 1000)):
                x = np.array([features(t) for t in part.column(1).to_pylist()]).reshape(-1, len(FEATURES))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.scores(x))], SCORED.names)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(run, SCORED)


def classify(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if score >= CUT) of every row of ``docs``; other columns are ignored.

    Nulls: a null or empty text is scored like any other, a null doc_id is not held out. Very long texts are scored
    whole; texts with equal features tie, and all of a tie are on the same side of CUT. Repeated rows give repeated
    rows, an empty table none; without usable labels every document passes.
    """
    scored = score(docs, train(docs, labels, rows))
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, in all their columns, with a score of CUT or more. One pass without shuffle."""
    at = docs.columns.index(next(c for c in docs.columns if c.lower() == "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, 1000) for k in range(0, batch.num_rows, 1000)):
                x = np.array([features(t) for t in part.column(at).to_pylist()]).reshape(-1, len(FEATURES))
                yield part.filter(pa.array(model.scores(x) >= CUT))

    return docs.mapInArrow(run, docs.schema)
