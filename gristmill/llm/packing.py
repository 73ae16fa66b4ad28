"""Harmonic packing of tokenised documents into sequences.

A document is cut into pieces whose lengths are the capacity over a power of two, down to SHORTEST, and a tail below that.
Pieces of one length are a class: a sequence of class ``length`` takes exactly ``capacity // length`` of them, the
reciprocal of the length, whatever other classes hold. So every worker fills the sequences of each class by counting its
own pieces; only the counts of workers and classes meet, and no piece moves. The one open sequence of a class needs no
padding where its length is a power of two: its pieces go to sequences of powers of two. The tails of other open
sequences, fewer in all than ``capacity`` times the harmonic number of SHORTEST, are cut into powers of two as well.
Padding is left in full sequences of tails alone, which miss less than a length's remainder of the capacity.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from gristmill.llm import bpe
from gristmill.llm.common import stored

CAPACITY, SHORTEST, END = 1024, 64, 0

PIECES = StructType([
    StructField("doc_id", LongType()),
    StructField("doc_tokens", LongType()),
    StructField("start", LongType()),
    StructField("length", IntegerType()),
    StructField("ids_crc32", LongType()),
    StructField("tail", BinaryType()),
    StructField("worker", IntegerType()),
    StructField("number", LongType()),
])

#: The tokenizer's matcher can't take longer runs of white space; texts that hold one go to the segment tree's encoder.
_LONG_BLANK = re.compile(r"\s{2000}")


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str):
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    plain = tiktoken.Encoding("pack", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda text: bpe.tokenizer(path).encode(text) if len(text) > 2000 and _LONG_BLANK.search(text) else plain.encode_ordinary(text)


def cuts(tokens: int, capacity: int = CAPACITY, shortest: int = SHORTEST) -> list[int]:
    """Lengths of a document's pieces: full ones, falling powers of two down to ``shortest``, and a tail below it."""
    rest, powers = divmod(tokens, capacity)[1], []
    while rest >= shortest:
        powers.append(1 << rest.bit_length() - 1)
        rest -= powers[-1]
    return [capacity] * (tokens // capacity) + powers + [rest] * (rest > 0)


def cut_documents(docs: DataFrame, path: str, capacity: int, shortest: int, end: int) -> DataFrame:
    """Pieces of ``docs``, each numbered within its length by the task that cuts it; tails carry their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, worker, counts = _encoder(path, public_tokenizers.PATTERN), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = np.append(np.asarray(encode(text or ""), "<u4"), np.uint32(end)).astype("<u4").tobytes()
                    start = 0
                    for length in cuts(len(ids) // 4, capacity, shortest):
                        piece = ids[4 * start : 4 * (start + length)]
                        rows.append((doc_id, len(ids) // 4, start, length, zlib.crc32(piece), piece if length < shortest else None, worker, counts[length]))
                        counts[length] += 1
                        start += length
                columns = zip(*rows, strict=True) if rows else [()] * len(PIECES)
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], PIECES.names)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(run, PIECES)


def _group(number: Column, total: Column, fit: Column) -> tuple[Column, Column]:
    """Sequence within a class, and place there, of piece ``number`` of ``total`` where ``fit`` pieces fill a sequence.

    What is left over falls into groups by the binary digits of its count, the largest first.
    """
    full, left = F.floor(total / fit), total % fit
    within = number - full * fit
    digit = F.floor(F.log2(left.bitwiseXOR(within))).cast("int")
    above = F.call_function("shiftright", left, digit + 1)
    start = F.call_function("shiftleft", above, digit + 1)
    filled = number < full * fit
    return F.when(filled, F.floor(number / fit)).otherwise(full + F.bit_count(above)), F.when(filled, number % fit).otherwise(within - start)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, shortest: int = SHORTEST, end: int = END) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) in sequences of at most ``capacity`` tokens.

    A document is the ids of its whole text and then ``end``. Returns a row for each piece: doc_id, start (ids of the
    document before it), length, ids_crc32 (of its little-endian unsigned 32-bit ids), doc_tokens, sequence_id and offset
    (its place in the sequence). A null text counts as empty and has the ``end`` alone; very long texts are cut as often
    as needed; repeated rows are documents of their own; a null doc_id stays null; other columns are ignored; an empty
    table gives no rows. Pieces of equal length are interchangeable: which of them share a sequence follows from the
    order in which tasks read them. ``path`` is the rank file, on each worker; ``capacity`` and ``shortest`` are powers
    of two.
    """
    if capacity & capacity - 1 or shortest & shortest - 1 or not 0 < shortest <= capacity:
        raise ValueError("capacity and shortest must be powers of two")
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    pieces = stored(cut_documents(docs, path, capacity, shortest, end), "pieces")
    counts = stored(pieces.groupBy("length", "worker").agg(F.count(F.lit(1)).alias("n")), "counts")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("length", "worker", before.alias("before"))
    # one row for each class, of which there are fewer than ``shortest`` and a few powers of two
    length, fit = F.col("length"), F.floor(F.lit(capacity) / F.col("length")).cast("long")
    exact = F.bit_count("length") == 1
    left = F.col("total") % F.col("fit")
    classes = counts.groupBy("length").agg(F.sum("n").alias("total")).withColumn("fit", fit)
    classes = classes.withColumn("whole", F.floor(F.col("total") / F.col("fit")) * F.col("fit"))
    classes = classes.withColumn("sequences", F.floor(F.col("total") / F.col("fit")) + F.when(exact, F.bit_count(left)).otherwise(0))
    rank = lambda: Window.orderBy("length").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.withColumn("base", F.coalesce(F.sum("sequences").over(rank()), F.lit(0)))
    numbered = pieces.join(offsets, ["length", "worker"]).join(F.broadcast(classes), "length").withColumn("number", F.col("number") + F.col("before"))
    sequence, place = _group(F.col("number"), F.col("total"), F.col("fit"))
    stays = exact | (F.col("number") < F.col("whole"))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    kept = numbered.where(stays).select("doc_id", "start", length.cast("long").alias("length"), "ids_crc32", "doc_tokens", (F.col("base") + sequence).alias("sequence_id"), (place * length).cast("long").alias("offset"))
    # tails of open sequences: bounded by the classes, whatever the number of documents
    power = F.explode(F.filter(F.transform(F.sequence(F.lit(0), F.lit(shortest.bit_length() - 2)), lambda b: F.call_function("shiftleft", F.lit(1), b)) if shortest > 1 else F.array().cast("array<int>"), lambda p: F.col("length").bitwiseAND(p) > 0))
    open_tails = numbered.where(~stays).select("doc_id", "doc_tokens", "start", "length", "tail", power.alias("power"))
    skip = F.col("length") - F.col("length") % (2 * F.col("power"))  # the larger powers come first
    ids = F.substring("tail", 4 * skip + 1, 4 * F.col("power"))
    open_tails = open_tails.select("doc_id", (F.col("start") + skip).alias("start"), F.col("power").cast("long").alias("length"), F.crc32(ids).alias("ids_crc32"), "doc_tokens")
    open_tails = stored(open_tails.withColumn("number", F.row_number().over(Window.partitionBy("length").orderBy("doc_id", "start")) - F.lit(1).cast("long")), "tails")
    again = open_tails.groupBy("length").agg(F.count(F.lit(1)).alias("total")).withColumn("fit", fit)
    again = again.withColumn("sequences", F.floor(F.col("total") / F.col("fit")) + F.bit_count(left))
    first = classes.agg(F.coalesce(F.sum("sequences"), F.lit(0)).alias("first"))
    again = again.withColumn("base", F.coalesce(F.sum("sequences").over(rank()), F.lit(0))).crossJoin(first)  # one row
    rest = open_tails.join(F.broadcast(again), "length")
    rest = rest.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("first") + sequence).alias("sequence_id"), (place * length).cast("long").alias("offset"))
    return kept.unionByName(rest).select(*columns)
