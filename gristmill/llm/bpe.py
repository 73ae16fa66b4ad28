"""Byte-level BPE: a segment tree over byte positions finds the leftmost pair of lowest rank; a merge updates few points."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

#: A worker keeps the tokens of at most so many pieces, of at most so many bytes each, between rows.
CACHED_PIECES, CACHED_BYTES = 500_000, 64


def pair_tree(keys: list[int], width: int, none: int) -> list[int]:
    """Minimum segment tree over byte positions, as a list: leaf i, at ``width + i``, holds the rank of the pair that
    starts with the part at byte i, above the position, so that the root (at 1) is the leftmost pair of lowest rank."""
    tree = [none] * width + keys + [none] * (width - len(keys))
    for k in range(width - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    return tree


def put(tree: list[int], k: int, key: int) -> None:
    """Sets leaf ``k`` and the minima above it, as far as they change."""
    if tree[k] == key:
        return
    tree[k] = key
    while k > 1:
        other = tree[k ^ 1]
        if other < key:
            key = other
        k >>= 1
        if tree[k] == key:
            return
        tree[k] = key


class _Pieces(dict):
    """Little-endian ids of the pieces met so far; bounded by CACHED_PIECES and CACHED_BYTES."""

    def __init__(self, merge):
        self.merge = merge

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.merge(piece.encode("utf-8")), "<u4").tobytes()
        if len(piece) <= CACHED_BYTES:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = ids
        return ids


class Tokenizer:
    """Encoder and decoder for a file of base64 tokens with their ranks."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        self.pieces = _Pieces(self.merge)

    def merge(self, piece: bytes) -> list[int]:
        """Token ids of one piece: the piece itself if it is a token, else merges by rank, leftmost first."""
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return [whole]
        n = len(piece)
        if n < 2:
            return [ranks[piece[i : i + 1]] for i in range(n)]
        shift = n.bit_length()
        low, none = (1 << shift) - 1, 1 << 62
        get = ranks.get
        after = list(range(1, n + 1))  # where the part that starts here ends, which is where the next one starts
        before = list(range(-1, n))
        width = 1 << (n - 2).bit_length()
        tree = pair_tree([none if (r := get(piece[i : i + 2])) is None else r << shift | i for i in range(n - 1)], width, none)
        best = tree[1]
        while best != none:
            i = best & low
            gone = after[i]
            after[i] = end = after[gone]
            before[end] = i
            left = before[i]
            if end < n:
                r = get(piece[i : after[end]])
                put(tree, gone + width, none)
                put(tree, i + width, none if r is None else r << shift | i)
            else:
                put(tree, i + width, none)
            if left >= 0:
                r = get(piece[left:end])
                put(tree, left + width, none if r is None else r << shift | left)
            best = tree[1]
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : after[i]]])
            i = after[i]
        return ids

    def encode(self, text: str) -> np.ndarray:
        """Token ids of a whole text, as little-endian unsigned 32-bit integers."""
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.split(text))), "<u4")

    def decode(self, ids) -> bytes:
        """Bytes of a list of token ids."""
        return b"".join(map(self.tokens.__getitem__, np.asarray(ids).tolist()))


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


ENCODED = StructType([
    StructField("doc_id", LongType()),
    StructField("n_tokens", LongType()),
    StructField("ids_sha256", StringType()),
    StructField("decoded_sha256", StringType()),
    StructField("round_trip", BooleanType()),
    StructField("ids", ArrayType(IntegerType())),
])


def encode_documents(docs: DataFrame, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """Tokens of every whole text of ``docs`` (doc_id, text), decoded again.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip (the decoded bytes are the text's) and, if asked
    for, ids. A null text counts as empty, an empty one has no tokens; very long texts are encoded whole, and a long
    piece in n log n time; a null doc_id stays null; of pairs with equal rank the leftmost is merged first; repeated rows
    give repeated rows; other columns are ignored; an empty table gives no rows. ``path`` is the rank file, on each worker. No shuffle.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    fields = [f for f in ENCODED.fields if with_ids or f.name != "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                counts, hashes, back, same, ids = [], [], [], [], []
                for text in part.column(1).to_pylist():
                    text = text or ""
                    got = t.encode(text)
                    decoded = t.decode(got)
                    counts.append(len(got))
                    hashes.append(hashlib.sha256(got.tobytes()).hexdigest())
                    back.append(hashlib.sha256(decoded).hexdigest())
                    same.append(decoded == text.encode("utf-8"))
                    if with_ids:
                        ids.append(got)
                columns = [part.column(0), pa.array(counts, pa.int64()), pa.array(hashes), pa.array(back), pa.array(same, pa.bool_())]
                if with_ids:
                    ends = pa.array([0, *map(int, accumulate(counts))], pa.int32())
                    values = pa.array(np.concatenate(ids).astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(ends, values))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(run, StructType(fields))
