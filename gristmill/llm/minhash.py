"""MinHash near-duplicates by a multi-index Hamming join.

A document's signature has COMPONENTS minima of BITS bits. Two signatures differ in at most CHUNKS * (ERRORS + 1) - 1
components only if some chunk of them differs in at most ERRORS; each chunk is therefore keyed once for every choice of
ERRORS components left out, and equal keys find every such pair. Distances and then full shingle sets confirm it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from gristmill.llm.common import components, discard, stored
from gristmill.llm.linking import link_by_keys
from gristmill.llm.shingles import WORDS, common, mix, shingle_set

COMPONENTS, BITS, CHUNKS, ERRORS = 30, 16, 6, 1
MAX_DISTANCE = CHUNKS * (ERRORS + 1) - 1
_SEEDS = mix(np.arange(1, 2 * COMPONENTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_A, _B = _SEEDS[:COMPONENTS] | np.uint64(1), _SEEDS[COMPONENTS:]


def signature(members: np.ndarray) -> np.ndarray:
    """The low BITS bits of the minimum of each of COMPONENTS hash functions over a non-empty set."""
    if len(members) <= 20_000:
        least = (members[None, :] * _A[:, None] + _B[:, None]).min(axis=1)
    else:
        least = np.array([(members * a + b).min() for a, b in zip(_A, _B, strict=True)], np.uint64)
    return (mix(least) & np.uint64((1 << BITS) - 1)).astype(np.int32)


FEATURES = StructType([
    StructField("doc_id", LongType()),
    StructField("n_shingles", LongType()),
    StructField("h1", LongType()),
    StructField("h2", LongType()),
    StructField("signature", ArrayType(IntegerType())),
])


def signatures(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """doc_id, size and 128-bit hash of the shingle set, and signature (null for an empty set) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sizes, hashes, found = [], [], []
                for text in part.column(1).to_pylist():
                    members = shingle_set(text, k)
                    sizes.append(len(members))
                    hashes.append(np.frombuffer(hashlib.blake2b(members.tobytes(), digest_size=16).digest(), np.int64))
                    found.append(signature(members) if len(members) else None)
                h = np.array(hashes, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(found, pa.list_(pa.int32()))], FEATURES.names)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(run, FEATURES)


def chunk_keys(sig: Column) -> Column:
    """The keys of a signature: for each chunk, the components that are left when ERRORS of them are taken out."""
    width = COMPONENTS // CHUNKS
    kept = [(c, left) for c in range(CHUNKS) for left in combinations(range(c * width, (c + 1) * width), width - ERRORS)]
    return F.array(*[F.xxhash64(F.lit(k), *[sig[i] for i in left]) for k, (_, left) in enumerate(kept)])


def distance(a: Column, b: Column) -> Column:
    """In how many components two signatures differ."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x != y), lambda x: x))


def candidates(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) within the signature distance whose sizes allow the similarity; adds ``distance``."""
    side = lambda c: reps.select(F.col("id").alias(c), F.col("signature").alias(f"s{c}"), F.col("n_shingles").alias(f"n{c}"))
    rows = pairs.join(side("a"), "a").where(F.col("na").isNotNull()).join(side("b"), "b")
    rows = rows.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent).withColumn("distance", distance(F.col("sa"), F.col("sb")))
    return rows.where(F.col("distance") <= MAX_DISTANCE).groupBy("a", "b").agg(F.min("distance").alias("distance"))


def verify(pairs: DataFrame, texts: DataFrame, percent: int, k: int = WORDS) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets reach ``percent`` in a hundred; ``texts`` has id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_set = None, None
        for batch in batches:
            left, right = [], []
            a, b, ta, tb = (batch.column(i) for i in range(4))
            for i in range(batch.num_rows):
                text = tb[i].as_py()
                if held_set is None or text != held:  # pairs come in order of b
                    held, held_set = text, shingle_set(text, k)
                mine = shingle_set(ta[i].as_py(), k)
                both = common(mine, held_set)
                if both and 100 * both >= percent * (len(mine) + len(held_set) - both):
                    left.append(a[i].as_py())
                    right.append(b[i].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    rows = pairs.select("a", "b").join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    rows = rows.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")
    return rows.mapInArrow(run, "a long, b long")


def prefix_pairs(rows: DataFrame, texts: DataFrame, percent: int, k: int = WORDS) -> DataFrame:
    """Pairs (a, b) of ids of ``rows`` (id, c), in different components c, that can reach ``percent`` in a hundred.

    Sets of that similarity share one of their rarest shingles: of n, one of the first n - ceil(n * percent / 100) + 1
    in order of frequency; and the first one that they share must leave room for the overlap they need behind it in
    both. Large groups of copies that differ too much for a link have few such pairs.
    """
    schema = StructType([StructField("id", LongType()), StructField("c", LongType()), StructField("size", LongType()), StructField("token", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 500) for at in range(0, batch.num_rows, 500)):
                sets = [shingle_set(t, k) for t in part.column(2).to_pylist()]
                sizes = np.array([len(x) for x in sets], np.int64)
                each = [np.repeat(part.column(j).to_numpy(), sizes) for j in range(2)]
                tokens = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(each[0]), pa.array(each[1]), pa.array(np.repeat(sizes, sizes)), pa.array(tokens)], schema.names)

    tokens = stored(rows.select("id", "c").distinct().join(texts, "id").select("id", "c", "text").mapInArrow(run, schema), "shingles")
    frequent = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    order = Window.partitionBy("id").orderBy("df", "token")
    rare = tokens.join(frequent, "token").withColumn("at", F.row_number().over(order))
    rare = rare.where(F.col("at") <= F.col("size") - F.ceil(F.col("size") * percent / 100) + 1).where("df > 1")
    live = rare.groupBy("token").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x <> y").select("token")
    rare = stored(rare.join(live, "token").select("token", "id", "c", "size", (F.col("size") - F.col("at") + 1).alias("room")), "rare-shingles")
    other = rare.select("token", F.col("id").alias("b"), F.col("c").alias("cb"), F.col("size").alias("sb"), F.col("room").alias("rb"))
    able = F.least("room", "rb") * (100 + percent) >= (F.col("size") + F.col("sb")) * percent
    pairs = rare.join(other, "token").where((F.col("b") < F.col("id")) & (F.col("c") != F.col("cb")) & able)
    pairs = stored(pairs.select(F.col("id").alias("a"), "b").distinct(), "prefix-pairs")
    discard(tokens, rare)
    return pairs


def link_sets(reps: DataFrame, docs: DataFrame, percent: int, k: int = WORDS) -> DataFrame:
    """Components (id, component) of the sets ``reps`` (id, n_shingles, signature); ids without links may be missing."""
    keys = reps.select("id", F.explode(chunk_keys(F.col("signature"))).alias("key"), F.lit(True).alias("home"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    ids = keys.join(shared, "key", "left_semi").select("id").distinct()
    held = docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"].cast("string").alias("text"))
    texts = stored(held.join(ids, "id", "left_semi"), "texts")
    out = link_by_keys(
        keys,
        within=lambda pairs: candidates(pairs, reps, percent),
        confirm=lambda pairs: verify(pairs, texts, percent, k),
        rounds=1,
        remaining=lambda rows: prefix_pairs(rows, texts, percent, k),
    )
    discard(texts)
    return out


def near_duplicates(docs: DataFrame, percent: int = 85, k: int = WORDS) -> DataFrame:
    """Classes of ``docs`` (doc_id, text) linked by ``100 * |A & B| >= percent * |A | B|`` of their word shingles.

    Returns doc_id, n_shingles, component_id (the smallest doc_id reachable, the document's own included) and kept
    (doc_id = component_id). A null, empty or blank text has an empty set and is linked with nothing; with fewer than
    ``k`` words the whole sequence is one shingle; very long texts have all their shingles. Texts with equal sets are one set from the start and are linked by
    it. Rows that share a doc_id are one document: a link of any is a link of all. A null doc_id is linked with
    nothing and kept. Other columns are ignored; an empty table gives no rows.
    """
    rows = stored(signatures(docs, k), "signatures")
    full = rows.where("n_shingles > 0 and doc_id is not null")
    sets = stored(full.groupBy("h1", "h2").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")), "sets")
    comps = link_sets(sets.select("id", "n_shingles", "signature"), docs, percent, k)
    same = full.join(sets.select("h1", "h2", "id"), ["h1", "h2"]).where("doc_id <> id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    # a document with several texts joins their sets
    several = same.groupBy("a").agg(F.min("b").alias("x"), F.max("b").alias("y")).where("x <> y")
    if not several.isEmpty():
        comps = components(same.union(comps.select("id", "component")))
    member = full.join(sets.select("h1", "h2", "id"), ["h1", "h2"]).select("doc_id", "id").distinct() if several.isEmpty() else full.select("doc_id", F.col("doc_id").alias("id")).distinct()
    member = member.join(comps, "id", "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "id")).alias("component_id"))
    out = rows.select("doc_id", "n_shingles").join(member, "doc_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
