"""Rendezvous sharding: a record goes to the shard that draws its smallest weighted score (DataFrame functions only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.common import columns_not_in


def shard_score(key: Column, shard: int, weight: float) -> Column:
    """Exponential draw of ``shard`` for ``key``: the smaller, the better; its rate is the weight."""
    uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.ln(uniform) / F.lit(float(weight))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0 to ``len(weights) - 1``) of ``key``. A shard of weight 0 gets nothing; a null key is a key like any other.

    A further shard takes rows only into itself, and a raised weight only draws rows to that shard.
    """
    drawn = [F.struct(shard_score(key, k, w).alias("score"), F.lit(k).alias("shard")) for k, w in enumerate(weights) if w > 0]
    if not drawn:
        raise ValueError("at least one shard needs a weight above 0")
    return (F.least(*drawn) if len(drawn) > 1 else drawn[0])["shard"]


def assign_shards(df: DataFrame, key: Column | str, weights: Sequence[float], grown: Sequence[float] | None = None, shard: str = "shard", grown_shard: str = "grown_shard") -> DataFrame:
    """``df`` with its shard under ``weights`` and, where ``grown`` is given, under those weights as well."""
    key = F.col(key) if isinstance(key, str) else key
    out = df.withColumn(shard, rendezvous(key, weights))
    return out.withColumn(grown_shard, rendezvous(key, grown)) if grown is not None else out


def number_slots(df: DataFrame, shard: str, order: Sequence[str], slot: str = "slot", buckets: int = 64) -> DataFrame:
    """``df`` with a gapless number from 0 in each shard.

    Numbers run bucket by bucket: rows of a shard are spread over ``buckets`` hash buckets of ``order``, the bucket
    sizes (one row a shard and bucket) give each bucket's offset, and ``row_number`` counts within a bucket, so that no
    task holds a whole shard. Rows that are equal in ``order`` get neighbouring numbers in any order.
    """
    bucket, offset, size = columns_not_in(df, "bucket", "offset", "bucket_size")
    rows = df.withColumn(bucket, F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sizes = rows.groupBy(shard, bucket).agg(F.count(F.lit(1)).alias(size))
    before = Window.partitionBy(shard).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(shard, bucket, F.coalesce(F.sum(size).over(before), F.lit(0)).alias(offset))
    within = Window.partitionBy(shard, bucket).orderBy(*order)
    numbered = rows.withColumn(slot, F.row_number().over(within) - 1)
    return numbered.join(offsets, [shard, bucket]).withColumn(slot, (F.col(slot) + F.col(offset)).cast("long")).drop(bucket, offset)


#: Rows of a shard that are numbered in one task, about.
BUCKET_ROWS = 250_000


def shard_documents(docs: DataFrame, shards: int = 16, weights: Sequence[float] | None = None, buckets: int | None = None) -> DataFrame:
    """Shards of ``docs`` (doc_id, text) by the law ``key``: doc_id and the shard count alone decide.

    Returns doc_id, size (UTF-8 bytes of the text plus 1; a null text has none), text_crc32, law, shard, slot and
    grown_shard (the shard with one more shard of weight 1). Other columns of ``docs`` are ignored. A null doc_id is
    a key of its own; a very long text counts with all its bytes; repeated rows share their shard and get slots of their
    own, ties in any order; an empty table gives no rows. ``buckets`` a shard follow from the count of rows, of at most
    about BUCKET_ROWS each.
    """
    weights = list(weights or [1.0] * shards)
    text = F.coalesce(F.col("text"), F.lit(""))
    if buckets is None:
        buckets = max(64, docs.count() // (shards * BUCKET_ROWS) + 1)
    rows = docs.select("doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"))
    rows = assign_shards(rows, "doc_id", weights, [*weights, 1.0])
    return number_slots(rows, "shard", ["doc_id", "text_crc32", "size"], buckets=buckets).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, path: str, key: str, weights: Sequence[float], tasks_per_shard: int = 8) -> None:
    """Write ``docs`` as Parquet partitioned by shard; a shard is spread over ``tasks_per_shard`` tasks."""
    name, salt = columns_not_in(docs, "shard", "salt")
    rows = docs.withColumn(name, rendezvous(F.col(key), weights)).withColumn(salt, F.pmod(F.xxhash64(*docs.columns), F.lit(tasks_per_shard)))
    rows.repartition(F.col(name), F.col(salt)).drop(salt).write.partitionBy(name).parquet(path)
