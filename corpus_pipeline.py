"""The corpus pipeline: quality filter, line dedup, near dedup, decontamination, tokens.

In every stage null and empty texts are rows like any other, very long texts are treated whole, an empty table gives no
rows, and further columns pass through whatever their names; what else holds is said at each stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm import bpe, decontam, line_dedup, minhash, quality
from gristmill.llm.common import columns_not_in, stored, table

#: Near copies from this similarity on, in a hundred, are one group.
NEAR_PERCENT = 80


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labels of these documents, accepts. Repeated rows and equal
    texts are on the same side; null ids are judged by their text. Without usable labels all stay."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier one has; those of which nothing is left go. n_chars follows the text.
    Ties in doc_id: rows of one id and text lose the same lines; null ids come first. Null and empty texts stay."""
    n_lines, n_dropped = columns_not_in(docs, "n_lines", "n_dropped")
    out = line_dedup.dedup_lines(docs)
    out = out.where(F.coalesce(~((F.col(n_dropped) > 0) & (F.trim(F.col("text")) == "")), F.lit(True)))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id. Rows without doc_id stay, and so do
    null and empty texts; of rows with one doc_id an arbitrary one stays."""
    kept = minhash.near_duplicates(docs, NEAR_PERCENT).where("kept and doc_id is not null").select("doc_id").distinct()
    one = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return one.unionByName(docs.where("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; repeated rows go together, and rows without text stay."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents, with digests of ids and decoded bytes, a row for each row; null texts have none."""
    return bpe.encode_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs


#: SQL can express neither the classifier nor byte-pair merges; tests compare run() with a brute-force version.
ORACLE_SQL = None
