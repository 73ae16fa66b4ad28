"""Values of unknown shape: VARIANT columns for fields that may be a text, a list, a number or an object."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def variant(text: Column) -> Column:
    """A JSON text as a VARIANT; null if it isn't JSON."""
    return F.try_parse_json(text)


def loose_text(value: Column, path: str) -> Column:
    """The field at ``path`` as a text: members of a list joined by spaces (null members are left out), anything else as it
    reads; empty where it is missing or null."""
    items = F.try_variant_get(value, path, "array<string>")
    plain = F.try_variant_get(value, path, "string")
    is_list = F.schema_of_variant(F.try_variant_get(value, path, "variant")).startswith("ARRAY")
    return F.coalesce(F.when(F.coalesce(is_list, F.lit(False)), F.array_join(items, " ")).otherwise(plain), F.lit(""))


def flatten_lexicon(df: DataFrame, lexicon: str) -> DataFrame:
    """Words of nested lexicons, each once and numbered in order: the other columns of ``df`` with (place, word).

    ``lexicon`` is a VARIANT column: categories that hold a list of words, or categories of lists. Words may be numbers.
    Objects give their members by name, as a VARIANT holds them. Other values are no lists and are left out; null
    members of lists too. Rows without words give nothing.
    """
    keys = [c for c in df.columns if c != lexicon]
    exploded = lambda rows, column: rows.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col(column).outer()))
    kind = lambda c: F.schema_of_variant(c)
    top = exploded(df.select(*keys, F.col(lexicon).alias("_lexicon")).where(kind(F.col("_lexicon")).startswith("OBJECT")), "_lexicon")
    top = top.select(*keys, F.col("pos").alias("_category"), F.col("value").alias("_held"))
    lists = top.where(kind(F.col("_held")).startswith("ARRAY")).select(*keys, "_category", F.lit(-1).alias("_sub"), F.col("_held").alias("_words"))
    nested = exploded(top.where(kind(F.col("_held")).startswith("OBJECT")), "_held").select(*keys, "_category", F.col("pos").alias("_sub"), F.col("value").alias("_words"))
    lists = lists.unionByName(nested.where(kind(F.col("_words")).startswith("ARRAY")))
    words = exploded(lists, "_words").select(*keys, F.struct("_category", "_sub", "pos").alias("_at"), F.try_variant_get("value", "$", "string").alias("word")).where("word is not null")
    first = words.groupBy(*keys, "word").agg(F.min("_at").alias("_at"))
    listed = first.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_at", "word"))).alias("_all"))  # as long as a lexicon
    return listed.select(*keys, F.posexplode("_all").alias("place", "_word")).select(*keys, "place", F.col("_word.word").alias("word"))
