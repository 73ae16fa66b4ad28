"""Line deduplication with a deletion-neighbourhood join (DataFrame functions only).

Lines are compared by their words, in lower case and without regard to white space. A line goes if an earlier one (by
doc_id, then line number) is equal; with MIN_WORDS words or more it goes as well if an earlier one is within one word
inserted, deleted or replaced. (One word of a shorter line is much of what it says.) Lines without words stay.

Every variant of a line with one word left out is a hashed key. Lines with equal keys are within the bound: with the
same word left out, one word is replaced; a variant that equals a whole line is an insertion. Each key therefore needs
only its earliest line, not all its pairs. Two lines within the bound share their first or their last half, so lines
that share neither end with another line emit no variants; this loses no pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.common import columns_not_in, discard, stored

MIN_WORDS = 5
#: A sieve of so many hash buckets, one row each at most, is what is broadcast.
SIEVE = 1 << 20


def normal_line(line: Column) -> Column:
    """Words of a line in lower case, one space between them."""
    out = F.lower(line)
    for space in "\t\r\f\x0b":
        out = F.replace(out, F.lit(space), F.lit(" "))
    return F.trim(F.when(out.contains("  "), F.regexp_replace(out, " +", " ")).otherwise(out))


def word_count(normal: Column) -> Column:
    return F.when(normal == "", 0).otherwise(F.octet_length(normal) - F.octet_length(F.replace(normal, F.lit(" "), F.lit(""))) + 1)


def _end_length(n: Column) -> Column:
    """The largest power of two that fits into half of ``n`` - 1 words, so that it is mostly that of ``n`` - 1 as well."""
    return F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(F.floor((n - 1) / 2), F.lit(1))))).cast("int")


def end_keys(normal: Column, own: Column, less: Column) -> list[Column]:
    """Keys of the first and last ``own`` words of a line, and of ``less`` words where that differs (else null)."""
    key = lambda k: F.xxhash64(F.call_function("substring_index", normal, F.lit(" "), k))
    return [key(own), key(-own), F.when(own != less, key(less)), F.when(own != less, key(-less))]


def raw_lines(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), no and line of each line of ``docs``; a null text has none."""
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].cast("string").alias("text")).where(F.col("text").isNotNull())
    return rows.select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(F.split("text", "\n")).alias("no", "line"))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column from a one-row inner table: what is built on it doesn't make Spark compute it again."""
    return df.select("*", F.explode(F.array(F.struct(value.alias(name)))).alias("_once")).select(*df.columns, F.col(f"_once.{name}").alias(name))


def counted_words(lines: DataFrame) -> DataFrame:
    """``lines`` with normal and n (words) in place of line; those without words are left out."""
    out = _once(lines, "normal", normal_line(F.col("line"))).drop("line").where("normal <> ''")
    return _once(out, "n", word_count(F.col("normal")))


def variants(lines: DataFrame) -> DataFrame:
    """Deletion neighbourhoods of ``lines`` (line, n, words, front, back): line, kind and key.

    kind 0 is the whole line, kind 1 the line without one word, kind 2 the same with that word's place. A key is the
    exclusive or of hashes of words and places, taken over the line by running windows, in linear time for any length.
    A word of the first half is left out only where ``front``, one of the last only where ``back``.
    """
    word = lines.select("line", "n", "front", "back", F.posexplode("words").alias("at", "word"))
    word = word.select("line", "n", "front", "back", "at", F.xxhash64("word", "at").alias("a"), F.xxhash64("word", F.col("at") - 1).alias("b"))
    whole = Window.partitionBy("line")
    before = whole.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = word.select("*", F.bit_xor("a").over(whole).alias("all_a"), F.bit_xor("b").over(whole).alias("all_b"), F.bit_xor("a").over(before).alias("to_a"), F.bit_xor("b").over(before).alias("to_b"))
    rest = F.col("to_a").bitwiseXOR(F.col("a")).bitwiseXOR(F.col("all_b")).bitwiseXOR(F.col("to_b"))
    half = F.floor((F.col("n") - 1) / 2)
    wanted = (F.col("back") & (F.col("at") >= half)) | (F.col("front") & (F.col("at") < F.col("n") - half))
    keys = [
        F.when(wanted, F.struct(F.lit(1).alias("kind"), F.xxhash64(F.lit(1), F.col("n") - 1, rest).alias("key"))),
        F.when(wanted, F.struct(F.lit(2).alias("kind"), F.xxhash64(F.lit(2), "n", "at", F.col("all_a").bitwiseXOR(F.col("a"))).alias("key"))),
        F.when(F.col("at") == 0, F.struct(F.lit(0).alias("kind"), F.xxhash64(F.lit(1), "n", "all_a").alias("key"))),
    ]
    return run.select("line", F.explode(F.array_compact(F.array(*keys))).alias("v")).select("line", "v.kind", "v.key")


def within_one_word(a: Column, b: Column) -> Column:
    """Whether word arrays are within one word inserted, deleted or replaced."""
    same = lambda x, y: F.zip_with(F.slice(x, 1, F.least(F.size(x), F.size(y))), F.slice(y, 1, F.least(F.size(x), F.size(y))), lambda p, q: p == q)
    wrong = F.size(F.filter(same(a, b), lambda x: ~x))
    at = F.array_position(same(a, b), False).cast("int")  # first difference, 0 if there is none
    long_, short = F.when(F.size(a) > F.size(b), a).otherwise(b), F.when(F.size(a) > F.size(b), b).otherwise(a)
    skipped = (at == 0) | (F.slice(long_, at + 1, F.size(long_)) == F.slice(short, F.greatest(at, F.lit(1)), F.size(short)))
    return F.when(F.size(a) == F.size(b), wrong <= 1).when(F.abs(F.size(a) - F.size(b)) == 1, skipped).otherwise(False)


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Lines (doc_id, th, no, reason) that go: ``equal`` or ``near`` an earlier one."""
    lines = counted_words(raw_lines(docs))
    lines = lines.withColumn("own", _end_length(F.col("n"))).withColumn("less", _end_length(F.col("n") - 1))
    ends = [F.when(F.col("n") >= min_words, c).alias(f"k{i}") for i, c in enumerate(end_keys(F.col("normal"), F.col("own"), F.col("less")))]
    keys = [f"k{i}" for i in range(len(ends))]
    met = stored(lines.select(F.xxhash64("normal").alias("h1"), F.xxhash64(F.lit(1), "normal").alias("h2"), "doc_id", "th", "no", *ends), "met-lines")
    ref = F.struct("doc_id", "th", "no")
    distinct = stored(met.groupBy("h1", "h2").agg(F.min(ref).alias("first"), F.count(F.lit(1)).alias("times"), *[F.max(k).alias(k) for k in keys]), "lines")

    again = distinct.where("times > 1").select("h1", "h2", "first")
    equal = met.select("h1", "h2", ref.alias("ref")).join(again, ["h1", "h2"]).where(~F.col("ref").eqNullSafe(F.col("first"))).select("ref.*", F.lit("equal").alias("reason"))

    # lines that share an end with another line; a shared first end leaves the edit to the back, a shared last one to the front
    end = distinct.select("h1", F.explode(F.array_compact(F.array(*keys))).alias("key"))
    shared = end.groupBy("key").agg(F.min("h1").alias("x"), F.max("h1").alias("y")).where("x <> y").select("key")
    live = stored(end.join(shared, "key", "left_semi"), "ends")
    open_ = distinct.join(live.groupBy("h1").agg(F.collect_set("key").alias("live")), "h1")
    any_live = lambda *ks: F.exists(F.array_compact(F.array(*ks)), lambda k: F.array_contains("live", k))
    open_ = stored(open_.select(F.col("h1").alias("line"), "first", any_live("k1", "k3").alias("front"), any_live("k0", "k2").alias("back")), "open-lines")
    discard(live)

    # only the open lines are read again; the sieve spares most others the shuffle while it isn't full
    bucket = lambda d, o: F.pmod(F.xxhash64(d, o), F.lit(SIEVE)).cast("int")
    sieve = open_.select(bucket("first.doc_id", "first.no").alias("bucket")).distinct()
    some = raw_lines(docs).withColumn("bucket", bucket("doc_id", "no")).join(F.broadcast(sieve), "bucket", "left_semi").drop("bucket")
    wanted = open_.select("line", "front", "back", F.col("first.doc_id").alias("d"), F.col("first.th").alias("t"), F.col("first.no").alias("o"))
    some = some.withColumnRenamed("line", "raw")
    held = some.join(wanted, some.doc_id.eqNullSafe(wanted.d) & (some.th == wanted.t) & (some.no == wanted.o))
    held = held.select("line", ref.alias("ref"), "front", "back", "raw").dropDuplicates(["line"])
    held = _once(held, "words", F.split(normal_line(F.col("raw")), " ")).drop("raw").withColumn("n", F.size("words"))
    held = stored(held, "held-lines")

    keyed = every = stored(variants(held), "all-variants")
    met_twice = keyed.groupBy("key").agg(F.min("line").alias("x"), F.max("line").alias("y")).where("x <> y").select("key")
    shared_keys = stored(keyed.join(met_twice, "key"), "variants")
    discard(every)
    keyed = shared_keys.join(held.select("line", "ref"), "line")
    least = lambda kind: F.min(F.when(F.col("kind") == kind, F.col("ref"))).alias(f"first{kind}")
    firsts = keyed.groupBy("key").agg(least(0), least(1), least(2))
    partner = F.when(F.col("kind") == 0, F.col("first1")).when(F.col("kind") == 1, F.col("first0")).otherwise(F.col("first2"))
    pairs = keyed.join(firsts, "key").select("ref", partner.alias("earlier")).where("earlier < ref").distinct()
    pairs = pairs.join(held.select("ref", F.col("words").alias("a")), "ref").join(held.select(F.col("ref").alias("earlier"), F.col("words").alias("b")), "earlier")
    near = pairs.where(within_one_word(F.col("a"), F.col("b"))).select("ref.*", F.lit("near").alias("reason"))
    out = stored(equal.union(near), "repeated-lines")
    discard(met, distinct, open_, held, shared_keys)
    return out


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (doc_id, text, ...) without repeated lines, with n_lines and n_dropped.

    The lines that stay, and the order of lines, are as they were; lines without words always stay, and those of fewer
    than ``min_words`` words go only where an earlier one is equal. A null text stays null (0 lines), an empty one empty
    (1 line); very long texts and lines are treated whole, as a line's variants are rows of their own. Rows with equal doc_id and text are one document, so
    that repeated rows lose the same lines; a null doc_id comes before all others. Further columns pass through, under
    any name; counts get a leading underscore where their names are taken. An empty table gives no rows.
    """
    n_lines, n_dropped, d, t, gone = columns_not_in(docs, "n_lines", "n_dropped", "d", "t", "gone")
    drops = repeated_lines(docs, min_words).groupBy("doc_id", "th").agg(F.collect_set("no").alias(gone))
    drops = drops.select(F.col("doc_id").alias(d), F.col("th").alias(t), gone)
    text = docs["text"].cast("string")
    out = docs.join(drops, docs["doc_id"].eqNullSafe(drops[d]) & (F.xxhash64(text) == drops[t]), "left")
    lines = F.split(text, "\n")
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(F.col(gone), i)), "\n")
    new = F.when(F.col(gone).isNull(), text).otherwise(left)
    kept = [new.alias("text") if c.lower() == "text" else docs[c] for c in docs.columns]
    return out.select(*kept, F.when(text.isNull(), 0).otherwise(F.size(lines)).alias(n_lines), F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).alias(n_dropped))
