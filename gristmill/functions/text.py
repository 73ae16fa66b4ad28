"""Text expressions: lexicons, keys, n-grams, buckets, rhythm and cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def nz(c: Column) -> Column:
    """Missing and empty are one."""
    return F.coalesce(c, F.lit(""))


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.trim(nz(text)), r"\s+"), "")


class Lowered:
    """A column of texts that ``lowered`` made: lexicons are looked up in it as it is, not each in a lower-cased copy."""

    def __init__(self, column: Column):
        self.column = column


def lowered(text: Column | Lowered) -> Column:
    return text.column if isinstance(text, Lowered) else F.lower(nz(text))


def keyword_hits(text: Column | Lowered, lexicon: Sequence[str]) -> Column:
    """Entries of ``lexicon`` that ``text`` holds, in lexicon order, whatever the case."""
    low = lowered(text)
    return F.array_compact(F.array(*[F.when(low.contains(str(k).lower()), F.lit(str(k))) for k in lexicon]))


def any_keyword(text: Column | Lowered, lexicon: Sequence[str]) -> Column:
    low = lowered(text)
    out = F.lit(False)
    for k in lexicon:
        out = out | low.contains(str(k).lower())
    return out


def cluster_text(text: Column) -> Column:
    """Text for cluster keys: lower case without dates, numbers, punctuation and space."""
    out = nz(text)
    for pattern in (r"\d{4}年\d{1,2}月\d{1,2}日", r"\d{4}[-/]\d{1,2}[-/]\d{1,2}", r"\d{1,2}月\d{1,2}日", r"\d+\.?\d*%?", r"[，。、！？；：‘’“”【】《》（）\[\]{},.!?;:'\"()<>]", r"\s+"):
        out = F.regexp_replace(out, pattern, "")
    return F.lower(out)


def cluster_key(kind: Column, title: Column, entities: Column, limit: int = 200) -> Column:
    """``kind:title40:entities`` with up to five sorted entities; a key longer than ``limit`` has 12 characters of their md5 instead."""
    names = F.array_join(F.slice(F.array_sort(F.array_distinct(entities)), 1, 5), "|")
    head = F.concat_ws(":", F.coalesce(F.nullif(F.trim(nz(kind)), F.lit("")), F.lit("unknown")), F.substring(cluster_text(F.trim(nz(title))), 1, 40))
    key = F.concat_ws(":", head, names)
    return F.when(F.length(key) > limit, F.concat_ws(":", head, F.substring(F.md5(names.cast("binary")), 1, 12))).otherwise(key)


def period_text(text: Column) -> Column:
    """Letters, digits and underscores of a text in lower case: the second normaliser, of the periods' keys."""
    return F.lower(F.regexp_replace(nz(text), r"[^\p{L}\p{N}_]", ""))


def period_fact_hash(fact: Column, title: Column) -> Column:
    """16 characters of the md5 of a fact, or else the title; empty without either."""
    norm = period_text(F.trim(F.coalesce(F.nullif(fact, F.lit("")), title)))
    return F.when(norm == "", "").otherwise(F.substring(F.md5(norm.cast("binary")), 1, 16))


def period_key(platforms: Column, companies: Column, kind: Column, actions: Column, default: str = "unsorted") -> Column:
    """Sorted platforms, sorted companies, kind and sorted actions, joined."""
    each = lambda a: F.array_sort(F.array_distinct(F.coalesce(a, F.array().cast("array<string>"))))
    parts = F.concat(each(platforms), each(companies), F.array(F.trim(kind)), each(actions))
    return F.coalesce(F.nullif(F.array_join(parts, "|"), F.lit("")), F.lit(default))


def article_id(url: Column, source: Column, index: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", nz(url), nz(source), index.cast("string")).cast("binary"), 256), 1, 16)


def content_hash(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.substring(F.sha2(nz(text).cast("binary"), 256), 1, 16))


def letters(text: Column, pattern: str = r"([\u4e00-\u9fff])") -> Column:
    """Distinct characters of a class, the Han characters by default."""
    return F.array_distinct(F.regexp_extract_all(nz(text), F.lit(pattern), F.lit(1)))


def title_similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of the 3-grams of two normalised titles; 1 if they are equal, 0 if either is empty."""
    x, y = period_text(a), period_text(b)
    return F.when((x == "") | (y == ""), 0.0).when(x == y, 1.0).otherwise(jaccard(char_ngrams(x), char_ngrams(y)))


def short_title(title: Column, most: int = 60) -> Column:
    return F.when(F.length(title) > most, F.concat(F.substring(title, 1, most - 3), F.lit("..."))).otherwise(title)


def mark_near(text: Column, ident: Column, marks: Sequence[str], before: int = 200, after: int = 150) -> Column:
    """Whether a mark lies around the first place of ``ident``; a text without it passes."""
    at = F.instr(text, ident)
    begin = F.greatest(at - before, F.lit(1))
    around = F.substr(text, begin, at + after - begin)
    return (at == 0) | F.coalesce(any_keyword(around, marks), F.lit(False))


def fact_hash(text: Column, chars: int = 12) -> Column:
    return F.substring(F.md5(cluster_text(text).cast("binary")), 1, chars)


def char_ngrams(text: Column, n: int = 3) -> Column:
    """Distinct character n-grams; none for shorter texts. In linear time: grams grow by a character at once."""
    letters = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    grams = letters
    for k in range(2, n + 1):
        grams = F.zip_with(grams, F.slice(letters, k, F.greatest(F.size(letters), F.lit(0))), lambda x, y: F.concat(x, y))  # null at the end
    return F.coalesce(F.array_distinct(F.array_compact(grams)), F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    """Share of common members of two arrays; 0 if both are empty."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, 0.0).otherwise(both / either)


def content_status(text: Column) -> Column:
    n = F.length(F.trim(nz(text)))
    return F.when(n > 500, "rich").when(n > 100, "moderate").when(n > 0, "thin").otherwise("empty")


def bucket(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """The first label whose edge ``value`` reaches (edges fall), else the last; null is ``missing``."""
    out = F.lit(labels[-1])
    for edge, label in reversed(list(zip(edges, labels, strict=False))):
        out = F.when(value >= edge, label).otherwise(out)
    return F.when(value.isNull(), "missing").otherwise(out)


def evidence(text: Column, keyword: str, least: int = 10, most: int = 200) -> Column:
    """First sentence of more than ``least`` characters that holds ``keyword``, cut to ``most``; null without one."""
    parts = F.transform(F.split(nz(text), r"[.!?。！？\n]"), lambda s: F.trim(s))
    hits = F.filter(parts, lambda s: F.lower(s).contains(keyword.lower()) & (F.length(s) > least))
    return F.substring(F.get(hits, F.lit(0)), 1, most)


def sentence_lengths(text: Column) -> Column:
    """Lengths in characters of the clauses of a text."""
    parts = F.transform(F.split(nz(text), r"[,.;:!?，。；：！？\n]"), lambda s: F.length(F.trim(s)))
    return F.filter(parts, lambda n: n > 0)


def orality(text: Column, stiff: Sequence[str], lively: Sequence[str], you: str = "[你您]", we: str = "我们") -> Column:
    """0 to 100 for how a script sounds: 5 off for each stiff phrase (patterns), 2 on for each lively one up to 20, 20 off
    for sentences of over 40 characters on average, 10 for over 30, 15 off where it addresses nobody (twice ``you`` and
    once ``we`` make less than 3)."""
    count = lambda patterns: sum((F.regexp_count(nz(text), F.lit(p)) for p in patterns), F.lit(0))
    lengths = F.filter(F.transform(F.split(nz(text), r"[。！？\n]"), lambda s: F.length(F.trim(s))), lambda n: n > 5)
    mean = F.when(F.size(lengths) > 0, F.aggregate(lengths, F.lit(0), lambda a, x: a + x) / F.size(lengths)).otherwise(0.0)
    score = 100 - 5 * count(stiff) + F.least(F.lit(20), 2 * count(lively))
    score = score - F.when(mean > 40, 20).when(mean > 30, 10).otherwise(0) - F.when(2 * count([you]) + count([we]) < 3, 15).otherwise(0)
    return F.greatest(F.lit(0), F.least(F.lit(100), score))


def strip_markdown(text: Column) -> Column:
    out = F.regexp_replace(nz(text), r"(?m)^#{1,6}\s*", "")
    out = F.regexp_replace(out, r"\[([^\]]*)\]\([^)]*\)", "$1")
    out = F.regexp_replace(out, r"[*_`]{1,3}", "")
    return F.regexp_replace(out, r"\n{3,}", "\n\n")


def report_sections(report: Column) -> Column:
    """Array of (number, title, body) of the numbered ``##`` sections of a report."""
    parts = F.filter(F.split(F.concat(F.lit("\n"), nz(report)), r"\n## "), lambda s: s.rlike(r"^\d"))
    return F.transform(parts, lambda s: F.struct(F.regexp_extract(s, r"^(\d+)", 1).alias("number"), F.trim(F.regexp_extract(s, r"^\d+[. ]*([^\n]*)", 1)).alias("title"), F.trim(F.regexp_replace(s, r"^[^\n]*\n?", "")).alias("body")))


def chunks(text: Column, size: int) -> Column:
    """Paragraphs packed in order into pieces of at most ``size`` characters; a longer paragraph stays whole.

    One fold over the paragraphs finds where pieces begin; only these places are gathered, not the text.
    """
    bound = lambda value, body: F.transform(F.array(value), body)[0]  # noqa: E731  # names a value, so that it is computed once
    start = F.struct(F.lit(0).alias("chars"), F.lit(0).alias("at"), F.array().cast("array<int>").alias("begins"))

    def add(acc: Column, part: Column) -> Column:
        n, at = F.length(part), acc["at"] + 1
        fits = (acc["chars"] > 0) & (acc["chars"] + n + 1 <= size)
        return F.struct(F.when(fits, acc["chars"] + n + 1).otherwise(n).alias("chars"), at.alias("at"), F.when(fits, acc["begins"]).otherwise(F.concat(acc["begins"], F.array(at))).alias("begins"))

    def pieces(parts: Column, begins: Column) -> Column:
        return F.transform(begins, lambda b, i: F.array_join(F.slice(parts, b, F.coalesce(F.get(begins, i + 1), F.size(parts) + 1) - b), "\n"))

    parts = F.filter(F.split(nz(text), "\n"), lambda p: F.trim(p) != "")
    return bound(parts, lambda ps: bound(F.aggregate(ps, start, add)["begins"], lambda bs: pieces(ps, bs)))


def parse_json(text: Column, schema: str) -> Column:
    """Struct of a JSON text: as it is, inside a fence, or the last object in it; null if none parses."""
    fenced = F.regexp_extract(nz(text), r"(?s)```(?:json)?\s*(.*?)```", 1)
    last = F.regexp_extract(nz(text), r"(?s)(\{[^{}]*\})[^{}]*$", 1)
    options = {"mode": "PERMISSIVE"}
    valid = lambda t: F.when(F.try_parse_json(t).isNotNull(), F.from_json(t, schema, options))
    return F.coalesce(valid(text), valid(F.nullif(fenced, F.lit(""))), valid(F.nullif(last, F.lit(""))))
