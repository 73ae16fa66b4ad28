"""Nulls, empty and very long texts, repeated rows, empty tables and clashing names, for operators and pipeline stages."""

import hashlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from gristmill.llm import bpe, html_text, minhash, quality, sharding

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{k % 5000}" for k in range(200_000))


def docs_of(spark, texts):
    return spark.createDataFrame([(d, t, "en", "s", None if t is None else len(t)) for d, t in texts], SCHEMA)


def test_bpe_edges(spark):
    texts = [(1, LONG), (1, LONG), (None, "x"), (2, None), (3, ""), (4, "\U0001f642 \x00")]
    docs = docs_of(spark, texts).withColumn("n_tokens", F.lit("taken")).withColumn("ids", F.lit(1))
    rows = bpe.encode_documents(docs).collect()
    t = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.Tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken")).ranks, special_tokens={})
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in rows) == sorted((d or 0, len(t.encode_ordinary(x or ""))) for d, x in texts)
    assert all(r["round_trip"] for r in rows)
    assert bpe.encode_documents(docs.limit(0)).count() == 0


def test_sharding_edges(spark):
    docs = docs_of(spark, [(1, LONG), (1, LONG), (None, "x"), (2, None), (3, "")]).withColumn("shard", F.lit("taken")).withColumn("bucket", F.lit(1)).withColumn("slot", F.lit(2))
    rows = sharding.shard_documents(docs).collect()
    assert sorted((r["doc_id"] or 0, r["size"]) for r in rows) == [(0, 2), (1, len(LONG) + 1), (1, len(LONG) + 1), (2, 1), (3, 1)]
    assert len({r["shard"] for r in rows if r["doc_id"] == 1}) == 1
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    kept = sharding.assign_shards(docs, "doc_id", [1.0, 1.0], shard="to").columns
    assert kept == [*docs.columns, "to"]


def test_html_edges(spark):
    page = f"<nav>menu</nav><article><p>{LONG}</p></article>"
    pages = spark.createDataFrame([(1, "u", page, 1), (None, None, page, 1), (2, "u", None, 1), (2, "u", None, 1)], "page_id long, url string, html string, text int")
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in html_text.extract_pages(pages).collect()) == [(0, len(LONG)), (1, len(LONG)), (2, 0), (2, 0)]
    assert html_text.extract_pages(pages.limit(0)).count() == 0


def test_near_duplicates_of_very_long_texts(spark):
    other = LONG.replace("word7 ", "changed ", 3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(docs_of(spark, [(5, LONG), (3, other), (9, "short text of five words")]).withColumn("kept", F.lit("taken"))).collect()}
    assert (got[5][1], got[3][1], got[9][1]) == (3, 3, 9)
    w = LONG.split()
    assert got[5][0] == len({tuple(w[k : k + 5]) for k in range(200_000 - 4)})


@pytest.fixture(scope="module")
def stages():
    import corpus_pipeline

    return dict(corpus_pipeline.STAGES)


def clashing(docs):
    for c in ("score", "th", "gone", "component_id", "ids", "h1", "words", "key"):
        docs = docs.withColumn(c, F.lit(c))
    return docs


def test_stages_take_edge_cases(spark, stages):
    """Each stage but the last returns the columns it was given; nulls and empty texts don't fail it."""
    good = "Plain prose, in sentences of some length, that nobody else has. " * 5
    texts = [(1, good), (1, good), (None, good + "More of it."), (2, None), (3, ""), (4, LONG), (5, LONG)]
    docs = clashing(docs_of(spark, texts))
    for name in ("quality", "line_dedup", "near_dedup", "decontamination"):
        out = stages[name](spark, docs, SF)
        assert out.columns == docs.columns
        ids = [r["doc_id"] for r in out.collect()]
        assert set(ids) <= {1, 2, 3, 4, 5, None}
        assert stages[name](spark, docs.limit(0), SF).count() == 0
        if name == "near_dedup":  # one of equal documents, null ids stay, empty texts are linked with nothing
            assert sorted(x or 0 for x in ids) == [0, 1, 2, 3, 4]
        if name == "decontamination":
            assert sorted(x or 0 for x in ids) == [0, 1, 1, 2, 3, 4, 5]
    rows = stages["bpe"](spark, docs, SF).collect()
    assert len(rows) == len(texts) and {r["n_tokens"] for r in rows if r["doc_id"] in (2, 3)} == {0}
    assert stages["bpe"](spark, docs.limit(0), SF).count() == 0


def test_line_stage_drops_what_is_left_empty(spark, stages):
    line = "a line of five words"
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in stages["line_dedup"](spark, clashing(docs_of(spark, [(1, line), (2, line), (3, f"{line}\nnew"), (4, None), (5, "")])), SF).collect()}
    assert out == {1: (line, 20), 3: ("new", 3), 4: (None, None), 5: ("", 0)}


def test_features_of_edge_texts():
    assert not quality.features(None).any() and not quality.features("").any()
    assert hashlib.sha256(quality.features(LONG).tobytes()).hexdigest() == hashlib.sha256(quality.features(LONG).tobytes()).hexdigest()
