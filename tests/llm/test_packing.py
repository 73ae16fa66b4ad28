"""Packing against the tokenizers library, and the laws of sequences."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gristmill.llm import packing
from gristmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def check(rows, ids_of, capacity=1024):
    """Every document whole, in order and in its own ids; sequences without gaps. Returns the share of padding."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids_of)
    for doc, pieces in by_doc.items():
        ids, at = ids_of[doc], 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : at].tobytes())
        assert at == len(ids)
    padded = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
        padded += at if at & at - 1 == 0 else capacity
    return padded / max(1, sum(map(len, ids_of.values()))) - 1


def test_packing_of_the_table(spark, library):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op13_packing"](spark, SF).collect()
    assert check(rows, {d: library(t) for d, t in texts.items()}) < 0.01


@pytest.mark.parametrize(("capacity", "shortest"), [(1024, 64), (64, 16), (8, 8), (32, 1)])
def test_packing_by_many_workers(spark, library, capacity, shortest):
    rng = np.random.default_rng(5)
    words = ["one", "two ", "été", "\n", " x", "  ", "'s", "12", "ж"]
    texts = {d: "".join(rng.choice(words, rng.integers(0, 300))) for d in range(400)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)
    rows = packing.pack_documents(docs, capacity=capacity, shortest=shortest).collect()
    assert check(rows, {d: library(t) for d, t in texts.items()}, capacity) < 0.05


def test_cuts():
    for n in range(1, 5000):
        got = packing.cuts(n)
        assert sum(got) == n and all(x >= 64 and x & x - 1 == 0 or k == len(got) - 1 for k, x in enumerate(got))


def test_packing_edges(spark, library):
    long = " ".join(f"w{k}" for k in range(100_000))
    texts = {1: None, 2: "", 3: long, 4: " " * 300_000 + "x", 5: "<|endoftext|> a\r\n\x00"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumns({"length": F.lit("taken"), "Worker": F.lit(1), "sequence_id": F.lit(None).cast("int")})
    rows = packing.pack_documents(docs).collect()
    check(rows, {d: library(t) for d, t in texts.items()})
    assert packing.pack_documents(docs.limit(0)).count() == 0
    twice = packing.pack_documents(docs.where("doc_id = 2").union(docs.where("doc_id = 2")).withColumn("doc_id", F.lit(None).cast("long"))).collect()
    assert [(r["doc_id"], r["start"], r["length"], r["doc_tokens"]) for r in twice] == [(None, 0, 1, 1)] * 2
    assert sorted((r["sequence_id"], r["offset"]) for r in twice) == [(0, 0), (0, 1)]
    with pytest.raises(ValueError):
        packing.pack_documents(docs, capacity=1000)
