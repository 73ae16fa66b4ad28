"""Each corpus operator against a brute-force version, and on nulls, empty texts, ties, repeats and clashing columns."""

import base64
import hashlib
import io
import math
import random
import re
import time
import zlib
from collections import Counter

import helpers
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gristmill.llm import bpe, common, decontam, embed_dedup, html_text, lattice, licenses, line_dedup, linking, minhash, quality, queries, sharding, shingles, warc

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts):
    rows = [(d, t, "en", "s", None if t is None else len(t)) for d, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


# --- shared -------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(k, k + 1) for k in range(40)], [(0, k) for k in range(1, 30)], [(5, 5), (7, 3), (3, 7), (9, 8)]])
def test_components(spark, edges):
    ids = {x for e in edges for x in e if e[0] != e[1]}
    got = {r["id"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == helpers.components(ids, [e for e in edges if e[0] != e[1]])


def test_link_by_keys_loses_no_link(spark):
    """Keys with many members, of which few are linked, and hubs that are linked with nothing."""
    draw = random.Random(4)
    values = {i: draw.randrange(60) for i in range(120)}
    keys = spark.createDataFrame([(k, i, True) for i in values for k in (0, 1 + i % 3)], "key long, id long, home boolean")
    number = spark.createDataFrame(list(values.items()), "id long, v long")
    near = lambda p: p.join(number.toDF("a", "va"), "a").join(number.toDF("b", "vb"), "b").where("va = vb").select("a", "b", F.lit(0.0).alias("distance"))
    got = {r["id"]: r["component"] for r in linking.link_by_keys(keys, near).collect()}
    expected = helpers.components(values, [(a, b) for a in values for b in values if a < b and values[a] == values[b]])
    assert {i: got.get(i, i) for i in values} == expected


def test_clean_up(spark):
    kept = common.stored(spark.range(3), "kept")
    common.clean_up(spark)
    with pytest.raises(Exception, match="exist"):
        kept.collect()


# --- 1 decontamination --------------------------------------------------------------------------------------------


def test_decontamination_equals_brute_force(spark):
    draw = random.Random(1)
    w = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(draw.choices(w, k=draw.randint(6, 40)))) for k in range(12)] + [(50, None), (51, ""), (52, "tiny item"), (53, "one"), (54, "a b c d")]
    texts = []
    for d in range(60):
        body = draw.choices(w, k=draw.randint(0, 80))
        if d % 3 == 0:
            part = items[d % 12][1].split()
            for _ in range(draw.randint(0, 2)):
                part[draw.choice((0, -1))] = "changed"
            at = draw.randint(0, len(body))
            body[at:at] = part if d % 2 else [x.upper() + "!" for x in part]
        texts.append((d, " ".join(body)))
    texts += [(100, None), (101, ""), (102, "Tiny, item!"), (103, "a tiny item here"), (104, "x one a b c d a b c d e"), (105, "one " * 30), (106, "b c d a"), (3, dict(texts)[3])]
    expected = {}
    for d, t in texts:
        have = decontam.words(t)
        for i, line in items:
            want = decontam.words(line)
            n = min(len(have), len(want)) if want else 0
            best = max((helpers.weighted_similarity(" ".join(have[s : s + n]), " ".join(want)) for s in range(len(have) - n + 1)), default=0) if n else 0
            if best >= 0.8:
                expected[d, i] = best
    docs, benchmark = docs_of(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontam.contaminations(docs, benchmark).collect()}
    assert got == pytest.approx(expected) and {(102, 52), (103, 52), (104, 53), (104, 54), (105, 53)} <= got.keys()
    left = decontam.decontaminate(docs, benchmark)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(d for d, _ in texts if d not in {d for d, _ in expected})
    assert decontam.contaminations(docs, benchmark.limit(0)).count() == decontam.contaminations(docs.limit(0), benchmark).count() == 0


def test_decontamination_of_reordered_items(spark):
    """Items whose sentences change places within longer documents, against all windows; nothing depends on the place of a shingle."""
    draw = random.Random(3)
    w = [f"w{k}" for k in range(4000)]
    items = [(k, " ".join(draw.sample(w, 50))) for k in range(6)] + [(6, " ".join(draw.sample(w, 25) * 2))]
    texts = []
    for i, line in items:
        part = line.split()
        for k, cut in enumerate((10, 20, 25, 40)):
            swapped = part[cut:] + part[:cut]
            texts.append((10 * i + k, " ".join(draw.sample(w, 70) + swapped + draw.sample(w, 30))))
        texts.append((10 * i + 8, " ".join(part[25:] + part[:20])))
        texts.append((10 * i + 9, " ".join(draw.sample(w, 30) + part[:30] + draw.sample(w, 30))))
    expected = {}
    for d, t in texts:
        have = t.split()
        for i, line in items:
            n = min(len(have), len(line.split()))
            best = max((helpers.weighted_similarity(" ".join(have[s : s + n]), line), -s) for s in range(len(have) - n + 1))
            if best[0] >= 0.8:
                expected[d, i] = (best[0], -best[1])
    assert {(10 * i + k, i) for i in range(7) for k in range(4)} <= expected.keys()
    found = decontam.contaminations(docs_of(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]): (r["similarity"], r["start"]) for r in found} == expected


def test_block_index_finds_all_within_radius(spark):
    draw = random.Random(2)
    fp = lambda: draw.getrandbits(64) - (1 << 63)
    items = [(k, 5, fp()) for k in range(8)]
    found = []
    for k in range(200):
        x = items[k % 8][2] & (2**64 - 1)
        for b in draw.sample(range(64), draw.randint(0, 20)):
            x ^= 1 << b
        found.append((k, x - (1 << 64) if x >> 63 else x, 5, False))
    near = decontam.within_radius(spark.createDataFrame(found, "n long, fp long, size int, whole boolean").drop("n"), spark.createDataFrame(items, "key long, size int, fp long"))
    assert {(r["fp"], r["key"]) for r in near.collect()} == {(x, i) for _, x, _, _ in found for i, _, y in items if ((x ^ y) & (2**64 - 1)).bit_count() <= decontam.RADIUS}


def test_simhashes_of_windows():
    h = shingles.word_hashes([f"w{k % 37}" for k in range(200)])
    for n in (1, 5, 40, 200):
        assert decontam.simhashes(h, n).tolist() == [decontam.simhash(h[k : k + n]) for k in range(201 - n)]


def test_decontamination_of_long_texts_and_null_ids(spark):
    """An item of 3,000 words in a document of 20,000, with some words changed; null ids and clashing columns."""
    draw = random.Random(12)
    w = [f"w{k}" for k in range(50_000)]
    item = draw.sample(w, 3000)
    part = list(item)
    for k in range(0, 3000, 150):
        part[k] = "changed"
    text = " ".join(draw.sample(w, 12_000) + part + draw.sample(w, 5000))
    short = "one two three four five six seven eight"
    docs = docs_of(spark, [(1, text), (None, f"x {short} y"), (2, "nothing here")]).withColumn("fp", F.lit(1)).withColumn("key", F.lit(2)).withColumn("th", F.lit("t")).withColumn("words", F.lit(0))
    benchmark = spark.createDataFrame([(7, " ".join(item), 1), (None, short, 1), (8, None, 1)], "item_id long, text string, size int")
    got = {(r["doc_id"], r["item_id"]): (r["start"], r["n_words"], r["similarity"]) for r in decontam.contaminations(docs, benchmark).collect()}
    assert got == {(1, 7): (12_000, 3000, pytest.approx(helpers.weighted_similarity(" ".join(part), " ".join(item)))), (None, None): (1, 8, 1.0)}
    assert [r["doc_id"] for r in decontam.decontaminate(docs, benchmark).collect()] == [2]


def test_decontamination_takes_passes(spark, monkeypatch):
    monkeypatch.setattr(decontam, "SEEDS_PER_PASS", 30)
    items = [(k, " ".join(f"w{10 * k + j}" for j in range(10))) for k in range(12)]
    docs = docs_of(spark, [(k, f"a b {line} c d") for k, line in items])
    found = decontam.contaminations(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"], r["start"]) for r in found) == [(k, k, 2) for k in range(12)]


# --- 2 embeddings -------------------------------------------------------------------------------------------------


def test_lattice_points_are_nearest():
    x = np.random.default_rng(0).normal(size=(500, 8)) * 2
    home = lattice.nearest(x)
    assert len(lattice.minimal_vectors()) == 240
    _, farther = lattice.neighbours(x, home, 240)
    assert farther.min() >= -1e-9  # no neighbour is nearer
    assert ((x - home / 2) ** 2).sum(1).max() <= 1 + 1e-9  # the covering radius


def test_near_vectors_equal_brute_force(spark):
    draw = np.random.default_rng(3)
    rows = [(k, v.tolist()) for k, v in enumerate(draw.normal(size=(150, 32)))]
    for k in range(150, 260):  # near copies, exact copies and multiples
        base = np.array(rows[k % 37][1])
        rows.append((k, (base * (1 + k % 3) + (k % 2) * draw.normal(size=32) * 0.05).tolist()))
    rows += [(300, None), (301, []), (302, [0.0] * 32), (303, [float("nan")] * 32), (304, [None] + [1.0] * 31), (305, [1.0, 2.0]), (306, [2.0, 4.0]), (5, rows[5][1])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, id string")
    out = {r["vec_id"]: r for r in embed_dedup.near_vectors(df).collect()}
    ok = {i: np.array(v) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    cos = lambda a, b: len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.95
    links = [(a, b) for a in ok for b in ok if a < b and cos(ok[a], ok[b])]
    expected = helpers.components([i for i, _ in rows], links)
    assert {i: r["component_id"] for i, r in out.items()} == expected
    assert all(r["n_links"] == sum(i in e for e in links) for i, r in out.items())
    assert all(r["kept"] == (i == expected[i]) for i, r in out.items())
    assert embed_dedup.near_vectors(df.limit(0)).count() == 0


def test_count_links_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK_ROWS", 7)
    v = np.random.default_rng(5).normal(size=(60, 4))
    rows = [(0, k, 1 + k % 3, x.tolist()) for k, x in enumerate(v)]
    got = {r["id"]: r["links"] for r in embed_dedup.count_links(spark.createDataFrame(rows, "component long, id long, times long, vector array<double>"), 0.5).collect()}
    u = v / np.linalg.norm(v, axis=1)[:, None]
    near = u @ u.T >= 0.5
    np.fill_diagonal(near, False)
    assert [got[k] for k in range(60)] == (near @ np.array([r[2] for r in rows])).tolist()


def test_vectors_of_very_large_and_small_components(spark):
    rows = [(1, [3e200, 4e200]), (2, [6e200, 8.1e200]), (3, [3e-200, 4e-200]), (4, [-3.0, 4.0]), (5, [1e308, 0.0]), (6, [5e-324, 0.0])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embed_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 5: (1, 5), 6: (1, 5)}


def test_links_of_a_large_component(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK_ROWS", 16)
    monkeypatch.setattr(embed_dedup, "SLICE_ROWS", 5)
    draw = np.random.default_rng(6)
    v = draw.normal(size=8) + draw.normal(size=(90, 8)) * 0.12
    u = v / np.linalg.norm(v, axis=1)[:, None]
    near = (u @ u.T >= 0.95) & ~np.eye(90, dtype=bool)
    members = spark.createDataFrame([(0, k, 1 + k % 2, v[k].tolist()) for k in range(90)], "component long, id long, times long, vector array<double>")
    times = np.array([1 + k % 2 for k in range(90)])
    assert {r["id"]: r["links"] for r in embed_dedup.count_links(members, 0.95).collect()} == dict(enumerate((near @ times).tolist()))


# --- 3 tokens -----------------------------------------------------------------------------------------------------

TOKENS = bpe.Tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"))
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=TOKENS.ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
def test_bpe_equals_tiktoken(text):
    ids = TOKENS.encode(text)
    assert ids.tolist() == REFERENCE.encode_ordinary(text)
    assert TOKENS.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 5000, " " * 3000 + "x", "ab" * 2000, "<|endoftext|>", "漢" * 900])
def test_bpe_of_long_pieces(text):
    assert TOKENS.encode(text).tolist() == REFERENCE.encode_ordinary(text)


def test_encode_documents(spark):
    texts = [(1, "Hello  world"), (2, None), (3, ""), (1, "Hello  world")]
    rows = bpe.encode_documents(docs_of(spark, texts)).collect()
    for r in rows:
        text = dict(texts)[r["doc_id"]] or ""
        ids = REFERENCE.encode_ordinary(text)
        assert (r["n_tokens"], r["ids"], r["round_trip"]) == (len(ids), ids, True)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert len(rows) == 4


# --- 4 quality ----------------------------------------------------------------------------------------------------


def test_quality_of_held_out_rows(spark):
    labels = {r["doc_id"]: r["quality"] for r in common.table(spark, "/root/testdata/sf0.01", "labels").collect()}
    rows = queries.op4_quality(spark, "/root/testdata/sf0.01").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) / len(held) > 0.95


def test_quality_edge_cases(spark):
    docs = docs_of(spark, [(1, None), (2, ""), (3, "x" * 200_000), (None, "a b c"), (3, "x" * 200_000)])
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (9, 0)], "doc_id long, quality int")
    assert quality.classify(docs, labels).count() == 5
    assert all(r["predicted"] == 1 for r in quality.classify(docs, labels.limit(0)).collect())
    assert quality.classify(docs.limit(0), labels).count() == 0
    model = quality.train(docs, labels)
    assert quality.keep_good(docs, model).columns == docs.columns


def test_fit_minimises_the_logistic_loss_of_pairs():
    """Weights against the loss written out pair by pair: no small step in any direction lowers it."""
    draw = np.random.default_rng(4)
    x = draw.normal(size=(24, len(quality.FEATURES)))
    good = x[:, 0] + 0.3 * draw.normal(size=24) > 0
    model = quality.fit(x, good, pairs=60)
    again = np.random.default_rng(7)
    winners, losers = np.flatnonzero(good), np.flatnonzero(~good)
    n = min(60, len(winners) * len(losers))
    pairs = list(zip(again.choice(winners, n), again.choice(losers, n), strict=True))
    d = model.design(x)
    loss = lambda w: sum(math.log1p(math.exp(-float((d[a] - d[b]) @ w))) for a, b in pairs) + 1e-2 * n / 1000 * float(w @ w) / 2
    least = loss(model.weights)
    for _ in range(40):
        step = draw.normal(size=len(model.weights))
        assert loss(model.weights + 1e-3 * step / np.linalg.norm(step)) > least
    s = model.strengths(x)
    assert (s > model.threshold).sum() == good.sum()  # the quantile at the share of bad rows
    assert np.allclose(model.scores(x) >= quality.CUT, s >= model.threshold)


def test_classes_of_long_texts_ties_and_clashing_columns(spark):
    texts = [(k, "Good prose, with words of all kinds, in sentences that end. " * (1 + k % 3) if k % 2 else "x1!! $$ ## " * (1 + k % 3)) for k in range(60)] + [(100, "word " * 300_000), (101, "word " * 300_000), (None, None), (1, "another text of one id")]
    docs = docs_of(spark, texts).withColumn("score", F.lit("taken")).withColumn("q", F.lit(1)).withColumn("features", F.lit(1))
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(60)], "doc_id long, quality int, toxic int")
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == len(texts)
    scores = {r["doc_id"]: r["score"] for r in rows if r["doc_id"] != 1}
    assert scores[100] == scores[101] and all(0 <= s <= 1 for s in scores.values())
    assert all((scores[k] >= quality.CUT) == bool(k % 2) for k in range(2, 60))
    one, two = (quality.train(docs.repartition(n), labels) for n in (1, 5))
    assert np.array_equal(one.weights, two.weights)
    assert quality.classify(docs.limit(0), labels).count() == 0


# --- 5 licences ---------------------------------------------------------------------------------------------------


def test_licences_and_inheritance(spark):
    files = [
        ("LICENSE", "Released under the MIT License."),
        ("a/LICENSE.txt", "This work is licensed under the GNU General Public License, version 3."),
        ("a/b/x.c", "// Licensed under the Apache License, Version 2.0.\nint main;"),
        ("a/b/y.c", "int main;"),
        ("a/b/y.c", "int main;"),
        ("a/z.c", None),
        ("q/r/s.c", ""),
        ("top.c", "Licensed under no license at all, we think"),
        (None, "text"),
    ]
    df = spark.createDataFrame(files, "path string, text string").withColumn("licence", F.lit("clash"))
    rows = licenses.licences(df).collect()
    got = {r["path"]: (r["holds"], r["origin"], r["from_path"]) for r in rows}
    assert len(rows) == len(files)
    assert got["a/b/x.c"] == ("Apache-2.0", "own", "a/b/x.c")
    assert got["a/b/y.c"] == got["a/z.c"] == ("GPL-3.0", "inherited", "a/LICENSE.txt")
    assert got["q/r/s.c"] == got["top.c"] == got[None] == ("MIT", "inherited", "LICENSE")
    assert licenses.licences(df.limit(0)).count() == 0


def test_licence_lines_of_documents(spark):
    notices = {"Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in common.table(spark, sf, "documents").collect()}
    for r in queries.op5_licenses(spark, sf).collect():
        stated = {notices[x] for x in texts[r["doc_id"]].split("\n") if x in notices}
        assert r["licence"] in stated if stated else r["licence"] is None


def brute_licence(text):
    """The licence of the unit with the highest cosine of dense TF-IDF vectors, all units against all templates."""
    counted = [Counter(licenses.terms(t)) for _, t in licenses.TEMPLATES]
    n = len(counted)
    idf = lambda t: math.log((1 + n) / (1 + sum(t in c for c in counted))) + 1
    parts = [text]
    parts += re.split(r"\n\s*\n", text)
    parts += text.split("\n")
    parts += [x for line in text.split("\n") for x in re.split(r"(?<=[.!?;])\s+|\s\|\s", line)]
    best = (0.0, None)
    for part in parts:
        v = {t: k * idf(t) for t, k in Counter(licenses.terms(part)).items()}
        for c, (name, _) in zip(counted, licenses.TEMPLATES, strict=True):
            u = {t: k * idf(t) for t, k in c.items()}
            if v:
                cosine = sum(x * v.get(t, 0) for t, x in u.items()) / math.sqrt(sum(x * x for x in u.values()) * sum(x * x for x in v.values()))
                if cosine >= licenses.MIN_COSINE and cosine > best[0] + 1e-9:
                    best = (cosine, name)
    return best


def test_licence_cosines_equal_brute_force():
    draw = random.Random(5)
    known = licenses.Templates(licenses.TEMPLATES)
    texts = ["Released under the MIT License " * 40 + "x" + " y".join(map(str, range(900)))]
    for _ in range(150):
        _, notice = draw.choice(licenses.TEMPLATES)
        body = notice.split()
        for _ in range(draw.randint(0, 6)):
            body.insert(draw.randrange(len(body) + 1), draw.choice(("other", "words", "the", "software")))
        del body[draw.randrange(len(body)) :: draw.randint(3, 30)]
        texts.append(draw.choice((" ", "\n", "\n\n")).join([" ".join(draw.choices(("lorem", "ipsum", "the", "of"), k=draw.randint(0, 50))), " ".join(body), "End. Of it | all"]))
    for text in texts:
        licence, cosine, _ = licenses.scan_text(text, known)
        expected, name = brute_licence(text)
        assert cosine == pytest.approx(expected, abs=1e-9)
        assert (licence is None) == (name is None)
        assert licence == name or expected < 1


@pytest.mark.parametrize(
    ("text", "licence"),
    [
        ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"),
        ("Licensed under CC BY-NC-ND 4.0.", "CC-BY-NC-ND-4.0"),
        ("This is not licensed under the MIT License.", None),
        ("It is no longer released under the MIT License.", None),
        ("# SPDX-License-Identifier: MIT\nx = 1", "MIT"),
        ("/* SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 */", "GPL-2.0-only WITH Classpath-exception-2.0"),
        ("// spdx-license-identifier: (MIT OR Apache-2.0)", "MIT OR Apache-2.0"),
        ("Copyright 2020\n\n" + next(t for n, t in reversed(licenses.TEMPLATES) if n == "MIT"), "MIT"),
        ("GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007\n\nPreamble and more of it", "AGPL-3.0"),
        ("words " * 50_000 + "\nReleased under the MIT License.", "MIT"),
    ],
)
def test_licence_units(text, licence):
    assert licenses.scan_text(text, licenses.Templates(licenses.TEMPLATES))[0] == licence


def test_a_document_that_is_a_licence_holds_for_its_directory(spark):
    rows = [(1, "Released under the MIT License.", "en", "s"), (2, "Prose.", "en", "s"), (3, "Long prose of many words comes first.\nReleased under the MIT License.", "de", "s"), (4, "Prose.", "de", "s"), (None, "Prose.", None, "s")]
    got = {r["doc_id"]: (r["holds"], r["origin"]) for r in licenses.document_licences(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert got == {1: ("MIT", "own"), 2: ("MIT", "inherited"), 3: ("MIT", "own"), 4: (None, "none"), None: (None, "none")}


# --- 6 WARC -------------------------------------------------------------------------------------------------------


def test_warc_round_trip(spark):
    pages = [(1, "http://e/1", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://e/3\r\nEvil: 1", None), (4, "u", ""), (5, "u", "WARC/1.1\r\n\r\n" * 50), (0, "u", "<p>yé</p>"), (6, "u", "<p>yé</p>")]
    df = spark.createDataFrame([(*p, 7) for p in pages], "page_id long, url string, html string, digest long")
    got = {r["page_id"]: r for r in warc.archive_round_trip(df).collect()}
    for i, _, html in pages:
        data = (html or "").encode()
        first = min(j for j, _, h in pages if (h or "") == (html or ""))
        r = got[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert (r["record_type"], r["refers_to"]) == (("response", None) if i == first else ("revisit", first))
    assert warc.archive_round_trip(df.limit(0)).count() == 0
    large = {r["page_id"]: r["record_type"] for r in warc.archive_round_trip(df, min_bytes=9).collect()}
    assert large[2] == "response" and large[6] == "revisit"


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(packed):
    draw = random.Random(6)
    raw = [warc.make_record(k, f"http://e/{k}", bytes(draw.choices(b"ab\r\nWARC/1.1\x1f\x8b\x08", k=draw.randint(0, 3000)))) for k in range(40)]
    parts = [warc.gzip_member(r) if packed else r for r in raw]
    starts = [sum(map(len, parts[:k])) for k in range(41)]
    bad = {3, 4, 20, 39}
    data = bytearray(b"".join(parts))
    for k in bad:
        data[starts[k] + len(parts[k]) // 2] ^= 0x55
    found = list(warc.salvage(io.BytesIO(bytes(data))))
    records = [x for x in found if isinstance(x, warc.Record)]
    assert [x.headers["warc-record-id"] for x in records] == [f"<urn:page:{k}>" for k in range(40) if k not in bad]
    gaps = [x for x in found if isinstance(x, warc.Gap)]
    assert [(g.start, g.end) for g in gaps] == [(starts[3], starts[5]), (starts[20], starts[21]), (starts[39], starts[40])]
    assert all(g.reason for g in gaps)
    assert list(warc.salvage(io.BytesIO(b""))) == []
    cut = list(warc.salvage(io.BytesIO(b"".join(parts)[:-5])))
    assert len(cut) == 40 and isinstance(cut[-1], warc.Gap)


def _plain_record(length):
    return b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: " + length + b"\r\n\r\nabc\r\n\r\n"


@pytest.mark.parametrize("length", [b"9" * 5000, "\u00b2".encode(), b"\xb2", b"-3", b"", b"3 3", b"0x3", b"900000000", b"9" * 18])
@pytest.mark.parametrize("packed", [True, False])
def test_salvage_of_false_lengths(packed, length):
    pack = warc.gzip_member if packed else bytes
    data = pack(_plain_record(length)) + pack(warc.make_record(1, "u", b"x"))
    bad, good = warc.salvage(io.BytesIO(data))
    assert isinstance(bad, warc.Gap) and good.payload == b"x" and (bad.start, bad.end) == (0, good.offset)


_PIECES = st.sampled_from([b"WARC/1.1\r\n", b"Content-Length: 3\r\n", b"Content-Length: 99999999999999999999999\r\n", b"\r\n\r\n", b"abc", b"\x1f\x8b\x08", b"\n", b": ", warc.make_record(1, "u", b"x"), warc.gzip_member(warc.make_record(2, "u", b"y"))])


@given(st.lists(_PIECES | st.binary(max_size=20), max_size=12))
@settings(max_examples=300, deadline=None)
def test_salvage_takes_any_bytes(pieces):
    data = b"".join(pieces)
    at = 0
    for x in warc.salvage(io.BytesIO(data)):
        begin, at_end = (x.start, x.end) if isinstance(x, warc.Gap) else (x.offset, None)
        assert begin >= at
        at = begin if at_end is None else at_end
    whole = [x for x in pieces if x == warc.make_record(1, "u", b"x")]
    assert not whole or any(isinstance(x, warc.Record) for x in warc.salvage(io.BytesIO(b"\n" + whole[0])))


def test_salvage_takes_linear_time():
    began = time.process_time()
    for junk in (b"WARC/1.1\r\n" * 300_000, b"\x1f\x8b\x08" * 300_000, b"\nWARC/" * 300_000):
        assert len(list(warc.salvage(io.BytesIO(junk)))) == 1
    assert time.process_time() - began < 30


def test_warc_reads_all_or_fails(spark, monkeypatch):
    long_ = "long text, " * 300_000
    df = spark.createDataFrame([(1, "u", long_), (1, "u", long_), (None, "u", "x"), (2, "u", long_)], "page_id long, url string, html string")
    got = sorted((r["page_id"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.archive_round_trip(df).collect())
    assert got == [(0, 1, "response", None), (1, len(long_), "response", None), (1, len(long_), "response", None), (2, len(long_), "revisit", 1)]
    folder = common.shared_path(spark, "warc")
    manifest = warc.write_archives(warc.mark_revisits(df), folder).collect()
    with open(manifest[0]["path"], "r+b") as f:
        f.seek(40)
        f.write(b"\0\0\0")
    broken = spark.createDataFrame(manifest, warc.MANIFEST)
    assert warc.read_archives(broken, folder).where("record_type = 'gap'").count() == 1
    with pytest.raises(Exception, match="damaged member|differs|bytes 0 to"):
        warc.read_archives(broken, folder, strict=True).collect()


# --- 7 sharding ---------------------------------------------------------------------------------------------------


def test_sharding_laws(spark):
    texts = [(k, f"t{k % 50}" * (k % 7)) for k in range(3000)] + [(None, "x"), (7, "other"), (8, None), (7, "other")]
    rows = sharding.shard_documents(docs_of(spark, texts), buckets=3).collect()
    assert len(rows) == len(texts)
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 16)
    assert set(by_shard) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    moved = sum(r["grown_shard"] == 16 for r in rows)
    assert 0.5 < moved * 17 / len(rows) < 1.6
    again = {r["doc_id"]: r["shard"] for r in sharding.shard_documents(docs_of(spark, [(5, "other text")])).collect()}
    assert again[5] == next(r["shard"] for r in rows if r["doc_id"] == 5)
    one = next(r for r in rows if r["doc_id"] == 13)
    data = dict(texts)[13].encode()
    assert (one["size"], one["text_crc32"], one["law"]) == (len(data) + 1, zlib.crc32(data), "key")
    assert sharding.shard_documents(docs_of(spark, []).limit(0)).count() == 0


def test_weights_and_shard_files(spark, tmp_path):
    df = docs_of(spark, [(k, "t") for k in range(4000)])
    counts = {r["shard"]: r["count"] for r in sharding.assign_shards(df, "doc_id", [1.0, 3.0, 0.0]).groupBy("shard").count().collect()}
    assert set(counts) == {0, 1} and 2.4 < counts[1] / counts[0] < 3.7
    sharding.write_shards(df, str(tmp_path / "s"), "doc_id", [1.0, 3.0, 0.0], tasks_per_shard=2)
    assert spark.read.parquet(str(tmp_path / "s")).count() == 4000


# --- 8 HTML -------------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body><header><h1>Site</h1></header><nav><a href="/">Home</a></nav>
<div class="ad">Buy</div>{}<aside>Side</aside><div id="comments"><p>A reader, who comments, at length, says this and that, and more.</p></div><form><input><label>Name</label></form><footer>&copy; me</footer></body></html>"""


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        (None, ""),
        ("", ""),
        ("<nav>only menu</nav>", ""),
        (PAGE.format("<article><h1>Head</h1><p>One &amp; two,<b>bold</b>\n x.<p>Three<br>four.</article>"), "Head One & two,bold x. Three four."),
        (PAGE.format("<div class=main><p>First, long enough, paragraph.</p><div><p>Second, nested, one.</p></div></div>"), "First, long enough, paragraph. Second, nested, one."),
        (PAGE.format("<article><p>Cut off <b>in the mid"), "Cut off in the mid Side"),
        ("plain &lt;text&gt; < here", "plain <text> < here"),
        ("<article><header><h2>Kept</h2></header><p>Body, it is.</p><p hidden>not shown</p></article>", "Kept Body, it is."),
    ],
)
def test_main_text(html, expected):
    got = html_text.main_text(html)
    if "in the mid" in expected:  # what follows an unclosed article belongs to it, but for what is marked otherwise
        assert got.startswith("Cut off in the mid") and "Side" not in got
    else:
        assert got == expected


@pytest.mark.parametrize(
    "attrs",
    ['style="overflow:hidden;"', 'style="overflow: hidden;"', 'title="A hidden gem of the coast"', "data-title='The hidden cost of tea'", "alt=not-hidden", 'style="content-visibility:hidden"', 'style="display:none;display:block"'],
)
def test_only_an_attribute_named_hidden_hides(attrs):
    assert html_text.main_text(PAGE.format(f"<div {attrs}><article><p>One, two.</p></article></div>")) == "One, two."
    assert html_text.main_text(f"<article><p>One <a {attrs}>two</a>.</p></article>") == "One two."


@pytest.mark.parametrize("attrs", ["hidden", "class=x HIDDEN", 'hidden=""', "hidden='until-found'", 'style="color:red; display : none"', 'style="visibility:hidden"', 'style="DISPLAY:none !important;"'])
def test_hidden_elements(attrs):
    assert html_text.main_text(f"<article><p>One, two.</p><p {attrs}>Not, shown.</p></article>") == "One, two."


@pytest.mark.parametrize(
    ("icon", "expected"),
    [
        ('<svg class="i"/>', "One two. Three."),
        ("<svg/>", "One two. Three."),
        ("<svg viewBox='0 0 1 1'><title>Icon</title><g><path d='M0'/></g></svg>", "One two. Three."),
        ("<svg><svg><text>a</text></svg><text>b</text></svg>", "One two. Three."),
        ("<svg><title/><style/><script href='x'/><text>a</text></svg>", "One two. Three."),
        ("<svg><foreignObject><div><p>a</p></div></foreignObject><text>b</text></svg>", "One two. Three."),
        ("<svg><path d='M0'>", None),
        ("<object><object>a</object>b</object>", "One two. Three."),
        ("<math><mi>x</mi><mspace/></math>", "One x two. Three."),
        ("<script>if (a</b>/.test('<svg>')) x()</script>", "One two. Three."),
    ],
)
def test_foreign_elements(icon, expected):
    got = html_text.main_text(f"<article><p>One {icon} two.</p><p>Three.</p></article>")
    assert got == expected if expected else got.startswith("One") and got.endswith("Three.")


BODY = "<p>One, long enough, paragraph of the text.</p><p>Two, another one, of it.</p>"
TEXT = "One, long enough, paragraph of the text. Two, another one, of it."


@pytest.mark.parametrize("attrs", ['class="content-sidebar-wrap"', 'class="has-sidebar"', 'class="layout no-sidebar"', 'id="page" class="comments-open"', 'class="with-ads"'])
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_class_words_of_wrappers(attrs, tag):
    noise = '<div class="sidebar"><p>Side, text.</p></div>'
    assert html_text.main_text(PAGE.format(f"<div {attrs}><{tag}>{BODY}</{tag}>{noise}</div>")) == TEXT


def test_advert_longer_than_the_article():
    assert html_text.main_text(PAGE.replace("Buy", "Buy this, and that, and more.").format("<article><p>Short.</p></article>")) == "Short."


def test_comments_longer_than_the_text():
    talk = '<div id="comments">' + "<p>I, for one, and others, agree, as said.</p>" * 20 + "</div>"
    for attrs in ("", 'class="comments-open"', 'class="has-sidebar"'):
        assert html_text.main_text(f"<body><div {attrs}><div>{BODY}</div>{talk}</div></body>") == TEXT
        assert html_text.main_text(f"<body><div {attrs}>{BODY}</div>{talk}</body>") == TEXT


@pytest.mark.parametrize(
    ("part", "kept"),
    [
        ('<header class="entry-header"><h1>Head</h1></header>', "Head"),
        ('<div class="post-header"><h1>Head</h1></div>', "Head"),
        ('<p class="notice">Mended, on Monday.</p>', "Mended, on Monday."),
        ('<section id="social-history"><h2>Then</h2><p>' + "It grew, as towns do. " * 5 + "</p></section>", "Then " + "It grew, as towns do. " * 5),
        ('<section class="related-work"><p>' + "Others, before us, tried. " * 5 + "</p></section>", "Others, before us, tried. " * 5),
        ('<div class="related-posts"><a href="/a">' + "Read that, too. " * 9 + "</a></div>", ""),
        ('<div class="social-share">Share, this.</div>', ""),
        ('<div class="ad"><p>' + "Buy it, now. " * 3 + "</p></div>", ""),
        ('<div id="comments"><article class="comment"><p>' + "I, for one, agree. " * 30 + "</p></article></div>", ""),
        ('<div class="comments-area"><p>' + "I, for one, agree. " * 30 + "</p></div>", ""),
    ],
)
def test_class_words_in_articles(part, kept):
    assert html_text.main_text(PAGE.format(f"<article>{part}{BODY}</article>")) == f"{kept.strip()} {TEXT}".strip()


LONG = "<p>" + "Many words, one after the other, fill a paragraph. " * 3 + "</p>"
SIDES = [
    "<section><p>" + "A short section of one paragraph. " * 4 + "</p></section>",
    "<h3>Third</h3>",
    "<h4>Fourth</h4>",
    "<ul><li>one</li><li>two</li></ul>",
    "<ol><li>first</li></ol>",
    "<table><tr><td>cell</td><td>of it</td></tr></table>",
    "<p>Short.</p>",
    "bare string",
    'bare <b>bold</b> and <a href="/x">link</a> in a longer sentence',
    "<blockquote>Quoted</blockquote>",
]


@pytest.mark.parametrize("side", SIDES)
def test_text_beside_the_best_section(side):
    text = lambda x: " ".join(html_text.main_text(f"<article>{x}</article>").split())
    nav = "<ul>" + '<li><a href="/a">Elsewhere</a></li>' * 3 + "</ul>"
    for best in (f"<section>{LONG * 11}</section>", f"<section><div>{LONG * 11}</div></section>"):
        page = f"<body>{nav}<div id=content><h3>Before</h3>{side}{best}{nav}{side}<div class=social>Share</div></div>{nav}</body>"
        assert html_text.main_text(page) == text(f"<h3>Before</h3>{side}{best}{side}")


def test_text_around_deep_elements_takes_linear_time():
    html_text.main_text("x<div>" * 20_000 + LONG)


def test_extract_pages(spark):
    df = spark.createDataFrame([(1, "u", PAGE.format("<article><p>\U0001f642 ok</article>"), 1), (2, None, None, 1), (1, "u", PAGE.format("<article><p>\U0001f642 ok</article>"), 1)], "page_id long, url string, html string, text int")
    assert sorted((r["page_id"], r["text"], r["n_chars"]) for r in html_text.extract_pages(df).collect()) == [(1, "\U0001f642 ok", 4), (1, "\U0001f642 ok", 4), (2, "", 0)]


@pytest.mark.parametrize(
    "html",
    [
        "<p>" * 20_000 + "x",
        '<a href="' * 5_000,
        "<!--" + "<div>" * 20_000,
        "<a" * 100_000,
        '<svg x="' * 20_000,
        "<script " * 20_000,
        "<div>" * 20_000 + "<li>" * 20_000,
        "<ul>" + "<div>" * 20_000 + "<li></li>" * 20_000,
        "<div>" * 20_000 + "</x>" * 20_000,
        "<b>" * 20_000 + "<div></div>" * 20_000,
        "<div>" * 20_000 + "<header>a</header>" * 20_000,
        "<div>" * 20_000 + "<div class=share>a</div>" * 20_000,
        "<svg><foreignObject>" + "<g>" * 20_000 + "<p></p>" * 20_000,
        "<table>" + "<tr><td>x" * 20_000,
    ],
)
def test_main_text_takes_linear_time(html):
    began = time.process_time()
    html_text.main_text(html)
    assert time.process_time() - began < 5  # a second or so; the square of these lengths would take minutes


def test_quotes_that_never_end():
    assert html_text.main_text('<article><p>One.</p><p title="x>Two.</p><p>Three, <b>four</b>.</p></article>') == "One. Two. Three, four."
    assert html_text.main_text("<article><p>If a <b and c") == "If a <b and c"


@pytest.mark.parametrize("inner", ["<div><article>{}</article></div>", "<div>{}</div>", "{}"])
def test_form_around_the_page(inner):
    page = "<body><form id=page>" + inner.format(BODY * 2) + "</form><div class=footer>F</div></body>"
    assert html_text.main_text(page) == f"{TEXT} {TEXT}"
    assert html_text.main_text(f"<article>{BODY}<form><p>Sign up, now, for more.</p></form></article>") == TEXT
    assert html_text.main_text("<body><form><label>Name</label><p>Please, log in.</p></form></body>") == ""


def test_comment_list():
    assert html_text.main_text(f'<article>{BODY}<section class="commentlist"><p>I, too, agree.</p></section></article>') == TEXT


def brute_best(html):
    """The container with the most points, by the definition: each paragraph passes its points to its parent, and half
    of them to its grandparent; a container's points are discounted by its share of link text."""
    root = html_text.parse(html)
    nodes = [root]
    for node in nodes:
        nodes += [x for x in node.children if isinstance(x, html_text.Node)]
    text = lambda n: " ".join(" ".join(x if isinstance(x, str) else text(x) for x in n.children).split())
    size = lambda n: sum(html_text._length(x) if isinstance(x, str) else size(x) for x in n.children)
    links = lambda n: size(n) if n.tag == "a" else sum(links(x) for x in n.children if not isinstance(x, str))
    points = dict.fromkeys(map(id, nodes), 0.0)
    for n in nodes:
        if n.tag == "p" and size(n):
            commas = sum(x.count(",") for x in n.children if isinstance(x, str))
            own = (1 + commas + min(size(n) / 100, 3)) * (1 - links(n) / size(n))
            points[id(n.parent)] += own
            points[id(n.parent.parent)] += own / 2
    best = max(nodes, key=lambda n: points[id(n)] * (1 - links(n) / size(n)) if size(n) else 0.0)
    return text(best)


def test_scores_equal_brute_force():
    draw = random.Random(8)
    for _ in range(200):
        sections = []
        for k in range(draw.randint(1, 5)):
            body = "".join(f"<p>{'word, ' * draw.randint(0, 9)}{'more ' * draw.randint(1, 60)}{'<a href=x>link of it</a>' * draw.randint(0, 3)}</p>" for _ in range(draw.randint(1, 4)))
            sections.append(f"<div id=s{k}>{body}</div>")
        page = f"<body><div><div>{''.join(sections)}</div></div></body>"
        order = html_text._score(html_text.parse(page))
        best = max(order, key=lambda n: n.points * (1 - n.links / n.size) if n.size else 0.0)
        out = []
        html_text._collect(best, out)
        assert "".join("".join(out).split()) == brute_best(page).replace(" ", "")


# --- 9 lines ------------------------------------------------------------------------------------------------------


def test_line_dedup_equals_brute_force(spark):
    draw = random.Random(9)
    w = "aa bb cc dd".split()
    texts = [(d, "\n".join(" ".join(draw.choices(w, k=draw.randint(0, 9))) for _ in range(draw.randint(0, 6)))) for d in range(60)]
    texts += [(100, ""), (101, "  One\tTwo  three four FIVE  \none two three four five"), (102, "one two x three four five"), (103, " ".join(draw.choices(w, k=3000)))]
    rows = line_dedup.dedup_lines(docs_of(spark, [*texts, (104, None)])).collect()
    assert {r["doc_id"]: r["text"] for r in rows} == helpers.without_repeated_lines([*texts, (104, None)])


def test_line_dedup_edge_cases(spark):
    line = "a line of five words"
    df = docs_of(spark, [(2, line), (1, f"{line}\nx"), (2, line), (None, f"{line}!\nfree")]).withColumn("n_dropped", F.lit("taken")).withColumn("gone", F.lit(1)).withColumn("th", F.lit(2))
    out = line_dedup.dedup_lines(df)
    assert out.columns == [*df.columns, "n_lines", "_n_dropped"]
    assert sorted((r["doc_id"] or 0, r["text"], r["_n_dropped"]) for r in out.collect()) == [(0, f"{line}!\nfree", 0), (1, "x", 1), (2, "", 1), (2, "", 1)]
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_line_dedup_of_short_and_blank_lines(spark):
    texts = [(1, "Yes\n\nno way\n \n"), (2, "yes\n\nno way now\nNO  WAY"), (3, "yes no\nyes")]
    rows = line_dedup.dedup_lines(docs_of(spark, texts)).collect()
    assert {r["doc_id"]: r["text"] for r in rows} == helpers.without_repeated_lines(texts) == {1: "Yes\n\nno way\n \n", 2: "\nno way now", 3: "yes no"}


def test_line_dedup_of_a_hot_variant_and_a_long_line(spark):
    """Lines that all share one variant, and one line of many words with a copy that lacks one."""
    same = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the same four words "), F.col("id")).alias("text"))
    long_ = " ".join(f"w{k}" for k in range(100_000))
    other = spark.createDataFrame([(30_000, long_), (30_001, long_.replace(" w77777 ", " "))], "doc_id long, text string")
    out = line_dedup.dedup_lines(same.union(other)).where("n_dropped = 0").collect()
    assert sorted(r["doc_id"] for r in out) == [0, 30_000]


# --- 10 near duplicates -------------------------------------------------------------------------------------------


def near_copies(seed):
    draw = random.Random(seed)
    w = [f"w{k}" for k in range(300)]
    texts = []
    for d in range(140):
        if d % 4 == 0 or not texts:
            body = draw.choices(w, k=draw.choice((0, 1, 3, 4, 5, 60, 120)))
        else:
            body = list(draw.choice(texts)[1].split())
            for _ in range(draw.randint(0, 3)):
                if body:
                    body[draw.randrange(len(body))] = draw.choice(w)
        texts.append((d, " ".join(body)))
    return texts


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates_equal_brute_force(spark, percent):
    texts = [*near_copies(percent), (200, None), (201, ""), (202, " \n\t"), (203, "Up  UP\tup"), (204, "up up up")]
    out = minhash.near_duplicates(docs_of(spark, texts).withColumn("component_id", F.lit(1)), percent).collect()
    classes, sizes = helpers.near_classes(texts, percent)
    assert {r["doc_id"]: r["component_id"] for r in out} == classes
    assert {r["doc_id"]: r["n_shingles"] for r in out} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def test_near_duplicates_edge_cases(spark):
    t = "one two three four five six seven"
    out = minhash.near_duplicates(docs_of(spark, [(3, t), (3, t), (None, t), (5, t), (3, "other words altogether in this one")])).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in out) == [(0, 0, True), (3, 3, True), (3, 3, True), (3, 3, True), (5, 3, False)]
    assert minhash.near_duplicates(docs_of(spark, []).limit(0)).count() == 0


def test_chunk_keys_meet_within_the_distance(spark):
    draw = random.Random(10)
    rows = []
    for k in range(300):
        a = [draw.randrange(1 << 16) for _ in range(minhash.COMPONENTS)]
        b = list(a)
        for i in draw.sample(range(minhash.COMPONENTS), minhash.MAX_DISTANCE):
            b[i] ^= 1
        rows.append((k, a, b))
    df = spark.createDataFrame(rows, "k long, a array<int>, b array<int>")
    assert df.where(F.arrays_overlap(minhash.chunk_keys(F.col("a")), minhash.chunk_keys(F.col("b")))).count() == 300


def test_shingles_of_words():
    a, b = (shingles.shingle_set(t) for t in ("A b c d e f", "a  B\tc d e f g"))
    assert (len(a), len(b), shingles.common(a, b)) == (2, 3, 2)
    assert len(shingles.shingle_set("x y")) == 1 and len(shingles.shingle_set(" ")) == 1 and len(shingles.shingle_set(" ")) == 0


# --- pipeline -----------------------------------------------------------------------------------------------------


def test_pipeline_equals_brute_force(spark):
    import corpus_pipeline

    docs = common.table(spark, SF, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = quality.train(docs, common.table(spark, SF, "labels"))
    kept = {d: t for d, t in sorted(texts.items()) if model.scores(quality.features(t)[None])[0] >= quality.CUT}
    lines = helpers.without_repeated_lines(kept.items())
    kept = {d: t for d, t in lines.items() if t.strip(" ") or t == kept[d]}
    classes, _ = helpers.near_classes(kept.items(), corpus_pipeline.NEAR_PERCENT)
    kept = {d: t for d, t in kept.items() if classes[d] == d}
    items = [decontam.words(r["text"]) for r in common.table(spark, SF, "benchmark").collect()]

    def leaks(text):
        have = decontam.words(text)
        for want in items:
            if not set(zip(*(have[k:] for k in range(5)), strict=False)) & set(zip(*(want[k:] for k in range(5)), strict=False)):
                continue
            n = min(len(have), len(want))
            if any(helpers.weighted_similarity(" ".join(have[s : s + n]), " ".join(want)) >= 0.8 for s in range(len(have) - n + 1)):
                return True
        return False

    expected = {d: REFERENCE.encode_ordinary(t) for d, t in kept.items() if not leaks(t)}
    got = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == expected
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "bpe"]
