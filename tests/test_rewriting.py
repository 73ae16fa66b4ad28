"""Rewriting against plain loops."""

import datetime as dt
import random
import re
import time

from pyspark.sql import functions as F

from gristmill.functions import rewrite
from gristmill.sources import readers


def test_rules_to_a_fixpoint_with_counts(spark):
    rules = [("aa", "a"), ("ab", "b"), ("\\s+$", ""), ("x(y)", "$1")]
    rng = random.Random(1)
    texts = ["".join(rng.choices("abxy \n", k=rng.randint(0, 30))) for _ in range(200)] + ["", None, "a" * 100]

    def plain(text, passes=4):
        counts, settled = [0] * len(rules), False
        if text is None:
            return None
        for _ in range(passes):
            before = text
            for k, (p, r) in enumerate(rules):
                text, n = re.subn(p.replace("$", r"\Z"), r.replace("$1", r"\1"), text)
                counts[k] += n
            if settled := text == before:
                break
        again = text
        for p, r in rules:
            again = re.sub(p.replace("$", r"\Z"), r.replace("$1", r"\1"), again)
        return text, counts, settled or again == text

    got = [r["s"] for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", rewrite.sanitize(F.col("t"), rules, 4).alias("s")).orderBy("k").collect()]
    assert [None if s is None else tuple(s) for s in got] == [plain(t) for t in texts]
    assert not got[-1]["settled"] and all(s["settled"] for s in got[:50] if s)


def test_letters_are_joined():
    assert rewrite.joined_letters("# h\na\nb\n\nc\n d\ne\n\n\nf\ng\nend") == "# h\nabcde\n\nfg\nend"
    assert rewrite.joined_letters("a\nb\nc\nd\nlong") == "a\nb\nc\nd\nlong"  # too few
    assert rewrite.joined_letters("\n\nlong\n\n") == "\n\nlong\n\n" and rewrite.joined_letters(None) is None and rewrite.joined_letters("") == ""
    assert rewrite.joined_letters("平\n台\n规\n则\n变") == "平台规则变"


def test_blank_columns_go():
    table = "| ref | n |  ref |\n|---|:-:|---|\n|  | 1 | x |\n| | 2 |"
    assert rewrite.without_empty_columns(f"a\n{table}\nb", ["ref"]) == "a\n| n |  ref |\n|:-:|---|\n| 1 | x |\n| 2 |\nb"
    assert rewrite.without_empty_columns("| ref |\n|---|\n| |", ["ref"]) == ""
    for same in ("| ref |\nno ruler", "", None, "|---|---|\n", "| n |\n|---|\n| |", "text | ref |"):
        assert rewrite.without_empty_columns(same, ["ref"]) == same


def test_lines_and_sections(spark):
    one = lambda c: spark.range(1).select(c.alias("c")).first()["c"]
    assert one(rewrite.drop_lines(F.lit("keep\n- vague\n • vague \nvague words\nvague"), ["vague"])) == "keep\nvague words"
    text = "## 1 a\nx\n## 2 b\nold\n|---|---|\nold\n## 3 c\ny"
    assert one(rewrite.replace_section(F.lit(text), "2 b", F.lit("new"))) == "## 1 a\nx\n## 2 b\n\nnew\n## 3 c\ny"
    assert one(rewrite.replace_section(F.lit(text), "3 c", F.lit("new"))).endswith("## 3 c\n\nnew")
    assert one(rewrite.replace_section(F.lit(text), "4 d", F.lit("new"))) == text == one(rewrite.replace_section(F.lit(text), "2 b", F.lit(None).cast("string")))


def test_resume_by_count_and_age(spark, tmp_path):
    rows = lambda *days: spark.createDataFrame([(d,) for d in days], "day int").withColumn("v", F.lit(1)).write.mode("append").partitionBy("day").parquet(str(tmp_path / "out"))
    rows(1, 1, 2, 3)
    time.sleep(1.1)
    since = dt.datetime.fromtimestamp(time.time() // 1, dt.timezone.utc)
    rows(3, 4, 5, 5)  # the third day is half old
    written = spark.read.schema("v int, day int").parquet(str(tmp_path / "out"))
    expected = spark.createDataFrame([(1, 2), (2, 1), (3, 2), (4, 1), (5, 3), (6, 0), (7, 1)], "day int, rows int")
    got = {r["day"]: (r["rows"], r["valid"], r["fresh"], r["resume"]) for r in readers.resume_status(written, expected, "day", since).collect()}
    assert got == {1: (2, True, False, False), 2: (1, True, False, False), 3: (2, True, False, False), 4: (1, True, True, True), 5: (2, False, True, False), 6: (0, False, False, False), 7: (0, False, False, False)}
