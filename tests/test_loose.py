"""Repair of JSON, loose types, site items and counted writes against plain versions."""

import json
import random
from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark.sql import functions as F

from gristmill.functions import loose, repair
from gristmill.plans import registry
from gristmill.plans.loose import list_pages
from gristmill.sources import metrics, sites

SF = "/root/testdata/sf0.001"


def longest_start(text):
    """Tries every start of ``text`` with the brackets closed that are open outside strings."""
    for n in range(len(text), 0, -1):
        stack, quoted, skip = [], False, False
        for c in text[:n]:
            if skip:
                skip = False
            elif quoted:
                skip, quoted = c == "\\", c != '"'
            elif c == '"':
                quoted = True
            elif c in "{[":
                stack.append("}" if c == "{" else "]")
            elif c in "}]":
                if not stack or stack.pop() != c:
                    break
        else:
            try:
                if isinstance(json.loads(out := text[:n] + "".join(reversed(stack))), (dict, list)):
                    return out
            except ValueError:
                pass
    return None


def same(text):
    """Equal but for white space before the closing brackets, where the search keeps it."""
    got, expected = repair.closed(text), longest_start(text)
    assert (got is None) == (expected is None) and (got is None or json.loads(got) == json.loads(expected)), text


def test_repair_equals_a_search_over_all_starts():
    values = [{"a": [1, -2.5e-3, True, None, {"b": "x\\\"}]é\n", "c": []}], "d": {}, "e": "\U0001f642"}, [[[]]], {"": {"": ""}}, [0.5, "a,b", {"k": 10}]]
    for text in [json.dumps(v, ensure_ascii=k % 2 == 0, indent=k or None) for k in range(3) for v in values]:
        for n in range(len(text) + 1):
            same(text[:n])
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choices('{}[]",:1 -e.tn\\', k=rng.randint(0, 12)))
        same(text)
    assert repair.closed(None) is None and repair.closed("") is None
    assert json.loads(repair.closed("[" * 500_000)[:3] + "]]]") is not None


def test_repair_column(spark):
    rows = spark.createDataFrame([('{"a": 1}',), ('"text"',), ('{"a": [1, {"b": "c',), (None,), ("none",)], "t string")
    assert [r["r"] for r in rows.select(repair.repair_json(F.col("t")).alias("r")).collect()] == ['{"a": 1}', '"text"', '{"a": [1, {}]}', None, None]


def test_loose_text_and_lexicons(spark):
    docs = ['{"v": [1, "b", [2], null, true]}', '{"v": {"x": 1}}', '{"v": 1.5}', '{"v": []}', "[]", None, "broken"]
    got = spark.createDataFrame([(d,) for d in docs], "d string").select(loose.loose_text(loose.variant(F.col("d")), "$.v").alias("v")).collect()
    assert [r["v"] for r in got] == ["1 b [2] true", '{"x":1}', "1.5", "", "", "", ""]
    lexicons = [(1, '{"a": {"x": ["w", 618, "w"]}, "b": ["v", "w"]}'), (2, "{}"), (3, "[1]"), (4, None), (5, '{"a": "none", "b": {"c": 5, "d": {"e": ["deep"]}}}')]
    got = loose.flatten_lexicon(spark.createDataFrame(lexicons, "id int, t string").select("id", loose.variant(F.col("t")).alias("lexicon")), "lexicon").collect()
    assert sorted((r["id"], r["place"], r["word"]) for r in got) == [(1, 0, "w"), (1, 1, "618"), (1, 2, "v")]


class Plain(HTMLParser):
    """State, JSON-LD, published time and links by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.links, self.scripts, self.meta, self.open = [], [], None, None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "a":
            self.open = (a.get("href"), [])
        elif tag == "script":
            self.scripts.append([a.get("type"), ""])
        elif tag == "meta" and a.get("property") == "article:published_time":
            self.meta = a["content"]

    def handle_data(self, data):
        if self.cdata_elem == "script":
            self.scripts[-1][1] += data
        elif self.open:
            self.open[1].append(data)

    def handle_endtag(self, tag):
        if tag == "a" and self.open:
            self.links.append((self.open[0], "".join(self.open[1])))
            self.open = None


def plain_items(page, base):
    p = Plain()
    p.feed(page)
    host = base.split("/")[2] if base else ""
    if host.endswith("example.org"):
        for _, script in p.scripts:
            if script.startswith("window.initialState = "):
                state = json.loads(script.removeprefix("window.initialState = ").removesuffix("; go()"))
                return [(f"https://example.org/p/{x['itemId']}", " ".join(x["name"].replace("<b>", "").replace("</b>", "").split()), x.get("at"), "state") for x in state["feed"]["items"] if "itemId" in x]
    for kind, script in p.scripts:
        if kind == "application/ld+json":
            x = json.loads(script)
            return [(urljoin(base or "", x["url"]), x["headline"].replace("&amp;", "&"), x["datePublished"], "json-ld")]
    out, least = {}, 4 if host.endswith("example.net") else 1
    for href, title in p.links:
        title = " ".join(title.split())
        if href and not href.startswith(("#", "javascript:", "mailto:")) and len(title) >= least and ("/" in href or least == 1):
            out.setdefault(urljoin(base or "", href.strip()), title)
    return [(u, t, p.meta, "link") for u, t in out.items()]


def test_site_items_equal_a_plain_parser(spark):
    expected = sorted((r["page_id"], *map(str, x)) for r in list_pages(spark, SF).collect() for x in plain_items(r["html"], r["url"]))
    got = sorted((r["page_id"], *map(str, r[1:])) for r in registry.QUERIES["q_site_items"](spark, SF).collect())
    assert got == expected and {r[4] for r in got} == {"state", "json-ld", "link"}


def test_odd_pages_have_items_or_none():
    assert sites.items_of("", "", []) == []
    page = '<script>window.s = {"a": {"b": "no list"}}</script><script type="application/ld+json">{broken</script><time datetime="2024"><a href="/x">t</a><a href="#y">z</a><a href="/x">again</a>'
    assert sites.items_of(page, "https://a.b/c", [{"host": "b", "state": "s", "path": ["a", "b"], "id": "i", "title": "t", "url": "{}"}]) == [("https://a.b/x", "t", "2024", "link")]


def test_counters_come_from_the_pass_that_writes(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)
    df = spark.range(1000).mapInArrow(lambda bs: (reads.add(b.num_rows) or b for b in bs), "id long").where("id % 3 = 0")
    got = metrics.write_counted(df, str(tmp_path / "out"), {"n": F.count(F.lit(1)), "most": F.max("id"), **metrics.count_by(F.col("id") % 2, {"even": 0, "odd": 1})})
    assert got == {"n": 334, "most": 999, "even": 167, "odd": 167} and reads.value == 1000
    written = spark.read.parquet(str(tmp_path / "out"))
    assert metrics.reconciled(written, got, "n", ["even", "odd"]) == {"rows": True, "parts": True}
    assert metrics.reconciled(written.limit(5), got, "n", ["even"]) == {"rows": False, "parts": False}
