"""First-fit clusters against the loop over all founders; numbers against a window."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from gristmill.operators import clusters, lineage
from gristmill.plans import registry
from gristmill.plans.clusters import cluster_rows

SCHEMA = "place long, period string, key string, fact string, entities array<string>, actions array<string>, title string"


def jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def loop(rows):
    """(place, founder) as the quadratic fold has them; how often each test decided."""
    out, used, founders = {}, [0] * 4, {}
    grams = lambda t: {t[i : i + 3] for i in range(len(t) - 2)}
    for place, period, key, fact, entities, actions, title in sorted(rows, key=lambda r: r[0]):
        for f in founders.setdefault(period, []):
            tests = [
                f[2] == key,
                bool(fact) and f[3] == fact,
                jaccard(set(f[4] or ()), set(entities or ())) >= 0.6 and bool(set(f[5] or ()) & set(actions or ())),
                bool(title) and bool(f[6]) and (title == f[6] or jaccard(grams(title), grams(f[6])) >= 0.65),
            ]
            if any(tests):
                used[tests.index(True)] += 1
                out[place] = f[0]
                break
        else:
            founders[period].append((place, period, key, fact, entities, actions, title))
            out[place] = place
    return out, used


def test_four_tests_equal_the_loop(spark):
    for seed in range(3):
        rng = random.Random(seed)
        titles = ["price war of the spring", "price war of the summer", "price war", "new store", "new stores open", "", None, "ab", "rule change", "rule changes"]
        rows = [
            (k * 3, rng.choice("pq"), f"key{rng.randrange(90)}", rng.choice([None, "", *(f"fact{i}" for i in range(60))]), rng.choice([None, [], *[rng.sample("abcdefgh", rng.randint(1, 5)) for _ in range(4)]]), rng.sample(["cut", "open", "close"], rng.randint(0, 2)), rng.choice([*titles, f"other {rng.randrange(10**9)}", f"more {rng.randrange(10**9)}"]))
            for k in range(250)
        ]
        expected, used = loop(rows)
        assert min(used) > 0 and len({*expected.values()}) > 20
        got = clusters.first_fit_clusters(spark.createDataFrame(rows, SCHEMA).repartition(3), "period").collect()
        assert {r["place"]: r["founder"] for r in got} == expected


def test_chains_and_no_rows(spark):
    chain = [(k, "p", f"k{k // 2}", f"f{(k + 1) // 2}", None, None, None) for k in range(25)]  # each fits its neighbours only
    got = clusters.first_fit_clusters(spark.createDataFrame(chain, SCHEMA), "period").collect()
    assert {r["place"]: r["founder"] for r in got} == loop(chain)[0]
    assert clusters.first_fit_clusters(spark.createDataFrame([], SCHEMA), "period").count() == 0


def test_numbers_have_no_gaps(spark):
    df = lineage.cut(spark.range(5000).select(F.when(F.col("id") % 7 != 0, F.least(F.col("id") % 50, F.lit(3))).alias("g"), F.xxhash64("id").alias("v")))
    got = clusters.number_rows(df, ["g"], [F.col("v").desc()])
    expected = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy(F.col("v").desc())))
    assert sorted(map(str, got.select("v", "number").collect())) == sorted(map(str, expected.select("v", F.col("n").alias("number")).collect()))


def test_clusters_of_the_events(spark):
    sf = "/root/testdata/sf0.001"
    rows = cluster_rows(spark, sf).select("place", "period", "key", "fact", "entities", "actions", "title", "event_id").collect()
    expected, used = loop([tuple(r)[:7] for r in rows])
    assert used[0] and used[1] and used[2]
    got = registry.QUERIES["q_first_fit_clusters"](spark, sf).collect()
    place = {r["event_id"]: r["place"] for r in rows}
    assert {place[r["event_id"]]: r["founder"] for r in got} == expected
    names = {(r["period"], r["founder"]): r["cluster"] for r in got}
    assert len(set(names.values())) == len(names) or len({p for p, _ in names}) > 1
