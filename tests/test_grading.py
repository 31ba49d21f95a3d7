"""Grading of many pairs in one plan against a plain version of its rules."""

import random
from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

from semgraph.operators import grade
from semgraph.operators.running import ranged, running_totals


def plain(g_names, g, r_names, r):
    lower = [n.lower() for n in g_names]
    if len(g_names) > len(r_names) and all(n.lower() in lower for n in r_names):
        keep = [lower.index(n.lower()) for n in r_names]
        g_names, g = [g_names[i] for i in keep], [[row[i] for i in keep] for row in g]
    normal = lambda rows: sorted(tuple(sorted("NULL" if v is None else str(v).lower() for v in row)) for row in rows)
    a, b = normal(g), normal(r)
    if max(len(a), len(b)) >= 500:
        if len(a) < len(b) and (len(b) - len(a)) / len(b) > 0.1:
            return False
        if (len(a) > len(b) and not Counter(b) - Counter(a)) or not a:
            return True
        size = min(50, len(a))
        places = [i * (len(a) // size) for i in range(size)]
        return sum(p < len(b) and a[p] == b[p] for p in places) / size >= 0.8
    if len(a) != len(b):
        return False
    more = len(g_names) - len(r_names)
    return a == b or (0 < more <= 4 and any(normal([[row[i] for i in c] for row in g]) == b for c in combinations(range(len(g_names)), len(r_names))))


def test_all_pairs_equal_a_plain_version(spark):
    rng = random.Random(11)
    cases, pairs = {}, {}
    for i in range(36):
        n = rng.choice([0, 1, 3, 20, 499, 500, 1300])
        r = [[rng.choice(["A", "b", None, "c"]), str(rng.randrange(60))] for _ in range(n)]
        g = [list(row) for row in r]
        for _ in range(rng.choice([0, 0, 1, n // 20, n // 6, n // 2])):
            if g:
                g[rng.randrange(len(g))][1] = rng.choice([None, "x", "60"])
        g += [list(rng.choice(r)) for _ in range(rng.choice([0, 0, 0, 2]))] if r else []
        g = g[: len(g) - rng.choice([0, 0, 0, 1, n // 15, n // 5])]
        rng.shuffle(g)
        names, extra = rng.choice([(["k", "v"], 0), (["V", "other"], 0), (["k", "V", "m"], 1), (["p", "q", "m", "o"], 2), (["a", "b", "c", "d", "e", "f", "g"], 5)])
        g = [[*row, *(["same"] * extra)] for row in g]
        cases[f"p{i}"] = (names, g, ["k", "v"], r)
        frame = lambda rows, cs: spark.createDataFrame([tuple(x) for x in rows], ", ".join(f"{c} string" for c in cs))
        pairs[f"p{i}"] = (frame(g, names), frame(r, ["k", "v"]))
    got = {row["pair"]: row for row in grade.graded(pairs).collect()}
    wrong = {k: (got[k], len(c[1]), len(c[3])) for k, c in cases.items() if got[k]["correct"] != plain(*c)}
    assert not wrong and len(got) == 36 and {r["correct"] for r in got.values()} == {True, False}
    assert all((r["reason"] is None) == r["correct"] for r in got.values())


def test_reasons_and_equal_names(spark):
    n = spark.range(1000).select("id", (F.col("id") * 2).alias("v"))
    found = {r["pair"]: r["reason"] for r in grade.graded({"short": (n.limit(800), n), "other": (n.select("id", F.lit(-1).alias("v")), n), "few": (n.limit(3), n.limit(4)), "twice": (n.limit(5).select("id", "id"), n.limit(5).select("id", "id")), "values": (n.where("id < 5"), n.where("id > 994"))}).collect()}
    assert found == {
        "short": "row count divergence >10% below reference: generated=800 reference=1000", "other": "sampled match rate 0.0% < 80%",
        "few": "row count mismatch: generated=3 reference=4", "twice": None, "values": "result set values differ",
    }


def test_totals_within_a_hot_group(spark):
    rows = [("hot", k, k % 5) for k in range(3000)] + [(None, k, 1) for k in range(4)] + [("z", None, 3), ("z", 1, 4)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = ranged(spark.createDataFrame(rows, "g string, k long, n long").repartition(7), ["g", "k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert dealt.where("g = 'hot'").select("_range").distinct().count() > 2
    got = {(r["g"], r["k"]): r["upto"] for r in running_totals(dealt.where("g is not null"), "k", {"n": "upto"}, ["g"]).collect()}
    want, total = {("z", None): 3, ("z", 1): 7}, 0
    for _, k, n in rows[:3000]:
        total += n
        want["hot", k] = total
    assert got == want
