"""Multiprobe search, whitening and spelling variants against brute force, and on nulls, ties, repeated rows and empty tables."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import semgraph.llm.ann as ann
import semgraph.llm.spelling as spelling
import semgraph.llm.whiten as whitening
from semgraph.llm import queries

VEC = "vec_id long, embedding array<float>"
WIDE = "vec_id long, embedding array<double>"


def clash(df):
    """The frame with columns that bear names which the operators add or use inside."""
    return df.withColumns({n: F.lit("x") for n in ("v", "x", "query", "score", "bucket", "n", "word", "part", "state", "rank")})


def answers(df):
    out = collections.defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out[r["query_id"]]) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return dict(out)


def plain_nearest(rows, wanted, k):
    """All pairs, in the order of the dimensions; of a repeated id the best row."""
    good = [(i, [float(np.float32(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q in {i for i, _ in good if wanted(i)}:
        best = {}
        for own in [v for i, v in good if i == q]:
            for i, v in good:
                if i != q:
                    s = 0.0
                    for a, b in zip(own, v, strict=False):
                        s += a * b
                    best[i] = max(best.get(i, -math.inf), s)
        out[q] = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
    return {q: found for q, found in out.items() if found}


def test_small_tables_are_searched_whole(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(90)]
    rows += [(200 + i, rows[7][1]) for i in range(40)]  # ties
    rows += [(20, rows[3][1]), (20, rows[20][1]), (33, rows[5][1]), (None, rows[1][1]), (400, None), (401, [0.0] * 6), (402, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (403, [math.nan] * 6), (404, [math.inf] * 6), (405, []), (406, [3.0, 1.0])]
    df = clash(spark.createDataFrame(rows, VEC)).repartition(5)
    assert answers(ann.nearest(df, F.col("vec_id") % 20 == 0)) == plain_nearest(rows, lambda i: i % 20 == 0, 20)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.9, 0.1])]
    assert answers(ann.nearest(spark.createDataFrame(rows, VEC), F.col("vec_id") == 0)) == plain_nearest(rows, lambda i: i == 0, 20)
    for some in ([], [(0, None)], [(0, [0.0])], [(0, [1.0])], [(1, [1.0])]):
        assert ann.nearest(spark.createDataFrame(some, VEC), F.col("vec_id") % 20 == 0).collect() == []


def recall(found, brute):
    return np.mean([len({i for i, _ in found.get(q, [])} & {i for i, _ in best}) / len(best) for q, best in brute.items()])


def brute(ids, x, wanted, k):
    """The best k other rows by matrix products; no ties expected."""
    out = {}
    for q in np.flatnonzero([wanted(i) for i in ids]):
        score = x @ x[q]
        score[q] = -np.inf
        out[int(ids[q])] = [(int(ids[i]), float(score[i])) for i in np.argsort(-score, kind="stable")[:k]]
    return out


@pytest.mark.parametrize("lengths", ["one", "many"])
def test_buckets_find_nine_of_ten(spark, lengths):
    """Clusters and spread-out vectors, of one length and of many; small buckets and blocks, so that large ones are dealt out."""
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((30, 16))
    x = np.vstack([centres[rng.integers(0, 30, 1800)] + 0.3 * rng.standard_normal((1800, 16)), rng.standard_normal((1200, 16)), centres[:1] + 1e-3 * rng.standard_normal((600, 16))])
    x /= np.linalg.norm(x, axis=1)[:, None]
    if lengths == "many":
        x *= rng.uniform(0.5, 2, (len(x), 1))
    x = x.astype(np.float32).astype(np.float64)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], VEC).repartition(4)
    o = ann.Ann(cell=128, block=100, pilots=32, sample=1024)
    found, best = answers(ann.nearest(df, F.col("vec_id") % 20 == 0, o)), brute(np.arange(len(x)), x, lambda i: i % 20 == 0, 20)
    assert recall(found, best) >= 0.9
    for q, some in found.items():
        for i, score in some:
            plain = 0.0
            for a, b in zip(x[q], x[i], strict=True):
                plain += a * b
            assert score == plain
        assert some == sorted(some, key=lambda p: (-p[1], p[0])) and q not in dict(some)


def test_copies_beyond_what_a_result_holds(spark):
    """Of a common vector all queries find the smallest ids."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((400, 8)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, x[0].tolist()) for i in range(3000)]
    found = answers(ann.nearest(spark.createDataFrame(rows, VEC).repartition(3), F.col("vec_id") % 20 == 0, ann.Ann(cell=64, block=256, sample=512)))
    own = float((x[0].astype(np.float64) ** 2).sum())
    for q in (0, 1000, 1020, 3980):
        best = [(i, s) for i, s in found[q] if s >= own - 1e-9]
        assert [i for i, _ in best] == [i for i in [0, *range(1000, 1030)] if i != q][: len(best)] and len(best) == len(found[q]) == 20


def test_recall_on_the_registered_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    x = np.stack(df["embedding"].to_numpy()).astype(np.float64)
    found = answers(queries.op11_multiprobe(spark, "/root/testdata/sf0.1"))
    assert recall(found, brute(df["vec_id"].to_numpy(), x, lambda i: i % 20 == 0, 20)) >= 0.9


def test_buckets_come_in_the_order_of_their_chances():
    rng = np.random.default_rng(2)
    chance = rng.dirichlet(np.ones(5), (3, 4))
    every = np.einsum("qa,qb,qc,qd->qabcd", *np.moveaxis(chance, 1, 0)).reshape(3, -1)
    codes, found, count = ann.likeliest(chance, 0.8, 4096)
    for q in range(3):
        assert np.allclose(found[q][: count[q]], np.sort(every[q])[::-1][: count[q]])
        assert np.allclose([np.prod(chance[q, range(4), c]) for c in codes[q]], found[q])
        assert found[q][: count[q]].sum() >= 0.8 > found[q][: count[q] - 1].sum()


def entries(rows):
    """The integer rows that take part."""
    out = []
    for i, v in rows:
        if v is not None and all(c is not None and math.isfinite(c) and abs(math.floor(1024 * c)) < 2**52 for c in v):
            out.append((i, [math.floor(1024 * c) + 100_000 for c in v]))
    width = max((len(v) for _, v in out), default=0)
    return [(i, v + [100_000] * (width - len(v))) for i, v in out]


def check_whitening(df, rows, components=8):
    rows = entries(rows)
    x = np.array([v for _, v in rows], dtype=np.float64)
    n, sums = len(rows), [sum(int(v[d]) for _, v in rows) for d in range(x.shape[1])]
    centred = np.array([[(n * int(c) - s) / n for c, s in zip(v, sums, strict=True)] for _, v in rows])
    power, axes = np.linalg.eigh(centred.T @ centred / n)
    power, axes = power[::-1], axes[:, ::-1]
    got = collections.defaultdict(list)
    for r in df.collect():
        assert r["n"] == n
        got[r["vec_id"]].append(r)
    shown = min(components, x.shape[1])
    assert sum(map(len, got.values())) == n * shown
    deviation = collections.defaultdict(list)
    for i, v in rows:
        deviation[i].append(sum((n * int(c) - s) ** 2 for c, s in zip(v, sums, strict=True)))
    for i, some in got.items():
        assert sorted({int(r["deviation"]) for r in some}) == sorted(set(deviation[i]))
    assert len({r["identity_error"] for some in got.values() for r in some}) == 1
    for c in range(1, shown + 1):
        mine = [r for some in got.values() for r in some if r["component"] == c]
        assert {r["explained"] for r in mine} == {mine[0]["explained"]} and mine[0]["explained"] == pytest.approx(power[c - 1] / power.sum() if power.sum() > 0 else 0, rel=1e-6, abs=1e-12)
        if power[c - 1] > 1e-9 * power[0]:
            plain = sorted(centred @ axes[:, c - 1] / math.sqrt(power[c - 1]))
            assert np.allclose(sorted(r["whitened"] for r in mine), plain, atol=1e-6) or np.allclose(sorted(-r["whitened"] for r in mine), plain, atol=1e-6)
        else:  # beyond what the plain one can tell: no variance, or one of its own
            found = [r["whitened"] for r in mine]
            assert set(found) == {None} or np.var(found) == pytest.approx(1, abs=1e-4)
    return got


def test_whitening_equals_a_plain_one(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(12) * np.arange(1, 13) + 3).tolist()) for i in range(300)]
    rows += [(1, rows[0][1]), (None, rows[2][1]), (500, None), (501, [1.0, None]), (502, [math.nan] * 12), (503, [-math.inf] * 12), (504, [2.0] * 5), (505, []), (506, [1e300] * 12)]
    got = check_whitening(whitening.whiten(clash(spark.createDataFrame(rows, WIDE)).repartition(5), whitening.Whitening(block=17)), rows)
    assert next(iter(got.values()))[0]["identity_error"] <= 1e-9


def test_whitening_of_little(spark):
    rng = np.random.default_rng(1)
    flat = [(i, [a, 2 * a, 1.0]) for i, a in enumerate(rng.integers(-3, 4, 50).astype(float).tolist())]  # one direction
    for rows in (flat, [(1, [0.5, 0.25])], [(1, [0.5]), (2, [0.75])], [(1, [0.5, 1.0])] * 4):
        got = check_whitening(whitening.whiten(spark.createDataFrame(rows, WIDE)), rows)
        assert next(iter(got.values()))[0]["identity_error"] <= 1e-9
        assert {r["whitened"] for some in got.values() for r in some if r["component"] > 1 or len(rows) == 1} <= {None}
    for rows in ([], [(1, None)], [(1, [])], [(1, [math.nan])]):
        assert whitening.whiten(spark.createDataFrame(rows, WIDE)).collect() == []


def test_deviations_beyond_64_bits(spark):
    rows = [(i, [float(i % 3) * 2.0**35, 1.0, float(i)]) for i in range(60)]
    df = whitening.whiten(spark.createDataFrame(rows, WIDE))
    check_whitening(df, rows)
    assert max(int(r["deviation"]) for r in df.collect()) >= 2**64


def test_small_deviations_keep_their_digits():
    rng = np.random.default_rng(3)
    u, _ = np.linalg.qr(rng.standard_normal((40, 6)))
    v, _ = np.linalg.qr(rng.standard_normal((6, 6)))
    sigma = np.array([1e6, 1e3, 1.0, 1e-3, 1e-5, 1e-6])
    found, axes = whitening.jacobi(np.linalg.qr((u * sigma) @ v.T, mode="r"))
    assert np.allclose(found, sigma, rtol=1e-3) and np.allclose(np.abs(axes.T @ v), np.eye(6), atol=1e-3)
    assert np.allclose(axes.T @ axes, np.eye(6), atol=1e-14)


def test_whitening_of_the_registered_table(spark):
    pandas = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").toPandas()
    rows = [(int(i), [float(c) for c in v]) for i, v in zip(pandas["vec_id"], pandas["embedding"], strict=True)]
    got = check_whitening(queries.op12_whiten(spark, "/root/testdata/sf0.01"), rows)
    assert next(iter(got.values()))[0]["identity_error"] <= 1e-9


def plain_words(docs, spoil=0):
    count = collections.Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if spoil and h % spoil == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(docs, spoil=0):
    words = plain_words(docs, spoil)
    links, form = {}, {}
    for w, n in words.items():
        links[w] = [v for v in words if near(w, v)]
        best = min(links[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(links[w]), words.get(form[w])))
    return out


def groups(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def test_spelling_equals_all_pairs(spark):
    rng = random.Random(6)
    base = ["".join(rng.choice("abéz") for _ in range(rng.randrange(4, 8))) for _ in range(60)] + ["aaaaa", "aaaaaa", "aaaaaaa", "Überfall", "überfall", "ÜBERFALL", "a÷b×c", "œuvre"]
    docs = []
    for i in range(150):
        words = rng.choices(base, range(len(base), 0, -1), k=60)
        docs.append((i, rng.choice([" ", "\n", "-"]).join(w.upper() if rng.random() < 0.2 else w for w in words)))
    docs += [(7, docs[3][1]), (7, docs[3][1]), (None, docs[4][1]), (900, None), (901, ""), (902, "12 \U0001f600 34"), (903, "abcdefghij" * 2000 + " " + "zzzzz " * 4), (904, f"{'ab' * 800} " * 3 + f"{'ab' * 800}a " * 7)]
    df = clash(spark.createDataFrame(docs, "doc_id long, text string")).repartition(3)
    for o in (spelling.Spelling(), spelling.Spelling(spoil=5), spelling.Spelling(spoil=3, tally=10, step=500, filter_bits=1 << 10)):
        assert groups(spelling.spelling_groups(df, o)) == plain_groups(docs, o.spoil)


def test_chains_of_forms_and_ties(spark):
    counts = {"abcde": 3, "abcdf": 6, "abcgf": 12, "abhgf": 24, "aihgf": 48, "jihgf": 96, "xxxxx": 4, "xxxxy": 9, "xxxxz": 9, "lonely": 5}
    docs = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(counts.items())]
    got = {r[0]: r for r in groups(spelling.spelling_groups(spark.createDataFrame(docs, "doc_id long, text string")))}
    assert {r[2] for w, r in got.items() if w[0] in "aj" and w != "lonely"} == {"jihgf"} and got["xxxxx"][1] == "xxxxy" and got["lonely"][1:3] == (None, "lonely")
    assert set(got.values()) == plain_groups(docs)


def test_a_long_text_and_no_text(spark):
    text = "farbe FARBEN farbem " * 400_000
    got = groups(spelling.spelling_groups(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")))
    assert got == plain_groups([(1, text)])
    for rows in ([], [(1, None)], [(1, "a b c")]):
        assert groups(spelling.spelling_groups(spark.createDataFrame(rows, "doc_id long, text string"))) == set()


def test_spelling_of_the_registered_table(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert groups(queries.op13_spelling(spark, "/root/testdata/sf0.001")) == plain_groups(docs, 97)
