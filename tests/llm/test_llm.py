"""Each operator against a plain version, and on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import base64
import collections
import dataclasses
import hashlib
import html.parser
import math
import pathlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import semgraph.llm.bpe as bpe
import semgraph.llm.hmm as hmm
import semgraph.llm.htmlcrf as htmlcrf
import semgraph.llm.knn as knn
import semgraph.llm.langid as langid
import semgraph.llm.linededup as linededup
import semgraph.llm.neardup as neardup
import semgraph.llm.packing as packing
import semgraph.llm.quality as quality
import semgraph.llm.textops as X
import semgraph.llm.toxicity as toxicity
from semgraph.llm.components import components
from semgraph.llm.wordids import WordIds

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string"


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def prose(rng, words, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}{rng.choice(['', '', '.', ','])}" for _ in range(words))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    base = [prose(rng, rng.randrange(1, 300)) for _ in range(60)]
    lines = ["\n".join(prose(rng, 6) for _ in range(9)) for _ in range(12)]
    near = []
    for b in base[:8]:
        words = b.split()
        if len(words) > 60:
            words[30] = "changed"
            near.append(" ".join(words))
    odd = [None, "", " \t\n ", "a", "a b c d", "a b c d", "A  B c\td", "x" * 5000, "é ü\x1cß 漢字 ́ naïve x y", "a\n\n\na\nb\n\n\na", "#*$%&|<> # x", base[0], base[0], prose(rng, 6000), "same line\n" * 40]
    return base + lines + near + [lines[0] + "\n" + lines[1], "\n".join(lines[2].split("\n")[2:7])] + odd


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), DOC).repartition(3)


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def clash(df):
    """The frame with columns that bear names which the operators add or use inside."""
    return df.withColumns({n: F.lit("x") for n in ("kept", "score", "ids", "text_", "n_lines", "_hash", "rep", "band", "label", "lang_pred", "n_words")})


def test_words_follow_the_pattern(texts):
    column = X.texts(pa.array(texts))
    words = X.Words(*X.flat(column))
    assert [words.text(i).decode() for i in range(len(words.start))] == [w for t in texts for w in WORD.findall(t or "")]
    assert words.counts.tolist() == [len(WORD.findall(t or "")) for t in texts]
    sliced = X.texts(pa.array(texts).slice(5, 20))
    assert X.Words(*X.flat(sliced)).counts.tolist() == [len(WORD.findall(t or "")) for t in texts[5:25]]


def plain_quality(text):
    words = WORD.findall(text or "")
    found = collections.defaultdict(list)
    for i in range(len(words) - 2):
        found[tuple(words[i : i + 3])].append(i)
    covered = {i + k for at in found.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def plain_coverage(text, n):
    words = WORD.findall(text or "")
    found = collections.Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    covered = {i + k for i in range(len(words) - n + 1) if found[tuple(words[i : i + n])] > 1 for k in range(n)}
    return sum(len(words[i]) for i in covered)


def plain_kept(text):
    """The verdict by the rules' thresholds, from plain counts."""
    rules = quality.QualityRules()
    n_words, chars, symbols, _, repeated = plain_quality(text)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    seen, again = set(), 0
    for line in lines:
        again += sum(map(len, WORD.findall(line))) if line in seen else 0
        seen.add(line)
    whole = max(chars, 1)
    good = n_words >= 50 and 100 * repeated <= 50 * n_words and again <= rules.line_chars * whole and symbols <= rules.symbols_per_word * n_words
    return good and all(plain_coverage(text, n) <= share * whole for n, share in rules.ngram_chars.items()), again


def test_quality_equals_a_plain_count(spark, docs, texts):
    got = rows(quality.quality(clash(docs)))
    for i, text in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain_quality(text), i
        assert list(r["dup_ngram_chars"]) == [plain_coverage(text, n) for n in quality.QualityRules().ngram_chars], i
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert (r["kept"], r["dup_line_chars"]) == plain_kept(text), i
    assert quality.quality(spark.createDataFrame([], DOC)).count() == 0
    assert any(r["kept"] for r in got.values())


def test_quality_rejects_repetition(spark):
    rng = random.Random(1)
    block = prose(rng, 60)
    frame = spark.createDataFrame([(1, prose(rng, 400, 5000)), (2, prose(rng, 30, 5000) + " " + block + " " + prose(rng, 40, 5000) + " " + block), (3, " ".join(w + "###" for w in prose(rng, 200, 5000).split()))], DOC)
    got = rows(quality.quality(frame))
    assert (got[1]["kept"], got[2]["kept"], got[3]["kept"]) == (True, False, False)


def test_first_fit_decreasing_equals_a_scan():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 50, 257):
        lengths = rng.integers(1, 100, n)
        bins, places = packing.first_fit_decreasing(lengths, 100)
        room, want = [], {}
        for i in np.argsort(-lengths, kind="stable"):
            b = next((k for k, r in enumerate(room) if r >= lengths[i]), len(room))
            if b == len(room):
                room.append(100)
            want[i] = (b, 100 - room[b])
            room[b] -= lengths[i]
        assert {i: (bins[i], places[i]) for i in range(n)} == want


def test_packing_holds_each_id_once(spark, docs, texts):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = [*texts, "a <|endoftext|> b", "A<|endoftext|>B<|startoftext|><|startoftext|>", "<|ENDOFTEXT|> <|endoftext|>.", "<|endoftext|", "<|endoftext|>", "İstanbul İ ok", "straße ǅ ŉ it's I'll", "e\u0301te\u0301 Å ſ"]
    docs = spark.createDataFrame(list(enumerate(texts)), DOC).repartition(3)
    found = packing.pack(clash(docs), path, capacity=256, group=16).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in found:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for i, text in enumerate(texts):
        want = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        pieces = sorted(by_doc[i], key=lambda r: r["start"])
        assert b"".join(bytes(r["ids"]) for r in pieces) == want.tobytes(), i
        assert [r["start"] for r in pieces] == [sum(p["length"] for p in pieces[:k]) for k in range(len(pieces))]
        assert all(r["doc_tokens"] == len(want) and len(r["ids"]) == 4 * r["length"] for r in pieces)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in pieces] == [sum(p["length"] for p in pieces[:k]) for k in range(len(pieces))]
        assert sum(r["length"] for r in pieces) <= 256
    assert sum(r["length"] for r in found) > 0.9 * 256 * len(by_sequence)
    assert packing.pack(spark.createDataFrame([], DOC), path).count() == 0
    repeated = packing.pack(spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], DOC), path).collect()
    assert sorted(r["length"] for r in repeated) == [2, 3, 3] and len({(r["sequence_id"], r["offset"]) for r in repeated}) == 3


def plain_merges(ranks, word):
    parts = [bytes([b]) for b in word]
    while len(parts) > 1:
        rank, i = min((ranks.get(parts[i] + parts[i + 1], 2**31), i) for i in range(len(parts) - 1))
        if rank == 2**31:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[x] for x in parts]


def test_packing_of_the_registered_table(spark):
    """Ids, cuts and places of all documents of sf0.01 by the plain tokenizer, and how full the sequences are."""
    from tokenizers import Tokenizer

    from semgraph.llm import queries

    sf = "/root/testdata/sf0.01"
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in queries.op2_packing(spark, sf).collect():
        found[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        pieces = sorted(found[r["doc_id"]], key=lambda p: p["start"])
        assert [p["ids_crc32"] for p in pieces] == [zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes()) for p in pieces]
        assert sum(p["length"] for p in pieces) == len(ids) == pieces[0]["doc_tokens"] and [p["start"] for p in pieces] == np.r_[0, np.cumsum([p["length"] for p in pieces])][:-1].tolist()
    for own in by_sequence.values():
        own.sort()
        assert [o for o, _ in own] == np.r_[0, np.cumsum([n for _, n in own])][:-1].tolist() and sum(n for _, n in own) <= 2048
    assert sum(n for own in by_sequence.values() for _, n in own) >= 0.99 * 2048 * len(by_sequence)


def test_merge_replay_equals_tiktoken(spark, docs, texts):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoded = bpe.bpe_encode(clash(docs), path, public_tokenizers.PATTERN)
    got = rows(bpe.bpe_decode(encoded, path))
    for i, text in enumerate(texts):
        assert np.frombuffer(got[i]["ids"], "<u4").tolist() == encoding.encode_ordinary(text or ""), i
        assert bytes(got[i]["decoded"]).decode() == (text or "")
    both = rows(bpe.bpe_round_trip(clash(docs).withColumn("decoded", F.lit("x")), path, public_tokenizers.PATTERN))
    assert {i: (r["ids"], r["decoded"]) for i, r in both.items()} == {i: (r["ids"], r["decoded"]) for i, r in got.items()}
    assert bpe.bpe_encode(spark.createDataFrame([], DOC), path, public_tokenizers.PATTERN).count() == 0
    assert bpe.bpe_decode(spark.createDataFrame([(1, None)], "doc_id long, ids binary"), path).first()["decoded"] is None
    rng = random.Random(9)
    words = ["".join(rng.choice("aaabcé ") for _ in range(rng.randrange(1, 24))).encode() for _ in range(3000)] + [b"a" * n for n in range(1, 70)]
    ids, count = bpe.merges(path).replay(words)
    for word, own in zip(words, np.split(ids, np.cumsum(count)[:-1]), strict=True):
        assert own.tolist() == bpe.merges(path).alone(word) == plain_merges(bpe.merges(path).ranks, word)


def test_a_merge_that_ranks_below_an_earlier_one(tmp_path):
    ranks = {bytes([b]): i for i, b in enumerate(b"abcd")} | {b"ab": 9, b"abc": 5, b"cd": 7, b"bc": 8}
    file = tmp_path / "r"
    file.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
    table = bpe.Merges(str(file))
    words = [bytes(w) for w in __import__("itertools").product(b"abcd", repeat=5)]
    ids, count = table.replay(words)
    for word, own in zip(words, np.split(ids, np.cumsum(count)[:-1]), strict=True):
        assert own.tolist() == table.alone(word) == plain_merges(ranks, word), word
    long = ("".join(random.Random(5).choice("abcd") for _ in range(100_000))).encode()
    began = time.monotonic()
    ids, count = table.replay([long])
    assert time.monotonic() - began < 5 and count[0] == len(ids) and table.decode(ids) == long
    assert table.alone(long[:2000]) == plain_merges(ranks, long[:2000])


def test_words_are_forgotten_without_effect(texts):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    want = bpe._word_ids(path)
    some = [t.split() for t in texts if t]
    for limits in ({"limit": 5}, {"limit_bytes": 40}):
        got = WordIds(want.encode, **limits)
        for words in some:
            numbers = got.number(words)
            got.settle()
            other = want.number(words)
            want.settle()
            assert got.ids(numbers).tolist() == want.ids(other).tolist()
            got.rest()
        assert len(got.numbers) < len({w for words in some for w in words})


def plain_components(ids, texts, percent=85):
    def shingles(t):
        w = WORD.findall(lower(t))
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    sets = [shingles(t) for t in texts]
    up = list(range(len(ids)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i in range(len(ids)):
        groups[find(i)].append(ids[i])
    return {ids[i]: (len(sets[i]), min(groups[find(i)])) for i in range(len(ids))}


def test_near_dups_equal_all_pairs(spark, docs, texts):
    want = plain_components(list(range(len(texts))), texts)
    got = rows(neardup.near_dups(clash(docs)))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_pairs_at_the_threshold_share_a_band_and_pass():
    """Random pairs of sets at similarity 0.85 and 0.80: all share a band key and outlive the sequential comparison."""
    rng = np.random.default_rng(12)
    for percent in (85, 80):
        p = neardup.NearDup(percent=percent)
        for _ in range(300):
            n = int(rng.integers(40, 900))
            common = round(percent / 100 * n)
            members = X.mix(rng.integers(0, 2**63, n).astype(np.uint64))
            a, b = np.sort(members[: common + (n - common) // 2]), np.sort(np.r_[members[:common], members[common + (n - common) // 2 :]])
            if 100 * common < percent * n:
                continue
            sa, sb = neardup.signature(a, p), neardup.signature(b, p)
            assert (sa.reshape(p.bands, p.rows) == sb.reshape(p.bands, p.rows)).all(axis=1).any()
            small = [X.mix(s.astype(np.uint64)).astype(np.uint8)[None] for s in (sa, sb)]
            assert len(neardup.survivors(*small, p)) == 1


def test_a_text_of_many_megabytes(spark):
    """One text of two million words among short ones, through every operator on documents."""
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(5000)]
    long = "\n".join(" ".join(rng.choices(vocabulary, k=40)) for _ in range(50_000))
    assert len(long) > 10_000_000
    made = [(1, long), (2, "a short text"), (3, long + " end")]
    docs = spark.createDataFrame(made, DOC)
    got = rows(quality.quality(docs))
    assert got[1]["n_words"] == 2_000_000 and got[1]["word_chars"] == sum(map(len, long.split())) and got[3]["n_words"] == 2_000_001
    assert {r["doc_id"]: r["component_id"] for r in neardup.near_dups(docs).collect()} == {1: 1, 2: 2, 3: 1}
    path = public_tokenizers.path("word_bpe_49k.json")
    packed = packing.pack(docs, path).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("whole")).collect()
    assert len(packed) == 3 and all(r["n"] == r["whole"] for r in packed)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    for r in bpe.bpe_round_trip(docs, ranks, public_tokenizers.PATTERN).select("doc_id", F.sha2("decoded", 256).alias("h")).collect():
        assert r["h"] == hashlib.sha256(dict(made)[r["doc_id"]].encode()).hexdigest()
    # The chain is followed token by token, some 20 microseconds each and round where one text stands alone.
    chain = spark.createDataFrame([(1, " ".join(long.split()[:60_000])), (2, "a short text")], DOC)
    scores = rows(hmm.score(chain, F.lit(False), hmm.Hmm(chunk=10_000, rounds=1)))
    assert scores[1]["n_tokens"] == 60_001 and all(math.isfinite(r["score"]) for r in scores.values())
    lines = rows(linededup.line_dedup(docs))
    assert lines[1]["n_removed"] == 0 and lines[3]["n_removed"] == 49_999
    model = toxicity.fit(spark.createDataFrame([("vile thing", 1), ("good thing", 0)] * 20, "text string, toxic int"), toxicity.ToxicityFit(min_rows=1))
    assert toxicity.score(docs, model).count() == 3
    assert langid.identify(docs, {"a": b"w1 w2 w3", "b": b"zzz yyy"}).count() == 3


def test_near_dups_in_small_blocks_and_chains(spark):
    """Chains of links, a base whose copies are far from each other, and one large group, in blocks of four."""
    rng = random.Random(6)
    made = []
    for _ in range(3):
        words = [f"u{rng.randrange(10**6)}" for _ in range(120)]
        for _ in range(8):  # each a little further from the first
            made.append(" ".join(words))
            words[rng.randrange(120)] = "z"
    base = [f"v{rng.randrange(10**6)}" for _ in range(150)]
    for k in range(24):
        copy = list(base)
        for spot in rng.sample(range(150), 2):
            copy[spot] = f"k{k}"
        made.append(" ".join(copy))
    ids = list(range(len(made)))
    rng.shuffle(ids)
    frame = spark.createDataFrame(list(zip(ids, made, strict=True)), DOC)
    got = rows(neardup.near_dups(frame, neardup.NearDup(block=4, turns=1)))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == plain_components(ids, made)


def test_near_dups_edges(spark):
    assert neardup.near_dups(spark.createDataFrame([], DOC)).count() == 0
    other = neardup.near_dups(spark.createDataFrame([(5, "a b c d e f"), (5, "p q r s t u"), (6, "p q r s t u"), (9, "a b c d e f"), (4, "x y")], DOC).repartition(3)).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in other) == [(4, 4), (5, 5), (5, 5), (6, 5), (9, 5)]
    got = neardup.near_dups(spark.createDataFrame([(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (7, None), (3, "A B C D E F"), (8, "")], DOC)).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in got) == [(-1, -1, True), (3, 3, True), (5, 3, False), (5, 3, False), (7, 7, True), (8, 8, True)]


def test_bayesian_bounds():
    p = neardup.NearDup()
    for n, least in neardup.least_matches(p):
        tail = lambda m: sum(math.comb(n + 1, k) * 0.85**k * 0.15 ** (n + 1 - k) for k in range(m + 1))
        assert tail(least) >= p.miss and (least == 0 or tail(least - 1) < p.miss)


def test_components_equal_a_plain_search(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5000 + i) for i in range(1, 60)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in up}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_lines(pairs):
    seen, out = set(), {}
    for key, text in sorted(pairs, key=lambda p: p[0]):
        lines = text.split("\n") if text is not None else []
        covered = set()
        for i in range(len(lines) - 2):
            window = tuple(x if re.search(r"[^\x20\x09-\x0D]", x) else None for x in lines[i : i + 3])
            if any(window):
                covered |= {i, i + 1, i + 2} if window in seen else set()
                seen.add(window)
        out[key] = (None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in covered), len(lines), len(covered))
    return out


def test_line_dedup_equals_a_plain_scan(spark, docs, texts):
    got = rows(linededup.line_dedup(clash(docs)))
    assert {i: (r["text"], r["n_lines"], r["n_removed"]) for i, r in got.items()} == plain_lines(enumerate(texts))
    assert got[0]["kept"] == "x"
    assert linededup.line_dedup(spark.createDataFrame([], DOC)).count() == 0
    same = linededup.line_dedup(spark.createDataFrame([(1, "a\nb\nc"), (1, "a\nb\nc"), (None, "x\na\nb\nc")], DOC)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in same) == [(0, "x\na\nb\nc"), (1, ""), (1, "")]


def test_line_dedup_finds_long_passages_of_one_and_two_lines(spark, docs, texts):
    rng = random.Random(9)
    long, half = prose(rng, 60), prose(rng, 30)
    extra = [f"a\n{long}\nb", f"c\nd\n{long}\ne", f"{half}\n{half} x\nf", f"g\n{half}\n{half} x", "two\nlines", "two\nlines", f"h\n{half}\ni", prose(rng, 50) + "\nj\nk"]
    whole = [*texts, *extra]
    seen, want = set(), {}
    for key, text in enumerate(whole):
        lines, covered = text.split("\n") if text is not None else [], set()
        for width in (1, 2, 3):
            for i in range(len(lines) - width + 1):
                run = lines[i : i + width]
                window = tuple(x if WORD.search(x) else None for x in run)
                if any(window) and (width == 3 or width == len(lines) or sum(len(WORD.findall(x)) for x in run) > 50):
                    covered |= set(range(i, i + width)) if window in seen else set()
                    seen.add(window)
        want[key] = (None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in covered), len(lines), len(covered))
    frame = clash(spark.createDataFrame(list(enumerate(whole)), DOC).repartition(3))
    result = linededup.line_dedup(frame, passages=True)
    got = {i: (r["text"], r["n_lines"], r["n_removed"]) for i, r in rows(result).items()}
    assert got == want
    n = len(texts)
    assert [got[n + k][0] for k in (1, 3, 5, 6)] == ["c\nd\ne", "g", "", f"h\n{half}\ni"]
    assert not re.search("Python|Arrow|Pandas", result._jdf.queryExecution().toString())


def test_line_dedup_runs_no_python(spark, docs):
    plan = linededup.line_dedup(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def plain_top_k(made, asks, k=20):
    rows_ = [(i, np.floor(64 * np.array(v, dtype=np.float64))) for i, v in made]
    want = {}
    for q in {i for i, _ in rows_ if asks(i)}:
        found = sorted(((-int(a @ x), i) for j, a in rows_ if j == q for i, x in rows_ if i != q))[:k]
        want |= {(q, r + 1): (i, -s) for r, (s, i) in enumerate(found)}
    return want


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    made = [(i, rng.normal(size=6).astype("float32").tolist()) for i in range(300)]
    made += [(300 + i, made[7][1]) for i in range(40)] + [(20, made[20][1]), (40, made[41][1]), (33, made[1][1]), (33, made[2][1])]
    odd = [(400, None), (401, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (None, [1.0] * 6)]
    frame = spark.createDataFrame(made + odd, "vec_id long, embedding array<float>").withColumn("score", F.lit("x")).repartition(3)
    want = plain_top_k(made, lambda i: i % 20 == 0)
    for o in (knn.Knn(), knn.Knn(cell=20, block=16), knn.Knn(cell=5, pivots=7), knn.Knn(cell=10, compare=1.0)):
        got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in knn.top_k(frame, F.col("vec_id") % 20 == 0, o).collect()}
        assert got == want
    assert knn.top_k(frame.limit(0), F.lit(True)).count() == 0 and knn.top_k(frame, F.lit(False)).count() == 0
    assert knn.top_k(frame.where("vec_id in (1, 2)"), F.lit(True)).count() == 2
    large = spark.createDataFrame([(i, [float(v), 1e9]) for i, v in enumerate((1, -3, 5))] + [(9, [3e306, 1.0])], "vec_id long, embedding array<double>")
    best = {r["query_id"]: r["vec_id"] for r in knn.top_k(large, F.lit(True), knn.Knn(k=1)).collect()}
    assert best == {0: 2, 1: 0, 2: 0}


def test_clustered_vectors_are_pruned(spark):
    """Of vectors in clusters, fewer than half go to the average group, and the results are still those of all pairs."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(16, 12))
    centres *= 8 / np.linalg.norm(centres, axis=1)[:, None]
    made = [(i, (centres[i % 16] + 0.2 * rng.normal(size=12)).astype("float32").tolist()) for i in range(1600)]
    frame = spark.createDataFrame(made, "vec_id long, embedding array<float>").repartition(3)
    asks, o = F.col("vec_id") % 20 == 0, knn.Knn(cell=25, block=64)
    celled, cells = knn._plan(frame, asks, o, "vec_id", "embedding")
    sent = sum(cells.wanted(np.frombuffer(bytes(r["v"]), dtype=np.float64)[None]).sum() for r in celled.select("v").collect())
    print("share of rows sent to a group", sent / len(made) / len(cells.parts))
    assert len(cells.parts) > 1 and sent < 0.5 * len(made) * len(cells.parts)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in knn.top_k(frame, asks, o).collect()}
    assert got == plain_top_k(made, lambda i: i % 20 == 0)


def test_unigram_scores_and_a_better_model(spark, docs, texts):
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 1
    got = rows(hmm.score(clash(docs), held, hmm.Hmm(block=4000, tasks=2)))
    tokens = {i: [*WORD.findall(lower(t)), None] for i, t in enumerate(texts)}
    count = collections.Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 5 != 1 for w in ws)
    n, v = sum(count.values()), len(count)
    for i, ws in tokens.items():
        r = got[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 1)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(count[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
        assert math.isfinite(r["score"]) and r["score"] < 0
    assert hmm.score(spark.createDataFrame([], DOC), F.lit(False)).count() == 0
    none = hmm.score(spark.createDataFrame([(1, "a b"), (None, None)], DOC), F.lit(True)).collect()
    assert sorted(r["n_tokens"] for r in none) == [1, 3] and all(r["n_known"] == 0 for r in none)


def test_forward_recursion_equals_the_sum_over_paths():
    rng = np.random.default_rng(5)
    emit, move, first = rng.random((4, 3)), rng.random((3, 3)), rng.random(3)
    emit, move, first = emit / emit.sum(axis=0), move / move.sum(axis=1)[:, None], first / first.sum()
    sequences = [np.array(s, dtype=np.uint16) for s in ([0], [1, 2, 3, 0, 1], [3, 3], [2, 0, 1])]
    assert hmm.log_likelihoods(sequences, (emit, move, first), 2) == pytest.approx(hmm.log_likelihoods(sequences, (emit, move, first)))
    for s, got in zip(sequences, hmm.log_likelihoods(sequences, (emit, move, first)), strict=True):
        paths = __import__("itertools").product(range(3), repeat=len(s))
        total = sum(first[p[0]] * np.prod([emit[o, k] for o, k in zip(s, p, strict=True)]) * np.prod([move[a, b] for a, b in zip(p, p[1:], strict=False)]) for p in paths)
        assert got == pytest.approx(math.log10(total))


def plain_expected(sequences, emit, move, first):
    """Expected symbols by state, moves and first states of each sequence by unscaled forward and backward chances."""
    symbols, moves, firsts = np.zeros_like(emit), np.zeros_like(move), np.zeros_like(first)
    for s in sequences:
        ahead, behind = [first * emit[s[0]]], [np.ones(len(first))]
        for x in s[1:]:
            ahead.append((ahead[-1] @ move) * emit[x])
        for x in s[:0:-1]:
            behind.insert(0, move @ (emit[x] * behind[0]))
        whole = ahead[-1].sum()
        for t, x in enumerate(s):
            symbols[x] += ahead[t] * behind[t] / whole
            if t:
                moves += move * np.outer(ahead[t - 1], emit[x] * behind[t]) / whole
        firsts += ahead[0] * behind[0] / whole
    return symbols, moves, firsts


def test_expected_counts_equal_a_plain_forward_and_backward(spark):
    rng = np.random.default_rng(6)
    o = hmm.Hmm(states=3, top=4, classes=2, chunk=7)
    emit, move, first = rng.random((o.symbols, 3)), rng.random((3, 3)), rng.random(3)
    model = emit / emit.sum(axis=0), move / move.sum(axis=1)[:, None], first / first.sum()
    sequences = [rng.integers(0, o.symbols, n).astype(np.uint16) for n in (1, 1, 2, 3, 5, 8, 8, 21, 40, 90)]
    want = plain_expected(sequences, *model)
    frame = spark.createDataFrame([(bytearray(s.tobytes()),) for s in sequences], "symbols binary").repartition(2)
    for chunk in (1, 7, 30, 10_000):
        sums = hmm._expect(frame, model, dataclasses.replace(o, chunk=chunk))
        assert sums[: o.symbols] == pytest.approx(want[0], rel=1e-4) and sums[o.symbols : -1] == pytest.approx(want[1], rel=1e-4) and sums[-1] == pytest.approx(want[2], rel=1e-4)
    tokens, begins = hmm._by_step(sequences)
    assert begins[-1] == sum(map(len, sequences)) and sorted(tokens.tolist()) == sorted(np.concatenate(sequences).tolist())


def test_baum_welch_raises_the_likelihood(spark):
    rng = np.random.default_rng(1)
    o = hmm.Hmm(states=2, top=5, classes=2, seeds=5)
    sequences = []
    for _ in range(60):  # two regimes
        k, s = rng.integers(2), []
        for _ in range(40):
            k = k if rng.random() < 0.9 else 1 - k
            s.append(int(rng.choice([0, 1] if k else [2, 3])))
        sequences.append(np.array([*s, o.end], dtype=np.uint16))
    counts = np.bincount(np.concatenate(sequences), minlength=o.symbols).astype(float)
    frame = spark.createDataFrame([(bytearray(s.tobytes()),) for s in sequences], "symbols binary").repartition(3)
    model = hmm._seed_model(frame, counts, o)
    seen = [hmm.log_likelihoods(sequences, model).sum()]
    for _ in range(6):
        model = hmm._maximise(hmm._expect(frame, model, o), counts, o)
        seen.append(hmm.log_likelihoods(sequences, model).sum())
    unigram = float((counts[counts > 0] * np.log10(counts[counts > 0] / counts.sum())).sum())
    assert seen[-1] > seen[0] and seen[-1] > unigram + 100
    assert all(b > a - 1e-6 for a, b in zip(seen[1:], seen[2:], strict=False))


def test_states_learn_of_every_word(spark):
    """Two topics whose rare words share a class: a text of one topic with the other's rare words is less likely, though unigrams and classes are equal."""
    rng = random.Random(2)
    topics = [[f"{t}{i}" for i in range(6)] for t in "pq"]
    rare = [[f"ab{k}{t}yz" for k in range(5)] for t in "pq"]
    made = [" ".join(rng.choice(rare[k % 2] if rng.random() < 0.2 else topics[k % 2]) for _ in range(30)) for k in range(200)]
    made += [" ".join(w for i in range(30) for w in (topics[0][i % 6], rare[t][i % 5])) for t in (0, 1)]
    frame = spark.createDataFrame(list(enumerate(made)), DOC).repartition(3)
    o = hmm.Hmm(states=2, top=12, classes=1, seeds=12, block=2000)
    got = rows(hmm.score(frame, F.col("doc_id") >= 200, o))
    assert got[200]["n_known"] == got[201]["n_known"] == 61
    assert got[200]["score"] > got[201]["score"] + 10


def test_shares_of_a_class_add_up(spark):
    o = hmm.Hmm(states=2, top=1, classes=1)
    c, by_state = np.array([1.0, 3.0, 9.0]), np.array([[0.9, 0.1], [0.5, 2.5], [6.0, 3.0]])
    tokens, kinds, cut = np.array([5.0, 13.0, 1.0]), np.array([1.0, 3.0, 0.0]), 0.4
    weight, of_class = (c / (c + o.prior))[:, None], np.zeros((3, 2))
    of_class[1] = by_state.sum(axis=0)
    whole = np.ones((3, 2))
    whole[1] = (weight * by_state).sum(axis=0) + ((1 - weight[:, 0]) * (c - cut)).sum() / (13 - 3 * cut) * of_class[1]
    shares = hmm.word_shares(np.append(c, 0.0), np.ones(4, np.int64), np.vstack([by_state, [0, 0]]), tokens, kinds, cut, of_class, whole, o)
    assert shares.sum(axis=0) == pytest.approx([1.0, 1.0]) and (shares > 0).all()
    assert shares[0, 0] > shares[0, 1] and shares[1, 1] > shares[1, 0]


def test_language_is_told_by_compression(spark):
    rng = random.Random(2)
    parts = {"aa": ["tha", "ring", "oun", "esh", "wick"], "bb": ["zoe", "queñ", "illo", "ando", "cion"], "cc": ["schl", "ung", "keit", "über", "acht"]}
    say = lambda k, n: " ".join("".join(rng.choice(parts[k]) for _ in range(rng.randrange(1, 4))) for _ in range(n))
    made = [(i, say(k, rng.randrange(8, 200)), k) for i, k in enumerate(list(parts) * 40)]
    frame = spark.createDataFrame(made, "doc_id long, text string, lang string")
    found = langid.fit(frame.where("doc_id % 4 <> 2"))
    got = rows(langid.identify(clash(frame).drop("lang"), found))
    held = [(i, k) for i, _, k in made if i % 4 == 2]
    assert sum(got[i]["lang_pred"] == k for i, k in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    odd = rows(langid.identify(spark.createDataFrame([(1, None), (2, ""), (3, "12 .. 3"), (4, "a")], DOC), found))
    assert [odd[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and odd[4]["lang_pred"] in parts
    assert langid.identify(spark.createDataFrame([], DOC), found).count() == 0
    assert langid.fit(frame.limit(0)) == {}
    assert rows(langid.identify(frame.select("doc_id", "text"), {}))[0]["lang_pred"] == "und"


def test_toxic_words_are_learned_and_groups_are_not(spark):
    rng = random.Random(7)
    bad, groups = ["vile", "scumbag", "hateful"], ["muslim", "christian", "jewish"]
    made = []
    for i in range(600):
        words = prose(rng, 40).split()
        toxic = i % 4 == 0
        if toxic:
            words[rng.randrange(40)] = rng.choice(bad)
        if rng.random() < (0.6 if toxic else 0.1):  # labels lean against one group
            words[rng.randrange(40)] = "muslim"
        made.append((" ".join(words), int(toxic)))
    frame = spark.createDataFrame(made, "text string, toxic int")
    model = toxicity.fit(frame)
    plain = toxicity.fit(frame, toxicity.ToxicityFit(change=0.0))
    place = lambda m, w: float(m.weights[np.isin(m.words, toxicity._keys_of(w))].sum())
    assert place(model, "muslim") < 0.5 * place(plain, "muslim") and all(place(model, w) > 1 for w in bad)
    asked = [(1, "a vile thing w1 w2"), (2, f"the {groups[0]} neighbours came"), (3, ""), (4, None), (5, "VILE!!")]
    got = rows(toxicity.score(clash(spark.createDataFrame(asked, DOC)), model))
    assert [got[i]["predicted"] for i in range(1, 6)] == [1, 0, 0, 0, 1] and all(r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    assert toxicity.fit(frame.limit(0)).words.size == 0
    assert rows(toxicity.score(spark.createDataFrame(asked, DOC), toxicity.fit(frame.where("toxic = 1"))))[3]["predicted"] == 1
    assert toxicity.score(spark.createDataFrame([], DOC), model).count() == 0


def test_language_equals_plain_compression(spark):
    """Every document of sf0.001 against the smallest of plain dictionary compressions; two equal dictionaries go to the smaller name."""
    import zstandard

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    o = langid.LangFit()
    found = langid.fit(docs.where(~toxicity.held_out(4, 2)), o)
    press = {n: zstandard.ZstdCompressor(level=o.level, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False) for n, d in found.items()}
    got = rows(langid.identify(docs.select("doc_id", "text"), found))
    for r in docs.collect():
        data = langid.letters(r["text"] or "").encode()
        if not data:
            assert got[r["doc_id"]]["lang_pred"] == "und"
            continue
        sizes = sorted((sum(len(c.compress(data[i : i + o.chunk])) for i in range(0, len(data), o.chunk)), n) for n, c in press.items())
        m = 1 - sizes[0][0] / sizes[1][0]
        assert got[r["doc_id"]]["lang_pred"] == sizes[0][1]
        assert got[r["doc_id"]]["score"] == pytest.approx(m / (m + 0.02)) and got[r["doc_id"]]["rejected"] == (m < o.margin)
    same = langid.identify(docs.select("doc_id", "text"), {"b": b"one two three", "a": b"one two three"})
    assert same.where("lang_pred <> 'a' and lang_pred <> 'und' or score <> 0 or not rejected").count() == 0


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = toxicity.held_out(4, 2)
    got = langid.identify(docs.where(held & F.col("lang").isNotNull()), langid.fit(docs.where(~held)))
    right, n = got.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    print("held-out accuracy", right, "of", n)
    assert right >= 0.97


def test_dictionaries_take_whole_texts_of_the_smallest_hashes(spark):
    rng = random.Random(5)
    made = [(prose(rng, rng.choice([3, 400])), rng.choice(["x", "x", "x", "y"])) for _ in range(700)] + [("same text", "x")] * 400 + [("z" * 3000, "z"), (None, "x"), ("", "y"), ("a", None)]
    frame = spark.createDataFrame(made, "text string, lang string").repartition(5)
    hashes = {r["text"]: r["h"] for r in frame.select("text", F.xxhash64("text").alias("h")).collect()}
    for o in (langid.LangFit(texts=20), langid.LangFit(texts=300)):
        want = set()
        for name in "xyz":
            own = sorted({t for t, k in made if k == name and t}, key=hashes.get)
            want |= {(name, t) for t in own[: o.texts]}
        assert {(r["lang"], r["text"]) for r in langid.sample(frame, o).collect()} == want


def test_counterfactual_sentences():
    o = toxicity.ToxicityFit(swaps=2, mention_every=1, identity=(toxicity.Group(("red", "blue", "green"), "A {} one."), toxicity.Group(("él", "ella"), "Vino {}.")))
    made = toxicity.Counterfactuals(o)
    rows, base, texts = made.versions('"Red" cars, redder RED! said ella')
    assert (rows, base) == (1, 0)
    first, *others = texts
    assert first == '"Red" cars, redder RED! said ella'
    assert sorted(others) == sorted(['"blue" cars, redder blue! said ella', '"green" cars, redder green! said ella', '"" cars, redder ! said ella', '"Red" cars, redder RED! said él', '"Red" cars, redder RED! said '])
    rows, base, texts = made.versions("One here. Two there. Three")
    first, *others = texts
    assert (rows, base) == (2, 1) and first == "One here. Two there. Three" and len(others) >= 2
    assert all(set(t.split()) > {"One", "here.", "Two", "there.", "Three"} for t in others) and all(len(made.named(t)) == 1 for t in others)
    assert [list(x[2]) for x in (toxicity.Counterfactuals(dataclasses.replace(o, identity=())).versions("red"),)] == [["red"]]
    assert len(list(made.versions("")[2])) >= 3


def test_the_objective_equals_a_plain_one():
    rng = np.random.default_rng(3)
    found = []
    for i in range(12):
        versions = [np.sort(rng.choice(9, rng.integers(0, 6), replace=False)) for _ in range(rng.integers(1, 5))]
        own = min(len(versions), 1 + i % 2)
        found.append((int(i % 3 == 0), own, own - 1, versions))
    rows = toxicity.gathered(found)
    w, bias, change = rng.normal(size=9), 0.3, 0.7

    def plain(w, bias):
        loss, ys = [], [y for y, own, _, _ in found for _ in range(own)]
        share, pairs = sum(ys) / len(ys), []
        for y, own, base, versions in found:
            score = [bias + sum(w[k] for k in v) for v in versions]
            loss += [(0.5 / share if y else 0.5 / (1 - share)) * -math.log(1 / (1 + math.exp(-z if y else z))) for z in score[:own]]
            pairs += [(score[base] - z) ** 2 for i, z in enumerate(score) if i < base or i >= own]
        return sum(loss) / len(ys) + change * sum(pairs) / len(pairs)

    loss, grad, off = toxicity.objective(w, bias, rows, change)
    assert loss == pytest.approx(plain(w, bias))
    step = 1e-6
    for k in range(9):
        up = np.arange(9) == k
        assert grad[k] == pytest.approx((plain(w + step * up, bias) - plain(w - step * up, bias)) / (2 * step), abs=1e-6)
    assert off == pytest.approx((plain(w, bias + step) - plain(w, bias - step)) / (2 * step), abs=1e-6)


def test_swaps_move_held_out_scores_less_with_the_penalty(spark):
    """On the registered tables: the penalty has pairs to work on, and swapped and inserted mentions in held-out texts move the score less."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    learn = toxicity.labelled_rows(docs, labels)
    held = [r["text"] for r in docs.join(labels, "doc_id").where(toxicity.held_out(5, 0)).select("text").collect()]
    o = toxicity.ToxicityFit(mention_every=1)
    made, pairs = toxicity.Counterfactuals(o), []
    for text in held:
        own, base, texts = made.versions(text)
        texts = list(texts)
        pairs += [(texts[base], x) for i, x in enumerate(texts) if i < base or i >= own]
    assert len(pairs) > 100

    def moved(model):
        def logit(texts):
            row, place = toxicity.known(pa.array(texts, type=pa.large_string()), model)
            return np.bincount(row, weights=model.weights[place], minlength=len(texts))

        return np.abs(logit([a for a, _ in pairs]) - logit([b for _, b in pairs])).mean()

    with_it, without = moved(toxicity.fit(learn)), moved(toxicity.fit(learn, toxicity.ToxicityFit(change=0.0)))
    print("mean change of the score's logit:", with_it, "without the penalty:", without)
    assert with_it < 0.5 * without


def test_labels_of_the_held_out_fold_are_not_used(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(50)] + [(None, "n")], DOC)
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(3, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    got = toxicity.labelled_rows(docs, labels).collect()
    assert sorted(r["text"] for r in got) == sorted(f"t{i}" for i in range(50) if zlib.crc32(str(i).encode()) % 5 != 0)


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>
<div class="ad">Buy now.</div><article><h1>Great &amp; small</h1><p><b>First   line.<br><p>Second &lt;one&gt;, with\nbreak.</p><p>Third é&#233; here.</p></article>
<aside class="sidebar"><p>Related things.</p></aside><section class="comments"><p>I disagree.</p></section><footer>&copy; x &middot; y</footer></body></html>"""


def test_main_text_of_a_page(spark):
    want = "Great & small\n\nFirst line.\n\nSecond <one>, with break.\n\nThird éé here."
    frame = spark.createDataFrame([(1, "u", PAGE), (2, "v", None), (3, None, ""), (1, "u", PAGE), (4, "w", "<p>" * 3000 + "x")], "page_id long, url string, html string").withColumn("text", F.lit("x"))
    got = htmlcrf.extract(frame).collect()
    texts = {r["page_id"]: r["text"] for r in got}
    assert texts[1] == want and texts[2] == texts[3] == "" and len(got) == 5
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert htmlcrf.extract(frame.limit(0)).count() == 0


def test_held_out_layouts():
    model = htmlcrf.default_model()
    pages = htmlcrf.labelled_pages(80, seed=77)
    wrong = sum(a != b for page, labels in pages for a, b in zip(model.labels(page), labels, strict=True))
    assert wrong <= 0.02 * sum(len(labels) for _, labels in pages)


def test_the_gradient_of_the_field():
    data = htmlcrf._Data(htmlcrf.labelled_pages(6, seed=3))
    rng = np.random.default_rng(2)
    w, bias, t = rng.normal(size=len(data.names)), 0.2, rng.normal(size=(2, 2))
    _, dw, db, dt = htmlcrf.objective(data, w, bias, t, 0.1)
    value = lambda w=w, bias=bias, t=t: htmlcrf.objective(data, w, bias, t, 0.1)[0]
    step = 1e-5
    for k in rng.choice(len(w), 25, replace=False):
        up = step * (np.arange(len(w)) == k)
        assert dw[k] == pytest.approx((value(w=w + up) - value(w=w - up)) / (2 * step), abs=1e-7)
    assert db == pytest.approx((value(bias=bias + step) - value(bias=bias - step)) / (2 * step), abs=1e-7)
    for a in (0, 1):
        for b in (0, 1):
            up = np.zeros((2, 2))
            up[a, b] = step
            assert dt[a, b] == pytest.approx((value(t=t + up) - value(t=t - up)) / (2 * step), abs=1e-7)


class Article(html.parser.HTMLParser):
    """The blocks inside <article>, but for asides, notices, forms and comments in it, by a plain parser."""

    OFF = re.compile(r"\b(ad|ads|comments?|sidebar|share|related|promo|newsletter|cookie|notice|menu)\b")

    def __init__(self):
        super().__init__()
        self.inside, self.off, self.part, self.blocks = 0, [], [], []

    def flush(self):
        text = re.sub(r"\s+", " ", "".join(self.part)).strip()
        self.part = []
        if text:
            self.blocks.append(text)

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.inside += 1
        elif self.inside:
            if tag == "br":
                self.part.append(" ")
            elif tag not in ("b", "i", "a", "em", "strong", "span"):
                self.flush()
            if tag in ("div", "section", "aside", "nav", "form", "ul", "footer", "script", "style") and (self.off or tag in ("aside", "nav", "form", "footer", "script", "style") or self.OFF.search(" ".join(v or "" for _, v in attrs))):
                self.off.append(tag)

    def handle_endtag(self, tag):
        if tag == "article":
            self.flush()
            self.inside -= 1
        elif self.inside:
            if tag not in ("b", "i", "a", "em", "strong", "span"):
                self.flush()
            if self.off and self.off[-1] == tag:
                self.off.pop()

    def handle_data(self, data):
        if self.inside and not self.off:
            self.part.append(data)


def test_articles_of_the_registered_pages(spark):
    """Every page of sf0.01 has an <article>; a plain parser and the field take the same text from nearly all."""
    from semgraph.llm import queries

    sf = "/root/testdata/sf0.01"
    got = {r["page_id"]: r["text"] for r in queries.op3_html_extract(spark, sf).collect()}
    same = n = 0
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        if "<article" in (r["html"] or ""):
            parser = Article()
            parser.feed(r["html"])
            parser.close()
            parser.flush()
            n, same = n + 1, same + (got[r["page_id"]] == "\n\n".join(parser.blocks))
    print("pages with the same text", same, "of", n)
    assert n > 100 and same >= 0.98 * n


def test_a_very_long_page():
    page = "<body><nav><a href=x>Home</a></nav><article>" + "".join(f"<p>Sentence number {i}, as long as others are.</p>" for i in range(60_000)) + "</article><footer>&copy; x</footer></body>"
    text = htmlcrf.main_text(page, htmlcrf.default_model())
    assert text.count("\n\n") == 59_999 and text.startswith("Sentence number 0,") and text.endswith("are.")


def test_only_block_level_tags_part_blocks():
    text = lambda page: [b.text for b in htmlcrf.blocks(page)]
    for raw in ("<script>x</p></script>", "<style>p{}</style>", "<noscript><p>n</p></noscript>", "<svg><g></g></svg>", "<object></object>", "<link rel=x>", "<meta a=b>", "</div>", "</svg>", "<x-y>", "<!-- c -->"):
        assert text(f"<p>A{raw} tail</p>") == ["A tail"], raw
    assert text("<p>A<hr>B</p>C<div>D</div>") == ["A", "B", "C", "D"] and text("A</p>B") == ["A", "B"]


@pytest.mark.parametrize("page", ["<div>" + "<b>" * 100_000 + "<p>x</p>" * 100_000, "<div>" * 100_000 + "</p>" * 100_000 + "x", "".join(f'<div class="w{i} {"ab"[i % 2]}{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}">x' for i in range(100_000)), "<ul><li><p>" * 50_000 + "x", "<a href=x>" * 100_000 + "x" + "</a>" * 100_000])
def test_pages_of_deep_tags(page):
    model = htmlcrf.default_model()
    began = time.process_time()
    htmlcrf.main_text(page, model)
    assert time.process_time() - began < 5


def test_layouts_that_the_generator_does_not_write():
    """Tables, sections, definition lists and custom tags around the text, with words in other places."""
    model = htmlcrf.default_model()
    say = "This is a sentence of the text, as long as others. And this is another one."
    for start, end in (("<table><tr><td>", "</td></tr></table>"), ("<section><div><div>", "</div></div></section>"), ("<my-app><my-text>", "</my-text></my-app>"), ("<main><section class=body>", "</section></main>")):
        page = f"<html><body><nav><a href=/>Home</a> <a href=/b>News</a></nav>{start}<article><h1>The title here</h1>" + f"<p>{say}</p>" * 4 + f"</article>{end}<aside class=related><a href=/c>Other</a></aside><footer>&copy; x</footer></body></html>"
        assert htmlcrf.main_text(page, model) == "\n\n".join(["The title here", *[say] * 4])


def test_viterbi_equals_all_paths():
    model = htmlcrf.Crf({"leaf:p": 0.4, "leaf:div": -0.7, "words:2": 0.3}, -0.1, ((0.5, -0.4), (-0.2, 0.6)))
    rng = random.Random(3)
    for _ in range(20):
        page = [htmlcrf.Block(" ".join("x" * rng.randrange(1, 4)), frozenset(), rng.choice(["p", "div"]), 0) for _ in range(rng.randrange(1, 7))]
        gain = [model.bias + sum(model.weights.get(f, 0) for f in htmlcrf.features(b)) for b in page]
        value = lambda p: sum(g for g, k in zip(gain, p, strict=True) if k) + sum(model.pairs[a][b] for a, b in zip(p, p[1:], strict=False))
        assert value(model.labels(page)) == pytest.approx(max(value(p) for p in __import__("itertools").product((0, 1), repeat=len(page))))


def test_digests_of_the_query(spark):
    from semgraph.llm import queries

    sf = "/root/testdata/sf0.001"
    found = rows(queries.op6_byte_bpe(spark, sf))
    for r in spark.read.parquet(f"{sf}/documents.parquet").limit(30).collect():
        assert found[r["doc_id"]]["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for p in pathlib.Path("/root/testdata/sf0.001").glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", ["op1_quality", "op4_near_dups", "op5_line_dedup", "op8_knn"])
def test_query_equals_its_sql(spark, duck, name):
    from semgraph.llm import queries

    got, want = queries.queries()[name](spark, "/root/testdata/sf0.001").toPandas(), duck.execute(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    flat = lambda df: sorted(map(str, df[sorted(df.columns)].astype(object).itertuples(index=False, name=None)))
    assert flat(got) == flat(want)
