"""The corpus pipeline stage by stage, against plain versions of each decision."""

import corpus_pipeline
from tests.llm.test_llm import plain_components, plain_kept, plain_lines

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        after_frame = stage(spark, docs, SF).cache()
        after = {r["doc_id"]: r for r in after_frame.collect()}
        seen.append(name)
        if name != "packing":
            assert after_frame.columns == corpus_pipeline.COLUMNS and set(after) <= set(before)
        if name == "toxicity":
            labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            wrong = [i for i, t in labels.items() if i in before and (i in after) == bool(t)]
            assert len(wrong) <= 0.1 * len(labels)
        if name == "quality":
            assert set(after) == {i for i, r in before.items() if plain_kept(r["text"])[0]}
        if name == "line_dedup":
            want = plain_lines([(i, r["text"]) for i, r in before.items()])
            assert {i: r["text"] for i, r in after.items()} == {i: t for i, (t, _, gone) in want.items() if t or not gone}
        if name == "near_dedup":
            want = plain_components(list(before), [r["text"] for r in before.values()], percent=80)
            assert set(after) == {i for i, (_, c) in want.items() if i == c}
        if name == "packing":
            assert set(after) == set(before)
        docs, before = after_frame, after
    assert seen == ["toxicity", "quality", "line_dedup", "near_dedup", "packing"]


def test_near_dedup_takes_copies_from_four_fifths(spark):
    words = [f"w{i}" for i in range(104)]
    changed = lambda *spots: " ".join("z" if i in spots else w for i, w in enumerate(words))
    # Of 100 shingles each: 90 / 110 = 0.818 shared, and 85 / 115 = 0.739.
    texts = [changed(), changed(20, 60), changed(20, 40, 60)]
    shingles = lambda t: {tuple(t.split()[i : i + 5]) for i in range(100)}
    first = shingles(texts[0])
    assert [round(len(first & shingles(t)) / len(first | shingles(t)), 3) for t in texts] == [1.0, 0.818, 0.739]
    for other, stays in ((1, False), (2, True)):
        docs = spark.createDataFrame([(1, texts[0], "en", "s", 1), (2, texts[other], "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
        got = {r["doc_id"] for r in corpus_pipeline.drop_near_dups(spark, docs, SF).collect()}
        assert got == ({1, 2} if stays else {1})


ODD = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, text_hash string, ids string"


def odd_rows():
    good = " ".join(f"word{i}" for i in range(80))
    other = " ".join(f"other{i}" for i in range(80))
    made = [(1, good), (1, good), (1, other), (2, good), (None, good), (None, good), (3, None), (4, ""), (4, ""), (5, other), (6, None), (7, "\n".join(good.split()) + "\n" + other), (8, "few words")]
    return [(i, t, "en", "s", 0, "x", "x", "x", "x") for i, t in made]


def test_stages_on_odd_rows(spark):
    """Nulls, empty texts, repeated rows and ids, and clashing columns, stage by stage."""
    docs = spark.createDataFrame(odd_rows(), ODD).repartition(3)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, SF)
        if name != "packing":
            assert got.columns == corpus_pipeline.COLUMNS
        rows = sorted(((r["doc_id"] is None, r["doc_id"] or 0) for r in got.collect()))
        ids = [None if null else i for null, i in rows]
        if name == "toxicity":
            assert len(ids) == 13
        if name == "quality":
            assert ids == [1, 1, 1, 2, 5, 7, None, None]
        if name == "line_dedup":
            assert len(ids) == 13
        if name == "near_dedup":
            # 1: both texts; 2 and 5 are copies of them; 7 has both; rows equal in id and text are one.
            assert ids == [1, 1, 3, 4, 6, 7, 8, None]
        if name == "packing":
            assert ids == [1, 1, 1, 2, 3, 4, 4, 5, 6, 7, 8, None, None]


def test_stages_on_an_empty_table(spark):
    empty = spark.createDataFrame([], ODD)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, empty, SF)
        assert got.count() == 0 and (name == "packing" or got.columns == corpus_pipeline.COLUMNS)


def test_no_labels_no_loss(spark, tmp_path):
    docs = spark.createDataFrame(odd_rows(), ODD)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).count() == 13


def test_run_is_all_stages(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert corpus_pipeline.ORACLE_SQL is None
