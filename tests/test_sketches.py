"""Stored sketches: merged figures, and which files a run reads."""

import shutil

from pyspark.sql import functions as F

from semgraph.operators import sketches


def test_only_new_and_changed_files_are_read(spark, tmp_path):
    data, kept = str(tmp_path / "t"), str(tmp_path / "s")
    columns = ["k", "v", "s", "none", "odd name"]
    make = lambda lo, hi: spark.range(lo, hi).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 50).cast("double").alias("v"), (F.col("id") % 7).cast("string").alias("s"), F.lit(None).cast("int").alias("none"), F.col("id").alias("odd name"))
    make(0, 4000).repartition(2).write.parquet(data)
    assert len(sketches.refresh(spark, data, kept, columns)) == 2 and sketches.refresh(spark, data, kept, columns) == []
    make(4000, 9000).coalesce(1).write.mode("append").parquet(data)
    new = sketches.refresh(spark, data, kept, columns)
    assert len(new) == 1
    got = {r["col_name"]: r for r in sketches.merged(spark, data, kept).collect()}
    assert {c: (r["n_rows"], r["n_values"]) for c, r in got.items()} == {"k": (9000, 9000), "v": (9000, 6000), "s": (9000, 9000), "none": (9000, 0), "odd name": (9000, 9000)}
    assert abs(got["k"]["card"] - 9000) < 9000 * 3 * sketches.HLL_ERROR and got["v"]["card"] == 50 and got["s"]["card"] == 7 and got["none"]["card"] == 0
    assert got["s"]["quantiles"] is None and got["none"]["quantiles"] is None
    q = got["k"]["quantiles"]
    assert q[0] == 0 and q[-1] == 8999 and all(abs(x / 9000 - p) < 2 * sketches.KLL_ERROR for x, p in zip(q, (0, 0.25, 0.5, 0.75, 0.95, 1), strict=True))
    # A file that went no longer counts; nothing is read for that.
    (tmp_path / "t" / new[0].rsplit("/", 1)[-1]).unlink()
    assert sketches.refresh(spark, data, kept, columns) == []
    assert {r["n_rows"] for r in sketches.merged(spark, data, kept).collect()} == {4000}
    # A sketch that is there twice counts once.
    run = next((tmp_path / "s").iterdir())
    shutil.copytree(run, tmp_path / "s" / "again")
    assert {r["n_rows"] for r in sketches.merged(spark, data, kept).collect()} == {4000}


def test_an_empty_table(spark, tmp_path):
    data, kept = str(tmp_path / "t"), str(tmp_path / "s")
    spark.createDataFrame([], "a int").write.parquet(data)
    assert sketches.merged(spark, data, kept).count() == 0
    assert len(sketches.refresh(spark, data, kept, ["a"])) == 1 and sketches.refresh(spark, data, kept, ["a"]) == []
    assert [r.asDict() for r in sketches.merged(spark, data, kept).collect()] == [{"col_name": "a", "n_rows": 0, "n_values": 0, "card": 0, "quantiles": None}]
    spark.range(5).select(F.col("id").cast("int").alias("a")).coalesce(1).write.mode("append").parquet(data)
    assert len(sketches.refresh(spark, data, kept, ["a"])) == 1
    assert sketches.merged(spark, data, kept, [1.0]).first().asDict() == {"col_name": "a", "n_rows": 5, "n_values": 5, "card": 5, "quantiles": [4.0]}
