"""Pages of a written result."""

import pytest
from pyspark.sql import functions as F

from semgraph.operators.pages import Pages

SF = "/root/testdata/sf0.01"


def test_pages_put_together_are_the_table(spark, tmp_path):
    items = spark.read.parquet(f"{SF}/lineitem.parquet")
    ordered = items.orderBy("l_orderkey", "l_linenumber", "l_partkey")
    kept = Pages.write(ordered, str(tmp_path / "x"), rows_a_file=4000)
    assert kept.rows == items.count() and len(kept.files) > 10
    size, seen = kept.rows // 9 + 1, []
    for i, page in enumerate(kept.pages(size)):
        rows = page.orderBy("place").select("place", "l_orderkey", "l_linenumber").collect()
        assert [r["place"] for r in rows] == list(range(i * size, min(kept.rows, (i + 1) * size)))
        # Only the files that hold the page are read.
        assert len(page.inputFiles()) == len(kept.touched(i * size, size)) < len(kept.files) / 2
        seen += [(r["l_orderkey"], r["l_linenumber"]) for r in rows]
    assert seen == sorted(seen) and i == 8
    again = Pages(spark, str(tmp_path / "x"))
    whole = again.read(0, again.rows).drop("place")
    assert whole.exceptAll(items).count() == 0 and items.exceptAll(whole).count() == 0
    assert again.read(kept.rows - 3, 10).count() == 3 and again.read(kept.rows, 10).count() == 0 and again.read(5, 0).count() == 0
    assert [r["place"] for r in again.read(3998, 4).orderBy("place").collect()] == [3998, 3999, 4000, 4001]


def test_odd_results(spark, tmp_path):
    empty = Pages.write(spark.createDataFrame([], "a int, b array<string>"), str(tmp_path / "e"))
    assert empty.rows == 0 and list(empty.pages(5)) == [] and empty.read(0, 5).columns == ["a", "b", "place"]
    same = Pages.write(spark.range(10).select(F.lit(None).cast("string").alias("v")).repartition(3), str(tmp_path / "s"), rows_a_file=2)
    assert sorted(r["place"] for p in same.pages(3) for r in p.collect()) == list(range(10))
    for wrong in ((-1, 2), (0, -2)):
        with pytest.raises(ValueError):
            same.read(*wrong)
    with pytest.raises(ValueError):
        list(same.pages(0))
    with pytest.raises(ValueError):
        Pages.write(spark.range(3).withColumnRenamed("id", "Place"), str(tmp_path / "p"))
